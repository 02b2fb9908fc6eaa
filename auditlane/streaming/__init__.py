"""The gate applied to each micro-batch of a stream of raw trip files."""

from auditlane.streaming.gated_stream import batch_handler, gate_stream, repeated_keys, stream_alerts, stream_mart, stream_outcomes

__all__ = ["batch_handler", "gate_stream", "repeated_keys", "stream_alerts", "stream_mart", "stream_outcomes"]
