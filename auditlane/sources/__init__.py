"""Lake storage (versioned snapshots), CSV sources, landing, and result/alert sinks."""
