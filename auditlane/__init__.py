"""auditlane: write-audit-publish batch pipelines with a declarative quality gate, on Spark.

Layout
------
functions/  Column-returning helpers (safe division, second-boundary durations, casts, "missing").
operators/  DataFrame -> DataFrame building blocks: staging, role-playing lookups, rules,
            the gate, exact seeded selection, fault injection and post-publish data tests.
sources/    Lake layout: versioned snapshots, CSV scans, landing, result and alert sinks.
plans/      Test-table bindings, publish step, the staged run with outcome codes, and the
            registry of queries checked against SQL.
streaming/  The same gate applied to each micro-batch of a stream.
"""

__version__ = "0.1.0"
