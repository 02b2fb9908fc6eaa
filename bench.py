"""Benchmark the headline workloads; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

  enrich_count      stage + two-role enrichment of the dirty line batch, every cell  (B1 B8 B9 C1 C2)
  freeze            write the enriched line batch once to the lake                  (I4)
  gate_full         seven rules over the frozen batch, one action                   (G1-G13)
  gate_samples      samples + alert for the failed rules of the frozen batch        (G14 G15 D1)
  fault_<mode>      exact seeded fault on the clean order batch, every cell            (E1-E4 D2)
  run_clean         land -> stage -> freeze -> gate -> test -> publish (orders)     (I1-I5)
  run_blocked       the same on the dirty line batch, blocked at the gate           (I1-I4)
Each workload is timed warm (median of BENCH_REPEAT runs, default 3) after one cold run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from auditlane.operators import faults, gate, rules  # noqa: E402
from auditlane.plans import bindings as b  # noqa: E402
from auditlane.plans import flow, registry  # noqa: E402
from auditlane.session import build_session, ensure_lake_root  # noqa: E402
from auditlane.sources.lake import Lake  # noqa: E402


def timed(fn, repeat: int) -> tuple[float, float]:
    t0 = time.perf_counter()
    fn()
    cold = time.perf_counter() - t0
    warm = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        warm.append(time.perf_counter() - t0)
    return cold, statistics.median(warm) if warm else cold


def build_workloads(spark, sf_dir: str, root: str) -> list:
    """(name, callable) pairs; each callable runs one workload to completion."""
    lake = Lake(spark, f"{root}/bench")
    suite_line = registry.line_suite()
    enriched = registry.enriched_lines(spark, sf_dir)
    frozen_holder: dict = {}

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def do_freeze():
        frozen_holder["df"] = flow.freeze(lake, registry.enriched_lines(spark, sf_dir))

    def do_gate():
        gate.evaluate(frozen_holder["df"], suite_line, model=registry.MODEL,
                      suite=rules.TRIPS_SUITE_NAME).collect()

    def do_samples():
        df = frozen_holder["df"]
        results = gate.evaluate(df, rules.trips_suite(), model=registry.MODEL, suite=rules.TRIPS_SUITE_NAME)
        rows = results.collect()
        failed = [r["rule_id"] for r in rows if not r["success"]]
        frozen_results = spark.createDataFrame(rows, results.schema)
        gate.build_alert(frozen_results, gate.offender_samples(df, rules.trips_suite(), failed)).collect()

    def do_fault(mode):
        return lambda: noop(faults.apply_fault(b.order_trips(spark, sf_dir), mode))

    def do_run(kind):
        def go():
            run_lake = Lake(spark, f"{root}/bench-run-{kind}-{time.time_ns()}")
            if kind == "clean":
                r = flow.run(spark, b.order_trips(spark, sf_dir), b.nation_zones(spark, sf_dir),
                             suite=registry.order_suite(), lake=run_lake)
                assert r.outcome == flow.Outcome.PUBLISHED, r.error
            else:
                r = flow.run(spark, b.line_trips(spark, sf_dir), b.nation_zones(spark, sf_dir),
                             suite=suite_line, lake=run_lake)
                assert r.outcome == flow.Outcome.BLOCKED, r.error
        return go

    return [
        ("enrich_count", lambda: noop(enriched)),
        ("freeze", do_freeze),
        ("gate_full", do_gate),
        ("gate_samples", do_samples),
        ("fault_null_flood", do_fault("null_flood")),
        ("fault_dup_pk", do_fault("dup_pk")),
        ("fault_negative_values", do_fault("negative_values")),
        ("run_clean", do_run("clean")),
        ("run_blocked", do_run("blocked")),
    ]


def session(cpus: int, extra: dict | None = None):
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    conf.update(extra or {})
    return build_session(master=f"local[{cpus}]", app_name="auditlane-bench",
                         shuffle_partitions=max(cpus, 8), extra_conf=conf)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = session(cpus)
    root = ensure_lake_root(spark)
    warm, cold = {}, {}
    for name, fn in build_workloads(spark, sf_dir, root):
        c, w = timed(fn, repeat)
        cold[name], warm[name] = round(c, 3), round(w, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    out = {
        "metric": "sum_of_warm_median_seconds",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
