"""SQL text for the oracle side of every registered query (DuckDB dialect, ANSI where possible).

Written from the same definitions as the Spark code (bindings, contracts, rule semantics),
as CTE builders so each registered query can be stated in a few lines.
"""

from __future__ import annotations

# -- bindings ---------------------------------------------------------------------------

PAYMENT_SQL = "CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 WHEN 'P' THEN 3 END AS BIGINT)"

LINE_RAW = f"""
SELECT l.l_orderkey * 10 + l.l_linenumber AS trip_id,
       l.l_suppkey % 2 + 1 AS vendor_id,
       o.o_orderdate AS pickup_datetime,
       l.l_shipdate AS dropoff_datetime,
       CAST(l.l_linenumber AS BIGINT) AS passenger_count,
       l.l_quantity AS trip_distance,
       CAST(c.c_nationkey AS BIGINT) AS pickup_location_id,
       CAST(s.s_nationkey AS BIGINT) AS dropoff_location_id,
       l.l_extendedprice AS fare_amount,
       l.l_extendedprice * l.l_discount AS tip_amount,
       l.l_extendedprice * (1 - l.l_discount) * (1 + l.l_tax) AS total_amount,
       {PAYMENT_SQL} AS payment_type
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""

ORDER_RAW = f"""
SELECT o.o_orderkey AS trip_id,
       o.o_custkey % 2 + 1 AS vendor_id,
       o.o_orderdate AS pickup_datetime,
       o.o_orderdate + to_minutes(CAST(o.o_orderkey % 60 + 1 AS BIGINT)) AS dropoff_datetime,
       o.o_orderkey % 4 + 1 AS passenger_count,
       CAST(o.o_custkey % 50 + 1 AS DOUBLE) AS trip_distance,
       CAST(c.c_nationkey AS BIGINT) AS pickup_location_id,
       CAST((c.c_nationkey + 7) % 25 AS BIGINT) AS dropoff_location_id,
       o.o_totalprice AS fare_amount,
       CAST(0.0 AS DOUBLE) AS tip_amount,
       o.o_totalprice AS total_amount,
       {PAYMENT_SQL} AS payment_type
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
"""


def zones_raw(drop_region: str | None = None) -> str:
    where = f"WHERE r.r_name <> '{drop_region}'" if drop_region else ""
    return f"""
SELECT CAST(n.n_nationkey AS BIGINT) AS location_id, r.r_name AS borough, n.n_name AS zone
FROM nation n JOIN (SELECT * FROM region r {where}) r ON n.n_regionkey = r.r_regionkey
"""


def stg_trips(raw: str) -> str:
    return f"""
SELECT CAST(trip_id AS BIGINT) AS trip_id,
       CAST(vendor_id AS INTEGER) AS vendor_id,
       CAST(pickup_datetime AS TIMESTAMP) AS pickup_at,
       CAST(dropoff_datetime AS TIMESTAMP) AS dropoff_at,
       CAST(passenger_count AS INTEGER) AS passenger_count,
       CAST(trip_distance AS DOUBLE) AS trip_distance_miles,
       CAST(pickup_location_id AS INTEGER) AS pickup_location_id,
       CAST(dropoff_location_id AS INTEGER) AS dropoff_location_id,
       CAST(fare_amount AS DOUBLE) AS fare_amount,
       CAST(tip_amount AS DOUBLE) AS tip_amount,
       CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(payment_type AS INTEGER) AS payment_type
FROM ({raw}) raw
"""


def stg_zones(raw: str) -> str:
    return f"""
SELECT CAST(location_id AS INTEGER) AS location_id,
       CAST(borough AS VARCHAR) AS borough,
       CAST(zone AS VARCHAR) AS zone
FROM ({raw}) raw
"""


ENRICHED_SELECT = """
SELECT t.trip_id, t.vendor_id, t.pickup_at, t.dropoff_at, t.passenger_count,
       t.trip_distance_miles, t.fare_amount, t.tip_amount, t.total_amount, t.payment_type,
       t.pickup_location_id, t.dropoff_location_id,
       pz.borough AS pickup_borough, pz.zone AS pickup_zone,
       dz.borough AS dropoff_borough, dz.zone AS dropoff_zone,
       CAST(date_diff('second', t.pickup_at, t.dropoff_at) AS DOUBLE) / 60.0 AS trip_duration_minutes,
       CASE WHEN t.trip_distance_miles IS NULL OR t.trip_distance_miles = 0 THEN NULL
            ELSE t.fare_amount * 1.0 / t.trip_distance_miles END AS fare_per_mile
"""


def enriched(raw_trips: str, raw_zones: str) -> str:
    return f"""{ENRICHED_SELECT}
FROM ({stg_trips(raw_trips)}) t
LEFT JOIN ({stg_zones(raw_zones)}) pz ON t.pickup_location_id = pz.location_id
LEFT JOIN ({stg_zones(raw_zones)}) dz ON t.dropoff_location_id = dz.location_id
"""


def line_enriched(drop_region: str | None = None) -> str:
    return enriched(LINE_RAW, zones_raw(drop_region))


def order_enriched() -> str:
    return enriched(ORDER_RAW, zones_raw())


# -- rules ------------------------------------------------------------------------------

def _missing(col: str, floating: bool) -> str:
    return f"({col} IS NULL OR isnan({col}))" if floating else f"({col} IS NULL)"


FLOATING = {"fare_amount", "trip_distance_miles", "trip_duration_minutes", "tip_amount",
            "total_amount", "fare_per_mile"}


def suite_rules(fare_max: float, distance_max: float = 500.0, passenger_max: float = 8,
                mostly: float = 0.98) -> list[tuple]:
    """(index, rule_id, kind, column, mostly, lo, hi) -- mirrors ``rules.trips_suite``."""
    return [
        (0, "trip_id_not_null", "not_null", "trip_id", 1.0, None, None),
        (1, "trip_id_unique", "unique", "trip_id", 1.0, None, None),
        (2, "fare_amount_not_null", "not_null", "fare_amount", mostly, None, None),
        (3, "fare_amount_between", "between", "fare_amount", mostly, 0, fare_max),
        (4, "trip_distance_miles_between", "between", "trip_distance_miles", mostly, 0, distance_max),
        (5, "passenger_count_between", "between", "passenger_count", mostly, 0, passenger_max),
        (6, "trip_duration_minutes_not_null", "not_null", "trip_duration_minutes", mostly, None, None),
    ]


TYPE_NAME = {
    "not_null": "expect_column_values_to_not_be_null",
    "unique": "expect_column_values_to_be_unique",
    "between": "expect_column_values_to_be_between",
    "min_rows": "expect_table_row_count_to_be_between",
}


def _lit(v) -> str:
    return "NULL" if v is None else repr(float(v))


def rule_metrics(batch_sql: str, rules: list[tuple]) -> str:
    """Rows (rule_index, rule_id, rule_type, column, mostly, element_count, missing_count,
    evaluated_count, unexpected_count) -- one per rule."""
    selects = []
    for idx, rid, kind, col, mostly, lo, hi in rules:
        miss = _missing(col, col in FLOATING)
        head = f"{idx} AS rule_index, '{rid}' AS rule_id, '{TYPE_NAME[kind]}' AS rule_type, " \
               f"'{col}' AS \"column\", CAST({float(mostly)!r} AS DOUBLE) AS mostly"
        if kind == "min_rows":
            selects.append(f"""SELECT {head}, count(*) AS element_count, CAST(0 AS BIGINT) AS missing_count,
  CAST(1 AS BIGINT) AS evaluated_count, CAST(CASE WHEN count(*) >= {lo} THEN 0 ELSE 1 END AS BIGINT) AS unexpected_count FROM batch""")
        elif kind == "not_null":
            selects.append(f"""SELECT {head}, count(*) AS element_count,
  count(*) FILTER (WHERE {miss}) AS missing_count, count(*) AS evaluated_count,
  count(*) FILTER (WHERE {miss}) AS unexpected_count FROM batch""")
        elif kind == "between":
            conds = []
            if lo is not None:
                conds.append(f"{col} >= {_lit(lo)}")
            if hi is not None:
                conds.append(f"{col} <= {_lit(hi)}")
            inside = " AND ".join(conds) or "TRUE"
            selects.append(f"""SELECT {head}, count(*) AS element_count,
  count(*) FILTER (WHERE {miss}) AS missing_count,
  count(*) FILTER (WHERE NOT {miss}) AS evaluated_count,
  count(*) FILTER (WHERE NOT {miss} AND NOT ({inside})) AS unexpected_count FROM batch""")
        else:
            kmiss = _missing("k", col in FLOATING)
            selects.append(f"""SELECT {head},
  CAST(coalesce(sum(c), 0) AS BIGINT) AS element_count,
  CAST(coalesce(sum(c) FILTER (WHERE {kmiss}), 0) AS BIGINT) AS missing_count,
  CAST(coalesce(sum(c) FILTER (WHERE NOT {kmiss}), 0) AS BIGINT) AS evaluated_count,
  CAST(coalesce(sum(c) FILTER (WHERE NOT {kmiss} AND c > 1), 0) AS BIGINT) AS unexpected_count
FROM (SELECT {col} AS k, count(*) AS c FROM batch GROUP BY {col}) g""")
    body = "\nUNION ALL\n".join(selects)
    return f"WITH batch AS ({batch_sql})\n{body}"


def decided(metrics_sql: str) -> str:
    return f"""
SELECT *,
  coalesce(CASE WHEN evaluated_count = 0 THEN NULL
           ELSE CAST(unexpected_count AS DOUBLE) * 100.0 / CAST(evaluated_count AS DOUBLE) END, 0.0)
    AS unexpected_percent,
  CASE WHEN evaluated_count = 0 THEN TRUE
       ELSE CAST(evaluated_count - unexpected_count AS DOUBLE) / CAST(evaluated_count AS DOUBLE) >= mostly
  END AS success
FROM ({metrics_sql}) m
"""


def gate_results(batch_sql: str, rules: list[tuple], batch_name: str | None = None) -> str:
    tag = f"'{batch_name}' AS batch, " if batch_name else ""
    return f"SELECT {tag}* FROM ({decided(rule_metrics(batch_sql, rules))}) d"


# -- samples ----------------------------------------------------------------------------

def _violation(kind: str, col: str, lo, hi) -> str:
    miss = _missing(col, col in FLOATING)
    if kind == "not_null":
        return miss
    conds = []
    if lo is not None:
        conds.append(f"{col} >= {_lit(lo)}")
    if hi is not None:
        conds.append(f"{col} <= {_lit(hi)}")
    return f"(NOT {miss} AND NOT ({' AND '.join(conds) or 'TRUE'}))"


def offender_samples(batch_sql: str, rules: list[tuple], k: int = 10, id_col: str = "trip_id") -> str:
    """Smallest k offending ids per *failed* rule; duplicated ids for a unique rule."""
    parts = []
    for _, rid, kind, col, _, lo, hi in rules:
        if kind == "unique":
            kmiss = _missing(col, col in FLOATING)
            parts.append(f"SELECT '{rid}' AS rule_id, CAST({col} AS BIGINT) AS row_id FROM batch "
                         f"WHERE NOT {kmiss} GROUP BY {col} HAVING count(*) > 1")
        else:
            parts.append(f"SELECT '{rid}' AS rule_id, CAST({id_col} AS BIGINT) AS row_id FROM batch "
                         f"WHERE {_violation(kind, col, lo, hi)}")
    offenders = "\nUNION ALL\n".join(parts)
    failed = f"SELECT rule_id FROM ({decided(rule_metrics(batch_sql, rules))}) d WHERE NOT success"
    return f"""
WITH batch AS ({batch_sql}),
off AS ({offenders}),
ranked AS (SELECT rule_id, row_id,
                  row_number() OVER (PARTITION BY rule_id ORDER BY row_id ASC NULLS LAST) AS rn
           FROM off WHERE rule_id IN ({failed}))
SELECT rule_id, CAST(rn AS INTEGER) AS rank, row_id FROM ranked WHERE rn <= {k}
"""


# -- exact seeded selection and faults -------------------------------------------------

RAW_COLUMNS = ("trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count",
               "trip_distance", "pickup_location_id", "dropoff_location_id", "fare_amount",
               "tip_amount", "total_amount", "payment_type")


def ranked(raw: str, seed: int, key: str = "trip_id") -> str:
    return f"""
SELECT *, row_number() OVER (ORDER BY md5(concat_ws(':', CAST({key} AS VARCHAR), '{seed}')), {key}) AS __rn,
       count(*) OVER () AS __total
FROM ({raw}) raw
"""


def _size(fraction: float, minimum: int = 0) -> str:
    n = f"CAST(floor(CAST(__total AS DOUBLE) * CAST({fraction!r} AS DOUBLE)) AS BIGINT)"
    if minimum:
        n = f"greatest({minimum}, {n})"
    return f"least({n}, __total)"


def null_flood(raw: str, column: str = "fare_amount", fraction: float = 0.35, seed: int = 7) -> str:
    cols = ", ".join(
        f"CASE WHEN __rn <= {_size(fraction)} THEN NULL ELSE {c} END AS {c}" if c == column else c
        for c in RAW_COLUMNS
    )
    return f"SELECT {cols} FROM ({ranked(raw, seed)}) r"


def dup_pk(raw: str, fraction: float = 0.1, seed: int = 11) -> str:
    cols = ", ".join(RAW_COLUMNS)
    return (f"SELECT {cols} FROM ({raw}) a UNION ALL "
            f"SELECT {cols} FROM ({ranked(raw, seed)}) r WHERE __rn <= {_size(fraction, 1)}")


def negative_values(raw: str, fraction: float = 0.15, seed: int = 13,
                    columns: tuple[str, ...] = ("fare_amount", "trip_distance")) -> str:
    cols = ", ".join(
        f"CASE WHEN __rn <= {_size(fraction)} THEN -abs({c}) ELSE {c} END AS {c}" if c in columns else c
        for c in RAW_COLUMNS
    )
    return f"SELECT {cols} FROM ({ranked(raw, seed)}) r"


def schema_drift(raw: str, old: str = "trip_distance", new: str = "trip_distance_mi") -> str:
    cols = ", ".join(f"{c} AS {new}" if c == old else c for c in RAW_COLUMNS)
    return f"SELECT {cols} FROM ({raw}) r"
