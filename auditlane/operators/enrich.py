"""Role-playing dimension lookups and the enriched trip model.

One dimension (zones) is attached twice, once per role (pickup, dropoff), with left outer
joins: unmatched facts are kept with NULL attributes, and a duplicated dimension key fans
the fact out (the gate's uniqueness rule is what notices).  The joins carry no hint: Catalyst
broadcasts a dimension whose statistics prove it within ``autoBroadcastJoinThreshold`` bytes,
and otherwise shuffles; a hot zone's partition is then split by AQE
(``spark.sql.adaptive.skewJoin.enabled``), which it can do on the left side of a left join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditlane.functions.exprs import minutes_between, safe_divide

# Column order of the enriched model (and of the fact mart built from it).
ENRICHED_COLUMNS: tuple[str, ...] = (
    "trip_id",
    "vendor_id",
    "pickup_at",
    "dropoff_at",
    "passenger_count",
    "trip_distance_miles",
    "fare_amount",
    "tip_amount",
    "total_amount",
    "payment_type",
    "pickup_location_id",
    "dropoff_location_id",
    "pickup_borough",
    "pickup_zone",
    "dropoff_borough",
    "dropoff_zone",
    "trip_duration_minutes",
    "fare_per_mile",
)


def attach_role(
    fact: DataFrame, dim: DataFrame, *, fact_key: str, dim_key: str, role: str, attributes: tuple[str, ...],
) -> DataFrame:
    """Left-join ``dim`` to ``fact`` on ``fact_key = dim_key``; attributes get a role prefix."""
    tag = f"__{role}_key"
    role_dim = dim.select(F.col(dim_key).alias(tag), *[F.col(a).alias(f"{role}_{a}") for a in attributes])
    return fact.join(role_dim, fact[fact_key] == role_dim[tag], "left").drop(tag)


def enrich_trips(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """Staged trips + pickup/dropoff zone attributes + duration and fare per mile."""
    zones = zones.select("location_id", "borough", "zone")
    out = trips
    for role in ("pickup", "dropoff"):
        out = attach_role(out, zones, fact_key=f"{role}_location_id", dim_key="location_id", role=role,
                          attributes=("borough", "zone"))
    out = out.withColumns(
        {
            "trip_duration_minutes": minutes_between("pickup_at", "dropoff_at"),
            "fare_per_mile": safe_divide("fare_amount", "trip_distance_miles"),
        }
    )
    return out.select(*ENRICHED_COLUMNS)
