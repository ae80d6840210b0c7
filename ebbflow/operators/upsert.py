"""Keyed merges as set operations (the logic behind the table upserts SNK1, SNK2).

A merge is one join on the key; nothing is looked up row by row. The result is a complete new version of the
touched rows, which the table store then writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELTA_KEYS = ("hour", "station_id")


def merge_stations(old: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Upsert stations by id: name, capacity and is_active come from the new row (a missing capacity becomes
    NULL, a missing is_active 1); created_at_utc is kept from the old row, else ``now``.

    ``new`` must hold one row per id (it is an aggregate upstream); ids only in ``old`` stay as they were.
    """
    now = now if now is not None else F.current_timestamp()
    n = new.select(
        F.col("id"),
        F.col("name").alias("n_name"),
        F.col("capacity").alias("n_capacity") if "capacity" in new.columns else F.lit(None).cast("int").alias("n_capacity"),
        F.col("is_active").alias("n_is_active") if "is_active" in new.columns else F.lit(None).cast("int").alias("n_is_active"),
        F.lit(True).alias("_new"),
    )
    o = old.select(
        F.col("id"),
        F.col("name").alias("o_name"),
        F.col("capacity").alias("o_capacity"),
        F.col("is_active").alias("o_is_active"),
        F.col("created_at_utc").alias("o_created"),
    )
    j = o.join(n, "id", "full_outer")
    is_new = F.coalesce(F.col("_new"), F.lit(False))
    return j.select(
        "id",
        F.when(is_new, F.col("n_name")).otherwise(F.col("o_name")).alias("name"),
        F.when(is_new, F.col("n_capacity")).otherwise(F.col("o_capacity")).cast("int").alias("capacity"),
        F.when(is_new, F.coalesce(F.col("n_is_active"), F.lit(1)))
        .otherwise(F.col("o_is_active"))
        .cast("int")
        .alias("is_active"),
        F.coalesce(F.col("o_created"), now.cast("timestamp")).alias("created_at_utc"),
    )


def merge_deltas(old: DataFrame, new: DataFrame, mode: str = "replace", keys: tuple[str, ...] = DELTA_KEYS) -> DataFrame:
    """Upsert flow rows by (hour, station_id).

    ``replace``: a new row replaces the old one, old keys absent from ``new`` stay (idempotent). ``add``: new
    values are added to old ones (for increments; applying the same increment twice counts it twice).
    """
    cols = [c for c in old.columns if c in new.columns]
    if mode == "replace":
        # one full outer join: each side is read once; a flag marks keys present in the new rows
        values = [c for c in cols if c not in keys]
        n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_in_new"))
        j = old.select(*cols).join(n, list(keys), "full_outer")
        in_new = F.coalesce(F.col("_in_new"), F.lit(False))
        return j.select(*keys, *[F.when(in_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in values])
    if mode == "add":
        values = [c for c in cols if c not in keys]
        both = old.select(*cols).unionByName(new.select(*cols))
        return both.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in values])
    raise ValueError(f"unknown merge mode {mode!r}")
