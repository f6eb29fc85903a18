"""Data-quality audits in place of the warehouse's declared constraints.

* ``fk_audit`` — the 29 declared foreign keys: fact keys without a dimension
  row (nulls are not violations, as in SQL);
* ``pk_audit`` — the 10 declared primary keys: null and duplicated keys;
* ``key_misses`` — trips the inner key lookups drop silently;
* ``key_collisions`` — ids of the unpadded legacy keys shared by several
  dates / minutes, with the number of trips each one would mis-assign;
* ``column_profile`` — per-column null count, min, max and approximate
  distinct count in one aggregation.

No audit shuffles raw fact rows by key: the FK audit and the collision
audit pre-aggregate the fact to (key, count) pairs before any join (a hot key
costs one row per task, not a third of the fact in one task), and the key-miss
audit probes broadcast dimensions and ends in one global aggregation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import in_date_range
from ..schemas import DIM_KEYS, FACTS
from .dims import Dims, legacy_dim_date, legacy_dim_time

# Declared foreign keys per fact: (fact column, dimension).
FKS = {
    "yellow": [("pickup_date_id", "dim_date"), ("vendor_id", "dim_vendor"),
               ("rate_code_id", "dim_ratecode"), ("pu_location_id", "dim_zone"),
               ("payment_id", "dim_payment"), ("do_location_id", "dim_zone"),
               ("pickup_time_id", "dim_time"), ("dropoff_time_id", "dim_time"),
               ("dropoff_date_id", "dim_date")],
    "green": [("trip_type_id", "dim_triptype"), ("pickup_date_id", "dim_date"),
              ("vendor_id", "dim_vendor"), ("rate_code_id", "dim_ratecode"),
              ("pu_location_id", "dim_zone"), ("payment_id", "dim_payment"),
              ("do_location_id", "dim_zone"), ("pickup_time_id", "dim_time"),
              ("dropoff_time_id", "dim_time"), ("dropoff_date_id", "dim_date")],
    "highvol": [("flag_id", "dim_flags"), ("pu_location_id", "dim_zone"),
                ("do_location_id", "dim_zone"), ("license_number", "dim_license"),
                ("pickup_date_id", "dim_date"), ("dropoff_date_id", "dim_date"),
                ("dispatching_baseno_id", "dim_base"), ("originating_baseno_id", "dim_base"),
                ("pickup_time_id", "dim_time"), ("dropoff_time_id", "dim_time")],
}

def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _key_pair(col, as_string: bool):
    """A key as (ikey bigint, skey string): integer keys stay numbers (no
    per-row text formatting on the hot path), text keys stay text."""
    if as_string:
        return F.struct(F.lit(None).cast("bigint").alias("ikey"),
                        col.cast("string").alias("skey"))
    return F.struct(col.try_cast("bigint").alias("ikey"), F.lit(None).cast("string").alias("skey"))


def fk_key_counts(fact: DataFrame, feed: str, by=()) -> DataFrame:
    """``(*by, fk_column, ikey, skey, n)``: how often each non-null key of every
    declared FK occurs. The fact is scanned once; its FK columns are unpivoted and
    reduced to distinct keys. With ``by=("data_year", "data_month")`` a month load
    keeps the counts of its own month; those of all months add up."""
    columns = [c for c, _ in FKS[feed]]
    text = {c: isinstance(fact.schema[c].dataType, T.StringType) for c in columns}
    pairs = (fact.select(*by, *[_key_pair(F.col(c), text[c]).alias(c) for c in columns])
             .unpivot(list(by), columns, "fk_column", "k")
             .select(*by, "fk_column", "k.ikey", "k.skey"))
    return (pairs.filter(F.col("ikey").isNotNull() | F.col("skey").isNotNull())
                 .groupBy(*by, "fk_column", "ikey", "skey").agg(F.count(F.lit(1)).alias("n")))


def fk_audit_of(counts: DataFrame, dims: Dims, feed: str) -> DataFrame:
    """``fk_audit`` from ``fk_key_counts``, also from those of many months."""
    fks = [(c, d) for c, d in FKS[feed] if dims.table(d) is not None]
    spark = counts.sparkSession
    known = dict(fks)
    listing = spark.sql("SELECT * FROM VALUES " + ", ".join(
        f"('{c}', '{d}', {str(c in known).lower()})" for c, d in FKS[feed])
        + " AS t(fk_column, ref_table, checked)")
    if not fks:
        none = F.lit(None).cast("bigint")
        return listing.select("*", *[none.alias(c) for c in ("checked_rows", "orphan_rows", "orphan_keys")])
    text = {c: isinstance(t, T.StringType) for c, t in FACTS[feed]}
    keys = (counts.where(F.col("fk_column").isin(list(known))).groupBy("fk_column", "ikey", "skey")
            .agg(F.sum("n").alias("n")))
    dim_keys = _union([
        dims.table(d).select(F.lit(c).alias("fk_column"),
                             _key_pair(F.col(DIM_KEYS[d]), text[c]).alias("k"))
            .select("fk_column", "k.ikey", "k.skey")
        for c, d in fks]).distinct().withColumn("known", F.lit(True))
    small = all(d.removeprefix("dim_") in dims.small for _, d in fks)
    # One path from the scan: a left join marks keys the dimension knows, one
    # aggregation counts checked and orphan rows (an anti join next to a
    # separate count would be planned as a second scan of the fact). Null-safe
    # equality: in each pair one side is always null.
    on = ((keys.fk_column == dim_keys.fk_column) & keys.ikey.eqNullSafe(dim_keys.ikey)
          & keys.skey.eqNullSafe(dim_keys.skey))
    marked = keys.join(F.broadcast(dim_keys) if small else dim_keys, on, "left").select(
        keys.fk_column, keys.n, dim_keys.known)
    orphan = F.col("known").isNull()
    stats = marked.groupBy("fk_column").agg(
        F.sum("n").alias("checked_rows"),
        F.sum(F.when(orphan, F.col("n"))).alias("orphan_rows"),
        F.count(F.when(orphan, 1)).alias("orphan_keys"))
    count = lambda c: F.when(F.col("checked"), F.coalesce(c, F.lit(0)).cast("bigint")).alias(c)
    return (listing.join(stats, "fk_column", "left")
            .select("fk_column", "ref_table", "checked",
                    *map(count, ("checked_rows", "orphan_rows", "orphan_keys"))))


def fk_audit(fact: DataFrame, dims: Dims, feed: str) -> DataFrame:
    """One row per declared FK, always all of them: ``checked`` (its dimension
    is there), ``checked_rows`` (non-null keys), ``orphan_rows`` and
    ``orphan_keys`` (distinct keys with no dimension row). Without its dimension
    a key is listed unchecked, with null counts.
    The fact is scanned once: its FK columns are unpivoted to (fk_column, key)
    and reduced to distinct keys with counts before they meet the dimension
    keys. Keys keep their kind (integer or text); a dimension key is compared
    in the kind of the fact column that references it."""
    return fk_audit_of(fk_key_counts(fact, feed), dims, feed)


def pk_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: rows, null keys and keys that occur more than once."""
    out = []
    for name, df in tables.items():
        key = DIM_KEYS[name]
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        out.append(per_key.agg(
            F.sum("n").cast("bigint").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0))
             .cast("bigint").alias("null_keys"),
            F.count(F.when(F.col(key).isNotNull() & (F.col("n") > 1), 1))
             .cast("bigint").alias("duplicate_keys"),
        ).select(F.lit(name).alias("table_name"), F.lit(key).alias("key_column"), "*"))
    return _union(out)


def miss_counts(dims: Dims) -> list[Column]:
    """Aggregates ``<role>_<kind>_misses`` over cleaned trips: rows whose date or
    clock minute finds no dimension row. In arithmetic form, so none for a
    calendar with holes or an incomplete clock."""
    if not (dims.date_contiguous and dims.time_complete):
        return []
    out = []
    for role in ("pickup", "dropoff"):
        known = F.coalesce(in_date_range(f"{role}_datetime", dims.date_start, dims.date_end), F.lit(False))
        out += [F.count_if(~known).alias(f"{role}_date_misses"),
                F.count_if(F.col(f"{role}_hour").isNull()).alias(f"{role}_time_misses")]
    return out


def key_misses(trips: DataFrame, dims: Dims) -> DataFrame:
    """Rows of cleaned trips (with ``pickup_*`` / ``dropoff_*`` parts) whose
    date or clock minute has no dimension row, per role and kind: the rows
    the inner key lookups drop. One pass: range tests where the calendar has no
    holes and the clock is complete; otherwise four left joins against the
    (distinct) dimension parts mark matches. One aggregation counts the rows."""
    if miss_counts(dims) and "pickup_datetime" in trips.columns:
        counts = trips.agg(*miss_counts(dims))
        long = counts.unpivot([], counts.columns, "rk", "missing_rows")
        part = F.split("rk", "_")
        return long.select(part[0].alias("role"), part[1].alias("kind"), F.col("missing_rows").cast("bigint").alias("missing_rows"))
    checks = []
    marked = trips
    for role in ("pickup", "dropoff"):
        for kind, dim, parts in (("date", dims.date, ("year", "month", "day")),
                                 ("time", dims.time, ("hour", "minute"))):
            cols = [f"{role}_{p}" for p in parts]
            flag = f"__hit_{role}_{kind}"
            d = dim.select(*[F.col(p).alias(c) for p, c in zip(parts, cols)]).distinct() \
                   .withColumn(flag, F.lit(True))
            # Plain equality: a null part never matches, as in the inner lookup.
            marked = marked.join(F.broadcast(d) if kind in dims.small else d, cols, "left")
            checks.append((role, kind, flag))
    counts = marked.agg(*[F.count_if(F.col(flag).isNull()).alias(f"{role}|{kind}")
                          for role, kind, flag in checks])
    long = counts.unpivot([], [f"{r}|{k}" for r, k, _ in checks], "rk", "missing_rows")
    return long.select(F.split("rk", "[|]")[0].alias("role"), F.split("rk", "[|]")[1].alias("kind"),
                       F.col("missing_rows").cast("bigint").alias("missing_rows"))


def key_collisions(dim: DataFrame, key: str, legacy: str, trips: DataFrame | None = None,
                   trip_key: str | None = None) -> DataFrame:
    """Legacy ids shared by more than one padded key: ``legacy_id``,
    ``n_keys`` and, with ``trips``, ``n_trips`` whose ``trip_key`` carries one
    of the colliding keys (trips a legacy-key join would mis-assign or fan
    out)."""
    per_legacy = dim.groupBy(legacy).agg(F.count(F.lit(1)).alias("n_keys"))
    clashing = per_legacy.filter(F.col("n_keys") > 1)
    members = dim.select(legacy, key).join(clashing, legacy, "left_semi")
    if trips is None:
        return clashing.withColumnRenamed(legacy, "legacy_id")
    per_key = trips.groupBy(F.col(trip_key).alias(key)).agg(F.count(F.lit(1)).alias("t"))
    return (members.join(per_key, key, "left")
            .groupBy(F.col(legacy).alias("legacy_id"))
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_keys"),
                 F.coalesce(F.sum("t"), F.lit(0)).cast("bigint").alias("n_trips")))


def date_key_collisions(dims: Dims, trips: DataFrame | None = None) -> DataFrame:
    return key_collisions(legacy_dim_date(dims.date), "dateid", "legacy_id", trips,
                          "pickup_date_id")


def time_key_collisions(dims: Dims, trips: DataFrame | None = None) -> DataFrame:
    return key_collisions(legacy_dim_time(dims.time), "time_id", "legacy_id", trips,
                          "pickup_time_id")


def column_profile(df: DataFrame, columns=None, approx: bool = True,
                   rsd: float = 0.05) -> DataFrame:
    """One row: ``n_rows`` and, per column, ``<c>__nulls``, ``<c>__min``,
    ``<c>__max`` and (``approx``) ``<c>__approx_distinct`` (HyperLogLog++,
    relative error ``rsd``). One pass, partial aggregation per task."""
    columns = columns or df.columns
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"),
                 F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
        if approx:
            aggs.append(F.approx_count_distinct(c, rsd).alias(f"{c}__approx_distinct"))
    return df.agg(*aggs)
