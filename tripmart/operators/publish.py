"""Publishing facts and dimensions: warehouse layout, type conformance,
CSV/Parquet sinks and the idempotent month load.

The month load replaces the warehouse's "delete the month, then bulk load"
procedure with a dynamic partition overwrite of ``data_year`` /
``data_month``: only the partitions present in the written rows are
replaced, so loading a month twice equals loading it once and other months
are never touched. Columns are mapped by name, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..period import Period
from ..schemas import DIMS, FACTS, VARCHAR
from .facts import WAREHOUSE_NAMES


def to_layout(fact: DataFrame, feed: str) -> DataFrame:
    """Job output -> warehouse column names, in the warehouse's column order."""
    renamed = fact.withColumnsRenamed({k: v for k, v in WAREHOUSE_NAMES.items()
                                       if k in fact.columns})
    return renamed.select(*[c for c, _ in FACTS[feed]])


def _decimal_fits(x, t: T.DecimalType):
    """Does ``try_cast(x AS decimal(p,s))`` succeed for a double ``x``?

    The cast rounds the shortest decimal form of ``x`` HALF_UP to ``s``
    places; that overflows exactly when ``|x|`` is at least the double
    nearest to ``10^(p-s) - 0.5 * 10^-s``, because the shortest form keeps
    the order of doubles. So one double comparison decides it, without
    building a decimal (and without the cast's per-row overflow exception).
    NaN and infinities do not fit."""
    bound = 10.0 ** (t.precision - t.scale) - 0.5 * 10.0 ** -t.scale
    return F.abs(x) < F.lit(bound)


def conform(df: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Split rows into (conformed, rejects) against the warehouse types.

    Every column is ``try_cast`` to its warehouse type (doubles -> decimal(p,2),
    keys -> int) and strings are checked against their varchar width. A row
    whose non-null value does not fit anywhere is a reject: ``rejects`` keeps
    the input row plus ``reject_reason`` (failing columns, comma separated).
    The split is two filters over the same projection (``tag_conformance``)."""
    return split_conformed(tag_conformance(df, feed), feed)


def tag_conformance(df: DataFrame, feed: str) -> DataFrame:
    """Input columns, their conformed values (``__ok_<c>``), the ``__reject``
    flag and ``reject_reason`` (null when the row conforms), in one projection."""
    checks, casts = [], {}
    types = {f.name: f.dataType for f in df.schema.fields}
    for c, t in FACTS[feed]:
        src = F.col(c)
        if types[c] == t and c not in VARCHAR:
            # Already the warehouse type: nothing can fail, nothing to cast
            # (and no copy of the column's expression in the reject test).
            casts[c] = src
            continue
        if isinstance(t, T.StringType):
            n = VARCHAR.get(c)
            # varchar widths count bytes.
            conv = F.when(F.octet_length(src) <= n, src) if n else src.cast("string")
        elif isinstance(t, T.DecimalType) and isinstance(types[c], (T.DoubleType, T.FloatType)):
            fits = _decimal_fits(src, t)
            casts[c] = F.when(fits, src.cast(t))
            checks.append((c, src.isNotNull() & ~fits))
            continue
        else:
            conv = src.try_cast(t)
        casts[c] = conv
        checks.append((c, src.isNotNull() & conv.isNull()))
    # One boolean decides the split; the reason text is built for rejects only.
    reject = F.lit(False)
    for _, bad in checks:
        reject = reject | bad
    reason = F.when(reject, F.concat_ws(",", *[F.when(bad, F.lit(c)) for c, bad in checks]))
    return df.select(*[F.col(c) for c, _ in FACTS[feed]],
                     *[v.alias(f"__ok_{c}") for c, v in casts.items()],
                     reject.alias("__reject"), reason.alias("reject_reason"))


# Rows per output file; bounds file size whatever the month's volume.
MAX_RECORDS_PER_FILE = 5_000_000


def split_conformed(tagged: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """(conformed rows, rejects) of a ``tag_conformance`` projection."""
    good = tagged.filter(~F.col("__reject")).select(
        *[F.col(f"__ok_{c}").alias(c) for c, _ in FACTS[feed]])
    rejects = tagged.filter(F.col("__reject")).select(
        *[c for c, _ in FACTS[feed]], "reject_reason")
    return good, rejects


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=(),
                mode: str = "overwrite") -> None:
    """Write a fact or dimension. CSV gets a header line; no forced single
    partition (each task writes its own part file)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")


def export_month_csv(df: DataFrame, root: str, feed: str, period: Period) -> str:
    """Export one fact month as headered CSV under
    ``<root>/Fact/<feed>/<yyyy>/<MM>/`` (overwrite), for loaders that take
    CSV. Every task writes its own part file: the export is not funnelled
    through one task; readers take the folder."""
    path = f"{root.rstrip('/')}/Fact/{feed}/{period.year}/{period.month}"
    month = df.filter((F.col("data_year") == period.year) & (F.col("data_month") == period.month))
    write_table(month, path, "csv")
    return path


def read_table(spark: SparkSession, path: str, schema: T.StructType,
               fmt: str = "parquet") -> DataFrame:
    """Read with a declared schema. For CSV the header line is skipped and
    columns are taken by position, like the warehouse's bulk load; a
    malformed value fails the read (FAILFAST) instead of becoming null."""
    r = spark.read.schema(schema)
    if fmt == "csv":
        return r.option("header", True).option("escape", '"').option("mode", "FAILFAST").csv(path)
    if fmt == "parquet":
        return r.parquet(path)
    raise ValueError(f"unsupported format {fmt!r}")


def read_dim(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, DIMS[name], fmt)


# Months are few: more reducers than these would mostly stay empty. Up to 200 (Spark's
# bypassMergeThreshold) a task writes its shuffle files without holding its rows.
MONTH_REDUCERS = 200


def rebalanced(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by ``keys`` (REBALANCE hint): AQE splits what is larger than the
    advisory size and joins what is smaller, so what a task sorts to write is
    bounded by that size, not by the file splits it reads."""
    n = min(MONTH_REDUCERS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.hint("rebalance", n, *keys)


def load_month(df: DataFrame, table_path: str, period: Period | None = None) -> None:
    """Delete, then load. With ``period``, exactly that month becomes its rows
    in ``df``, also when there are none: the partition folder is overwritten.
    Without it, the months present in ``df`` are replaced. Files are sorted by
    pickup date key, so date ranges skip row groups, and bounded in size. Rows are
    dealt by month (one month: by day) first, which bounds the sort of a task."""
    key = [c for c in df.columns if c == "pickup_date_id"]
    if period is not None:
        month = df.filter((F.col("data_year") == period.year) & (F.col("data_month") == period.month))
        month = month.drop("data_year", "data_month")
        (rebalanced(month, *key).sortWithinPartitions(*key) if key else month).write.mode("overwrite") \
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE) \
            .parquet(f"{table_path.rstrip('/')}/data_year={period.year}/data_month={period.month}")
        return
    (rebalanced(df, "data_year", "data_month").sortWithinPartitions("data_year", "data_month", *key)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy("data_year", "data_month").parquet(table_path))


def read_fact(spark: SparkSession, table_path: str, schema: T.StructType) -> DataFrame:
    """Read a month-partitioned fact; the partition columns come back as
    strings (``'01'``, not 1) because the schema says so."""
    return spark.read.schema(schema).parquet(table_path)
