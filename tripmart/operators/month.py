"""One-step month load: loaded rows and rejects of a file month are one write.

``replace_month`` writes a month to a staging folder in one job, partitioned by
``outcome`` (``loaded`` or ``rejected``), and then puts that folder in the
month's place by renaming it, so a reader sees the old month or the new one,
never the loaded rows of one load beside the rejects of another. An outcome that
has become empty goes with the old folder. What the load read, loaded, rejected
and missed is counted by the same job (``DataFrame.observe``).

A load that dies before the swap leaves the old month and some staging; one that
dies between its two renames leaves a complete staged month, which the next load
or ``finish_swaps`` puts in place. Renaming a folder is one step on HDFS and
local disks; on object stores without that, readers must wait for the load.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..period import Period
from ..schemas import FACTS
from .publish import MAX_RECORDS_PER_FILE

LOADED, REJECTED = "loaded", "rejected"
TAGS = ("data_year", "data_month")


def _columns(feed: str) -> list[tuple[str, T.DataType]]:
    return [(c, t) for c, t in FACTS[feed] if c not in TAGS]


def month_schema(feed: str, raw: T.StructType) -> T.StructType:
    """Of the stored table: fact columns, the rejected row as it came (``raw``),
    the reason, and the partition columns."""
    fields = [T.StructField(c, t) for c, t in _columns(feed)]
    kept = T.StructType([raw[c] for c, _ in _columns(feed)])
    return T.StructType([*fields, T.StructField("rejected", kept), T.StructField("reject_reason", T.StringType()),
                         *[T.StructField(c, T.StringType()) for c in (*TAGS, "outcome")]])


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _month_path(path: str, period: Period) -> str:
    return f"{path.rstrip('/')}/data_year={period.year}/data_month={period.month}"


def _swap(spark: SparkSession, path: str, staged: str, period: Period) -> None:
    """Put the folder ``staged`` in the month's place."""
    fs, at = _fs(spark, path)
    month = at(_month_path(path, period))
    old = at(f"{path.rstrip('/')}/_old/{uuid.uuid4().hex}")
    fs.mkdirs(month.getParent())
    fs.mkdirs(old.getParent())
    if fs.exists(month) and not fs.rename(month, old):
        raise RuntimeError(f"cannot move {month} away")
    if not fs.rename(at(staged), month):
        raise RuntimeError(f"cannot put {staged} in place")
    fs.delete(old, True)


def finish_swaps(spark: SparkSession, path: str) -> int:
    """Put complete staged months in place whose month is gone (their load died
    between its two renames) and drop all other staging. Call it while no load
    of the table runs. Returns the number of months put in place."""
    fs, at = _fs(spark, path)
    staging, done = at(f"{path.rstrip('/')}/_staging"), 0
    for status in fs.listStatus(staging) if fs.exists(staging) else []:
        name = status.getPath().getName()
        period = Period(*name.split("-")[:2])
        whole = fs.exists(at(status.getPath(), "_SUCCESS"))
        if whole and not fs.exists(at(_month_path(path, period))):
            _swap(spark, path, status.getPath().toString(), period)
            done += 1
        else:
            fs.delete(status.getPath(), True)
    return done


def replace_month(tagged: DataFrame, path: str, feed: str, period: Period) -> dict:
    """Write the rows of ``tag_conformance`` as the month ``period`` of the table
    at ``path``, also when there are none. Returns ``loaded`` and ``rejected``."""
    spark, bad = tagged.sparkSession, F.col("__reject")
    rows = tagged.select(
        *[F.col(f"__ok_{c}").alias(c) for c, _ in _columns(feed)],
        F.when(bad, F.struct(*[c for c, _ in _columns(feed)])).alias("rejected"), "reject_reason",
        F.when(bad, REJECTED).otherwise(LOADED).alias("outcome"))
    counts = Observation(f"{feed} {period}")
    rows = rows.observe(counts, F.count_if(F.col("outcome") == LOADED).alias("loaded"),
                        F.count_if(F.col("outcome") == REJECTED).alias("rejected"))
    finish_swaps(spark, path)
    staged = f"{path.rstrip('/')}/_staging/{period.year}-{period.month}-{uuid.uuid4().hex}"
    key = [c for c, _ in _columns(feed) if c == "pickup_date_id"]
    (rows.sortWithinPartitions("outcome", *key).write.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
     .partitionBy("outcome").parquet(staged))
    _swap(spark, path, staged, period)
    return counts.get


def read_months(spark: SparkSession, path: str, feed: str, raw: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(loaded rows, rejects) of a table of ``replace_month``, each pruned to its
    own files. Rejects have the row as it came and ``reject_reason``."""
    rows = spark.read.schema(month_schema(feed, raw)).parquet(path)
    loaded = rows.where(F.col("outcome") == LOADED).select(*[c for c, _ in FACTS[feed]])
    rejects = rows.where(F.col("outcome") == REJECTED).select(
        *[F.col(c) if c in TAGS else F.col(f"rejected.{c}").alias(c) for c, _ in FACTS[feed]], "reject_reason")
    return loaded, rejects
