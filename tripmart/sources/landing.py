"""Month landing gate: a month is ready only when every required feed landed.

The manifest is a DataFrame ``(year, month, feed, path, bytes)``; it can be
listed from storage with ``manifest_from_paths`` (file metadata only, file
contents are never read) or derived from any other inventory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..period import Period
from ..session import path_exists
from .feeds import FEED_FILE_PREFIX

REQUIRED_FEEDS = ("yellow", "green")


def manifest_from_paths(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """List landed files under ``root/<yyyy>/<MM>/<feed>_tripdata_<yyyy>-<MM>*``
    (a file, or a folder of part files) through the ``binaryFile`` source,
    selecting only path and length: file contents are not read."""
    prefixes = "|".join(FEED_FILE_PREFIX.values())
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(root).select("path", "length"))
    # A landed month is one file, or one folder of part files.
    pat = rf"/(\d{{4}})/(\d{{2}})/({prefixes})_tripdata_\d{{4}}-\d{{2}}[^/]*(/[^/]+)?$"
    inverse = {v: k for k, v in FEED_FILE_PREFIX.items()}
    feed = F.col("prefix")
    for prefix, name in inverse.items():
        feed = F.when(F.col("prefix") == prefix, F.lit(name)).otherwise(feed)
    return (files.select(F.regexp_extract("path", pat, 1).alias("year"),
                         F.regexp_extract("path", pat, 2).alias("month"),
                         F.regexp_extract("path", pat, 3).alias("prefix"),
                         "path", F.col("length").alias("bytes"))
                 .filter(F.col("year") != "")
                 .select("year", "month", feed.alias("feed"), "path", "bytes"))


MANIFEST = "year string, month string, feed string, path string, bytes long"


def manifest_for(spark: SparkSession, root: str, periods: Sequence[Period]) -> DataFrame:
    """``manifest_from_paths`` of some months: only their folders are listed, so
    a check of one month costs the same however many lie there. Months without a
    folder have no rows."""
    folders = [f"{root.rstrip('/')}/{p.year}/{p.month}" for p in periods]
    there = [f for f in folders if path_exists(spark, f)]
    return manifest_from_paths(spark, there) if there else spark.createDataFrame([], MANIFEST)


def merge_manifest(spark: SparkSession, stored: str, root: str, periods: Sequence[Period]) -> DataFrame:
    """List some months again and replace their rows in the stored manifest, also
    by none; other months are not listed. Returns the whole manifest."""
    now = manifest_for(spark, root, periods)
    for p in periods:
        (now.where((F.col("year") == p.year) & (F.col("month") == p.month)).drop("year", "month").coalesce(1)
         .write.mode("overwrite").parquet(f"{stored.rstrip('/')}/year={p.year}/month={p.month}"))
    return spark.read.schema(MANIFEST).parquet(stored).select("year", "month", "feed", "path", "bytes")


def landing_status(manifest: DataFrame, expected: DataFrame | None = None,
                   feeds: Sequence[str] = REQUIRED_FEEDS) -> DataFrame:
    """Per month ``(year, month, feeds_landed, result)``: ``success`` when
    every feed in ``feeds`` has a file, else ``fail``. ``expected`` (year,
    month) adds months with nothing landed at all (they fail)."""
    landed = (manifest.filter(F.col("feed").isin(list(feeds)))
              .groupBy("year", "month")
              .agg(F.count_distinct("feed").alias("feeds_landed")))
    if expected is not None:
        landed = expected.select("year", "month").distinct().join(landed, ["year", "month"], "left")
    n = F.coalesce(F.col("feeds_landed"), F.lit(0)).cast("int")
    return landed.select("year", "month", n.alias("feeds_landed"),
                         F.when(n == len(set(feeds)), "success").otherwise("fail").alias("result"))


def missing_feeds(manifest: DataFrame, expected: DataFrame,
                  feeds: Sequence[str] = REQUIRED_FEEDS) -> DataFrame:
    """(year, month, feed) for every required feed of an expected month with
    no landed file: what to fetch again. Months are expanded by feed with
    ``explode`` (no cross join), then anti-joined with the manifest."""
    wanted = (expected.select("year", "month").distinct()
              .withColumn("feed", F.explode(F.array(*[F.lit(f) for f in feeds]))))
    landed = manifest.select("year", "month", "feed").distinct()
    return wanted.join(landed, ["year", "month", "feed"], "left_anti")
