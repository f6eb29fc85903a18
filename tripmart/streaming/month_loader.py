"""Incremental month loads with Structured Streaming.

The batch job builds one month per run when the scheduler passes a period.
Here the landing folder itself drives the loads. A clock stream fires the
micro-batches; each lists the landed files (path, length and modification time:
contents are never read for it, and month-to-month schema drift in the trip
files cannot break it) and compares every month with what its last load saw. A
month with new, replaced or removed files is rebuilt from all of its landed
files (``read_feed``, which conforms each month's own schema) and replaced as a
whole, also with no rows. A month whose files are all gone keeps its rows.
``watch`` names the months that are listed, afresh for each micro-batch (such as
``lambda: recent_periods(4)``): a batch then costs the same however many months
lie in the landing folder. Without it the whole folder is listed.

Two loaders share this: ``start_month_loader`` keeps the fact of one feed in the
job's layout; ``start_warehouse_loader`` runs the batch job itself, with landing
gate, warehouse layout, conformance and rejects.

Rebuilding touched months (rather than loading only new rows) keeps a month
whole when its part files land in two micro-batches: the second load
replaces the month with every part, not with the second part alone. What a load
saw takes the place of what the month's last load saw in ``<checkpoint>/months``,
one small file per month, after the load: a load that failed is repeated, a
restarted query goes on with what changed since, and replaying a micro-batch
rewrites the same partitions with the same rows.

Landing layout (as in the batch job): ``<root>/<yyyy>/<MM>/<prefix>_tripdata_<yyyy>-<MM>``,
one file or one folder of part files per feed and month.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..jobs import IncompleteMonth, load_period
from ..operators.dims import Dims
from ..operators.facts import build_fact
from ..operators.publish import load_month
from ..period import Period
from ..session import path_exists
from ..sources.feeds import FEED_FILE_PREFIX, read_feed
from ..sources.landing import REQUIRED_FEEDS

SEEN = "year string, month string, files string"
Watch = Callable[[], Sequence[Period]] | None


def _folder(root: str, period: Period) -> str:
    return f"{root.rstrip('/')}/{period.year}/{period.month}"


def landed_months(spark: SparkSession, feeds: Sequence[str], landing_root: str | list[str]) -> DataFrame:
    """``(year, month, files)`` of every month with a landed file of ``feeds``
    below one or several folders; ``files`` changes with the path, length or
    modification time of any file."""
    names = "|".join(FEED_FILE_PREFIX[f] for f in feeds)
    pat = rf"/(\d{{4}})/(\d{{2}})/(?:{names})_tripdata_\d{{4}}-\d{{2}}"
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(landing_root)
             .select("path", "length", "modificationTime"))
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return (files.withColumns({"year": F.regexp_extract("path", pat, 1), "month": F.regexp_extract("path", pat, 2)})
                 .filter(F.col("year") != "")
                 .groupBy("year", "month")
                 .agg(F.concat_ws(":", F.count("*").cast("string"), F.sum(each).cast("string")).alias("files")))


def changed_months(spark: SparkSession, feeds: Sequence[str], landing_root: str, seen: str,
                   watched: Sequence[Period] | None = None) -> list:
    """Rows of ``landed_months`` (of the ``watched`` ones, if given) that differ
    from what ``seen`` holds: a handful of (year, month) pairs."""
    roots = [landing_root] if watched is None else [_folder(landing_root, p) for p in watched]
    roots = [r for r in roots if path_exists(spark, r)]
    if not roots:
        return []
    now = landed_months(spark, feeds, roots)
    if path_exists(spark, seen):
        last = spark.read.schema(SEEN).parquet(seen).withColumnRenamed("files", "last")
        now = now.join(last, ["year", "month"], "left").filter(~F.col("files").eqNullSafe(F.col("last"))).drop("last")
    return now.orderBy("year", "month").collect()


def _start(spark: SparkSession, feeds: Sequence[str], landing_root: str, checkpoint: str, available_now: bool,
           load: Callable[[SparkSession, Period], bool], watch: Watch) -> StreamingQuery:
    seen = f"{checkpoint.rstrip('/')}/months"

    def run(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        for r in changed_months(session, feeds, landing_root, seen, watch() if watch else None):
            if load(session, Period(r.year, r.month)):
                session.createDataFrame([(r.files,)], "files string").coalesce(1).write.mode("overwrite") \
                    .parquet(f"{seen}/year={r.year}/month={r.month}")

    # One row per micro-batch: the stream is the clock only.
    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
    w = clock.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_month_loader(spark: SparkSession, feed: str, landing_root: str, table_path: str,
                       dims: Dims, checkpoint: str, available_now: bool = True,
                       how: str = "arith", watch: Watch = None) -> StreamingQuery:
    """Keep the fact of ``feed`` (``build_fact``, by file month) at ``table_path``.
    With ``available_now`` it processes what has landed or changed and stops (a
    scheduled run), otherwise it keeps watching the folder. No other feed is
    waited for and nothing is conformed: see ``start_warehouse_loader``."""
    def load(session: SparkSession, period: Period) -> bool:
        rows = read_feed(session, feed, [period], landing_root, tag=True)
        load_month(build_fact(rows, feed, None, dims, how), table_path, period)
        return True

    return _start(spark, [feed], landing_root, checkpoint, available_now, load, watch)


def start_warehouse_loader(spark: SparkSession, landing_root: str, warehouse: str, checkpoint: str,
                           dims: Dims | None = None, feeds: Sequence[str] = REQUIRED_FEEDS,
                           available_now: bool = True, watch: Watch = None) -> StreamingQuery:
    """Run ``jobs.load_period`` for every month that landed or changed: facts and
    rejects of ``feeds`` are replaced. A month waits until all required feeds
    have landed; one that the calendar of ``dims`` does not cover stops the query
    before anything of it is replaced."""
    def load(session: SparkSession, period: Period) -> bool:
        try:
            load_period(session, period, landing_root, warehouse, dims, feeds)
        except IncompleteMonth:
            return False
        return True

    return _start(spark, sorted({*REQUIRED_FEEDS, *feeds}), landing_root, checkpoint, available_now, load, watch)
