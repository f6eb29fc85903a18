"""Session construction and the shared folder for written intermediate tables.

Intermediate tables (materialized facts, round-trip exports) go under the
folder the cluster names in ``spark.checkpoint.dir``; that folder is shared by
every executor, so a lost executor never takes a written table with it. A
folder of our own is set only when the setting is missing on a local master,
as in tests.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Sizing for a large cluster (about 100 TB of trips, ~1000 executors). The
# only big shuffles are shuffle joins of whole tables (the order-trip adapter)
# and rebalanced writes; AQE starts every shuffle at `initialPartitionNum`
# (tens of TB over 50,000 reducers is about 1 GB each, spilling if needed;
# more reducers would grow every map task's shuffle index) and coalesces the
# many small shuffles (KPI and audit aggregations arrive pre-aggregated) to
# the advisory size; skewed join partitions above 1 GB are split. Scans split
# at 256 MiB. Dimensions are bounded, so a 64 MiB broadcast threshold covers
# them without letting a fact side through.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "50000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def get_session(app: str = "tripmart", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Build (or return) a session with the settings this library relies on.

    ``profile="cluster"`` adds ``CLUSTER_CONF`` (partition sizing for large
    inputs); tests and local runs use the defaults plus ``shuffle_partitions``.

    ANSI mode stays on (Spark 4 default); every place where the reference
    yields null instead of an error uses an explicit ``try_*`` function.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        d = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect: no SparkContext on the client
        d = None
    return d or spark.conf.get("spark.checkpoint.dir", None)


def shared_root(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir``.

    When it is unset on a master of one process (tests, single-node runs) a fresh
    folder is created and registered as the checkpoint dir. On a cluster an
    unset value is an error: a node-local folder would not survive the loss of
    the node that wrote it.
    """
    d = _checkpoint_dir(spark)
    if d:
        return d.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder "
                           "(HDFS/object store) before writing intermediate tables")
    d = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return _checkpoint_dir(spark).rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path under the shared folder; ``unique`` adds a fresh component."""
    segs = [shared_root(spark), "tripmart", *parts]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(s.strip("/") if i else s.rstrip("/") for i, s in enumerate(segs))


def written(df: DataFrame, *parts: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and
    cut from its lineage."""
    path = shared_path(df.sparkSession, *parts)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists, through the Hadoop filesystem of the session."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
