"""One place that builds the Spark session."""

from __future__ import annotations

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Defaults for large inputs. The cluster's own settings win: only keys that are
# not set yet are filled in.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Target size of a shuffle partition and, through REBALANCE, of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Start wide and let AQE merge, so that no partition is too large at the outset. The runs
    # set the number by their input, see ``size_shuffles``.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.shelfpulse.sizeShuffles": "true",
    # A dimension above this size is joined by shuffle instead of broadcast.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Recording the call site of every column expression slows the building of wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8",
    "spark.shelfpulse.sizeShuffles": "false",
    # Small inputs still occupy all cores.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
}


PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
FEWEST_PARTITIONS, MOST_PARTITIONS = 200, 400_000
#: What a byte of landed text may become in a shuffle, at most.
GROWTH = 3


def size_shuffles(spark: SparkSession, *folders: str) -> int | None:
    """Let shuffles start with as many partitions as the bytes in some folders call for.

    A partition then has about the advisory size if all of the input meets in one shuffle; AQE
    merges those of smaller ones. Nothing is set where ``spark.shelfpulse.sizeShuffles`` is
    not true; gives the number otherwise.
    """
    if spark.conf.get("spark.shelfpulse.sizeShuffles", "false") != "true":
        return None
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    wanted = jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    )
    number = min(MOST_PARTITIONS, max(FEWEST_PARTITIONS, -(-GROWTH * total // wanted)))
    spark.conf.set(PARTITIONS, number)
    return number


def _given(conf: dict[str, str]) -> SparkConf:
    """What is set already: by a running session, or by the submit command and its files."""
    running = SparkSession.getActiveSession()
    if running:
        return running.sparkContext.getConf()
    # Starts the driver's JVM, which must know settings like its memory, and asks it.
    SparkContext._ensure_initialized(conf=SparkConf(loadDefaults=False).setAll(list(conf.items())))
    return SparkConf()


def build_session(
    app_name: str = "shelfpulse",
    *,
    master: str | None = None,
    time_zone: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the time zone set explicitly.

    ``conf`` overrides everything; what the cluster or the submit command sets overrides the
    defaults here, which only fill in what nobody has set.

    An Iceberg catalog is plain Spark configuration and goes through ``conf``
    (``spark.sql.catalog.<name>`` and its companions).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = dict(SESSION_DEFAULTS)
    if master and master.startswith("local"):
        options.update(LOCAL_DEFAULTS)
    options["spark.sql.session.timeZone"] = time_zone
    options.update(conf or {})
    given = _given(conf or {})
    if given.contains(PARTITIONS):
        # Somebody chose the number.
        options["spark.shelfpulse.sizeShuffles"] = "false"
    for key, value in options.items():
        chosen = conf and key in conf or key == "spark.sql.session.timeZone"
        if chosen or not given.contains(key):
            builder = builder.config(key, value)
    return builder.getOrCreate()
