"""Session set-up and the one shared folder jobs may write working tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "vigilframe", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings this library relies on.

    ANSI mode stays on (Spark's default): casts that may fail use ``try_*``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Collecting a Python stack trace per column call is most of the time to build a query.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        # State larger than executor memory, and sessions merged before their shuffle.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark: SparkSession) -> SparkSession:
    """Naive timestamps mean UTC everywhere, so the session must agree."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_PARTITION_BYTES = 512 << 20
_MOST_PARTITIONS = 40_000


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise the shuffle partitions to fit the input; returns the number in force.

    About half a gigabyte each, which spills gracefully, and never more than 40,000: with
    many thousands of map tasks the blocks between them would become too small. AQE merges
    what turns out smaller and splits skewed joins. A large input is also read in larger
    pieces, for the same reason. A higher setting of the session is left alone.
    """
    wanted = min(-(-input_bytes // _PARTITION_BYTES), _MOST_PARTITIONS)
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", wanted)
        if wanted == _MOST_PARTITIONS:
            spark.conf.set("spark.sql.files.maxPartitionBytes", _PARTITION_BYTES)
    return max(wanted, current)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can read: what the cluster names, else a local one.

    A machine-local folder is only ever chosen in local mode, where one machine is
    the whole cluster; elsewhere an unset folder is an error.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    chosen = tempfile.mkdtemp(prefix="vigilframe-")
    spark.conf.set(CHECKPOINT_KEY, chosen)
    return chosen


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's working table below the shared folder."""
    return f"{shared_dir(spark)}/vigilframe/{name}-{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written copy.

    Used where a result is read several times: the lineage ends at files that
    survive the loss of any executor, and the copy carries exact statistics.
    """
    path = work_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Remove all working tables below the shared folder; call when no job uses them."""
    from vigilframe.sources.files import remove

    remove(spark, f"{shared_dir(spark)}/vigilframe")
