"""Session set-up and the shared work folder."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app="logweir", master=None, hive=False, **conf):
    """A session with the settings the jobs rely on.

    Extra settings are passed as a mapping: build_session(**{"spark.executor.memory": "16g"}).
    Shuffle width is left to the caller: adaptive execution only merges partitions, so on a
    cluster set `spark.sql.shuffle.partitions` to a few times the number of cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.orc.filterPushdown": "true",
        # Window state can outgrow the JVM heap, so keep it in RocksDB.
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def pin_utc(spark):
    """Log times carry no zone; parse and print them in UTC whatever the cluster default is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_folder(spark, label):
    """A fresh folder path under the shared folder the cluster names.

    Only a local session without `spark.checkpoint.dir` falls back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="logweir-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/logweir/{label}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark):
    """DataFrame.checkpoint() needs a folder; take the session's own if it has one."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(work_folder(spark, "checkpoints"))
