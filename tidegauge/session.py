"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import tidegauge

# Functions travel to the Python workers whole, so that the package need not be
# installed there.
cloudpickle.register_pickle_by_value(tidegauge)

ROCKSDB = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str = "tidegauge", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators expect.

    Shuffle partition counts are left to the cluster's own defaults and to
    adaptive execution unless passed in ``conf``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the cluster's ``spark.checkpoint.dir``.

    Where that setting is absent on a single machine, as in tests, a new temporary
    folder is made and recorded for the session. On a cluster its absence is an
    error: executors would each write to a disk of their own.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not root:
        root = tempfile.mkdtemp(prefix="tidegauge-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate result to the shared folder and go on from there.

    It is computed once however often it is used, and a lost executor costs a
    re-read, not a re-run. The folder is the cluster's to clean up.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
