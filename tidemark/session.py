"""Session factory, table access and the shared folder for lineage cuts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_made: list[str] = []
#: Catalyst's estimate for sources it knows nothing of is larger than this.
UNKNOWN_BYTES = 1 << 60
#: Up to so many bytes a whole frame may be ordered in one task, whatever its keys.
ONE_TASK_BYTES = 64 << 20


def get_spark(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; ``conf`` wins over the defaults."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which every executor reaches.

    Only on one machine (a local master, as in tests) a temporary one is made
    where none is set, and set as the checkpoint folder; elsewhere that is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.getCheckpointDir().orElse(None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared one, for what is written and read again; removed when the driver's process ends."""
    path = f"{shared_root(spark)}/tidemark-{purpose}-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_remove_made, spark)
    _made.append(path)
    return path


def _remove_made(spark: SparkSession) -> None:
    """Folders made by ``shared_dir``, if the session still stands; lazy frames may read them until then."""
    while _made:
        path = _made.pop()
        try:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
            state = spark._jvm.org.apache.hadoop.fs.Path(f"{path}-state")
            state.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(state, True)
        except Exception:  # noqa: BLE001  # the session is gone: nothing to ask
            return


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.getCheckpointDir().isPresent():
        sc.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a frame in bytes; where it has none, the rows are counted."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate if estimate < UNKNOWN_BYTES else df.count() * 100


def fits_one_task(*frames: DataFrame) -> bool:
    """Whether even a key that holds all rows of these frames is small enough to be ordered in one task."""
    return sum(plan_bytes(f) for f in frames) <= ONE_TASK_BYTES


def buckets_for(df: DataFrame, bytes_each: int, least: int = 1) -> int:
    """How many hash buckets keep each one near ``bytes_each`` by Catalyst's estimate."""
    return max(least, -(-plan_bytes(df) // bytes_each))
