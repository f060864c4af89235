"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on for their meaning, whatever session they get.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a bucket that is one file comes in the order it was stored in
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; cluster sizing is left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SEMANTIC_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_settings(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    for key, value in SEMANTIC_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a
    machine-local folder would not be visible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/millrace/{label}-{uuid.uuid4().hex}"


_STAGES: list[str] = []


def drop_stages(spark: SparkSession) -> int:
    """Delete all copies that ``stage`` has made so far, when no frame that reads them is needed any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    n = 0
    while _STAGES:
        path = hadoop(_STAGES.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` as parquet to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and fixes values that
    depend on the physical layout (partition ids, positions). ``drop_stages``
    removes the copies once their readers are done.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    _STAGES.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` with the executors while several results are made from it, and release it after.

    The results must be made inside, e.g. staged. Blocks that don't fit in memory go to
    the executors' disks, and those of a lost executor are computed again.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
