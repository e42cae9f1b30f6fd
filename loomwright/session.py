"""Session helpers: table access, the shared folder, shipping the package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables below ``sf_dir`` (any path that Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the cluster names in ``spark.checkpoint.dir``. Only where that is unset in a local
    session, as in tests, a folder of this machine is used; a cluster without one is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = _local_shared()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def _local_shared() -> str:
    path = os.path.join(tempfile.gettempdir(), f"loomwright-shared-{os.getuid()}-{os.getpid()}")
    os.makedirs(path, exist_ok=True)
    return f"file://{path}"


def new_folder(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back: lineage ends here,
    and no executor has to be alive for a later read. Spark deletes the shuffle files of the write when it is done, else they
    would stay until the driver collects garbage."""
    spark = df.sparkSession
    path = new_folder(spark, what)
    schema = df.schema
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(schema).parquet(path)
    out._stored_at = path
    return out


#: Rows of a task where the work on each is heavy.
ROWS = 20_000


def spread(df: DataFrame, rows: int = 0) -> DataFrame:
    """``df`` dealt into tasks of some ``rows`` (``ROWS``) each, for heavy work on rows: one small file is one task's otherwise, however many
    rows it has. A plain read of Parquet files is counted from their footers."""
    parts = -(-df.count() // (rows or ROWS))
    return df.repartition(parts) if parts > 1 else df


#: Rows of a task that sorts or hashes them.
TASK_ROWS = 400_000


def tasks_of(df: DataFrame) -> int:
    """Into how many tasks the rows of ``df`` are dealt, so that a task's memory does not grow with the table: joined and merged by size
    of their compressed shuffle files, narrow rows would be millions in a task. A plain read of Parquet files is counted from their footers."""
    n = df.count()
    return max(1, -(-n // TASK_ROWS), min(df.sparkSession.sparkContext.defaultParallelism, -(-n // 20_000)))


def forget(*tables: DataFrame) -> None:
    """Delete tables that ``written`` stored and that no later read needs. What others were derived from must
    have been consumed: a lazy result that still reads one fails."""
    for t in tables:
        path = t.__dict__.pop("_stored_at", None)
        if path:
            spark = t.sparkSession
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, wherever they run (once per context)."""
    sc = spark.sparkContext
    # Whole texts are long: Spark's default of 10,000 rows would be tens of MB at once on either side.
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) == 10_000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    if getattr(sc, "_loomwright_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="loomwright-")
    path = os.path.join(folder, "loomwright.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, p.relative_to(_PACKAGE.parent))
    sc.addPyFile(path)
    sc._loomwright_shipped = True
