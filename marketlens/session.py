"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE sizes the reduce side at run time, turns a sort-merge join into a broadcast join
# only after it has measured the small side, and splits the partition of a hot join key.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "marketlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A cluster must set it. A local session without it, as in tests, gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="marketlens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_STAGED: list[str] = []


def _delete(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release_staged(spark: SparkSession) -> None:
    """Deletes what this process has staged so far; results that read it must be stored or consumed before."""
    while _STAGED:
        _delete(spark, _STAGED.pop())


def discard(table: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more, such as the one a later round has replaced."""
    path = getattr(table, "_staged_at", None)
    if path in _STAGED:
        _STAGED.remove(path)
        _delete(table.sparkSession, path)


def staged(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back, for plans that use it twice.

    It stays until :func:`release_staged`, as the plans that read it may run at any later time.

    ``by`` names a column with few values whose rows are read apart later.
    """
    path = fresh_path(df.sparkSession, label)
    _STAGED.append(path)
    df.write.parquet(path, partitionBy=by, compression="zstd")
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._staged_at = path
    return table
