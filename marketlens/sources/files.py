"""Document, table and text files.

The scans are lazy and run on the executors; only path checks talk to the file system from
the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions import variant
from marketlens.schemas import CORRUPT, DOCUMENT_KINDS, MISSING, NAMED_THINGS, UNREAD


def table_path(base: str, layer: str, schema: str, table: str) -> str:
    """``base/layer/schema/table.parquet`` with the layer prefix cut off the table name."""
    return f"{base.rstrip('/')}/{layer}/{schema}/{table.replace(f'{layer}_', '')}.parquet"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def partition_folders(spark: SparkSession, path: str) -> list[str]:
    """Paths of the ``column=value`` folders directly below ``path``, none if it is not there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [s.getPath() for s in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []
    return [p.toString() for p in found if "=" in p.getName()]


def scan_documents(spark: SparkSession, root: str, kind: str, pattern: str | None = None, lines: bool = False) -> DataFrame:
    """One row per JSON document of ``kind`` below ``root``, with its path.

    Documents are told by their file names; ``pattern`` stands in for the kind's own. A file is one document, or
    with ``lines`` holds one in each line, as files of many documents do. A document that does not parse keeps its text in the corrupt-record column.
    """
    if kind not in DOCUMENT_KINDS:
        raise ValueError(f"unknown document kind {kind!r}; use one of {sorted(DOCUMENT_KINDS)}")
    texts = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern or DOCUMENT_KINDS[kind][0])
        .text(root, wholetext=not lines)
    )
    return parse_documents(texts.select(F.col("_metadata.file_path").alias("path"), "value"), "value", kind)


def parse_documents(texts: DataFrame, text: str, kind: str) -> DataFrame:
    """The columns of the documents in the JSON column ``text``, next to the other columns.

    Values are converted one by one, so a document is unreadable only if it is no JSON object. Paths of
    values that do not convert and fields that are missing where they must be stand in columns of their own.
    """
    schema = T.StructType.fromDDL(DOCUMENT_KINDS[kind][1])
    # A generator keeps later filters above the parser, which then runs once per document.
    parsed = texts.select("*", F.explode(F.array(F.try_parse_json(text))).alias("_json"))
    value = F.col("_json")
    broken = F.when(F.coalesce(~variant.is_object(value), F.lit(True)), F.col(text)).alias(CORRUPT)
    array, names = NAMED_THINGS.get(kind, ("", []))
    lacking = variant.missing(value, array, names) if array else F.array().cast("array<string>")
    fields = [variant.read(variant.part(value, f.name), f.dataType).alias(f.name) for f in schema.fields]
    kept = [c for c in texts.columns if c != text]
    return parsed.select(*kept, *fields, broken, variant.unread(value, schema).alias(UNREAD), lacking.alias(MISSING))


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """File paths only; the pruned schema keeps the contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(root)
        .select("path")
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame | None, path: str) -> None:
    """Full replacement; no frame, no write."""
    if df is not None:
        df.write.mode("overwrite").parquet(path)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, repeats and blank lines removed, in column ``token``."""
    lines = spark.read.text(path).select(F.trim("value").alias("token"))
    return lines.filter(F.col("token") != "").distinct()


def read_or_create(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The CSV table at ``path``; written empty first when there is none."""
    if not path_exists(spark, path):
        write_csv(spark.createDataFrame([], schema), path)
    return read_csv(spark, path, schema)
