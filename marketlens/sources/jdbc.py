"""Relational database options. The driver jar and the database are the caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlens.operators.load import load_projection
from marketlens.schemas import TableSpec

BATCH_ROWS = 10_000


def staging_name(schema: str, table: str, day: str) -> str:
    return f"{schema}.{table}_tmp_{day.replace('-', '_')}"


def write_options(url: str, table: str, writers: int, **extra: str) -> dict[str, str]:
    """Options of a batched write over at most ``writers`` connections."""
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(BATCH_ROWS),
        "numPartitions": str(writers),
        **extra,
    }


def write_staging(df: DataFrame, spec: TableSpec, url: str, schema: str, day: str, writers: int = 16, **extra: str) -> str:
    """Replace the staging table of ``spec`` with the declared columns of ``df``."""
    name = staging_name(schema, spec.name, day)
    options = write_options(url, name, writers, **extra)
    load_projection(df, spec).write.format("jdbc").options(**options).mode("overwrite").save()
    return name


def merge_statements(spec: TableSpec, schema: str, staging: str) -> list[str]:
    """SQL that merges a staging table into its target in one transaction and drops it.

    Rows with a known key replace the target's other columns; a table of keys alone ignores them.
    """
    columns = ", ".join(spec.names)
    rest = [c for c in spec.names if c not in spec.keys]
    action = "UPDATE SET " + ", ".join(f"{c} = EXCLUDED.{c}" for c in rest) if rest else "NOTHING"
    return [
        "BEGIN TRANSACTION",
        f"INSERT INTO {schema}.{spec.name} ({columns}) SELECT {columns} FROM {staging} ON CONFLICT ({', '.join(spec.keys)}) DO {action}",
        "COMMIT",
        f"DROP TABLE IF EXISTS {staging}",
    ]


def read_options(url: str, table: str, column: str | None = None, bounds: tuple[int, int] | None = None, readers: int = 16, **extra: str) -> dict[str, str]:
    """Options of a table scan, split on a numeric column when one is named."""
    options = {"url": url, "dbtable": table, **extra}
    if column and bounds:
        options.update(
            partitionColumn=column,
            lowerBound=str(bounds[0]),
            upperBound=str(bounds[1]),
            numPartitions=str(readers),
        )
    return options


def read_jdbc(spark: SparkSession, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
