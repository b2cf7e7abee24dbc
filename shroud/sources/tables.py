"""Table scans (R1), literal relations (R3) and the overwrite sink (R2)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table. Projections and filters written later reach the parquet
    reader (ReadSchema / PushedFilters), so callers never pre-select columns here."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def literal(spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str) -> DataFrame:
    """Rows with a declared schema -> DataFrame. Used for control relations that a person
    writes by hand (entitlements, policies, vocabularies); never for data."""
    return spark.createDataFrame(list(rows), schema)


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite sink. Files are replaced as a whole: a DataFrame built earlier on the
    old files will fail rather than read a mix, so protected reads are rebuilt per call."""
    df.write.mode("overwrite").format(fmt).save(path)


def save_as_table(df: DataFrame, name: str, comment: str | None = None,
                  column_comments: dict[str, str] | None = None) -> None:
    """Overwrite a catalog table and attach comments."""
    spark = df.sparkSession
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {_sql_str(comment)}")
    for col, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN {col} COMMENT {_sql_str(text)}")


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
