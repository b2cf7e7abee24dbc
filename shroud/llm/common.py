"""Tables, shared scratch tables and small helpers of the operators here."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_dir

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Scratch:
    """Tables written to the shared folder: they cut lineage, and outlive a lost executor.
    ``drop`` removes one that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        ensure_checkpoint_dir(spark)
        self.spark, self.base = spark, shared_dir(spark, f"llm-{uuid.uuid4().hex}")
        self.n = 0

    def path(self) -> str:
        self.n += 1
        return f"{self.base}/{self.n}"

    def write(self, df: DataFrame, **options: str) -> DataFrame:
        path = self.path()
        df.write.options(**options).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            if path := getattr(t, "_scratch", None):
                at = jvm.org.apache.hadoop.fs.Path(path)
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def blank(df: DataFrame) -> bool:
    return not df.take(1)


def crc_fold(doc_id: str, mod: int):
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "UTF-8")) % F.lit(mod)
