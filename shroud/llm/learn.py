"""Bounded labelled samples and calibration for the classifiers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold


def labelled(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int, most: int) -> DataFrame:
    """(text, y) of at most ``most`` labelled rows outside the held-out fold, picked by a hash of the
    id. A document with labels of both kinds counts as 1. Only their ids are ranked; they are broadcast (``most`` bounds them) to fetch the texts."""
    if most > 1_000_000:
        raise ValueError("a sample of more than a million rows is not broadcast")
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold("doc_id", mod) != held))
    known = known.groupBy(F.col("doc_id").alias("id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    few = known.orderBy(F.xxhash64(F.lit(2), F.col("id")), "id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(few), docs.doc_id == few.id).select("id", "text", "y")


def fetch(df: DataFrame) -> pa.Table:
    """The sample in an order of its own: rows of one id by what they hold, so row order decides nothing."""
    return df.orderBy(F.xxhash64(F.lit(2), F.col("id")), "id", *[c for c in df.columns if c != "id"]).toArrow()


def log_loss_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss on calibration rows."""
    grid = np.exp(np.linspace(np.log(0.2), np.log(8.0), 80))
    if not len(y) or y.min() == y.max():
        return 1.0
    loss = [np.mean(np.logaddexp(0, logit / t) - y * logit / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))
