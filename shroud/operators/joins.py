"""Control relations of checked size. Joins carry no broadcast hints: Spark decides from bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame

LOCAL_MAX_ROWS = 10_000


def localize(df: DataFrame, max_rows: int = LOCAL_MAX_ROWS) -> DataFrame:
    """A control relation (policies, vocabulary) computed once and kept as a local
    relation when a count proves it small: later joins see its exact size (and broadcast
    it) instead of re-running its plan in every job. Larger relations are left as they are."""
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return df.sparkSession.createDataFrame(rows, df.schema)  # from Arrow: its size is known, from Row objects it is not
