"""Steps that are written once and read several times.

A table that a plan needs more than once (cells, a rate card, sorted ranges) is
written as Parquet to the shared folder that the cluster names in
``spark.checkpoint.dir``. Its lineage ends there: the facts behind it are read
once, and a lost executor costs no more than the tasks it ran.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ledgerloom.session import checkpoint_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, with the same columns."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
