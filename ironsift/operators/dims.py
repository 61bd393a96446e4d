"""Small tables that come with the program or its profiles: known to the planner as such, broadcast only when their size is proven."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SMALL = 10_000


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """Rows of the program as a local relation, whose size the planner knows."""
    kind = to_arrow_schema(StructType.fromDDL(schema))
    columns = list(zip(*rows, strict=True)) or [()] * len(kind)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, kind, strict=True)], schema=kind))


def small(df: DataFrame, most: int = SMALL) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows; else the planner chooses."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
