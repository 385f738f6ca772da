"""Small relations: fixed ones from Python configuration, and one-row results put together."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def local_table(spark: SparkSession, rows: Iterable[dict], ddl: str) -> DataFrame:
    """Config rows as a LocalRelation: no Python workers, and its exact size is known to Catalyst."""
    schema = T.StructType.fromDDL(ddl)
    table = pa.Table.from_pylist(list(rows), schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema=schema)


def side_by_side(*frames: DataFrame) -> DataFrame:
    """One-row results with different columns as one row, without a join."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])
