"""Loading, querying, auditing and writing the telemetry tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from trailmark.functions.dates import in_date_range, timestamp_literal
from trailmark.plans.local import local_table
from trailmark.sources.schemas import DDL, REQUIRED, schema


def _typed(name: str, stored: T.DataType, wanted: T.DataType) -> Column:
    """A column in its load-time type; dates and lists may be stored as text."""
    c = F.col(name)
    if stored == wanted:
        return c
    if isinstance(wanted, T.ArrayType) and isinstance(stored, T.StringType):
        # Stored as the text of a list: ['a', 'b'] or [0.5, 0.5]. It is also valid JSON once the
        # quotes are doubled.
        return F.from_json(F.translate(c, "'", '"'), wanted).alias(name)
    return c.cast(wanted).alias(name)


def typed(df: DataFrame, table: str) -> DataFrame:
    """Cast the columns of ``df`` that belong to ``table`` to their load-time types."""
    stored = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[_typed(f.name, stored[f.name], f.dataType) for f in schema(table) if f.name in stored])


def filter_events(
    events: DataFrame,
    event_types: Sequence[str] | None = None,
    user_ids: Sequence | None = None,
    date_range: tuple | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Event scan with ANDed filters; the range is typed and inclusive at both ends."""
    out = events
    if event_types:
        out = out.where(F.col("event_type").isin(list(event_types)))
    if user_ids:
        out = out.where(F.col("user_id").isin(list(user_ids)))
    if date_range:
        out = out.where(in_date_range("timestamp", date_range))
    return out.limit(limit) if limit else out


class Catalog:
    """The telemetry tables under one root folder or object-store prefix, one Parquet path each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        if table not in DDL:
            raise ValueError(f"Unknown table: {table}")
        return f"{self.root}/{table}.parquet"

    def exists(self, table: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def load_table(self, table: str) -> DataFrame:
        """Lazy typed scan. Raises ValueError for an unknown name, FileNotFoundError for no data."""
        path = self.path(table)
        if not self.exists(table):
            raise FileNotFoundError(f"Data file not found: {path}")
        return typed(self.spark.read.parquet(path), table)

    def load_all_tables(self, exclude_events: bool = True) -> dict[str, DataFrame]:
        """Every table that can be read. Lazy, so the events may be included at any size."""
        names = [t for t in DDL if t != "events" or not exclude_events]
        loaded = {}
        for name in names:
            try:
                loaded[name] = self.load_table(name)
            except (FileNotFoundError, AnalysisException) as error:
                print(f"skipped {name}: {error}")
        return loaded

    def register_views(self) -> list[str]:
        """Temp views over all tables present, for free SQL."""
        tables = self.load_all_tables(exclude_events=False)
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
        return list(tables)

    def register_frame(self, name: str, df: DataFrame) -> None:
        """Make a DataFrame visible to SQL under ``name``."""
        df.createOrReplaceTempView(name)

    def execute_query(self, query: str, **frames: DataFrame) -> DataFrame:
        """Free SQL over the registered views and over DataFrames passed by name as ``{name}``."""
        return self.spark.sql(query, **frames)

    def query_raw_table(self, table: str, query: str | None = None, limit: int | None = None) -> DataFrame:
        """A table by name, optionally through a SQL template that says ``FROM {table}``."""
        df = typed(self.spark.read.parquet(self.path(table)), table)
        if query:
            df = self.spark.sql(query, table=df)
        return df.limit(limit) if limit else df

    def query_events(
        self,
        event_types: Sequence[str] | None = None,
        user_ids: Sequence | None = None,
        date_range: tuple | None = None,
        limit: int | None = None,
        padded_text: bool = False,
    ) -> DataFrame:
        """Filtered event scan; see ``filter_events``. A range also prunes the date folders of the sink.

        Timestamps stored as text reach the range through a cast, which the Parquet filter cannot use. Where every
        one is written as ``yyyy-MM-dd`` and what follows, the caller may say so by ``padded_text``: such text sorts
        like time, and a wider test on it is pushed down. Text like ``2024-1-5`` would be lost by that test.
        """
        raw = self.spark.read.parquet(self.path("events"))
        if date_range and "event_date" in raw.columns:
            days = [F.to_date(timestamp_literal(d)) for d in date_range]
            raw = raw.where(F.col("event_date").between(*days))
        if date_range and padded_text and isinstance(raw.schema["timestamp"].dataType, T.StringType):
            lo, hi = (F.date_format(timestamp_literal(d), "yyyy-MM-dd") for d in date_range)
            raw = raw.where((F.col("timestamp") >= lo) & (F.col("timestamp") < F.concat(hi, F.lit("~"))))
        return filter_events(typed(raw, "events"), event_types, user_ids, date_range, limit)

    def get_table_info(self) -> DataFrame:
        """Rows and size (MB, one decimal) of each table present."""
        return table_info(self.spark, {t: self.path(t) for t in DDL if self.exists(t)})

    def validate_paths(self, required: Iterable[str] = REQUIRED) -> DataFrame:
        """Source audit: which required tables are present, and their size in MB."""
        names = list(required)
        status = local_table(
            self.spark,
            [{"table": t, "present": self.exists(t)} for t in names],
            "table string, present boolean",
        )
        present = [t for t in names if self.exists(t)]
        if not present:
            return status.withColumn("size_mb", F.lit(None).cast("double"))
        sizes = table_sizes(self.spark, {t: self.path(t) for t in present})
        return status.join(sizes, "table", "left").select(
            "table", "present", F.round(F.col("bytes") / 1e6, 1).alias("size_mb")
        )

    def write_table(self, table: str, df: DataFrame, mode: str = "overwrite", files_per_day: int = 32) -> None:
        """Parquet sink. Events are laid out by date, each date spread over several files."""
        out = typed(df, table)
        if table != "events":
            out.write.mode(mode).parquet(self.path(table))
            return
        dated = out.withColumn("event_date", F.to_date("timestamp"))
        salt = F.pmod(F.xxhash64("event_id"), F.lit(files_per_day))
        (
            dated.repartition(F.col("event_date"), salt)
            .write.mode(mode)
            .partitionBy("event_date")
            .parquet(self.path(table))
        )


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Stored bytes per table, from file listings alone (the content column is never read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = files.option("pathGlobFilter", "*.parquet")
    parts = [
        files.load(p).agg(F.sum("length").alias("bytes")).select(F.lit(t).alias("table"), "bytes")
        for t, p in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_rows(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Row count per table, which Parquet answers from its footers."""
    parts = [
        spark.read.parquet(p).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows")
        for t, p in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def table_info(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and size (MB, one decimal) of each table."""
    return (
        table_rows(spark, paths)
        .join(table_sizes(spark, paths), "table")
        .select("table", "rows", F.round(F.col("bytes") / 1e6, 1).alias("size_mb"))
    )
