"""File sources and sinks of the layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import written

ROSTER = "row int, ticker string, name string, cik string, occurrence int, date_added date, date_removed date, name_when_added string, name_when_removed string"
SECTORS = "ticker string, sector string, industry string, note string"


def read_roster(spark: SparkSession, path: str, least_rows: int = 800) -> DataFrame:
    """The roster file: a leading row number is dropped, names trimmed."""
    rows = spark.read.csv(path, header=True, schema=ROSTER).drop("row")
    out = rows.withColumns({"ticker": F.upper(F.trim("ticker")), "name": F.trim("name"), "occurrence": F.coalesce("occurrence", F.lit(1))})
    if out.count() <= least_rows:
        raise ValueError(f"the roster has no more than {least_rows} rows")
    return out


def read_sectors(spark: SparkSession, *paths: str) -> DataFrame:
    """Sector files of one layout; of a repeated ticker the later file's row."""
    parts = []
    for k, path in enumerate(paths):
        rows = spark.read.csv(path, header=True, schema=SECTORS)
        parts.append(rows.select(F.upper(F.trim("ticker")).alias("ticker"), F.trim("sector").alias("sector"), F.trim("industry").alias("industry"), F.lit(k).alias("_k")))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("ticker").agg(F.max_by(F.struct("sector", "industry"), "_k").alias("_s")).select("ticker", "_s.*")


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer; copies that a file syncer named ``x (1).parquet`` are
    left out, and older files may lack newer columns."""
    rows = spark.read.option("mergeSchema", True).parquet(path)
    return rows.where(~F.col("_metadata.file_path").rlike(r"(%20| )\(\d+\)\.parquet$"))


def write_partitions(rows: DataFrame, path: str, *by: str) -> None:
    """Replace only the partitions that ``rows`` has."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_rows(spark: SparkSession, rows: DataFrame, path: str, keys: list[str], *by: str) -> int:
    """Append what the layer, partitioned ``by``, does not have by key; its
    columns and their types must be the same. Running twice adds nothing. Of
    the layer only the partitions that ``rows`` touches are read. Returns the
    number of rows added."""
    fresh = written(rows, "fresh")
    try:
        old = spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        fresh.write.partitionBy(*by).parquet(path)
        return fresh.count()
    types = lambda df: {f.name: f.dataType for f in df.schema if f.name not in by}
    if types(old) != types(rows) or set(old.columns) != set(rows.columns):
        raise ValueError(f"columns differ: {sorted(map(str, set(types(old).items()) ^ set(types(rows).items())))}")
    if by:
        touched = [r[0] for r in fresh.select(by[0]).distinct().collect()]
        old = old.where(F.col(by[0]).isin(touched))
    fresh = written(fresh.join(old.select(*keys), keys, "left_anti").select(*old.columns), "fresh")
    count = fresh.count()
    if count:
        fresh.write.mode("append").partitionBy(*by).parquet(path)
    return count


def missing(planned: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """The planned outputs that do not exist yet."""
    return planned.join(existing.select(*keys), keys, "left_anti")


def append_log(rows: DataFrame, path: str) -> None:
    """Append a run's few rows to a folder of CSV files."""
    rows.write.mode("append").option("header", True).csv(path)
