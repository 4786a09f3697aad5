"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.storage import dropped, new_path, scratch, written

__all__ = ["arrow_batches", "ascii_lower", "bitmap", "dropped", "free_names", "join_groups", "marked", "new_path", "scratch", "table", "without_rows", "written"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A key counts as hot from this share of all rows on, so there are at most
#: 1 / HOT_SHARE hot keys: that bounds what ``join_groups`` broadcasts.
HOT_SHARE = 1 / 512
#: Buckets of a bitmap: 64 in a row, so 2^18 rows at most.
BUCKETS = 1 << 24
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def bitmap(keyed: DataFrame, keys: list[str], name: str) -> DataFrame:
    """The buckets that hold a key of ``keyed``, 64 a row, for ``marked``."""
    bits = F.bit_or(F.expr("shiftleft(1L, _b % 64)")).alias(f"{name}_bits")
    rows = keyed.select(_bucket(keys).alias("_b")).groupBy(F.expr("_b div 64").cast("int").alias(f"{name}_row")).agg(bits)
    return F.broadcast(rows)


def marked(rows: DataFrame, keys: list[str], bits: DataFrame, name: str, known: Column | None = None) -> DataFrame:
    """Add ``name``: whether the row's bucket is in the bitmap of that name,
    false unless ``known``. A bucket may hold several keys."""
    bucket = _bucket(keys) if known is None else F.when(known, _bucket(keys))
    placed = rows.withColumn(f"{name}_b", bucket).withColumn(f"{name}_row", F.expr(f"cast({name}_b div 64 as int)"))
    hit = F.coalesce(F.expr(f"getbit({name}_bits, {name}_b % 64) = 1"), F.lit(False))
    return placed.join(bits, f"{name}_row", "left").withColumn(name, hit).drop(f"{name}_row", f"{name}_b", f"{name}_bits")


def without_rows(docs: DataFrame, gone: DataFrame, keep: Callable[..., None]) -> DataFrame:
    """``docs`` without the rows of ``gone`` (doc_id, text_id), text_id being
    xxhash64 of the text. A bitmap of ``gone`` lets most rows pass where they
    are; only the others meet ``gone``. ``keep`` is that of the ``scratch``
    block around."""
    doc_id, text_id, mark = free_names(docs, "_gone_id", "_gone_text", "_gone_in")
    found = written(gone.select(F.col("doc_id").alias(doc_id), F.col("text_id").alias(text_id)).distinct(), "gone")
    keep(found)
    hashed = docs.withColumn(text_id, F.xxhash64("text"))
    split = marked(hashed, [text_id], bitmap(found, [text_id], mark), mark)
    match = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == found[text_id])
    rest = split.where(mark).select(*docs.columns).join(found, match, "left_anti")
    return split.where(~F.col(mark)).select(*docs.columns).unionByName(rest)


def arrow_batches(spark: SparkSession, rows: int = 1000, megabytes: int = 16) -> None:
    """Bound the batches that go to Python by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. All-ASCII texts take the faster ``lower``."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, how: str = "inner") -> DataFrame:
    """Join ``rows`` with one row per key of ``groups``, whatever the skew.

    ``groups[count]`` is the number of rows of each key. A key that holds at
    least HOT_SHARE of all rows is hot: there are at most 1 / HOT_SHARE of
    them, so the broadcast of hot keys is bounded; their rows are dealt over
    SALTS salted copies of the group row.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    least = max(1000, int(total * HOT_SHARE))
    hot = groups.where(F.col(count) >= least).select(*keys, F.lit(True).alias("_hot"))
    # by the row and its partition: a task that runs again deals alike
    spread = F.xxhash64(*rows.columns) + F.spark_partition_id() * 7919
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), F.pmod(spread, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    )
    copies = F.when(F.col(count) >= least, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return salted.drop("_hot").join(groups.withColumn("_salt", F.explode(copies)), [*keys, "_salt"], how).drop("_salt")
