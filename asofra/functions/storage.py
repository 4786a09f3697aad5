"""The folder that a cluster shares, and tables that cut a plan in two."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is ``spark.checkpoint.dir``. Only where that is unset and Spark runs on
    one machine, as in tests, a temporary folder takes its place; a cluster
    without the setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="asofra-")
        spark.conf.set("spark.checkpoint.dir", found)
        atexit.register(shutil.rmtree, found.removeprefix("file://"), True)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/asofra/{name}-{uuid.uuid4().hex}"


#: The paths of each open ``scratch``, innermost last.
_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[..., None]]:
    """Delete the tables that are ``written`` in this block when it ends,
    unless they are given to the function it yields, which leaves them to the
    block around. What the block returns must read none of the others."""
    kept: list[DataFrame] = []
    _scopes.append([])
    try:
        yield lambda *tables: kept.extend(tables)
    finally:
        mine = _scopes.pop()
        held = {t._written_path for t in kept}
        rest = [p for p in mine if p not in held]
        if _scopes:
            _scopes[-1] += held.intersection(mine)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in rest:
            found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(conf).delete(found, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    A lost executor costs a re-read of these files, never the work before,
    and a table that several branches use is computed once. Inside a
    ``scratch`` block the table lives as long as that says.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if _scopes:
        _scopes[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def dropped(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a ``written`` table that nothing reads any more."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for parent in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent)
        path.getFileSystem(conf).delete(path, True)
