"""File sources and sinks: CSV source (A1), table overwrite (A3),
prediction CSV sink (A4)."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """A1: header row, comma separated; a UTF-8 byte-order mark is dropped by
    Spark's reader. An explicit schema avoids the extra inference pass over
    the data; ``infer=True`` runs it (small files only)."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A2: a saved table by name."""
    return spark.read.table(name)


def write_table(df: DataFrame, name: str, fmt: str = "parquet") -> None:
    """A3: (re)place the named table. Not for a plan that reads the same
    table; :func:`overwrite_table` keeps versions for that."""
    df.write.mode("overwrite").format(fmt).saveAsTable(name)


def overwrite_table(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """A3: make ``df`` the current version of the table at ``path``.

    Every version is a folder of its own below ``path``, written once, and so
    may be computed from the version before. Its name, which sorts after all
    earlier ones, counts only once the writer's success mark is there: a reader
    sees the old version or the new one, never none. Old versions stay for
    readers that still use them."""
    version = f"{path.rstrip('/')}/v={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(version)
    return spark.read.format(fmt).load(version)


def current_version(spark: SparkSession, path: str) -> str | None:
    """The folder of the table's newest complete version."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return None
    done = [str(s.getPath()) for s in fs.listStatus(root) if s.getPath().getName().startswith("v=")
            and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return max(done, default=None)


def read_version(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` as :func:`overwrite_table` last left it."""
    version = current_version(spark, path)
    if version is None:
        raise FileNotFoundError(f"no complete version of {path}")
    return spark.read.format(fmt).load(version)


def write_predictions_csv(scored: DataFrame, keys: Sequence[str], path: str,
                          prediction: str = "prediction") -> None:
    """A4: one prediction per line, with the row key (Spark rows have no
    order, so a bare value column could not be matched back)."""
    scored.select(*keys, prediction).write.mode("overwrite").option("header", True).csv(path)
