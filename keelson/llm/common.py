"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
import pickle
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.session import checkpoint_dir


#: rows of text that go to a Python worker at a time
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Lower Spark's rows per Arrow batch where it is higher: whole texts, of
    which some are very long, stand in a batch, on both sides of the pipe."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def id_and_bytes(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of ``text`` (null: empty), and nothing
    else of the input: extra columns with clashing names never get in the way."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)


def beside_text(docs: DataFrame) -> tuple[Column, Column]:
    """What a task carries along so that :func:`rows_again` can give the rows
    back: the other columns as one (no name can clash), and whether the text is null."""
    others = [F.col(c) for c in docs.columns if c != "text"]
    return F.struct(*others).alias("rest"), F.col("text").isNull().alias("no_text")


def rows_again(found: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The rows of ``docs`` from their carried columns and their (new) text."""
    return found.select(*[F.when(~F.col("no_text"), text.cast("string")).alias(c) if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns])


def schema_with(rows: DataFrame, more: str, skip: tuple[str, ...] = ("text",)) -> T.StructType:
    """The columns of ``rows`` but those of ``skip``, then ``more`` (as DDL)."""
    return T.StructType([f for f in rows.schema.fields if f.name not in skip] + T.StructType.fromDDL(more).fields)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared checkpoint folder, so that a lost
    executor never sends the job back to the first stage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """As :func:`saved`, but as a Parquet table in that folder. The planner
    then knows the table's true size, where a checkpoint hands on an estimate;
    over rounds of joins those multiply beyond any number."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table that is made meanwhile go with the job that made it."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def kept(df: DataFrame) -> DataFrame:
    """As :func:`written`, without the shuffle files of making the table."""
    with shuffles_go(df.sparkSession):
        return written(df)


def let_go(*tables: DataFrame) -> None:
    """Delete the files of tables made by :func:`written` that nothing will read again."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id folds to 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts, F.lit(0)).cast("int")


def fresh_worker(owner: str) -> None:
    """Let go of what another operator's tasks left in this Python worker:
    workers live from one stage of a pipeline to the next."""
    if sys.__dict__.get("keelson_owner") == owner:
        return
    sys.__dict__["keelson_owner"] = owner
    if kept := sys.__dict__.get("keelson_kept"):
        import ctypes
        import gc

        import pyarrow as pa

        kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass


def once_per_worker(key, make):
    """What a Python worker keeps from one task to the next."""
    kept = sys.__dict__.setdefault("keelson_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class Shared:
    """A broadcast of any object, its classes included; a Python worker
    unpacks ``value`` once and keeps the last two it was asked for."""

    def __init__(self, spark: SparkSession, value):
        self.name = uuid.uuid4().hex
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        kept = once_per_worker("shared", dict)
        if self.name not in kept:
            while len(kept) > 1:
                del kept[next(iter(kept))]
            kept[self.name] = pickle.loads(self.packed.value)
        return kept[self.name]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x >= 0 else (e := math.exp(x)) / (1 + e)


BITS = 26


def seen_bits(df: DataFrame, key: str, bits: int = BITS):
    """A bitmap of ``2 ** bits`` bits with the low bits of every value of the
    long column ``key`` set, at most 2 ** (bits - 6) rows on the way to the
    driver whatever the table's size. It only ever says "surely absent", so a
    full one costs work and no results."""
    import numpy as np

    words = df.select(F.shiftrightunsigned(F.col(key).bitwiseAND((1 << bits) - 1), 6).alias("at"),
                      F.expr(f"shiftleft(1L, cast({key} & 63 as int))").alias("bit")).groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("at").to_numpy()] = words.column("bit").to_numpy().view(np.uint64)
    return Shared(df.sparkSession, out)


def maybe_in(bitmap, keys):
    """Which of the numpy keys (64-bit) may be in the bitmap."""
    import numpy as np

    k = keys.view(np.uint64) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[(k >> np.uint64(6)).astype(np.int64)] >> (k & np.uint64(63)) & np.uint64(1)).astype(bool)


def cutoff(df: DataFrame, count: str, most: int) -> int:
    """The smallest count such that at most ``most`` rows reach it (found on
    eighths of powers of two, exact below 16)."""
    tiers = df.select(F.col(count).alias("n"), F.when(F.col(count) < 16, F.col(count)).otherwise(
        F.floor(F.log2(F.col(count).cast("double")) * 8) + 1000).alias("tier")).groupBy("tier").agg(
        F.min("n").alias("least"), F.count(F.lit(1)).alias("rows")).collect()
    best, total = None, 0
    for r in sorted(tiers, key=lambda r: -r["least"]):
        total += r["rows"]
        if total > most:
            break
        best = r["least"]
    return best if best is not None else (max((r["least"] for r in tiers), default=0) + 1) * 2
