"""Splits that do not depend on data layout.

``DataFrame.randomSplit`` changes with the number and order of partitions,
so every split here is a function of the row key only: md5 of the key text,
cut into per-mille buckets. The same rows land in the same split on any
cluster size and in DuckDB.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.exprs import bucket1000, hash32

ETL_SALT = "etl"        # C1: cleaned table -> training / validation
HOLDOUT_SALT = "holdout"  # C2: training -> train / test
SCORE_SALT = "score"    # C3: scoring holdout


def threshold(fraction: float) -> int:
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return int(round(fraction * 1000))


def hash_split(df: DataFrame, key_cols: Sequence[str | Column], fraction: float,
               salt: str = ETL_SALT, names: tuple[str, str] = ("train", "test"),
               col: str = "split") -> DataFrame:
    """Label each row ``names[1]`` with probability ``fraction``."""
    b = bucket1000(key_cols, salt)
    return df.withColumn(col, F.when(b < threshold(fraction), names[1]).otherwise(names[0]))


def split_pair(df: DataFrame, key_cols: Sequence[str | Column], fraction: float,
               salt: str = ETL_SALT) -> tuple[DataFrame, DataFrame]:
    """(train, test) frames; both are filters over one plan (no shuffle)."""
    b = bucket1000(key_cols, salt)
    t = threshold(fraction)
    return df.filter(b >= t), df.filter(b < t)


def nested_split(df: DataFrame, key_cols: Sequence[str | Column], outer: float = 0.2,
                 inner: float = 0.2, col: str = "split") -> DataFrame:
    """C4: validation by the ETL hash, then test inside the rest by a second,
    independent hash: 64 % train, 16 % test, 20 % validation."""
    b1 = bucket1000(key_cols, ETL_SALT)
    b2 = bucket1000(key_cols, HOLDOUT_SALT)
    return df.withColumn(
        col,
        F.when(b1 < threshold(outer), "validation")
        .when(b2 < threshold(inner), "test")
        .otherwise("train"),
    )


def split_counts(df: DataFrame, col: str = "split") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


# --- exact-size holdout ------------------------------------------------------

def _digits(key_cols, salt) -> list[Column]:
    """Four 16-bit digits of a 64-bit key hash, most significant first."""
    a = hash32(key_cols, salt, 0)
    b = hash32(key_cols, salt, 1)
    return [F.shiftright(a, 16), a.bitwiseAND(0xFFFF), F.shiftright(b, 16), b.bitwiseAND(0xFFFF)]


def exact_holdout(df: DataFrame, key_cols: Sequence[str], fraction: float,
                  salt: str = HOLDOUT_SALT, col: str = "split",
                  names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """Exactly ``ceil(n * fraction)`` test rows — the rows with the
    smallest (64-bit key hash, key), as a global sort would pick them, but
    without sorting or collecting the table.

    The hash is read as four 16-bit digits. Each round counts the rows per
    next digit inside the current boundary prefix (at most 65,536 counts) and
    fixes that digit; rows with a smaller prefix are test rows. What is left at
    the boundary are rows of one hash, nearly always of one key; the rows still
    needed are its first in key order.

    NULL keys are keys like others. If several rows share the boundary key and
    only some of them are needed, no key can tell them apart: ValueError.
    """
    key_cols = list(key_cols)
    dcols = [f"__d{i}" for i in range(4)]
    marked = df.select("*", *[d.alias(c) for d, c in zip(_digits(key_cols, salt), dcols)])
    prefix_eq, is_test, need = F.lit(True), F.lit(False), None
    for dc in dcols:
        # a running sum over at most 65,536 bucket counts (one small task)
        # finds the bucket where the cut falls; one row reaches the driver
        counts = marked.filter(prefix_eq).groupBy(dc).agg(F.count(F.lit(1)).alias("c"))
        running = Window.orderBy(dc).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        cum = counts.withColumn("cum", F.sum("c").over(running))
        if need is None:  # the first round knows the row count as well
            cum = cum.withColumn("need", F.ceil(F.sum("c").over(Window.partitionBy()) * F.lit(float(fraction))))
        else:
            cum = cum.withColumn("need", F.lit(need))
        cut = cum.filter(F.col("cum") >= F.col("need")).orderBy(dc).limit(1).first()
        need = 0 if cut is None else int(cut["need"])
        if need == 0:
            break
        is_test = is_test | (prefix_eq & (F.col(dc) < cut[dc]))
        prefix_eq = prefix_eq & (F.col(dc) == cut[dc])
        need -= cut["cum"] - cut["c"]
        if need == cut["c"]:  # the whole bucket
            is_test, need = is_test | prefix_eq, 0
            break
    if need:
        # keys of one 64-bit hash: taken whole, in key order
        edge = marked.filter(prefix_eq).groupBy(*key_cols).agg(F.count(F.lit(1)).alias("c")).orderBy(*key_cols).limit(need).collect()
        for r in edge:
            if need < r["c"]:
                raise ValueError(f"{r['c']} rows share the boundary key; the key must identify rows")
            same = prefix_eq
            for k in key_cols:
                same = same & F.col(k).eqNullSafe(F.lit(r[k]))
            is_test, need = is_test | same, need - r["c"]
            if not need:
                break
    return marked.withColumn(col, F.when(is_test, names[1]).otherwise(names[0])).drop(*dcols)
