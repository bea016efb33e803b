"""Language id by rank-order profiles (operator 7).

A profile lists the most frequent character n-grams (one to three characters
of a word with a blank on either side) of a language, by count. A document's
own profile is compared with each language's: an n-gram adds the distance of
its two places, or the profile's length where the language lacks it; the
smallest sum wins, ties to the smaller name. The score is one minus the sum's
share of the largest possible sum.

Counts are summed in every task, then by Spark; only the profiles (``places``
n-grams for each language) travel to the tasks.

Cases: null text, text without a letter, or nothing learned gives ``und`` and
0; a null language is never learned; case is folded; rows stay one for one; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.common import fold, id_and_bytes, table

PLACES = 400


class Grams:
    """N-gram counts of texts. An n-gram is a number: its characters' code
    points, 21 bits each. Characters get small numbers of their own first, so
    that a text's n-grams are counted in an array and not by sorting."""

    def __init__(self) -> None:
        self.letter = np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), bool)
        self.dense = np.full(0x110000, -1, np.int32)
        self.dense[32] = 0
        self.points = [32]

    def count(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(n-grams, counts)."""
        a = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
        a = np.concatenate([[32], np.where(self.letter[a], a, 32), [32]])
        a = a[(a != 32) | (np.concatenate([[0], a[:-1]]) != 32)]
        if len(a) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ids = self.dense[a]
        if (ids < 0).any():
            for c in np.unique(a[ids < 0]).tolist():
                self.dense[c] = len(self.points)
                self.points.append(c)
            ids = self.dense[a]
        here = np.flatnonzero(np.bincount(ids))
        small = np.zeros(here[-1] + 1, np.int64)
        small[here] = np.arange(len(here))
        x, k, point = small[ids], len(here), np.array(self.points, np.int64)[here]
        inner = x[1:-1] != small[0]  # no n-gram reaches over a blank
        codes, counts = [], []
        for n, values in ((1, x[x != small[0]]), (2, x[:-1] * k + x[1:]), (3, ((x[:-2] * k + x[1:-1]) * k + x[2:])[inner])):
            if k**n <= 1 << 20:
                full = np.bincount(values)
                some = np.flatnonzero(full)
                full = full[some]
            else:
                some, full = np.unique(values, return_counts=True)
            codes.append(sum(point[some // k**j % k] << 21 * j for j in range(n)))
            counts.append(full)
        return np.concatenate(codes), np.concatenate(counts)


def gram_counts(docs: DataFrame, flush: int = 4_000_000) -> DataFrame:
    """(lang, gram, n) of ``text`` by ``lang``, summed over all rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, held, size = Grams(), {}, 0

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                codes, at = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([n for _, n in parts])).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)],
                                                 ["lang", "gram", "n"])

        for batch in batches:
            texts: dict[str, list[str]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts.setdefault(lang, []).append(text)
            for lang, own in texts.items():
                held.setdefault(lang, []).append(grams.count("\n".join(own)))
                size += len(held[lang][-1][0])
            if size > flush:
                yield from emit()
                held, size = {}, 0
        yield from emit()

    return docs.select("lang", "text").mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(train: DataFrame, places: int = PLACES) -> dict[str, list[int]]:
    """The n-grams of each language, most frequent first."""
    rows = train.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    w = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    top = gram_counts(rows).withColumn("place", F.row_number().over(w)).filter(F.col("place") <= places)
    out: dict[str, list[int]] = {}
    for r in sorted(top.collect(), key=lambda r: (r["lang"], r["place"])):  # places x languages
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def predict(docs: DataFrame, profiles: dict[str, list[int]], places: int = PLACES, parts: int = 5) -> DataFrame:
    langs = sorted(profiles)
    known = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    place = np.full((len(known) + 1, len(langs)), -1, np.int64)
    for j, lang in enumerate(langs):
        place[np.searchsorted(known, np.array(profiles[lang], np.int64)), j] = np.arange(len(profiles[lang]))

    def one(grams: Grams, text: str) -> tuple[str, float]:
        codes, n = grams.count(text)
        if not len(codes) or not langs:
            return "und", 0.0
        codes = codes[np.lexsort((codes, -n))][:places]
        at = np.searchsorted(known, codes)
        at[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != codes)] = len(known)
        theirs = place[at]
        apart = np.where(theirs < 0, places, np.abs(theirs - np.arange(len(codes))[:, None])).sum(0)
        j = int(apart.argmin())
        return langs[j], 1 - float(apart[j]) / (places * len(codes))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in batches:
            found = [one(grams, t.decode("utf-8", "replace")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([l for l, _ in found], pa.string()),
                                              pa.array([s for _, s in found], pa.float64())], ["doc_id", "fold", "lang_pred", "score"])

    return id_and_bytes(docs, fold("doc_id", parts).alias("fold")).mapInArrow(
        run, "doc_id long, fold int, lang_pred string, score double")


def op7(docs: DataFrame) -> DataFrame:
    profiles = learn_profiles(docs.filter(fold("doc_id", 5) != 0))
    return predict(docs, profiles).select("doc_id", (F.col("fold") == 0).alias("held_out"), "lang_pred", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7(table(spark, sf_dir, "documents"))
