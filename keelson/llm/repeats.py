"""Removal of repeated spans (operator 4).

A byte goes if a string of ``span`` bytes covers it that also starts anywhere
else in the collection.

Every document is cut into contexts at anchors that its content alone chooses:
the smallest hashed 32-gram of a window is the window's anchor, and windows
next to each other with the same anchor form a context. Equal windows have
equal anchors at equal places, so only contexts with the same anchor can share
a window. Contexts that occur twice are repeated as a whole. Where different
contexts share an anchor, they are gathered by anchor, aligned at it, and built
column by column: each round inserts one symbol of every context, from the
last column to the first, and updates the column of the Burrows-Wheeler
transform, the order of the suffixes and their common prefixes. Columns are
read from, and transform columns written to, sequential external files, so a
block's memory holds an order, common prefixes and one column.

An anchor with more different contexts than ``hot`` (a passage in very many
documents) is not gathered: its windows are counted by fingerprint, in partial
sums, by Spark.

Cases: null text is empty; texts shorter than a span lose nothing; repeated
rows are documents of their own; null ids are carried along; matches never
cross documents. Documents are named by a 128-bit hash of their text. An empty
table gives an empty result.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import id_and_bytes, maybe_in, saved, seen_bits, table

SPAN = 400
GRAM = 32
BASE = np.uint64(0x9E3779B97F4A7C15)
PIECE = 1 << 22  # a document's windows are looked at so many at a time
PAD = 0xFF  # no byte of UTF-8


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Windows' anchors in one text."""

    def __init__(self, span: int = SPAN, gram: int = GRAM):
        self.span, self.gram = span, gram
        self.symbol = np.random.default_rng(7).integers(1, 2**63, 256, np.uint64) | np.uint64(1)
        self.inverse = pow(int(BASE), -1, 1 << 64)
        self.grow(1 << 16)

    def grow(self, n: int) -> None:
        self.up, self.down = powers(int(BASE), n), powers(self.inverse, n)

    def hashes(self, x: np.ndarray) -> np.ndarray:
        """Of every gram, mixed."""
        if len(x) + 1 > len(self.up):
            self.grow(2 * len(x) + 1)
        total = np.zeros(len(x) + 1, np.uint64)
        np.cumsum(self.symbol[x] * self.up[:len(x)], out=total[1:])
        h = (total[self.gram:] - total[:-self.gram]) * self.down[:len(x) - self.gram + 1]
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(32))

    def contexts(self, text: bytes) -> Iterator[tuple[np.ndarray, ...]]:
        """(first window, windows, anchor's distance, anchor's hash)."""
        for a in range(0, len(text) - self.span + 1, PIECE):
            x = np.frombuffer(text, np.uint8, min(len(text), a + PIECE + self.span - 1) - a, a)
            h = self.hashes(x)
            w, n = self.span - self.gram + 1, len(x) - self.span + 1
            # the leftmost smallest gram of each window: hash above, place below
            low = np.uint64((1 << 23) - 1)
            v = np.full(-(-len(h) // w) * w, np.iinfo(np.uint64).max, np.uint64)
            v[:len(h)] = (h & ~low) | np.arange(len(h), dtype=np.uint64)
            rows = v.reshape(-1, w)
            ahead = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
            behind = np.minimum.accumulate(rows, 1).ravel()
            at = (np.minimum(ahead[:n], behind[w - 1:w - 1 + n]) & low).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            yield first + a, np.diff(np.append(first, n)), at[first] - first, h[at[first]]


# a context's place in one number: first window, windows, anchor's distance
def place(first: np.ndarray, n: np.ndarray, ahead: np.ndarray) -> np.ndarray:
    return first << 24 | n << 12 | ahead


def unplace(p: int) -> tuple[int, int, int]:
    return p >> 24, p >> 12 & 4095, p & 4095


def find_contexts(texts: DataFrame, span: int) -> DataFrame:
    """One row per context: the text's name, place, anchor, and a fingerprint
    of its bytes."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(span)
        for batch in batches:
            name1, name2 = (batch.column(i).to_numpy() for i in (0, 1))
            row, places, marks, prints = [], [], [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                for first, n, ahead, mark in anchors.contexts(text):
                    places.append(place(first, n, ahead))
                    marks.append(mark)
                    row.append(np.full(len(first), i))
                    prints += [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(first.tolist(), (first + n + span - 1).tolist())]
            if row:
                at = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name1[at]), pa.array(name2[at]), pa.array(np.concatenate(places)), pa.array(np.concatenate(marks).view(np.int64)),
                     pa.array(np.array(prints, np.uint64).view(np.int64))], ["name1", "name2", "place", "anchor", "print"])

    return texts.select("name1", "name2", "text").mapInArrow(run, "name1 long, name2 long, place long, anchor long, print long")


def repeated_windows(strings: list[bytes], ahead: list[int], span: int) -> list[np.ndarray]:
    """For strings aligned ``ahead`` bytes after their starts: which windows of
    each also occur in another, at the same distance from the anchor.

    Columns are inserted from the last to the first. ``order`` sorts the
    suffixes that begin in the newest column; ``common[r]`` is what the r-th
    shares with the one before. The symbols in that order are the newest column
    of the transform."""
    m, lead = len(strings), max(ahead)
    width = max(len(s) + lead - a for s, a in zip(strings, ahead))
    start, windows = np.array([lead - a for a in ahead]), np.array([len(s) - span + 1 for s in strings])
    found = np.zeros((m, windows.max()), bool)
    with tempfile.TemporaryFile() as columns, tempfile.TemporaryFile() as transform:
        for a in range(0, width, 64):  # the columns, transposed 64 at a time, last first
            b = width - a
            part = np.full((m, min(64, b)), PAD, np.uint8)
            c0 = b - part.shape[1]
            for i, s in enumerate(strings):
                lo, hi = max(c0, start[i]), min(b, start[i] + len(s))
                if lo < hi:
                    part[i, lo - c0:hi - c0] = np.frombuffer(s, np.uint8, hi - lo, lo - start[i])
            columns.write(np.ascontiguousarray(part[:, ::-1].T).tobytes())
        columns.seek(0)
        order, common = np.arange(m), np.zeros(m + 1, np.int32)
        for column in range(width - 1, -1, -1):
            symbols = np.frombuffer(columns.read(m), np.uint8)[order]
            transform.write(symbols.tobytes())
            step = np.argsort(symbols, kind="stable")
            shared = np.minimum.reduceat(common, step + 1)  # least common prefix between one and the next
            same = symbols[step[1:]] == symbols[step[:-1]]
            common = np.zeros(m + 1, np.int32)
            common[1:m] = np.where(same & (symbols[step[1:]] != PAD), shared[:-1] + 1, 0)
            order = order[step]
            again = order[(common[:m] >= span) | (common[1:] >= span)]
            at = column - start[again]
            fit = (at >= 0) & (at < windows[again])
            found[again[fit], at[fit]] = True
    return [f[:n] for f, n in zip(found, windows)]


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the runs that are true."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), (edge[1::2] - edge[::2]).tolist()))


RUN_SCHEMA = "name1 long, name2 long, run long"


def run_rows(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    """(name, name, first window << 24 | windows)."""
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else ([], [], []))], ["name1", "name2", "run"])


def column_wise(contexts: DataFrame, span: int, block: int) -> DataFrame:
    """Runs of repeated windows of contexts gathered by anchor. ``contexts``
    has anchor, name1, name2, place, asked (whether its windows are wanted) and
    bytes; whole anchors are built together, about ``block`` contexts at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def built() -> pa.RecordBatch:
            places = [unplace(r["place"]) for r in held]
            found = repeated_windows([r["bytes"] for r in held], [p[2] for p in places], span)
            return run_rows([(r["name1"], r["name2"], p[0] + s << 24 | n) for r, p, f in zip(held, places, found) if r["asked"] for s, n in runs_of(f)])

        for batch in batches:
            for r in batch.to_pylist():
                if len(held) >= block and r["anchor"] != held[-1]["anchor"]:
                    yield built()
                    held = []
                held.append(r)
        if held:
            yield built()

    return contexts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, RUN_SCHEMA)


def by_fingerprint(contexts: DataFrame, span: int) -> DataFrame:
    """Runs of the repeated windows of hot anchors: windows by fingerprint."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                first, n, _ = unplace(r["place"])
                for j in range(n):
                    h = xxhash.xxh3_128_intdigest(r["bytes"][j:j + span])
                    out.append((r["name1"], r["name2"], first + j << 24 | 1, (h >> 64) - (1 << 63), (h & (1 << 64) - 1) - (1 << 63), r["asked"]))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in [*zip(*out)][:5]), pa.array([x[5] for x in out])] if out else
                                             [pa.array([], pa.int64())] * 5 + [pa.array([], pa.bool_())], ["name1", "name2", "run", "p1", "p2", "asked"])

    windows = contexts.mapInArrow(run, RUN_SCHEMA + ", p1 long, p2 long, asked boolean")
    twice = windows.groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("p1", "p2")
    return windows.filter("asked").join(twice, ["p1", "p2"], "left_semi").select("name1", "name2", "run")


def repeated_runs(texts: DataFrame, span: int, block: int, hot: int) -> DataFrame:
    """(name1, name2, run): runs of windows that occur again."""
    contexts = saved(find_contexts(texts, span))
    # anchors that occur twice, and whether their contexts differ
    anchors = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("print").alias("a"), F.max("print").alias("b")).filter(
        "n > 1").select("anchor", (F.col("a") != F.col("b")).alias("mixed"))
    again = saved(contexts.join(anchors, "anchor").withColumn("row", F.xxhash64("name1", "name2", "place")))
    groups = again.groupBy("anchor", "print").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("one"))
    judged = again.join(groups, ["anchor", "print"]).select(
        "anchor", "name1", "name2", "place", (F.col("n") > 1).alias("whole"),
        (F.col("mixed") & (F.col("row") == F.col("one"))).alias("needed"))
    judged = saved(judged)
    place = F.col("place")
    whole = judged.filter("whole").select("name1", "name2", F.shiftright(place, 24).alias("first"),
                                          F.shiftright(place, 12).bitwiseAND(4095).alias("n")).select(
        "name1", "name2", (F.shiftleft("first", 24).bitwiseOR(F.col("n"))).alias("run"))
    # the bytes of one context of each kind, where kinds differ
    needed = judged.filter("needed").select("anchor", "name1", "name2", "place", (~F.col("whole")).alias("asked")).distinct()
    counted = needed.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    needed = saved(needed.join(counted, "anchor"))
    asked = needed.groupBy("name1", "name2").agg(F.collect_set(F.struct("anchor", "place", "asked", "kinds")).alias("asked"))
    own = maybe_named(texts, seen_bits(needed, "name1")).select("name1", "name2", "text")
    found = asked.join(own.dropDuplicates(["name1", "name2"]), ["name1", "name2"]).select("name1", "name2", "text", "asked")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "name1", "name2", "place", "asked", "kinds", "bytes"]
        for batch in batches:
            out = []
            for name1, name2, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
                for x in asked:
                    first, n, _ = unplace(x["place"])
                    out.append((x["anchor"], name1, name2, x["place"], x["asked"], x["kinds"], text[first:first + n + span - 1]))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)], names)

    cuts = saved(found.mapInArrow(cut, "anchor long, name1 long, name2 long, place long, asked boolean, kinds long, bytes binary"))
    return whole.union(column_wise(cuts.filter(F.col("kinds") <= hot), span, block)).union(
        by_fingerprint(cuts.filter(F.col("kinds") > hot), span))


def maybe_named(texts: DataFrame, bitmap) -> DataFrame:
    """The rows whose name may be in the bitmap, before any shuffle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bitmap.value, batch.column("name1").to_numpy())))

    return texts.mapInArrow(run, texts.schema)


def remove_repeats(docs: DataFrame, span: int = SPAN, block: int = 40_000, hot: int = 5_000) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans and the bytes that are left."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    texts = id_and_bytes(docs, F.xxhash64(text).alias("name1"), F.xxhash64(F.lit(1), text).alias("name2"))
    runs = saved(repeated_runs(texts.filter(F.octet_length("text") >= span), span, block, hot))
    bitmap = seen_bits(runs, "name1")
    mine = runs.groupBy("name1", "name2").agg(F.collect_set("run").alias("runs"))
    touched = maybe_named(texts, bitmap).join(mine, ["name1", "name2"], "left").select("doc_id", "text", F.coalesce("runs", F.array()).alias("runs"))

    def untouched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(~maybe_in(bitmap.value, batch.column("name1").to_numpy())))

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                parts, a, n = [], 0, 0
                for r in sorted(runs):
                    first, end = r >> 24, (r >> 24) + (r & 0xFFFFFF) - 1 + span
                    if first > a or not n:
                        parts.append(text[a:first])
                        n += 1
                    a = max(a, end)
                kept.append(b"".join([*parts, text[a:]]))
                spans.append(n)
                removed.append(len(text) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r + len(k) for r, k in zip(removed, kept)], pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    none = texts.mapInArrow(untouched, texts.schema).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.col("text").alias("kept"))
    return none.union(touched.mapInArrow(apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"))


def op4(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4(table(spark, sf_dir, "documents"))
