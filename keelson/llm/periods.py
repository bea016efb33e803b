"""Periodic run detection (operator 11).

A run is a stretch of consecutive words with smallest period q (words q apart
are identical), at least twice q long, that no neighbouring word extends.

Runs of a period below 16 come from a direct scan of each lag. For the
periods from B to 2B (B = 16, 32, ...) a text's k-grams of words are hashed
and the least one of every window of at most B words is a minimizer. A run
holds its first period twice, so it holds the same window twice, q apart: two
equal minimizers B to 2B apart are a seed, and a seed is extended to both
sides by comparing the words themselves. Minimizers are taken among the
k-grams without a period of k/2 or less, whose equal neighbours are more than
k/2 apart, so there are at most eight seeds to a minimizer whatever the text.
A run without such a k-gram is two touching runs of one small period; those
are known from earlier scales, and the lags that lay one on the other are
enumerated, each a run of its own.

Texts of an Arrow batch are handled together, in blocks of ``BLOCK`` words,
longest first, so that a scale works on the texts long enough for it. Nothing
is shuffled; a text's work is proportional to its words times the scales.

Cases: null, empty and blank texts have no words, no runs and an empty
collapsed text; rows stay one for one, repeated and null ids included; an
empty table gives an empty result; extra columns are left out, whatever their
names; whole texts are searched, and one longer than a block is a block.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import id_and_bytes, table

#: words of a block of texts handled together
BLOCK = 400_000
#: periods below are scanned lag by lag
SHORT = 16
LEAST = 12
ODD = 0x9E3779B97F4A7C15
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)

Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, end, period


def lag_stretches(x: np.ndarray, q: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The maximal [start, end) of at least ``least`` places with x[i] == x[i + q]."""
    at = np.flatnonzero(x[:-q] == x[q:]) if len(x) > q else np.empty(0, np.int64)
    cut = np.flatnonzero(np.diff(at) != 1)
    first, last = (at[np.r_[0, cut + 1]], at[np.r_[cut, len(at) - 1]]) if len(at) else (at, at)
    keep = last - first + 1 >= least
    return first[keep], last[keep] + 1


def sliding(a: np.ndarray, w: int, op) -> np.ndarray:
    """``op`` (minimum or maximum) over every ``w`` consecutive values."""
    out, span = a, 1
    while span * 2 <= w:
        out, span = op(out[:-span], out[span:]), span * 2
    return op(out[:len(a) - w + 1], out[w - span:w - span + len(a) - w + 1])


def smallest(runs: list[Runs]) -> Runs:
    """Of the runs over the same words the one of the smallest period, by start and end."""
    s, e, q = (np.concatenate(c) for c in zip(*runs))
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    new = np.r_[True, (np.diff(s) != 0) | (np.diff(e) != 0)] if len(s) else np.empty(0, bool)
    return s[new], e[new], q[new]


def reach(x: np.ndarray, at: np.ndarray, q: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """How far every place goes on with x[i] == x[i + q], up to its limit."""
    end, live, width = at.copy(), np.flatnonzero(at < limit), 8
    while len(live):
        span = end[live][:, None] + np.arange(width)
        same = span < limit[live][:, None]
        same &= x[np.minimum(span, len(x) - 1)] == x[np.minimum(span + q[live][:, None], len(x) - 1)]
        went = np.where(same.all(1), width, same.argmin(1))
        end[live] += went
        live = live[went == width]
        width = max(8, min(width * 2, 1024, (1 << 21) // max(len(live), 1)))
    return end


def extended(x: np.ndarray, at: np.ndarray, q: np.ndarray) -> Runs:
    """Runs around the seeds (x[at] == x[at + q]). Seeds of one lag that lie in
    the same stretch are chained, so a stretch's words are compared once."""
    order = np.lexsort((at, q))
    at, q = at[order], q[order]
    new = np.r_[True, (np.diff(at) != 0) | (np.diff(q) != 0)]
    at, q = at[new], q[new]
    follows = np.r_[q[1:] == q[:-1], False]
    limit = np.where(follows, np.r_[at[1:], 0], len(x) - q)
    end = reach(x, at, q, limit)
    joined = follows & (end == limit)
    head, tail = np.flatnonzero(~np.r_[False, joined[:-1]]), np.flatnonzero(~joined)
    mirrored = len(x) - at[head] - q[head]
    back = reach(x[::-1], mirrored, q[head], len(x) - q[head]) - mirrored
    s, e, q = at[head] - back, end[tail], q[head]
    keep = e - s >= np.maximum(q, LEAST - q)
    return s[keep], e[keep] + q[keep], q[keep]


def minimizer_seeds(x: np.ndarray, known: Runs, power: tuple[np.ndarray, np.ndarray], scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) of equal minimizers ``scale`` to twice ``scale`` apart."""
    k = max(LEAST, scale // 2)
    w = scale - k + 1
    n = len(x) - k + 1
    if n < w:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    total, inverse = power
    h = (total[k:k + n] - total[:n]) * inverse[:n]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    s, e, q = known
    inner = (q * 2 <= k) & (e - s >= k) & (e <= len(x))
    edge = np.bincount(s[inner], minlength=n + 1)[:n + 1] - np.bincount(e[inner] - k + 1, minlength=n + 1)[:n + 1]
    plain = np.cumsum(edge)[:n] == 0
    h = np.where(plain, h, TOP)
    least = np.zeros(n + w - 1, np.uint64)
    least[w - 1:n] = sliding(h, w, np.minimum)
    chosen = np.flatnonzero((h == sliding(least, w, np.maximum)) & plain)
    order = np.argsort(h[chosen], kind="stable")
    at = chosen[order]
    g = h[at]
    found, i, j = [], np.arange(len(at)), 1
    while len(i := i[i + j < len(at)]):
        d = at[i + j] - at[i]
        near = (g[i + j] == g[i]) & (d < 2 * scale)
        i, d = i[near], d[near]
        found.append((at[i[d >= scale]], d[d >= scale]))
        j += 1
    return (np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])) if found else (at[:0], at[:0])


def touching_seeds(x: np.ndarray, known: Runs, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, lag) for lags of ``scale`` to twice ``scale`` that lay a run of
    a small period on a touching one of the same period."""
    s, e, p = known
    small = (p * 2 <= max(LEAST, scale // 2)) & (e - s >= scale) & (e <= len(x))
    s, e, p = s[small], e[small], p[small]
    order = np.lexsort((s, p))
    s, e, p = s[order], e[order], p[order]
    ats, lags = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i in np.flatnonzero((p[1:] == p[:-1]) & (s[1:] <= e[:-1])):
        period, needle, hay = int(p[i]), x[s[i]:s[i] + p[i]], x[s[i + 1]:s[i + 1] + 2 * p[i] - 1]
        off = np.flatnonzero((np.lib.stride_tricks.sliding_window_view(hay, period) == needle).all(1)) if period < 64 else _find(needle, hay)
        if len(off):
            base = int(s[i + 1] + off[0] - s[i])
            lag = np.arange(scale + (base - scale) % period, min(2 * scale - 1, e[i] - s[i], e[i + 1] - s[i + 1]) + 1, period)
            ats.append(np.maximum(s[i], s[i + 1] - lag))
            lags.append(lag)
    return np.concatenate(ats), np.concatenate(lags)


def _find(needle: np.ndarray, hay: np.ndarray) -> list[int]:
    """The place of one number array in another, if any."""
    a, b, size, at = needle.tobytes(), hay.tobytes(), needle.itemsize, -1
    while (at := b.find(a, at + 1)) >= 0:
        if at % size == 0:
            return [at // size]
    return []


def runs_of(x: np.ndarray, sizes: np.ndarray) -> Runs:
    """All runs of texts laid end to end, by start and end. ``x`` holds their
    word numbers, a number of its own after each text; ``sizes`` are their
    word counts, largest first."""
    found = [(s, e + q, np.full(len(s), q)) for q in range(1, SHORT) for s, e in [lag_stretches(x, q, max(q, LEAST - q))]]
    known = smallest(found)
    scale, ends = SHORT, np.cumsum(sizes + 1)
    power = None
    while len(sizes) and 2 * scale <= sizes[0]:
        part = x[:ends[np.searchsorted(-sizes, -2 * scale, "right") - 1]]
        if power is None:  # sums of word hashes times powers of an odd number, and the powers' inverses
            mixed = (part.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(31)
            mixed *= np.uint64(0xD6E8FEB86659FD93)
            mixed ^= mixed >> np.uint64(33)
            steps = np.full(len(part) + 1, pow(ODD, -1, 1 << 64), np.uint64)
            steps[0] = 1
            up = np.full(len(part), ODD, np.uint64)
            up[0] = 1
            power = np.r_[np.uint64(0), np.cumsum(mixed * np.cumprod(up), dtype=np.uint64)], np.cumprod(steps)
        seeds = [minimizer_seeds(part, known, power, scale), touching_seeds(part, known, scale)]
        at, q = (np.concatenate(c) for c in zip(*seeds))
        if len(at):
            known = smallest([known, extended(part, at, q)])
        scale *= 2
    return known


Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def block_runs(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For every text, in order: its runs' starts, lengths and periods, and which words are kept."""
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    ends = np.cumsum(sizes[order] + 1)
    x = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
    own = np.ones(len(x), bool)
    own[ends - 1] = False
    x[own] = pa.array([w for k in order for w in texts[k]], pa.binary()).dictionary_encode().indices.to_numpy()
    x[~own] = -1 - np.arange(len(ends))
    s, e, q = runs_of(x, sizes[order])
    edge = np.bincount(s + q, minlength=len(x) + 1) - np.bincount(e, minlength=len(x) + 1) if len(s) else np.zeros(len(x) + 1, np.int64)
    kept = np.cumsum(edge)[:len(x)] == 0
    begin = ends - sizes[order] - 1
    first = np.searchsorted(s, np.r_[begin, len(x)])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    for i in place:
        a, b = first[i], first[i + 1]
        yield s[a:b] - begin[i], e[a:b] - s[a:b], q[a:b], kept[begin[i]:ends[i] - 1]


def collapse_runs(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document its number of words, all runs (by start, then period) and
    the text without what a run says after its first period, words joined by
    one space. ``rewrite`` changes a text's words before they are searched."""
    rows = id_and_bytes(docs)
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lo = 0
            ids, texts, words = batch.column(0).to_pylist(), [], 0
            for k, text in enumerate(batch.column(1)):
                own = text.as_py().split()
                texts.append(rewrite(ids[k], own) if rewrite else own)
                words += len(own)
                if words < BLOCK and k + 1 < len(ids):
                    continue
                counts, parts, clean = [], [], []
                for t, (s, length, q, kept) in zip(texts, block_runs(texts)):
                    counts.append(len(s))
                    parts.append((s, length, q))
                    clean.append(b" ".join(t if kept.all() else [t[i] for i in np.flatnonzero(kept).tolist()]))
                offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
                runs = pa.StructArray.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts)], fields=list(run_type))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, len(texts)), pa.array([len(t) for t in texts], pa.int64()),
                     pa.ListArray.from_arrays(offsets, runs), pa.array(clean, pa.binary())], ["doc_id", "n_words", "runs", "clean"])
                lo, texts, words = k + 1, [], 0

    return rows.mapInArrow(run, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, clean binary").withColumn(
        "clean", F.col("clean").cast("string"))


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's alteration: a tenth of the texts, by a hash of the id,
    end in a repeated period. A text of a null id stays as it is."""
    n = len(words)
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op11(docs: DataFrame) -> DataFrame:
    found = collapse_runs(docs, repeated_tail)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.try_element_at(F.sort_array(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(1))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"), F.expr("1000 * -best.less div best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", line), 256).alias("runs_sha256"), F.sha2("clean", 256).alias("collapsed_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11(table(spark, sf_dir, "documents"))
