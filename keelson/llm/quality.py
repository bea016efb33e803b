"""Weak-label quality classifier (operator 9).

Overlapping heuristic labellers vote good, bad or nothing on every document.
Expectation-maximisation over the counts of all vote patterns (at most
3 ** labellers rows) estimates how often each labeller is right about good and
about bad documents; the posterior of a document's pattern is its soft label.
A hashed linear scorer over the shapes of tokens is fitted to those labels on
a bounded sample (``sample_rows``, by a hash of the text) and scores all rows.

No given label is used; labels only measure the result in the tests.

Cases: null and empty text get the votes of an empty text; rows stay one for
one, repeated and null ids included; an empty table gives an empty result.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import id_and_bytes, table
from keelson.llm.linear import Cache, Scorer, bucket, fit

UPPER, LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123), *range(128, 256)])
SYMBOLS, MARKS = b"#$%&*+/<=>@\\^_`{|}~[]", b"!?#$%&*|~"
#: marks become !, white space becomes blank, all else a
MARKED = bytes(33 if c in MARKS else 32 if c in b" \t\n\r\v\f" else 97 for c in range(256))
COARSE = bytes(65 if 65 <= c <= 90 else 97 if c > 127 or 97 <= c <= 122 else 48 if 48 <= c <= 57 else c for c in range(256))
#: labellers, each with the measure it looks at and its bounds: bad below the
#: first or above the last, good between the middle two, no vote elsewhere
LABELLERS = (("words", 5, 20, 1e9, 1e9), ("word_size", 2.0, 3.0, 9.0, 12.0), ("symbols", -1, 0, 0.02, 0.06),
             ("upper", -1, 0, 0.08, 0.3), ("repeated_lines", -1, 0, 0.1, 0.3), ("marked_words", -1, 0, 0.15, 0.4),
             ("letters", 0.6, 0.75, 1, 2), ("commonest", -1, 0, 0.12, 0.2), ("repeated_words", -1, 0, 0.05, 0.2))


def measures(text: bytes, words: list[bytes], counts: Counter) -> dict[str, float]:
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, w = max(len(text), 1), max(len(words), 1)
    letters = len(text) - len(text.translate(None, LETTERS))
    return {"words": len(words), "word_size": sum(map(len, words)) / w, "symbols": (len(text) - len(text.translate(None, SYMBOLS))) / n,
            "upper": (len(text) - len(text.translate(None, UPPER))) / max(letters, 1),
            "repeated_lines": 1 - len(set(lines)) / max(len(lines), 1),
            "marked_words": (text + b" ").translate(MARKED).count(b"! ") / w, "letters": letters / n,
            "commonest": max(counts.values(), default=0) / max(w, 20),
            "repeated_words": sum(map(eq, words, words[1:])) / max(w, 20)}


def votes(text: bytes, words: list[bytes], counts: Counter) -> str:
    """One letter a labeller: g(ood), b(ad) or - for no vote."""
    m = measures(text, words, counts)
    return "".join("b" if m[k] < a or m[k] > d else "g" if b <= m[k] <= c else "-" for k, a, b, c, d in LABELLERS)


def counted(text: bytes) -> tuple[bytes, list[bytes], Counter]:
    words = text.split()
    return text, words, Counter(words)


def estimate(patterns: dict[str, int], rounds: int = 100) -> dict[str, float]:
    """The posterior of good for each pattern. Labellers start a little better
    than chance, which fixes which class is which."""
    names = sorted(patterns)
    if not names:
        return {}
    n = np.array([patterns[p] for p in names], np.float64)
    x = np.array([[{"g": 0, "b": 1, "-": 2}[c] for c in p] for p in names])
    one = np.eye(3)[x]  # pattern, labeller, vote
    bad = (x == 1).sum(1) / np.maximum((x < 2).sum(1), 1)
    q = np.clip(1 - 1.5 * bad, 0.02, 0.98)
    for _ in range(rounds):
        prior = np.clip((q * n).sum() / n.sum(), 1e-3, 1 - 1e-3)
        good = np.einsum("p,plv->lv", q * n, one) + 1
        poor = np.einsum("p,plv->lv", (1 - q) * n, one) + 1
        good, poor = good / good.sum(1, keepdims=True), poor / poor.sum(1, keepdims=True)
        odds = np.log(prior / (1 - prior)) + np.einsum("plv,lv->p", one, np.log(good / poor))
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return dict(zip(names, q.tolist()))


def shapes(text: bytes) -> list[bytes]:
    """Of every token: letters as a or A, digits as 0, other marks as they
    are, runs shortened."""
    text = text.translate(COARSE)
    for c in (b"a", b"A", b"0", b"#", b"%", b"$", b"&", b"*", b"!", b".", b"-", b"|"):
        if c + c in text:
            text = text.replace(c * 6, c).replace(c * 3, c).replace(c * 2, c).replace(c * 2, c)
    return text.split()


def features(text: bytes, words: list[bytes], counts: Counter) -> set[int]:
    """Token shapes with the size classes of their share of the tokens, and
    those of the commonest and of repeated tokens."""
    by_shape = {s[:12]: n for s, n in Counter(shapes(text)).items()}
    by_shape |= {b" top": max(counts.values(), default=0), b" twice": sum(map(eq, words, words[1:]))}
    return {BUCKET[s, k] for s, n in by_shape.items() for k in range(bisect_left(SHARES, n / max(len(words), 20)) + 1)} | {
        BUCKET[b" size", k] for k in range(len(words).bit_length() + 1)}


SHARES = (0.02, 0.05, 0.1, 0.3, 0.6)
BUCKET = Cache(lambda x: bucket(x[0] + b" %d" % x[1]))


def classify(docs: DataFrame, sample_rows: int = 10_000, threshold: float = 0.5) -> DataFrame:
    base = id_and_bytes(docs)

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(votes(*counted(t)) for t in batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pattern", "n"])

    seen = base.mapInArrow(vote, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    posterior = estimate({r["pattern"]: r["n"] for r in seen})
    total = sum(r["n"] for r in seen)
    # a hash of the text picks each row with the same chance; the limit only guards the bound
    chosen = base.filter(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 20)) < F.lit(int((1 << 20) * min(1.0, sample_rows / max(total, 1))))).limit(2 * sample_rows)

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            seen = [counted(t) for t in texts]
            soft = [posterior.get(votes(*x), 0.5) for x in seen]
            own = [sorted(features(*x)) for x in seen]
            yield pa.RecordBatch.from_arrays([pa.array(soft, pa.float64()), pa.array(own, pa.list_(pa.int32()))], ["soft", "own"])

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(y, b.column(1)[i].values.to_numpy()) for b in batches for i, y in enumerate(b.column(0).to_pylist())]
        rows.sort(key=lambda r: (r[0], r[1].tobytes()))
        model = fit([r[1] for r in rows], np.array([r[0] for r in rows]))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([model.bias, list(model.weights.items())])])], ["model"])

    fitted = chosen.mapInArrow(featurise, "soft double, own array<int>").repartition(1).mapInArrow(train, "model string").first()
    bias, weights = json.loads(fitted["model"]) if fitted else (0.0, [])
    model = Scorer(bias, dict(map(tuple, weights)))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen, own = [], []
            for text in batch.column(1).to_pylist():
                x = counted(text)
                seen.append(votes(*x))
                own.append(model.score(features(*x)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(seen, pa.string()),
                                              pa.array([posterior.get(v, 0.5) for v in seen], pa.float64()), pa.array(own, pa.float64())],
                                             ["doc_id", "votes", "posterior", "score"])

    return base.mapInArrow(score, "doc_id long, votes string, posterior double, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"))
