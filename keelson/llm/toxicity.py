"""Counterfactual-regularised toxicity scores (operator 10).

A hashed linear classifier over the distinct words of a text and their first
letters. For every labelled text that names an identity group, a counterfactual
text swaps each identity term with another term of its set; the squared change
of the log-odds between the two joins the loss, so that naming a group does not
move the score by itself.

The classifier is fitted on a bounded sample of the labelled rows
(``sample_rows``, chosen by a hash of the id over the whole table); every text
is scored whole.

Cases: null or empty text has no features and scores the bias; no labelled row
scores 0; contradicting labels of one id count as toxic; rows stay one for
one, repeated and null ids included (a null id counts as not held out); an
empty table gives an empty result.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import beside_text, fold, fresh_worker, id_and_bytes, rows_again, schema_with, table
from keelson.llm.linear import Cache, Scorer, fit

# identity terms that stand for each other (fixed values)
IDENTITY_SETS = (
    ("man", "woman", "person"), ("men", "women", "people"), ("male", "female", "human"), ("boy", "girl", "child"),
    ("he", "she", "they"), ("him", "her", "them"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "sikh", "catholic"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "sikhs", "catholics"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab", "indigenous"),
    ("gay", "lesbian", "straight", "bisexual", "heterosexual", "homosexual", "queer"),
    ("transgender", "cisgender", "nonbinary"), ("immigrant", "refugee", "foreigner", "citizen"),
    ("immigrants", "refugees", "foreigners", "citizens"), ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly"), ("american", "mexican", "chinese", "indian", "russian", "german", "french", "spanish"),
    ("mann", "frau", "mensch"), ("homme", "femme", "personne"), ("hombre", "mujer", "persona"),
)
SWAP = {w.encode(): s[(i + 1) % len(s)].encode() for s in IDENTITY_SETS for i, w in enumerate(s)}
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
BLANKED = bytes(32 if c in MARKS else c for c in range(256))


def features(token: bytes) -> list[int] | None:
    """Of one lower-case token: each of its words, and the word's first four,
    five and six bytes, as numbers."""
    core = token.strip(MARKS)
    words = (core,) if len(core.translate(None, MARKS)) == len(core) else core.translate(BLANKED).split()
    out = []
    for w in words:
        four = crc32(w[:4])
        five = crc32(w[4:5], four)
        out += four, five ^ 5, crc32(w[5:6], five) ^ 6, crc32(w[4:], four) ^ 7
    return out or None


def tokens(text: str) -> set[bytes]:
    return set(text.lower().encode("utf-8", "replace").split())


def counterfactual(words: set[bytes]) -> set[bytes] | None:
    """The tokens with identity terms swapped; None if there are none."""
    if not any(w.strip(MARKS) in SWAP for w in words):
        return None
    return {w.replace(core, SWAP[core]) if (core := w.strip(MARKS)) in SWAP else w for w in words}


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000, penalty: float = 1.0) -> Scorer:
    """``labels`` has doc_id and a 0/1 column ``label``."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("label").cast("int").alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "label", "text")  # sample_rows rows of two numbers
    # an id may have many rows: then a hash of the text picks among them
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(F.broadcast(sample), "doc_id").count()
    if rows > sample_rows:
        found = found.filter(F.pmod(F.xxhash64("text", "doc_id"), F.lit(1 << 40)) < int((1 << 40) * sample_rows / rows))

    def featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("toxicity")
        cache = Cache(features, 100_000)
        flat = lambda words: np.sort(np.fromiter(cache.union(words), np.uint32)).view(np.int32)
        for whole in batches:
            for batch in (whole.slice(k, 100) for k in range(0, whole.num_rows, 100)):
                words = [tokens(t) for t in batch.column(2).to_pylist()]
                own = [flat(w) for w in words]
                other = [flat(c) if (c := counterfactual(w)) else None for w in words]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int32())),
                                                  pa.array(other, pa.list_(pa.int32()))], ["doc_id", "label", "own", "other"])

    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("toxicity")
        rows = []
        for b in batches:
            for i, (key, y) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                other = b.column(3)[i].values
                rows.append((key, y, b.column(2)[i].values.to_numpy().view(np.uint32), None if other is None else other.to_numpy().view(np.uint32)))
        rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
        model = fit([r[2] for r in rows], np.array([r[1] for r in rows], np.float64),
                    [(i, r[3]) for i, r in enumerate(rows) if r[3] is not None], penalty)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps([model.bias, list(model.weights.items())])])], ["model"])

    fitted = found.mapInArrow(featurise, "doc_id long, label int, own array<int>, other array<int>").repartition(1).mapInArrow(
        train, "model string").first()
    bias, weights = json.loads(fitted["model"]) if fitted else (-20.0, [])
    return Scorer(bias, dict(map(tuple, weights)))


def score(docs: DataFrame, model: Scorer, carry: tuple = (), with_text: bool = False) -> DataFrame:
    """doc_id, the columns ``carry`` and the score of every row, and the text's bytes if asked for."""
    rows = id_and_bytes(docs, *carry)
    passed = range(rows.schema.names.index("doc_id") + (1 if with_text else 2), len(rows.columns))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("toxicity")
        cache = Cache(lambda t: [f for f in features(t) or () if f in model.weights] or None)
        for batch in batches:
            scores = [model.score(cache.union(tokens(t.decode("utf-8", "replace")))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(batch.column(i) for i in passed), pa.array(scores, pa.float64())],
                                             [batch.schema.names[0], *(batch.schema.names[i] for i in passed), "score"])

    return rows.mapInArrow(run, schema_with(rows, "score double", () if with_text else ("text",)))


def learn_toxicity(docs: DataFrame, labels: DataFrame) -> Scorer:
    return learn(docs, labels.filter(fold("doc_id", 4) != 2).select("doc_id", F.col("toxic").alias("label")))


THRESHOLD = 0.3


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    scored = score(docs, learn_toxicity(docs, labels), beside_text(docs), with_text=True)
    return rows_again(scored.filter(F.col("score") < threshold), docs, F.col("text"))


def op10(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, learn_toxicity(docs, labels), (fold("doc_id", 4).alias("fold"),)).select(
        "doc_id", (F.col("fold") == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
