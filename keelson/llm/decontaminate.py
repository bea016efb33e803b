"""Benchmark decontamination (operator 2).

The words of all test items become one generalised suffix automaton. Every
task streams its documents through it and tracks, word by word, the longest
match that ends there; a match of ``window`` words or more (or a whole item
that is shorter) marks its words. Words outside the items' vocabulary send the
automaton back to its root, so only runs of known words are streamed.

The automaton travels with the tasks: items are dealt into blocks of at most
``block_bytes`` of text, one pass over the documents for each block (one, for
any benchmark under that size). Texts are cut from the hits of all blocks; the
texts that were cut are looked at again by all blocks.

Cases: null text has no words; items without words take no part; items with a
null id mark words but are not listed; repeated items count once by id; an
empty document or benchmark table gives no hits or no rows; rows are kept one
for one, null and repeated ids included.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.common import Shared, small_batches, table, written

WINDOW = 10
# words: digits, a-z and every non-ASCII character, after lower-casing A-Z
TO_SPACE = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(TO_SPACE).split()


class SuffixAutomaton:
    """Over word numbers of many items; ``top`` and ``whole`` tell which items
    a match names."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.window = [-1], [0], window
        coded = []
        for key, words in items:
            if words:
                ids = [self.vocab.setdefault(w, len(self.vocab)) for w in words]
                coded.append((key, ids))
                last = 0
                for i in ids:
                    last = self._add(last, i)
        self.items_at: dict[int, set[str | None]] = {}
        self.whole: dict[int, list[tuple[int, str | None]]] = {}
        self.shortest = min([window, *(len(ids) for _, ids in coded)])
        for key, ids in coded:
            v, n = 0, len(ids)
            for j, i in enumerate(ids):
                v = self.next[v][i]
                if n >= window and j + 1 >= window:
                    self.items_at.setdefault(self._holding(v, window), set()).add(key)
            if n < window:
                self.whole.setdefault(self._holding(v, n), []).append((n, key))
        # nearest state on the way to the root that ends a short item
        self.short = [-1] * len(self.next)
        for v in sorted(range(len(self.next)), key=self.size.__getitem__):
            self.short[v] = v if v in self.whole else self.short[self.link[v]] if v else -1

    def _add(self, last: int, c: int) -> int:
        nxt, link, size = self.next, self.link, self.size
        if (q := nxt[last].get(c)) is not None:
            return q if size[q] == size[last] + 1 else self._split(last, c, q)
        new = len(nxt)
        nxt.append({})
        size.append(size[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if size[q] == size[p] + 1 else self._split(p, c, q)
        return new

    def _split(self, p: int, c: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.size.append(self.size[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _holding(self, v: int, n: int) -> int:
        """The state of the last n words of a match that ends in v."""
        while self.size[self.link[v]] >= n:
            v = self.link[v]
        return v

    def match(self, words: list[bytes]) -> tuple[np.ndarray, set[str | None]]:
        """Which words are hit, and the items with occurring windows."""
        n = len(words)
        hit, found = np.zeros(n, bool), set()
        if n < self.shortest or not self.vocab:
            return hit, found
        ids = np.fromiter(map(self.vocab.get, words, repeat(-1)), np.int64, n)
        unknown = np.concatenate([[-1], np.flatnonzero(ids < 0), [n]])
        for r in np.flatnonzero(np.diff(unknown) > self.shortest).tolist():
            a, b = int(unknown[r]) + 1, int(unknown[r + 1])
            self._stream(ids[a:b].tolist(), a, hit, found)
        return hit, found

    def _stream(self, ids: list[int], at: int, hit: np.ndarray, found: set[str | None]) -> None:
        nxt, link, size, window = self.next, self.link, self.size, self.window
        v = length = 0
        for i, c in enumerate(ids, at):
            while v and c not in nxt[v]:
                v = link[v]
                length = size[v]
            if c in nxt[v]:
                v = nxt[v][c]
                length += 1
            if length >= window:
                hit[i - window + 1:i + 1] = True
                found |= self.items_at[self._holding(v, window)]
            u = self.short[v]
            while u >= 0:
                for n, key in self.whole[u]:
                    if length >= n:
                        hit[i - n + 1:i + 1] = True
                        found.add(key)
                u = self.short[link[u]] if u else -1


def spans_of(text: bytes, hit: np.ndarray) -> list[tuple[int, int]]:
    """Byte spans of the runs of hit words."""
    out: list[tuple[int, int]] = []
    run = False
    for m, h in zip(WORD.finditer(text.lower()), hit.tolist()):
        if h:
            out = [*out[:-1], (out[-1][0], m.end())] if run else [*out, (m.start(), m.end())]
        run = h
    return out


def cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    parts, a = [], 0
    for s, e in spans:
        parts.append(text[a:s])
        a = e
    return b" ".join([*parts, text[a:]])


def cleaned(text: bytes, hit: np.ndarray, automaton: SuffixAutomaton) -> bytes:
    """The text without its hit spans; what joins at a cut is looked at again."""
    while hit.any():
        text = cut(text, spans_of(text, hit))
        hit, _ = automaton.match(words_of(text))
    return text


RESULT = "struct<n_words:long,n_hit:long,hits:array<struct<start:long,end:long>>,items:array<string>,clean:string>"


def item_blocks(items: DataFrame, block_bytes: int) -> list[int]:
    """How many blocks the items' total size asks for, as block numbers."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return list(range(max(1, -(-int(total) // block_bytes))))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = 1.0,
                  block_bytes: int = 2 << 20, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: the words, the hit words, byte spans of the hits, the
    items found, the text without those spans, and ``rejected``: whether more
    than ``max_coverage`` of its words are hit. ``keep`` names input columns to
    carry along."""
    small_batches(docs.sparkSession)
    items = items.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    out = docs.select(F.struct(F.col("doc_id").cast("long").alias("doc_id"), "text",
                               *[F.col(c) for c in keep if c not in ("doc_id", "text")]).alias("doc"))
    blocks = item_blocks(items, block_bytes)
    shared = []
    for b in blocks:
        own = items if len(blocks) == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(len(blocks))) == b)
        listed = [(r["item_id"], words_of(r["text"].encode())) for r in own.toLocalIterator()]
        shared.append(Shared(docs.sparkSession, SuffixAutomaton(listed, window)))
    out = _pass(out, shared[0]) if len(blocks) == 1 else _passes(out, shared)
    return out.select("doc.*", "n_words", "n_hit", "hits", "items", "clean",
                      (F.col("n_hit") > F.col("n_words") * max_coverage).alias("rejected"))


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _schema(df: DataFrame, *more: T.StructField) -> T.StructType:
    return T.StructType([df.schema["doc"], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("hits", SPANS),
                         T.StructField("items", T.ArrayType(T.StringType())), T.StructField("clean", T.StringType()), *more])


def _structs(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"start": s, "end": e} for s, e in spans]


def _pass(df: DataFrame, shared) -> DataFrame:
    """All items, as one block, over all documents."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            doc = batch.column(batch.schema.get_field_index("doc"))
            n_words, n_hit, hits, items, clean = [], [], [], [], []
            for text in doc.field("text").cast(pa.binary()).to_pylist():
                words = words_of(text or b"")
                hit, found = automaton.match(words)
                found.discard(None)
                rest = cleaned(text, hit, automaton) if text is not None and hit.any() else text
                n_words.append(len(words))
                n_hit.append(int(hit.sum()))
                hits.append(_structs(spans_of(text, hit)) if hit.any() else [])
                items.append(sorted(found))
                clean.append(None if rest is None else rest.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(hits, ARROW_SPANS),
                 pa.array(items, pa.list_(pa.string())), pa.array(clean, pa.string())],
                ["doc", "n_words", "n_hit", "hits", "items", "clean"])

    return df.mapInArrow(run, _schema(df))


def _passes(df: DataFrame, blocks: list) -> DataFrame:
    """Many blocks of items, with the result of one: the hits of all blocks
    are collected before a text is cut, and the texts that were cut are looked
    at again, by all blocks, until no block hits."""
    df = df.select("doc", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast(SPANS).alias("hits"),
                   F.array().cast("array<string>").alias("items"), F.col("doc.text").alias("clean"),
                   F.lit(True).alias("open"), F.array().cast(SPANS).alias("spans"))
    first = True
    while first or not df.filter("open").isEmpty():
        for k, shared in enumerate(blocks):
            df = _marked(df, shared, first, k == len(blocks) - 1)
        df, first = written(df), False
    return df


def _marked(df: DataFrame, shared, first: bool, last: bool) -> DataFrame:
    """One block's hits in the open texts, added to ``spans``; after the last
    block the texts are cut, and those that were stay open."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for batch in batches:
            doc, names = batch.column(batch.schema.get_field_index("doc")), batch.schema.names[1:]
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
            rows = [dict(zip(names, values)) for values in zip(*columns)]
            for row in rows:
                if not row["open"]:
                    continue
                text = (row["clean"] or "").encode()
                words = words_of(text)
                hit, found = automaton.match(words)
                for s in row["spans"]:
                    hit |= _inside(text, s["start"], s["end"])
                spans = spans_of(text, hit) if hit.any() else []
                row["spans"] = _structs(spans)
                if first:
                    found.discard(None)
                    row |= {"n_words": len(words), "n_hit": int(hit.sum()), "hits": row["spans"], "items": sorted(found | set(row["items"]))}
                if last:
                    if spans:
                        row["clean"] = cut(text, spans).decode("utf-8", "replace")
                    row |= {"open": bool(spans), "spans": []}
            yield pa.RecordBatch.from_arrays(
                [doc, *(pa.array([row[n] for row in rows], batch.schema.field(n).type) for n in names)], batch.schema.names)

    return df.mapInArrow(run, _schema(df, T.StructField("open", T.BooleanType()), T.StructField("spans", SPANS)))


def _inside(text: bytes, start: int, end: int) -> np.ndarray:
    return np.array([start <= m.start() < end for m in WORD.finditer(text.lower())], bool)


def op2(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = decontaminate(docs, items)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL = r"""
WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, row_number() OVER () AS rid FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, p, p + least(len(w), 10) - 1) AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT rid, n, p, list_slice(w, p, p + n - 1) AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM lowered, sizes WHERE len(w) >= n)),
occurs AS (SELECT rid, p, g.n, item_id FROM grams g JOIN windows USING (n, g)),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM occurs) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM occurs) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""
