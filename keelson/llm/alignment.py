"""Cross-tokenizer alignment (operator 12).

A space and the text are encoded by two tokenizers, A (byte-level pieces) and
B (pieces with a space mark and byte fallback). Tokens whose byte ranges
overlap are linked; the places where a token of both ends cut them into
groups. The merge runs in lockstep: one state vector holds an A and a B
pointer for every lane of a batch, each step emits a link per lane, and a cut
where both tokens end, moves on whichever ends first, and finished lanes are
taken out.

A lane is a piece of a text. Before a space that follows a character which is
not white space both tokenizers always start a token (checked on B's vocabulary
when it is loaded), so texts are cut there and a batch's repeated pieces are
encoded and merged once. A piece of more than ``LANE`` A tokens is spread over
several lanes, each with its own A tokens. Texts that hold white space before
a space, or that end in one, are one piece.

Links are counted in two stages, in the task and then by pair in Spark. The
counts of the ``core`` most frequent pairs go to the tasks as a broadcast of
at most ``core`` entries; what a text links beyond them is joined by pair.

Cases: null and empty texts, and texts whose tokens do not spell the space and
the text, have no tokens: zeros and an empty list of groups; rows stay one for
one, repeated and null ids included; an empty table gives an empty result;
extra columns are left out, whatever their names; whole texts are encoded.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import Shared, cutoff, id_and_bytes, once_per_worker, table, written

#: A tokens of a lane; text bytes of a block; pairs whose counts are broadcast; counts a task gathers before it hands them on
LANE, BLOCK, CORE, HELD = 256, 1 << 22, 1_000_000, 1 << 21
#: codes of pairs: A id times this, plus the B id
SHIFT = 1 << 20
SPACED = re.compile(r"\s ")
MARK = "▁"


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the texts of their ids."""

    def __init__(self, ranks: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        entries = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks, "rb"))}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=entries, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        own = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.splits = not any(MARK in p.lstrip(MARK) for p in own)
        as_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(own)]
        by_id = dict(zip(entries.values(), entries.keys()))
        self.tables = [Spelled([by_id.get(i, b"") for i in range(max(by_id) + 1)]), Spelled(as_bytes)]
        # an id and what follows it: A id in a group, A id at its end, B id in a group, B id at its end
        self.labels = [b"%d%s" % (i, end) for t, ends in zip(self.tables, (b",|", b",;")) for i in range(len(t.size)) for end in (ends[:1], ends[1:])]

    def encode(self, pieces: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per tokenizer all ids, and how many each piece has. A piece is
        without its first space, which B adds itself."""
        both = [self.a.encode_ordinary(" " + p) for p in pieces], self.b.encode(pieces, num_threads=1)
        counts = [np.fromiter(map(len, ids), np.int64, len(ids)) for ids in both]
        return [(np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(n.sum())), n) for ids, n in zip(both, counts)]


class Spelled:
    """The bytes of every token, end to end."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.all = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        end = np.cumsum(size)
        return self.all[np.repeat(self.start[ids] - end + size, size) + np.arange(int(end[-1]) if len(end) else 0)]


def paths() -> tuple[str, str]:
    """The default files of the two tokenizers; the ranks are the vocabulary of byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes."""
    total = np.r_[0, np.cumsum(values)]
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, a: np.ndarray, b: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge all lanes at once. ``end_a``, ``end_b``: where tokens end; a lane
    starts at its pointers ``a``, ``b`` and is finished when ``a`` is at
    ``stop``. Returns the links' A and B tokens and the A tokens that end with a B token."""
    links_a, links_b, cuts = [], [], []
    live = a < stop
    while True:
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
        if not len(a):
            break
        links_a.append(a)
        links_b.append(b)
        ea, eb = end_a[a], end_b[b]
        cuts.append(a[ea == eb])
        a, b = a + (ea <= eb), b + (eb <= ea)
        live = a < stop
    none = [np.empty(0, np.int64)]
    return np.concatenate(links_a or none), np.concatenate(links_b or none), np.concatenate(cuts or none)


class Block:
    """The alignment of a block of texts: per piece counts, pair codes and the
    label of its groups, and per text the pieces it is made of."""

    def __init__(self, tok: Tokenizers, texts: list[str], whole: bool = False):
        cut = [[] if not t else [t] if whole or not tok.splits or t[-1].isspace() or t[0].isspace() or SPACED.search(t) else t.split(" ") for t in texts]
        self.n_pieces = np.array([len(c) for c in cut], np.int64)
        coded = pa.array(itertools.chain.from_iterable(cut), pa.string()).dictionary_encode()
        self.piece = coded.indices.to_numpy().astype(np.int64)
        self._align(tok, coded.dictionary.to_pylist())
        bad = sums(~self.good[self.piece], self.n_pieces) > 0
        self.used = np.bincount(self.piece[np.repeat(~bad, self.n_pieces)], minlength=len(self.good))
        self.bad = bad
        # a text with a piece that is not spelled is looked at as one piece
        again = np.flatnonzero(bad & (self.n_pieces > 1))
        self.again = (again, Block(tok, [texts[i] for i in again.tolist()], True)) if len(again) else None

    def _align(self, tok: Tokenizers, pieces: list[str]) -> None:
        (a, n_a), (b, n_b) = tok.encode(pieces)
        said = [b" " + p.encode() for p in pieces]
        size = np.fromiter(map(len, said), np.int64, len(said))
        self.good = good = (sums(tok.tables[0].size[a], n_a) == size) & (sums(tok.tables[1].size[b], n_b) == size)
        fits = good.copy()
        of = np.repeat(np.flatnonzero(fits), size[fits])
        want = np.frombuffer(b"".join(said), np.uint8)[np.repeat(fits, size)]
        for ids, n, t in ((a, n_a, tok.tables[0]), (b, n_b, tok.tables[1])):
            good[of[t.spell(ids[np.repeat(fits, n)]) != want]] = False
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        self.n_a, self.n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
        end_a, end_b = np.cumsum(tok.tables[0].size[a]), np.cumsum(tok.tables[1].size[b])
        # lanes: at most LANE A tokens of a piece
        first = np.cumsum(self.n_a) - self.n_a
        lanes = -(-self.n_a // LANE)
        part = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = np.repeat(first, lanes) + part * LANE
        stop = np.minimum(start + LANE, np.repeat(first + self.n_a, lanes))
        begin = np.r_[0, end_a][start]
        la, lb, cuts = lockstep(end_a, end_b, start, np.searchsorted(end_b, begin, "right"), stop)
        # a + b grows from link to link, so it is a link's place
        order = np.zeros(len(a) + len(b), np.int64)
        order[la + lb] = a[la] * SHIFT + b[lb] + 1
        self.codes = order[order > 0] - 1
        of_a = np.repeat(np.arange(len(good)), self.n_a)
        self.n_links = np.bincount(of_a[la], minlength=len(good))
        self.n_groups = np.bincount(of_a[cuts], minlength=len(good))
        self._label(tok, a, b, end_a, end_b, np.sort(cuts))

    def _label(self, tok: Tokenizers, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, cuts: np.ndarray) -> None:
        """Each piece's groups as text, A ids of a group before its B ids."""
        last_a, last_b = cuts + 1, np.searchsorted(end_b, end_a[cuts]) + 1  # tokens up to each group's end
        closes_a, closes_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        closes_a[last_a - 1] = closes_b[last_b - 1] = 1
        in_a, in_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b  # groups ended before each token
        out = np.empty(len(a) + len(b), np.int64)
        out[np.arange(len(a)) + np.r_[0, last_b][in_a]] = 2 * a + closes_a
        out[np.arange(len(b)) + np.r_[0, last_a][in_b + 1]] = 2 * (len(tok.tables[0].size) + b) + closes_b
        said, ends = [tok.labels[i] for i in out.tolist()], np.cumsum(self.n_a + self.n_b).tolist()
        self.groups = [b"".join(said[s:e]) for s, e in zip([0, *ends], ends)]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pair codes and how many links of the texts hold them."""
        weight = np.repeat(self.used, self.n_links)
        own = [(self.codes[weight > 0], weight[weight > 0])] + ([self.again[1].pairs()] if self.again else [])
        return summed(own)

    def per_text(self, of_piece: np.ndarray, name: str, *args) -> np.ndarray:
        """Sums over each text's pieces; ``name`` gives the same for texts looked at as one piece."""
        out = np.where(self.bad, 0, sums(of_piece[self.piece], self.n_pieces))
        if self.again:
            out[self.again[0]] = getattr(self.again[1], name)(*args)
        return out

    def counts(self, which: str) -> np.ndarray:
        return self.per_text(getattr(self, which), "counts", which)

    def labels(self) -> list[bytes]:
        ends = np.cumsum(self.n_pieces).tolist()
        out = [b"" if bad else b"".join([self.groups[i] for i in self.piece[s:e].tolist()])[:-1] for s, e, bad in zip([0, *ends], ends, self.bad)]
        if self.again:
            for i, label in zip(self.again[0].tolist(), self.again[1].labels()):
                out[i] = label
        return out

    def scores(self, core: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Per text: links of a pair that is its B id's most frequent, the sum
        of all links' pair counts, and the codes of links beyond the core."""
        known, n, best = core
        at = np.minimum(np.searchsorted(known, self.codes), max(len(known) - 1, 0))
        hit = known[at] == self.codes if len(known) else np.zeros(len(self.codes), bool)
        n, best = (np.where(hit, n[at], 0), hit & best[at]) if len(known) else (np.zeros(len(self.codes), np.int64), hit)
        n_best, total = (np.where(self.bad, 0, sums(sums(v, self.n_links)[self.piece], self.n_pieces)) for v in (best, n))
        rest = [self.codes[:0]] * len(self.bad)
        missed = sums(~hit, self.n_links)
        if missed.any():
            by_piece = np.split(self.codes[~hit], np.cumsum(missed)[:-1])
            place, piece = np.repeat(np.arange(len(self.bad)), self.n_pieces), self.piece
            some = np.flatnonzero((missed[piece] > 0) & ~self.bad[place])
            for i, own in itertools.groupby(some.tolist(), key=lambda j: place[j]):
                rest[i] = np.concatenate([by_piece[piece[j]] for j in own])
        if self.again:
            again = self.again[1].scores(core)
            n_best[self.again[0]], total[self.again[0]] = again[0], again[1]
            for i, r in zip(self.again[0].tolist(), again[2]):
                rest[i] = r
        return n_best, total, rest


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    new = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.empty(0, np.int64)
    return codes[new], np.add.reduceat(n, new) if len(new) else n


def blocks(batches: Iterable[pa.RecordBatch], files: tuple[str, str]) -> Iterator[tuple[pa.Array, Block]]:
    """The texts of the batches, aligned in blocks, with their ids."""
    tok = once_per_worker(("alignment", *files), lambda: Tokenizers(*files))
    for batch in batches:
        texts, size, lo = [], 0, 0
        for k, text in enumerate(batch.column(1)):
            texts.append(text.as_py().decode("utf-8", "replace"))
            size += len(texts[-1])
            if size >= BLOCK or k + 1 == batch.num_rows:
                yield batch.column(0).slice(lo, len(texts)), Block(tok, texts)
                texts, size, lo = [], 0, k + 1


def pair_counts(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """How many links of all texts hold each (A id, B id): columns code, a, b, n."""
    files = files or paths()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        out = lambda: pa.RecordBatch.from_arrays([pa.array(c) for c in summed(held)], ["code", "n"])
        for _, block in blocks(batches, files):
            held.append(block.pairs())
            size += len(held[-1][0])
            if size > HELD:
                held = [summed(held)]
                size = len(held[0][0])
                if size > HELD // 2:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    total = id_and_bytes(docs).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return total.select("code", F.expr(f"code div {SHIFT}").alias("a"), (F.col("code") % SHIFT).alias("b"), "n")


def aligned_groups(docs: DataFrame, files: tuple[str, str] | None = None) -> DataFrame:
    """Per document its numbers of tokens, groups and links, and its groups as
    text: ``a1,a2|b1;a3|b2,b3``."""
    files = files or paths()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, block in blocks(batches, files):
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(block.counts(c)) for c in COUNTS), pa.array([g.decode() for g in block.labels()])],
                                             ["doc_id", *COUNTS, "groups"])

    return id_and_bytes(docs).mapInArrow(run, f"doc_id long, {', '.join(c + ' long' for c in COUNTS)}, groups string")


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def scored(docs: DataFrame, core: int = CORE, files: tuple[str, str] | None = None) -> DataFrame:
    """Per document its counts, a digest of its groups, how many of its links
    are of a pair that is its B id's most frequent one, and the sum of the
    pair counts over its links."""
    spark, files = docs.sparkSession, files or paths()
    counts = written(pair_counts(docs, files))
    # one row for each B id: at most as many as B has tokens
    top = counts.groupBy("b").agg(F.max("n").alias("top"))
    flagged = written(counts.join(F.broadcast(top), "b").select("code", "n", (F.col("n") == F.col("top")).alias("best")))
    least = cutoff(flagged, "n", core)
    kept = flagged.filter(F.col("n") >= least).sort("code").toArrow()
    shared = Shared(spark, tuple(kept.column(c).to_numpy() for c in ("code", "n", "best")))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        for ids, block in blocks(batches, files):
            n_best, total, rest = block.scores(shared.value)
            digest = [hashlib.sha256(g).hexdigest() if g else "" for g in block.labels()]
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array(block.counts(c)) for c in COUNTS), pa.array(n_best), pa.array(total), pa.array(digest),
                 pa.array(np.arange(row, row + len(ids))), pa.array(rest, pa.list_(pa.int64()))],
                ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256", "row", "rest"])
            row += len(ids)

    longs = ", ".join(f"{c} long" for c in ("doc_id", *COUNTS, "n_best", "count_sum"))
    first = written(id_and_bytes(docs).mapInArrow(run, f"{longs}, groups_sha256 string, row long, rest array<long>"))
    rare = flagged.filter(F.col("n") < least)
    beyond = first.select("row", F.explode("rest").alias("code")).join(rare, "code").groupBy("row").agg(
        F.sum("n").alias("more"), F.count_if("best").alias("more_best"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return first.join(beyond, "row", "left").select(
        "doc_id", *COUNTS, (F.col("n_best") + zero("more_best")).alias("n_best"), (F.col("count_sum") + zero("more")).alias("count_sum"), "groups_sha256")


def op12(docs: DataFrame) -> DataFrame:
    return scored(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12(table(spark, sf_dir, "documents"))
