"""Harmonic packing of token sequences (operator 1).

Every task packs the documents it reads, block by block, without a shuffle:
a document of n tokens belongs to the reciprocal-capacity class k = capacity
div n, and a bin of class k holds exactly k whole documents. What a bin lacks
to its capacity is filled from a supply that may be cut: documents longer than
a sequence, documents below the last class, and the few left over when a class
does not fill its last bin. When the supply is short, the emptiest bins are
broken up and join it. The remainder of a block is cut at powers of two.

Cases: null or empty text is the end token alone; a null id is carried along;
repeated rows are packed as often as they occur; an empty table gives no rows;
only the longest single document and one block bound a task's memory.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import fresh_worker, id_and_bytes, once_per_worker

#: the kind of every byte: letter (and all beyond ASCII), white space, digit, apostrophe, other mark
KINDS = bytes(97 if chr(c).isalpha() or c > 127 else 32 if chr(c) in " \t\n\r\v\f" else 48 if chr(c).isdigit() else 39 if c == 39 else 33
              for c in range(256))
ASCII = bytes(range(128))
MARKS = [chr(c) for c in range(33, 127) if KINDS[c] == 33]


class WordEncoder:
    """Token ids as little-endian 32-bit bytes, for tokenizers whose words
    never reach over white space or from letters to marks. Pieces between
    spaces are looked up in a bounded cache, and unknown words go to the
    tokenizer in one call. In most texts marks stand alone; there they are
    pieces of their own. Texts that may hold a special token are encoded as
    they are."""

    def __init__(self, path: str, end_id: int | None, cache_words: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, self.size, self.cache = Tokenizer.from_file(path), cache_words, {"": b""}
        self.last = np.zeros(self.tok.get_vocab_size(), bool)
        for piece, i in self.tok.get_vocab().items():
            self.last[i] = piece.endswith("</w>")
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.tok.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.asarray(e.ids, "<u4").tobytes() for e in found]

    def learn(self, pieces: list[str]) -> None:
        words = [p for p in pieces if p.isalpha()]
        for i in range(0, len(words), 20_000):
            part = words[i:i + 20_000]
            ids = np.frombuffer(self.plain([" ".join(part)])[0], "<u4")
            ends = 4 * np.flatnonzero(self.last[ids]) + 4
            if len(ends) == len(part):
                raw, ends = ids.tobytes(), ends.tolist()
                self.cache.update(zip(part, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:  # some word is more than one for the tokenizer
                self.cache.update(zip(part, self.plain(part)))
        rest = [p for p in pieces if not p.isalpha()]
        self.cache.update(zip(rest, self.plain(rest)))

    def pieces(self, text: str) -> list[str] | None:
        """What to look up; None for a text to be encoded as it is."""
        if any(s in text for s in self.special):
            return None
        raw = text.encode("utf-8", "replace")
        kinds = raw.translate(KINDS)
        other = b"" if text.isascii() else raw.translate(None, ASCII)
        if b"!!" not in kinds and b"'" not in kinds and (not other or other.decode("utf-8", "replace").isalpha() and "\u0130" not in text and "\u03a3" not in text):
            text = text.lower()
            for m in MARKS:
                if m in text:
                    text = text.replace(m, f" {m} ")
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for i in range(0, len(texts), 200):
            split = [self.pieces(t) for t in texts[i:i + 200]]
            if len(self.cache) > self.size:
                self.cache = {"": b""}
            cache = self.cache
            self.learn([p for p in set().union(*(s for s in split if s)) if p not in cache])
            get = cache.__getitem__
            for t, s in zip(texts[i:i + 200], split):
                yield (self.plain([t])[0] if s is None else b"".join(map(get, s))) + self.end


def harmonic(lengths: np.ndarray, capacity: int, classes: int = 32) -> tuple[np.ndarray, ...]:
    """Pieces of one block: document, start, length, sequence, offset, class
    (0 for pieces of the supply). Lengths are over 0."""
    n = np.asarray(lengths, np.int64)
    kind = np.where(n > capacity, 0, capacity // np.maximum(n, 1))
    kind[kind > classes] = 0
    doc, seq, off, cls, fills, loose = [], [], [], [], [], [np.flatnonzero(kind == 0)]
    bins = 0
    for k in range(1, classes + 1):
        own = np.flatnonzero(kind == k)
        full = len(own) // k
        loose.append(own[full * k:])
        if full:
            own = own[:full * k].reshape(full, k)
            size = n[own]
            doc.append(own.ravel())
            off.append((np.cumsum(size, 1) - size).ravel())
            seq.append(np.repeat(np.arange(bins, bins + full), k))
            cls.append(np.full(full * k, k))
            fills.append(size.sum(1))
            bins += full
    cat = lambda x: np.concatenate([*x, np.zeros(0, np.int64)]).astype(np.int64)
    doc, seq, off, cls, fill, supply = cat(doc), cat(seq), cat(off), cat(cls), cat(fills), cat(loose)
    # break up the emptiest bins until the supply covers every gap that stays
    order = np.argsort(fill, kind="stable")
    have = n[supply].sum() + np.concatenate([[0], np.cumsum(fill[order])])
    need = (capacity - fill).sum() - np.concatenate([[0], np.cumsum(capacity - fill[order])])
    broken = np.zeros(bins, bool)
    broken[order[:int(np.argmax(have >= need))]] = True
    supply = np.concatenate([supply, doc[broken[seq]]])
    kept = ~broken[seq]
    doc, seq, off, cls, fill = doc[kept], (np.cumsum(~broken) - 1)[seq[kept]], off[kept], cls[kept], fill[~broken]
    # slots for the supply: the gaps, whole sequences, powers of two
    gaps = np.flatnonzero(fill < capacity)
    rest = int(n[supply].sum() - (capacity - fill[gaps]).sum())
    tail = [1 << b for b in range(capacity.bit_length(), -1, -1) if rest % capacity >> b & 1]
    slot_size = np.concatenate([capacity - fill[gaps], np.full(rest // capacity, capacity), tail]).astype(np.int64)
    slot_seq = np.concatenate([gaps, len(fill) + np.arange(rest // capacity + len(tail))]).astype(np.int64)
    slot_off = np.concatenate([fill[gaps], np.zeros(len(slot_size) - len(gaps))]).astype(np.int64)
    ends, slots = np.cumsum(n[supply]), np.cumsum(slot_size)
    cuts = np.unique(np.concatenate([ends, slots]))
    begin = np.concatenate([[0], cuts[:-1]]).astype(np.int64)[:len(cuts)]
    which, into = np.searchsorted(ends, begin, "right"), np.searchsorted(slots, begin, "right")
    return (np.concatenate([doc, supply[which]]),
            np.concatenate([np.zeros(len(doc), np.int64), begin - (ends - n[supply])[which]]),
            np.concatenate([n[doc], cuts - begin]),
            np.concatenate([seq, slot_seq[into]]),
            np.concatenate([off, slot_off[into] + begin - (slots - slot_size)[into]]),
            np.concatenate([cls, np.zeros(len(begin), np.int64)]))


SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, class int"


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 2, classes: int = 32,
         block_tokens: int = 4_000_000) -> DataFrame:
    """One row per piece; ``ids`` are its token ids as little-endian unsigned
    32-bit numbers. ``capacity`` must be a power of two. ``sequence_id`` is
    unique over the table: the task's number, then the task's own count."""
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker("packing")
        encoder = once_per_worker(("WordEncoder", tokenizer, end_id), lambda: WordEncoder(tokenizer, end_id))
        following = TaskContext.get().partitionId() << 33
        keys: list[int | None] = []
        held: list[bytes] = []
        tokens = 0

        def packed() -> pa.RecordBatch:
            nonlocal following
            sizes = np.array([len(x) // 4 for x in held], np.int64)
            doc, start, length, seq, off, cls = harmonic(sizes, capacity, classes)
            ids = [held[d][4 * s:4 * (s + k)] for d, s, k in zip(doc.tolist(), start.tolist(), length.tolist())]
            key = pa.array(keys, pa.int64()).take(pa.array(doc))
            out = [key, start, length, pa.array(ids, pa.binary()), sizes[doc], seq + following, off, cls.astype(np.int32)]
            following += int(seq.max()) + 1
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "class"]
            return pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

        for batch in batches:
            texts = [x.decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            for key, ids in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                if ids:
                    keys.append(key)
                    held.append(ids)
                    tokens += len(ids) // 4
                if tokens >= block_tokens:
                    yield packed()
                    keys, held, tokens = [], [], 0
        if held:
            yield packed()

    return id_and_bytes(docs).mapInArrow(run, SCHEMA)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary file installed beside the libraries, on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1(docs: DataFrame) -> DataFrame:
    return pack(docs, tokenizer_path()).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                               "doc_tokens", "sequence_id", "offset")
