"""Personal data (operator 13).

A linear-chain conditional random field labels the words of a sentence as
outside, beginning or inside of one of four kinds. What it sees of a word is
its shape (letters collapsed, digits and marks kept), counts and checks of its
digits, and whether it is one of the few frequent words; the same of the words
before and after. It is trained from a small labelled table of word windows
(``labelled_windows``: at most ``WINDOWS`` of them, from about
``SAMPLE_DOCUMENTS`` documents; the plain patterns below say which words are
labelled, and each window with a phone, card or address also stands there in
another way of writing) and decoded by Viterbi, all sentences of a block of
documents at once. Four plain patterns are reported besides; a labelled stretch
that meets none of their matches is added as ``crf_<kind>``.

A sentence ends with its line or with a word that ends in . ! or ?, whatever its length.

Cases: null text is empty and gives no spans; without any text to learn from
nothing is added; rows stay one for one, repeated and null ids included; an
empty table gives an empty result; extra columns are left out, whatever their
names; whole texts are scanned, whatever their length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import Shared, id_and_bytes, schema_with, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{place}-{kind}" for kind in KINDS for place in "BI"))
#: documents and windows of the labelled table, words before and after, windows of a document
SAMPLE_DOCUMENTS, WINDOWS, AROUND, PER_DOCUMENT = 4_000, 2_000, 6, 8
#: words of a block of documents decoded together
BLOCK = 400_000

# each pattern in a form that looks at a character a bounded number of times
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
NUMBERS = re.compile(rb"[0-9]")


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """A match begins where the characters before an @ begin, or where the last match ended."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and not NOT_LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the plain patterns, by kind, then start; code points, end exclusive."""
    out = [(0, s, e) for s, e in emails(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(d := digits_of(m[0])) <= 19 and luhn(d)]
    return out + [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]


# --- what the field sees of a word

CLASSES = bytes(ord("X") if 65 <= c <= 90 else ord("x") if 97 <= c <= 122 or c > 127 else ord("9") if 48 <= c <= 57 else c for c in range(256))
LETTERS, DIGITS = re.compile(rb"[xX]+"), re.compile(rb"9+")


def word_key(word: bytes, frequent: set[bytes]) -> bytes:
    """What two words share when the field cannot tell them apart."""
    if word.isalpha():
        return word.lower() if word.lower() in frequent else b" x"
    shape = LETTERS.sub(b"x", word.translate(CLASSES))
    if not NUMBERS.search(word) and b"@" not in word:
        return b" " + (shape if len(shape) <= 24 else shape[:24] + b"~")
    text = word.decode("utf-8", "replace")
    digits = digits_of(text)
    parts = re.fullmatch(r"\D*([0-9]{1,3}(?:\.[0-9]{1,3}){3})\D*", text)
    checks = [b"luhn%d" % luhn(digits)] if 13 <= len(digits) <= 19 else []
    checks += [b"parts%d" % all(int(p) <= 255 for p in parts[1].split("."))] if parts else []
    checks += [b"domain%d" % bool(DOMAIN.match(text, text.index("@") + 1))] if "@" in text else []
    return b" ".join([b"", shape if len(shape) <= 24 else DIGITS.sub(b"9", shape)[:24] + b"~", b"%d" % min(len(digits), 20), *checks])


def key_features(key: bytes) -> list[str]:
    if not key.startswith(b" "):
        return ["word " + key.decode(), "rough x"]
    shape, *more = key[1:].decode().split(" ")
    rough = re.sub("9+", "9", shape)
    return ["shape " + shape, "rough " + rough, "start " + rough[:1], "end " + rough[-1:], *(f"digits {m}" if m.isdigit() else m for m in more)]


EDGE = b" <edge>"


@dataclass
class Field:
    """Weights of (role, feature, label) and of label pairs; roles are the word itself, the one before and the one after."""

    features: dict[str, int]
    frequent: set[bytes]
    weights: np.ndarray  # 3, features, labels
    moves: np.ndarray  # labels + 1 (the last: before a sentence), labels

    def rows(self, keys: list[bytes]) -> np.ndarray:
        """Scores of every key in its three roles: 3, keys, labels."""
        out = np.zeros((3, len(keys), len(LABELS)))
        for i, k in enumerate(keys):
            if known := [self.features[f] for f in key_features(k) if f in self.features]:
                out[:, i] = self.weights[:, known].sum(1)
        return out


def allowed() -> np.ndarray:
    """0 where a label may follow another (the last row: start a sentence), a large negative number elsewhere."""
    out = np.zeros((len(LABELS) + 1, len(LABELS)))
    for j, label in enumerate(LABELS):
        if label[0] == "I":
            out[:, j] = -1e6
            out[[j - 1, j], j] = 0
    return out


def viterbi(scores: np.ndarray, moves: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The best label of every word of all sentences at once. ``scores``:
    words by labels; sentence i has ``size[i]`` words from ``first[i]``; sizes largest first."""
    labels = np.zeros(len(scores), np.int8)
    back = np.zeros((len(scores), scores.shape[1]), np.int8)
    if not len(size):
        return labels
    active = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")  # sentences of more than t words
    best = moves[-1] + scores[first]
    columns = np.ascontiguousarray(moves[:-1].T)  # to, from
    ends = np.empty(best.shape)
    ends[:] = best
    for t in range(1, int(size[0])):
        n = active[t]
        at = first[:n] + t
        via = best[:n, None, :] + columns
        back[at] = came = via.argmax(2)
        best = np.take_along_axis(via, came[:, :, None].astype(np.int64), 2)[:, :, 0] + scores[at]
        ends[:n] = best
    now = ends.argmax(1)
    for t in range(int(size[0]) - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        labels[at] = now[:n]
        if t:
            now[:n] = back[at, now[:n]]
    return labels


def likelihood(scores: np.ndarray, moves: np.ndarray, labels: np.ndarray, mask: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum over windows of log p(labels), and its gradients by the words'
    scores and by the moves. Arrays are windows by places; ``mask`` says which
    places hold a word. Sums over paths are scaled at every place."""
    w, t, k = scores.shape
    rows, step = np.arange(w), np.exp(moves)
    top = scores.max(2, keepdims=True)
    e = np.exp(scores - top)
    ahead, size = np.empty((w, t, k)), np.ones((w, t))
    for i in range(t):
        own = (step[-1] if not i else ahead[:, i - 1] @ step[:-1]) * e[:, i]
        size[:, i] = np.where(mask[:, i], own.sum(1), 1)
        ahead[:, i] = np.where(mask[:, i, None], own / size[:, i, None], ahead[:, i - 1] if i else own)
    value = -(np.log(size) + np.where(mask, top[:, :, 0], 0)).sum() + np.where(mask, np.take_along_axis(scores, labels[:, :, None], 2)[:, :, 0], 0).sum()
    value += moves[-1, labels[:, 0]].sum()
    by_score, by_move = np.zeros_like(scores), np.zeros_like(moves)
    behind = np.ones((w, k))
    for i in range(t - 1, -1, -1):
        live = mask[:, i]
        by_score[:, i] = -np.where(live[:, None], ahead[:, i] * behind, 0)
        by_score[rows[live], i, labels[live, i]] += 1
        if i:
            coming = np.where(live[:, None], e[:, i] * behind / size[:, i, None], 0)
            by_move[:-1] -= ahead[:, i - 1].T @ coming * step[:-1]
            np.add.at(by_move, (labels[live, i - 1], labels[live, i]), 1)
            value += moves[labels[live, i - 1], labels[live, i]].sum()
            behind = np.where(live[:, None], coming @ step[:-1].T, behind)
    by_move[-1] = by_score[:, 0].sum(0)
    return value, by_score, by_move


def fit(windows: list[tuple[list[bytes], list[int]]], rounds: int = 80, l2: float = 2e-4, rate: float = 0.1) -> Field | None:
    """Adam on the mean log-likelihood of the windows (words, labels)."""
    if not any(any(y) for _, y in windows):
        return None
    count = Counter(w.lower() for words, _ in windows for w in set(words) if w.isalpha())
    frequent = {w for w, n in sorted(count.items(), key=lambda x: (-x[1], x[0]))[:200] if n >= 20}
    k = len(LABELS)
    t = max(len(words) for words, _ in windows)
    labels, mask, code = np.zeros((len(windows), t), np.int64), np.zeros((len(windows), t), bool), np.zeros((len(windows), t + 2), np.int64)
    keys: dict[bytes, int] = {EDGE: 0}
    for i, (words, y) in enumerate(windows):
        labels[i, :len(y)], mask[i, :len(y)] = y, True
        code[i, 1:len(y) + 1] = [keys.setdefault(word_key(w, frequent), len(keys)) for w in words]
    names = [key_features(key) for key in keys]
    features = {f: i for i, f in enumerate(sorted({f for own in names for f in own}))}
    per_key = np.array([len(own) for own in names])
    feature, key = np.array([features[f] for own in names for f in own]), np.repeat(np.arange(len(names)), per_key)
    first = np.cumsum(per_key) - per_key
    roles = code[:, 1:-1], code[:, :-2], code[:, 2:]
    fixed = allowed()
    x, m, v = (np.zeros(3 * len(features) * k + (k + 1) * k) for _ in range(3))
    for step in range(1, rounds + 1):
        weights, moves = x[:-(k + 1) * k].reshape(3, len(features), k), x[-(k + 1) * k:].reshape(k + 1, k)
        scores = sum(np.add.reduceat(weights[r][feature], first)[roles[r]] for r in range(3))
        _, by_score, by_move = likelihood(scores, moves + fixed, labels, mask)
        flat, parts = by_score.reshape(-1, k), []
        for r in range(3):
            by_key = np.stack([np.bincount(roles[r].ravel(), flat[:, y], len(keys)) for y in range(k)], 1)
            parts.append(np.stack([np.bincount(feature, by_key[key, y], len(features)) for y in range(k)], 1).ravel())
        g = l2 * x - np.concatenate([*parts, by_move.ravel()]) / len(windows)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(features, frequent, x[:-(k + 1) * k].reshape(3, len(features), k), x[-(k + 1) * k:].reshape(k + 1, k) + fixed)


# --- the labelled table

def word_labels(text: str) -> tuple[list[str], list[int]]:
    """The words of a text and what the plain patterns say of them."""
    spans = [m.span() for m in WORD.finditer(text)]
    starts = np.array([s for s, _ in spans] + [len(text) + 1])
    labels = [0] * len(spans)
    for kind, s, e in base_spans(text):
        a, b = int(np.searchsorted(starts, s, "right")) - 1, int(np.searchsorted(starts, e, "left"))
        if a >= 0 and not any(labels[a:b]):
            labels[a:b] = [2 * kind + (1 if i == a else 2) for i in range(a, b)]
    return [text[s:e] for s, e in spans], labels


def rewritten(words: list[str], labels: list[int]) -> tuple[list[str], list[int]] | None:
    """The window with what it holds written in another way: a phone number
    without its country code, a card in groups of four, an address with (at)."""
    out, other = [], []
    for word, y in zip(words, labels):
        new, at = [word], LABELS[y]
        if at == "B-phone" and re.fullmatch(r"\+[0-9]{1,3}", word):
            new = []
        elif at == "B-card" and (m := re.fullmatch(r"([0-9]{4})([0-9]{4})([0-9]{4})([0-9]{4})(\W*)", word)):
            new = [m[1], m[2], m[3], m[4] + m[5]]
        elif at == "B-email":
            new = [word.replace("@", "(at)", 1)]
        started = at[0] == "I" and (not other or not other[-1])
        out += new
        other += [y - 1 if started else y, *[y + 1] * (len(new) - 1)][:len(new)]
    return (out, other) if out != words and any(other) else None


def labelled_windows(docs: DataFrame, documents: int = SAMPLE_DOCUMENTS, windows: int = WINDOWS) -> DataFrame:
    """Columns words, labels: windows around words with digits or an @, and
    some others, of documents chosen by a hash of id and text."""
    rows = id_and_bytes(docs)
    share = min(1.0, documents / max(docs.count(), 1))
    chosen = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) < int(share * (1 << 40)) + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for raw in batch.column(1):
                words, labels = word_labels(raw.as_py().decode("utf-8", "replace"))
                order = lambda i: xxhash.xxh3_64_intdigest(f"{i} {words[i]}")  # noqa: E731, B023
                telling = [i for i, w in enumerate(words) if (labels[i] and LABELS[labels[i]][0] == "B") or not labels[i] and re.search("[0-9@]", w)]
                for i in [*sorted(telling, key=order)[:PER_DOCUMENT - 1], *sorted(range(0, len(words), 50), key=order)[:1]]:
                    a, b = max(0, i - AROUND), min(len(words), i + AROUND + 4)
                    while a and LABELS[labels[a]][0] == "I":
                        a -= 1
                    found.append((words[a:b], labels[a:b]))
            key = [xxhash.xxh3_64_intdigest("\0".join(w)) >> 1 for w, _ in found]
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array([w for w, _ in found], pa.list_(pa.string())),
                                              pa.array([y for _, y in found], pa.list_(pa.int32()))], ["key", "words", "labels"])

    return chosen.mapInArrow(run, "key long, words array<string>, labels array<int>").distinct().orderBy("key", "words").limit(windows).drop("key")


def learn(windows: DataFrame) -> Field | None:
    """Fit the field to a small table of words and labels (at most ``WINDOWS`` rows)."""
    found = [(r["words"], r["labels"]) for r in windows.collect()]
    found += [other for words, labels in found if (other := rewritten(words, labels))]
    return fit([([w.encode() for w in words], labels) for words, labels in found])


# --- decoding

def block_labels(field: Field, texts: list[list[bytes]], breaks: list[np.ndarray]) -> np.ndarray:
    """Labels of all words of the texts, end to end; ``breaks``: per text the words a sentence starts with."""
    flat = [w for t in texts for w in t]
    coded = pa.array(flat, pa.binary()).dictionary_encode()
    keys: dict[bytes, int] = {EDGE: 0}
    of_word = np.array([keys.setdefault(word_key(w, field.frequent), len(keys)) for w in coded.dictionary.to_pylist()], np.int64)
    code = of_word[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
    own, before, after = field.rows(list(keys))
    starts = np.concatenate([b + n for b, n in zip(breaks, np.cumsum([0] + [len(t) for t in texts]).tolist())]).astype(np.int64)
    prev, nxt = np.r_[0, code[:-1]][:len(code)], np.r_[code[1:], 0][:len(code)]
    prev[starts] = 0
    nxt[starts[1:] - 1] = 0
    size = np.diff(np.r_[starts, len(code)])
    order = np.argsort(-size, kind="stable")
    return viterbi(own[code] + before[prev] + after[nxt], field.moves, starts[order], size[order])


def sentence_starts(text: bytes, words: list[bytes]) -> np.ndarray:
    ends = np.fromiter((w[-1] in b".!?" for w in words), bool, len(words))
    if b"\n" in text and len(words):
        per_line = [len(line.split()) for line in text.split(b"\n")]
        last = np.cumsum(per_line)[:-1] - 1
        ends[last[last >= 0]] = True
    return np.flatnonzero(np.r_[True, ends[:-1]][:len(words)])


def added_spans(text: str, labels: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The labelled stretches that meet no base span, without the marks around them."""
    words = [m.span() for m in WORD.finditer(text)]
    found, i = [], 0
    while i < len(labels):
        j = i + 1
        if labels[i]:
            while j < len(labels) and labels[j] == (labels[i] + 1) // 2 * 2:  # inside of the same kind
                j += 1
            s, e = words[i][0], words[j - 1][1]
            while s < e and not (text[s].isalnum() or text[s] in "+("):
                s += 1
            while e > s and not text[e - 1].isalnum():
                e -= 1
            if s < e and not any(s < b and a < e for _, a, b in base):
                found.append((len(KINDS) + (int(labels[i]) - 1) // 2, s, e))
        i = j
    return sorted(found)


def scan_pii(docs: DataFrame, field: Field | None = None, mark: str = "[PII]", carry: tuple = ()) -> DataFrame:
    """Per document its spans (kind, start, end; code points) and the text
    with every span replaced by ``mark`` (null where nothing was found);
    ``carry`` holds columns to return besides. The field is learned from the documents unless given."""
    field = field or learn(labelled_windows(docs))
    shared = Shared(docs.sparkSession, field)
    rows = id_and_bytes(docs, *carry)
    names = (*KINDS, *(f"crf_{k}" for k in KINDS))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def scanned(raw: list[bytes]) -> list[list[tuple[int, int, int]]]:
        field = shared.value
        base = [base_spans(t.decode("utf-8", "replace")) if NUMBERS.search(t) or b"@" in t else [] for t in raw]
        if field is None:
            return base
        words = [t.split() for t in raw]
        labels = block_labels(field, words, [sentence_starts(t, w) for t, w in zip(raw, words)])
        ends = np.cumsum([len(w) for w in words])
        some = np.add.reduceat(np.r_[labels != 0, False], np.r_[0, ends[:-1]]) if len(labels) else np.zeros(len(raw))
        return [b + added_spans(t.decode("utf-8", "replace"), labels[e - len(w):e], b) if n and len(w) else b
                for t, w, e, b, n in zip(raw, words, ends.tolist(), base, some)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found, waiting, size = batch.column(1).to_pylist(), [], [], 0
            for k, t in enumerate(texts):
                waiting.append(t)
                size += len(t)
                if size >= 6 * BLOCK or k + 1 == len(texts):
                    found += scanned(waiting)
                    waiting, size = [], 0
            clean = [redacted(t.decode("utf-8", "replace"), f, mark) if f else None for t, f in zip(texts, found)]
            spans = [[{"kind": names[k], "start": s, "end": e} for k, s, e in f] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], pa.array(spans, pa.list_(span)), pa.array(clean, pa.string())],
                                             [batch.schema.names[0], *batch.schema.names[2:], "spans", "clean"])

    return rows.mapInArrow(run, schema_with(rows, "spans array<struct<kind:string,start:long,end:long>>, clean string"))


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    out, a = [], 0
    for _, s, e in sorted(spans, key=lambda x: x[1]):
        if s >= a:
            out += [text[a:s], mark]
        a = max(a, e)
    return "".join([*out, text[a:]])


def op13(docs: DataFrame) -> DataFrame:
    label = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return scan_pii(docs).select("doc_id", *(count(k) for k in KINDS), F.sha2(F.concat_ws(",", F.transform(base, label)), 256).alias("base_sha256"),
                                 F.concat_ws(",", F.transform("spans", label)).alias("spans"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13(table(spark, sf_dir, "documents"))
