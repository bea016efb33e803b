import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import awkward, docs_of

from keelson.llm import periods


def brute(words):
    """Every run by comparing all lags, the smallest period of equal stretches."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i - s >= max(q, 12 - q):
                found.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def got(words):
    s, length, q, kept = next(periods.block_runs([words]))
    dropped = {i for a, n, p in zip(s, length, q) for i in range(a + p, a + n)}
    assert set(np.flatnonzero(~kept)) == dropped
    return list(zip(s.tolist(), length.tolist(), q.tolist()))


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


ab = lambda s: [c.encode() for c in s]
SHAPES = {
    "one word": "a" * 300,
    "touching runs": "ab" * 60 + "ba" * 60,
    "touching runs of three": "abc" * 50 + "bca" * 20 + "cab" * 50,
    "runs of runs": ("aaab" * 12 + "b") * 9,
    "long words in runs": ("a" * 40 + "b" * 40) * 5 + "a" * 39,
    "half a run left over": "xyz" + ("a" * 30 + "b" + "a" * 17) * 4 + "a" * 60,
    "Fibonacci": fibonacci(400),
    "Thue-Morse": "".join("ab"[bin(i).count("1") % 2] for i in range(512)),
    "squares": "abcdefghijklmnopqrstuvwxyz" * 2 + "0" + "abcdefghijklmnopqrstuvwxyz"[::-1] * 3,
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shapes_against_brute_force(shape):
    words = ab(SHAPES[shape])
    assert got(words) == brute(words)


def test_random_texts_against_brute_force():
    rng = random.Random(5)
    for _ in range(250):
        parts = []
        while sum(map(len, parts)) < rng.choice((20, 90, 260)):
            unit = [b"%d" % rng.randrange(rng.choice((1, 2, 3, 40))) for _ in range(rng.choice((1, 2, 3, 7, 17, 33, 70)))]
            parts.append((unit * rng.choice((1, 1, 2, 3, 6)))[:rng.randrange(20, 300)])
        words = [w for p in parts for w in p]
        assert got(words) == brute(words)


def test_texts_of_a_block_do_not_meet():
    rng = random.Random(6)
    texts = [[b"%d" % rng.randrange(2) for _ in range(rng.randrange(0, 120))] for _ in range(60)] + [[], ab("abc" * 9), ab("abc" * 9)]
    for t, (s, length, q, _) in zip(texts, periods.block_runs(texts)):
        assert list(zip(s, length, q)) == brute(t)


def test_query_against_brute_force(spark, monkeypatch):
    docs = awkward() + [(i, "lorem ipsum dolor sit " * (i % 9) + " ".join(f"w{j % (i + 1)}" for j in range(7 * i))) for i in range(20, 60)]
    want = []
    for i, t in docs:
        w = (t or "").encode().split()
        n = len(w)
        h = zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
        runs = brute(w)
        dropped = {j for s, m, q in runs for j in range(s + q, s + m)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     sha("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()), sha(b" ".join(x for j, x in enumerate(w) if j not in dropped))))
    assert any(r[1] for r in want)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, periods.op11(docs_of(spark, docs)).collect()), key=key) == sorted(want, key=key)
    assert periods.op11(docs_of(spark, docs).limit(0)).collect() == []


def test_long_texts_and_small_blocks(spark):
    """A text longer than a block is a block; a long one-word text has one run."""
    rows = {r["doc_id"]: r for r in periods.collapse_runs(docs_of(spark, [(1, "a " * (periods.BLOCK + 9)), (2, "b c " * 9), (3, None)])).collect()}
    assert [tuple(r) for r in rows[1]["runs"]] == [(0, periods.BLOCK + 9, 1)] and rows[1]["clean"] == "a"
    assert [tuple(r) for r in rows[2]["runs"]] == [(0, 18, 2)] and rows[2]["clean"] == "b c"
    assert rows[3]["n_words"] == 0 and rows[3]["clean"] == ""
