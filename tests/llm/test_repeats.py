import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import awkward, docs_of, words
from hypothesis import given, settings
from hypothesis import strategies as st

from keelson.llm import repeats


def brute(docs, span):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[p:p + span] for t in texts for p in range(len(t) - span + 1))
    out = []
    for (i, _), t in zip(docs, texts):
        gone = np.zeros(len(t), bool)
        for p in range(len(t) - span + 1):
            if seen[t[p:p + span]] > 1:
                gone[p:p + span] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def cases():
    rng = random.Random(9)
    passage, other = words(rng, 150), words(rng, 200)
    docs = awkward()
    for k in range(12):  # passages in different surroundings, cut at different places
        docs.append((200 + k, words(rng, rng.randint(0, 90)) + passage[rng.randint(0, 60):] + words(rng, 70) + other[:rng.randint(300, 900)]))
    docs += [(300, "ab" * 700), (301, "x" + "ab" * 300), (302, other), (303, other), (304, other + passage + other), (305, passage[:399]),
             (306, passage[:400] + "!"), (307, "é" * 500), (308, ("line of the same words again\n" * 40))]
    return docs


@pytest.mark.parametrize("hot", [5000, 3])
def test_against_brute_force(spark, hot):
    docs = cases()
    from pyspark.sql import functions as F
    got = repeats.remove_repeats(docs_of(spark, docs), block=7, hot=hot).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, 400)


def test_query_and_empty_table(spark):
    docs = cases()
    assert sorted(map(tuple, repeats.op4(docs_of(spark, docs)).collect()), key=str) == brute(docs, 400)
    assert repeats.op4(docs_of(spark, docs).limit(0)).count() == 0
    assert [r["n_removed"] for r in repeats.op4(docs_of(spark, [(1, None), (2, "")])).collect()] == [0, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab", min_size=6, max_size=30), min_size=1, max_size=8), st.integers(0, 5))
def test_columns_find_every_shared_window(strings, lead):
    span = 5
    raw = [s.encode() for s in strings]
    ahead = [min(lead, len(s) - span) for s in raw]
    found = repeats.repeated_windows(raw, ahead, span)
    seen = Counter((p - a, s[p:p + span]) for s, a in zip(raw, ahead) for p in range(len(s) - span + 1))
    for s, a, f in zip(raw, ahead, found):
        assert f.tolist() == [seen[p - a, s[p:p + span]] > 1 for p in range(len(s) - span + 1)]


def test_contexts_cover_all_windows(monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    text = words(random.Random(3), 600).encode()
    at = 0
    for first, n, ahead, _ in repeats.Anchors().contexts(text):
        for a, k, d in zip(first.tolist(), n.tolist(), ahead.tolist()):
            assert a == at and 0 <= d <= 400 - 32
            at += k
    assert at == len(text) - 399
