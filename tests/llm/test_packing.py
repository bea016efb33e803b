import zlib

import numpy as np
import pytest
from helpers import awkward, docs_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keelson.llm import packing


def check_pieces(lengths, capacity, classes, pieces):
    doc, start, length, seq, off, cls = (x.tolist() for x in pieces)
    for d, n in enumerate(lengths):
        at = 0
        for s, k in sorted((s, k) for x, s, k in zip(doc, start, length) if x == d):
            assert s == at and k > 0
            at += k
        assert at == n
    loose = 0
    for q in set(seq):
        own = sorted((o, k, c, d) for x, o, k, c, d in zip(seq, off, length, cls, doc) if x == q)
        at = 0
        for o, k, _, _ in own:
            assert o == at
            at += k
        assert at <= capacity
        kinds = {c for _, _, c, _ in own} - {0}
        assert len(kinds) <= 1
        for c in kinds:  # a bin holds the class's fixed number of whole documents
            whole = [d for _, _, k, d in own if k]
            assert len(whole) == c and all(capacity // lengths[d] == c for d in whole)
        loose += 0 if at & (at - 1) == 0 else capacity - at
    return loose


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 200), min_size=1, max_size=60), st.sampled_from([16, 64]), st.sampled_from([2, 8]))
def test_pieces_cover_all_tokens_without_padding(lengths, capacity, classes):
    assert check_pieces(lengths, capacity, classes, packing.harmonic(np.array(lengths), capacity, classes)) == 0


def test_ids_equal_the_tokenizers(spark):
    texts = awkward()
    path = packing.tokenizer_path()
    tok = Tokenizer.from_file(path)
    got = packing.pack(docs_of(spark, texts), path, capacity=64, block_tokens=900).collect()
    by_doc = {}
    for r in got:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], bytes(r["ids"])))
        assert len(r["ids"]) == 4 * r["length"]
    want = {}
    for i, t in texts:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        want.setdefault((i, len(ids)), []).append(np.array(ids, "<u4").tobytes())
    assert by_doc.keys() == want.keys()
    for key, raw in want.items():
        if len(raw) == 1:
            assert b"".join(x[2] for x in sorted(by_doc[key])) == raw[0]
        assert sum(x[1] for x in by_doc[key]) == len(raw) * key[1]
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        assert sorted(parts)[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:]))


def test_query_digests_and_empty_table(spark):
    docs = docs_of(spark, awkward())
    rows = packing.op1(docs).collect()
    assert {tuple(r)[:3]: r["ids_crc32"] for r in rows} == {
        (r["doc_id"], r["start"], r["length"]): zlib.crc32(bytes(r["ids"])) for r in packing.pack(docs, packing.tokenizer_path()).collect()}
    assert packing.op1(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, packing.tokenizer_path(), capacity=100)
