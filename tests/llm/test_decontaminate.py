import hashlib
import random
import re

import pytest
from helpers import awkward, docs_of, words

from keelson.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    for i, text in docs:
        w = lowered(text)
        hit, found = set(), set()
        for key, item in items:
            g = lowered(item)
            n = min(window, len(g))
            grams = {tuple(g[k:k + n]) for k in range(len(g) - n + 1)} if g else ()
            for p in range(len(w) - n + 1):
                if n and tuple(w[p:p + n]) in grams:
                    hit.update(range(p, p + n))
                    if key is not None:
                        found.add(str(key))
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def cases():
    rng = random.Random(5)
    items = [(k, words(rng, n)) for k, n in [(1, 30), (2, 12), (10, 4), (11, 10), (12, 0)]] + [(20, None), (None, words(rng, 14)), (1, words(rng, 15)), (13, "Ab, cd")]
    docs = awkward()
    for k, (_, t) in enumerate(items):
        for n in (3, 9, 10, 11, 40):
            w = (t or "").upper().split() if n != 11 else (t or "").split()
            docs.append((100 + k, words(rng, 8) + "\n" + ", ".join(w[max(0, len(w) - n):]) + "! " + words(rng, 8) + " " + " ".join(w[:n])))
    return docs, items


def item_table(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")


def test_against_brute_force(spark):
    docs, items = cases()
    got = dc.op2(docs_of(spark, docs), item_table(spark, items))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_blocks_of_items_add_up(spark):
    docs, items = cases()
    frame = docs_of(spark, docs)
    one = dc.decontaminate(frame, item_table(spark, items)).select("doc_id", "n_words", "n_hit", "hits", "items", "rejected")
    many = dc.decontaminate(frame, item_table(spark, items), block_bytes=200).select("doc_id", "n_words", "n_hit", "hits", "items", "rejected")
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_clean_text_has_no_window_left_and_clean_rows_stay(spark):
    docs, items = cases()
    got = dc.decontaminate(docs_of(spark, docs), item_table(spark, items), keep=("text", "lang", "n")).collect()
    assert len(got) == len(docs)
    left = brute([(r["doc_id"], r["clean"]) for r in got], items)
    assert not any(r[-1] for r in left)
    assert all(r["clean"] == r["text"] for r in got if not r["n_hit"])


@pytest.mark.parametrize("none", ["docs", "items"])
def test_empty_tables(spark, none):
    docs, items = docs_of(spark, awkward()), item_table(spark, cases()[1])
    got = dc.op2(docs.limit(0) if none == "docs" else docs, items.limit(0) if none == "items" else items).collect()
    assert len(got) == (0 if none == "docs" else len(awkward())) and not any(r["contaminated"] for r in got)


def test_blocks_of_items_clean_as_one(spark):
    """Items that overlap in a document, and windows that form at a cut, with
    items of other blocks or the same."""
    rng = random.Random(11)
    w = [f"p{k}" for k in range(60)]
    items = [(1, " ".join(w[:15])), (2, " ".join(w[9:22])), (3, " ".join(w[30:42])), (4, " ".join(w[44:56])), *[(10 + k, words(rng, 20)) for k in range(8)]]
    docs = [(1, " ".join(["before", *w[:22], "after"])),
            (2, " ".join(["before", *w[30:36], *w[44:56], *w[36:42], "after"])), (3, " ".join(["before", *w[44:50], *w[30:42], *w[50:56], "after"])),
            (4, "clean text"), (5, None)]
    frame, table = docs_of(spark, docs), item_table(spark, items)
    one, many = (sorted(map(str, dc.decontaminate(frame, table, block_bytes=b).collect())) for b in (16 << 20, 100))
    assert len(dc.item_blocks(table, 100)) > 5
    assert one == many
