import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import awkward, docs_of, words
from tokenizers import Tokenizer

from keelson.llm import alignment

ODD = ["<|endoftext|> and </s> <s> are <unk> text", " starts with a space", "ends with one ", "two  spaces\n and a line", "tab\t tab", "mark ▁ here a▁b",
       "line\n", "\n\nlines\n\n\nlines \n x", "a  b　 c", "日本 語 emoji 👍🏽 é é", "\x00 nul \x01", "x" * 900, "it's we'll 12345 3.14%%% ###",
       "▁", " ", "  ", "ﬁ ligature ½", "ab " * 700, "a  b  c"]


@pytest.fixture(scope="module")
def brute():
    """Both tokenizers by their own files, tokens as bytes, and plain merging of all pairs."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in printable)}
    to_byte = {c: b for b, c in chars.items()}
    a_bytes = {i: bytes(to_byte[c] for c in t) for t, i in json.load(open(public_tokenizers.path("byte_bpe_50k.json")))["model"]["vocab"].items() if i != 50256}
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    b_bytes = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def ranges(tokens):
        out, at = [], 0
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    def one(text):
        if not text:
            return [], [], [], []
        ta = [(i, a_bytes[i]) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = [(i, b_bytes(i)) for i in b.encode(text)]
        want = (" " + text).encode()
        if b"".join(x for _, x in ta) != want or b"".join(x for _, x in tb) != want:
            return [], [], [], []
        ra, rb = ranges(ta), ranges(tb)
        links, j = [], 0
        for i, s, e in ra:
            while j < len(rb) and rb[j][2] <= s:
                j += 1
            k = j
            while k < len(rb) and rb[k][1] < e:
                links.append((i, rb[k][0]))
                k += 1
        ends = sorted({e for _, _, e in ra} & {e for _, _, e in rb})
        groups = [([i for i, s, _ in ra if lo <= s < hi], [i for i, s, _ in rb if lo <= s < hi]) for lo, hi in zip([0, *ends], ends)]
        return ra, rb, groups, links

    def all_of(docs):
        found = [(i, *one(t)) for i, t in docs]
        count = Counter(x for *_, links in found for x in links)
        top = {}
        for (_, y), n in count.items():
            top[y] = max(top.get(y, 0), n)
        text = lambda groups: ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        return [(i, len(ra), len(rb), len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links),
                 hashlib.sha256(text(groups).encode()).hexdigest() if ra else "", text(groups)) for i, ra, rb, groups, links in found]

    return all_of


def cases():
    rng = random.Random(3)
    return [d for d in awkward() if d[0] != 8] + [(100 + k, t) for k, t in enumerate(ODD)] + [(200 + k, words(rng, rng.randrange(30))) for k in range(25)]


key = lambda r: tuple(map(str, r))


@pytest.mark.parametrize("core", [alignment.CORE, 40, 0])
def test_scores_against_brute_force(spark, brute, core):
    docs = cases()
    want = brute(docs)
    assert any(not r[1] for r in want if 100 <= (r[0] or 0) < 200) and sum(bool(r[1]) for r in want) > 40
    assert sorted(map(tuple, alignment.scored(docs_of(spark, docs), core=core).collect()), key=key) == sorted((r[:8] for r in want), key=key)


def test_groups_as_text(spark, brute):
    docs = cases()
    got = alignment.aligned_groups(docs_of(spark, docs)).collect()
    assert sorted(map(tuple, got), key=key) == sorted(((*r[:5], r[8]) for r in brute(docs)), key=key)


def test_pair_counts_and_small_blocks(spark, brute, monkeypatch):
    docs = cases()
    monkeypatch.setattr(alignment, "BLOCK", 50)
    monkeypatch.setattr(alignment, "HELD", 30)
    monkeypatch.setattr(alignment, "LANE", 3)
    tok = alignment.Tokenizers(*alignment.paths())
    assert tok.splits
    got = [(i, *(int(block.counts(c)[k]) for c in alignment.COUNTS), block.labels()[k].decode())
           for i, t in docs for block in [alignment.Block(tok, [t or "", t or ""])] for k in [1]]
    assert sorted(got, key=key) == sorted(((*r[:5], r[8]) for r in brute(docs)), key=key)


def test_empty_table(spark):
    docs = docs_of(spark, cases()).limit(0)
    assert alignment.scored(docs).collect() == [] and alignment.aligned_groups(docs).collect() == []


def test_ranks_cut_texts_as_the_json_does():
    """The ranks' own pattern splits every character like the vocabulary's file."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    tok = alignment.Tokenizers(*alignment.paths())
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(signs), 64):
        t = " ".join(f"b{c}b 1{c} {c}{c}" for c in signs[lo:lo + 64])
        assert a.encode(t, add_special_tokens=False).ids == tok.a.encode_ordinary(t), hex(ord(signs[lo]))
