import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from helpers import awkward, docs_of, words

from keelson.llm import pii

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
CASES = ["a.b+c@x-1.example.org,d@e f@g.h@i.j", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.255 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111",
         "+1 (017) 555-7713 +12 +1234567890123456 + 1 2 +49.30.1234567)", "é日 x@y.z 10.0.0.1é@q.r 12345678901234567890123", "a@b@c.d..e@f.g-", "79927398713 +1-4111-1111-1111-1111"]


def brute(text):
    out = []
    for kind, form in FORMS.items():
        for m in re.finditer(form, text or ""):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            n = len(digits)
            total = sum(d if k % 2 == 0 else sum(map(int, str(2 * d))) for k, d in enumerate(reversed(digits)))
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= n <= 19 and total % 10 == 0, "phone": 9 <= n <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_against_brute_force():
    rng = random.Random(4)
    texts = CASES + ["".join(rng.choices("0123456789.-+ ()@aZé_%,\n", k=rng.randrange(60))) for _ in range(20_000)]
    texts += ["".join(rng.choices(["4111111111111111", "+1 (2", "10.0.0.", "255", "@", "a.b", " ", "-"], k=rng.randrange(9))) for _ in range(20_000)]
    for t in texts:
        assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(t)] == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "a." * 150_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000, "a@" * 100_000, "1 " * 150_000, "+1" + "(" * 300_000):
        pii.base_spans(t)
        pii.word_labels(t)


def test_viterbi_and_likelihood_against_all_paths():
    rng = np.random.default_rng(1)
    k = len(pii.LABELS)
    moves = rng.normal(size=(k + 1, k)) + pii.allowed()
    sizes = np.array([4, 3, 3, 1])
    first = np.array([3, 0, 7, 10])
    scores = rng.normal(size=(11, k)) * 2
    got = pii.viterbi(scores, moves, first, sizes)
    padded, labels, mask = np.zeros((4, 4, k)), np.zeros((4, 4), int), np.zeros((4, 4), bool)
    want = 0.0
    for i, (a, n) in enumerate(zip(first, sizes)):
        paths = list(itertools.product(range(k), repeat=int(n)))
        value = np.array([moves[-1, p[0]] + sum(scores[a + j, p[j]] for j in range(n)) + sum(moves[p[j], p[j + 1]] for j in range(n - 1)) for p in paths])
        assert paths[int(value.argmax())] == tuple(got[a:a + n])
        padded[i, :n], labels[i, :n], mask[i, :n] = scores[a:a + n], got[a:a + n], True
        want += value.max() - value.max() - np.log(np.exp(value - value.max()).sum())
    value, by_score, by_move = pii.likelihood(padded, moves, labels, mask)
    assert value == pytest.approx(want)
    for i, j, y in itertools.product(range(4), range(4), range(k)):
        up = padded.copy()
        up[i, j, y] += 1e-6
        assert by_score[i, j, y] == pytest.approx((pii.likelihood(up, moves, labels, mask)[0] - value) / 1e-6, abs=1e-4)
    for x, y in itertools.product(range(k + 1), range(k)):
        up = moves.copy()
        up[x, y] += 1e-6
        assert by_move[x, y] == pytest.approx((pii.likelihood(padded, up, labels, mask)[0] - value) / 1e-6, abs=1e-4)


def person(rng):
    card = [int(c) for c in "4" + "".join(rng.choices("0123456789", k=14))]
    check = -sum(sum(divmod(2 * d, 10)) if k % 2 == 0 else d for k, d in enumerate(reversed(card))) % 10
    return rng.choice([f"{rng.choice(['anna', 'jo', 'Kim.li'])}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com",
                       ".".join(str(rng.randrange(256)) for _ in range(4)), "".join(map(str, [*card, check])),
                       f"+{rng.randrange(1, 99)} ({rng.randrange(100, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"])


def decoy(rng):
    return rng.choice(["".join(rng.choices("0123456789", k=rng.choice((3, 8, 14)))), f"{rng.randrange(9)}.{rng.randrange(9)}.", "v1.2", f"{rng.randrange(300, 999)}.1.1.1"])


def corpus(seed, n):
    rng = random.Random(seed)
    say = lambda: words(rng, 4) + " " + (person(rng) if rng.random() < 0.5 else decoy(rng))
    return [(i, ". ".join(" ".join(say() for _ in range(3)) + " " + words(rng, 2) for _ in range(6))) for i in range(n)]


@pytest.fixture(scope="module")
def field(spark):
    return pii.learn(pii.labelled_windows(docs_of(spark, corpus(1, 250) + awkward())))


def test_held_out_words_get_their_labels(spark, field):
    right = wrong = missed = 0
    for _, t in corpus(2, 150):
        own, labels = pii.word_labels(t)
        raw = t.encode()
        got = pii.block_labels(field, [raw.split()], [pii.sentence_starts(raw, raw.split())])
        right += sum(a == b and b > 0 for a, b in zip(got, labels))
        wrong += sum(a != b and a > 0 for a, b in zip(got, labels))
        missed += sum(a != b and b > 0 for a, b in zip(got, labels))
    assert right > 400 and missed < 0.02 * right and wrong < 0.02 * right, (right, wrong, missed)


def test_other_ways_of_writing_are_added(spark, field):
    texts = [(1, "the restre (017) 555-7713 inea of"), (2, "write to anna.34(at)mail7.example.com then"), (3, "nothing here but words and 12 numbers of 2024.")]
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.scan_pii(docs_of(spark, texts), field).collect()}
    assert got == {1: [("crf_phone", 11, 25)], 2: [("crf_email", 9, 37)], 3: []}


def test_query_against_brute_force(spark):
    docs = awkward() + corpus(3, 60) + [(500 + k, t) for k, t in enumerate(CASES)]
    got = pii.op13(docs_of(spark, docs)).collect()
    want = []
    for i, t in docs:
        b = brute(t)
        want.append((i, *(sum(k == kind for k, _, _ in b) for kind in FORMS), hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str)
    for r in got:
        base = [x for x in r["spans"].split(",") if x and not x.startswith("crf_")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r["base_sha256"]
    assert pii.op13(docs_of(spark, docs).limit(0)).collect() == []


def test_redaction_and_texts_without_personal_data(spark, field):
    for r in pii.scan_pii(docs_of(spark, awkward() + corpus(5, 20)), field).collect():
        assert (r["clean"] is None) == (not r["spans"])
        assert not r["clean"] or not brute(r["clean"])
    assert all(not r["spans"] for r in pii.scan_pii(docs_of(spark, awkward())).collect())


def test_decoding_does_not_depend_on_the_block(field):
    texts = [t.encode().split() for _, t in corpus(6, 12)] + [[], [b"a"]]
    breaks = [pii.sentence_starts(b" ".join(t), t) for t in texts]
    whole = pii.block_labels(field, texts, breaks)
    assert whole.tolist() == [y for t, b in zip(texts, breaks) for y in pii.block_labels(field, [t], [b])]
