"""Language profiles, weak labels and the linear scorer against plain loops."""

import math
import random
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from helpers import awkward, docs_of

from keelson.llm import langid, linear, quality, toxicity

SF = "/root/testdata/sf0.001"


def grams(text):
    words, own = [], ""
    for c in text.lower() + " ":
        if c.isalpha():
            own += c
        elif own:
            words.append(own)
            own = ""
    count = Counter()
    for w in words:
        p = f" {w} "
        count.update(p[i:i + k] for k in (1, 2, 3) for i in range(len(p) - k + 1) if p[i:i + k].strip())
    return count


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def test_languages_of_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    total = {}
    for i, text, lang in docs:
        if crc32(str(i).encode()) % 5 and text is not None and lang is not None:
            total.setdefault(lang, Counter()).update(grams(text))
    first = lambda count: [g for g, _ in sorted(count.items(), key=lambda x: (-x[1], code(x[0])))[:langid.PLACES]]
    profiles = {lang: {g: k for k, g in enumerate(first(count))} for lang, count in sorted(total.items())}
    want = {}
    for i, text, _ in docs:
        own = first(grams(text or ""))
        apart = {lang: sum(abs(p[g] - k) if g in p else langid.PLACES for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(apart, key=apart.get) if own else "und"
        want[i] = (crc32(str(i).encode()) % 5 == 0, best, round(1 - apart[best] / (langid.PLACES * len(own)), 9) if own else 0.0)
    got = {r["doc_id"]: (r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in langid.query(spark, SF).collect()}
    assert got == want


def plain_posteriors(patterns, rounds=100):
    """Expectation-maximisation one pattern, labeller and vote at a time."""
    q = {}
    for p in patterns:
        cast = [v for v in p if v != "-"]
        q[p] = min(0.98, max(0.02, 1 - 1.5 * (cast.count("b") / max(len(cast), 1))))
    width = len(next(iter(patterns)))
    for _ in range(rounds):
        prior = min(1 - 1e-3, max(1e-3, sum(q[p] * n for p, n in patterns.items()) / sum(patterns.values())))
        share = []
        for k in range(width):
            good, poor = dict.fromkeys("gb-", 1.0), dict.fromkeys("gb-", 1.0)
            for p, n in patterns.items():
                good[p[k]] += q[p] * n
                poor[p[k]] += (1 - q[p]) * n
            share.append({v: (good[v] / sum(good.values())) / (poor[v] / sum(poor.values())) for v in "gb-"})
        for p in patterns:
            odds = math.log(prior / (1 - prior)) + sum(math.log(share[k][v]) for k, v in enumerate(p))
            q[p] = 1 / (1 + math.exp(-min(30, max(-30, odds))))
    return q


def test_weak_labels_against_plain_expectation_maximisation(spark):
    rng = random.Random(4)
    patterns = {"".join(rng.choice("ggb-") for _ in range(5)): rng.randrange(1, 60) for _ in range(40)}
    assert quality.estimate(patterns) == pytest.approx(plain_posteriors(patterns), abs=1e-9)
    docs = awkward() + [(100 + k, " ".join(rng.choice(["word", "$$$", "UP", "of", "tion"]) for _ in range(rng.randrange(60)))) for k in range(60)]
    rows = quality.classify(docs_of(spark, docs)).collect()
    votes = [quality.votes(*quality.counted((t or "").encode())) for _, t in docs]
    said = plain_posteriors(Counter(votes))
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["votes"], round(r["posterior"], 7)) for r in rows), key=key) == sorted(
        ((i, v, round(said[v], 7)) for (i, _), v in zip(docs, votes)), key=key)


def plain_fit(rows, y, swapped, penalty, l2=1e-4, rounds=400, rate=0.1):
    """The scorer's loss, its gradient and Adam, one row and feature at a time."""
    n = len(rows)
    mean = sum(y) / n
    always = {f for i, other in swapped for f in set(rows[i]) ^ set(other)}
    seen = Counter(f for r in rows for f in r)
    mass = Counter()
    for r, v in zip(rows, y):
        for f in r:
            mass[f] += v
    used = sorted(f for f, c in seen.items() if f in always or c >= 3 and abs(mass[f] - c * mean) / math.sqrt(max(c * mean * (1 - mean), 1e-9)) >= 3.5)
    w, b = dict.fromkeys(used, 0.0), math.log(mean / (1 - mean))
    m, v = dict.fromkeys([*used, None], 0.0), dict.fromkeys([*used, None], 0.0)
    for step in range(1, rounds + 1):
        g = dict.fromkeys([*used, None], 0.0)
        for r, t in zip(rows, y):
            miss = (1 / (1 + math.exp(-(b + sum(w.get(f, 0.0) for f in r)))) - t) / n
            g[None] += miss
            for f in r:
                if f in g:
                    g[f] += miss
        for i, other in swapped:
            change = 2 * penalty / len(swapped) * (sum(w.get(f, 0.0) for f in rows[i]) - sum(w.get(f, 0.0) for f in other))
            for f in rows[i]:
                if f in g:
                    g[f] += change
            for f in other:
                if f in g:
                    g[f] -= change
        for f in g:
            g[f] += l2 * w[f] if f is not None else 0.0
            m[f], v[f] = 0.9 * m[f] + 0.1 * g[f], 0.999 * v[f] + 0.001 * g[f] ** 2
            move = rate * (m[f] / (1 - 0.9**step)) / (math.sqrt(v[f] / (1 - 0.999**step)) + 1e-8)
            if f is None:
                b -= move
            else:
                w[f] -= move
    return b, w


def test_scorer_against_plain_loops():
    rng = random.Random(5)
    rows, y = [], []
    for _ in range(120):
        toxic = rng.random() < 0.4
        rows.append(sorted({rng.randrange(12) for _ in range(4)} | ({20, 21} if toxic and rng.random() < 0.9 else set()) | ({30} if toxic else {31} if rng.random() < 0.8 else set())))
        y.append(float(toxic))
    swapped = [(i, sorted(set(r) - {30} | {31})) for i, r in enumerate(rows) if 30 in r][:20]
    as_arrays = [np.array(r, np.int64) for r in rows]
    for own in ([], swapped):
        model = linear.fit(as_arrays, np.array(y), [(i, np.array(f, np.int64)) for i, f in own], penalty=2.0)
        b, w = plain_fit(rows, y, own, 2.0)
        assert model.bias == pytest.approx(b, abs=1e-6) and model.weights == pytest.approx({f: x for f, x in w.items() if abs(x) > 1e-6}, abs=1e-6)


def test_toxicity_of_a_whole_table_is_the_scorer_on_its_rows(spark):
    """op10's scores on a small table from the plain scorer over its labelled rows."""
    rng = random.Random(6)
    docs = [(k, " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(12)) + (" vile scum" if k % 3 == 0 else " kind folk")) for k in range(90)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in docs], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in toxicity.op10(docs_of(spark, docs), labels).collect()}
    own = {k: sorted({f for t in toxicity.tokens(text) for f in toxicity.features(t) or ()}) for k, text in docs}
    fitted = [k for k, _ in docs if crc32(str(k).encode()) % 4 != 2]
    b, w = plain_fit([own[k] for k in fitted], [float(k % 3 == 0) for k in fitted], [], 1.0)
    for k, _ in docs:
        assert got[k] == pytest.approx(1 / (1 + math.exp(-(b + sum(w.get(f, 0.0) for f in own[k])))), abs=1e-4)
