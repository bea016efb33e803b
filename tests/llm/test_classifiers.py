import math

import numpy as np
from helpers import awkward, docs_of

from keelson.llm import langid, linear, quality, toxicity

SF = "/root/testdata/sf0.01"


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_languages_of_held_out_texts(spark):
    docs = read(spark, "documents")
    got = langid.op7(docs)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == docs.count() and len(held) > 100
    assert np.mean([r["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(spark):
    docs = docs_of(spark, awkward() + [(50, "12 34 !?"), (51, "東京 は")])
    rows = {(r["doc_id"], r["lang_pred"]) for r in langid.op7(docs).collect()}
    assert {(0, "und"), (1, "und"), (2, "und"), (50, "und"), (3, "en")} <= rows
    assert langid.op7(docs.limit(0)).count() == 0
    nothing = langid.op7(docs.withColumn("lang", langid.F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and len(nothing) == docs.count()


def test_gram_counts_and_distance_against_brute_force():
    text = "Ab ab, CÉ東! abc"
    codes, n = langid.Grams().count(text)
    want = {}
    for w in ("ab", "ab", "cé東", "abc"):
        p = f" {w} "
        for k in (1, 2, 3):
            for i in range(len(p) - k + 1):
                if p[i:i + k].strip():
                    g = p[i:i + k]
                    if k > 1 or g != " ":
                        want[g] = want.get(g, 0) + 1
    name = lambda c: "".join(chr(c >> 21 * j & (1 << 21) - 1) for j in (2, 1, 0) if c >> 21 * j & (1 << 21) - 1)
    assert {name(c): k for c, k in zip(codes.tolist(), n.tolist())} == want


def test_toxicity_of_held_out_texts(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    rows = toxicity.op10(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_toxicity_of_awkward_rows(spark):
    docs = docs_of(spark, awkward())
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (5, 0, 0), (8, None, 1), (None, 1, 1), (10, 0, 1), (99, 1, 1)], "doc_id long, toxic int, quality int")
    assert toxicity.op10(docs, labels).count() == len(awkward())
    assert toxicity.op10(docs.limit(0), labels).count() == 0
    assert {r["predicted"] for r in toxicity.op10(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.accepted(docs, labels.limit(0)).columns == docs.columns


def test_counterfactual_penalty_evens_out_identity_terms(spark):
    # one group is named in toxic texts, another in clean ones: without the
    # penalty the group's name alone decides
    rows, labels = [], []
    for i in range(400):
        toxic = i % 2
        rows.append((i, f"{'muslim' if toxic else 'christian'} people w{i % 7} {'awful trash' if toxic and i % 3 else 'fine day'}"))
        labels.append((i, toxic))
    docs, known = docs_of(spark, rows), spark.createDataFrame(labels, "doc_id long, label int")
    gap = {}
    for penalty in (0.0, 20.0):
        model = toxicity.learn(docs, known, penalty=penalty)
        score = lambda t: model.score({f for w in toxicity.tokens(t) for f in toxicity.features(w) or () if f in model.weights})  # noqa: E731, B023
        gap[penalty] = abs(score("a muslim w1 fine day") - score("a christian w1 fine day"))
        assert score("awful trash") > score("fine day")
    assert gap[20.0] < gap[0.0] / 2


def test_quality_finds_bad_texts_without_labels(spark):
    docs, labels = read(spark, "documents"), read(spark, "labels")
    got = quality.classify(docs)
    rows = got.join(labels.select("doc_id", "quality"), "doc_id").collect()
    right = np.array([r["predicted"] == r["quality"] for r in rows])
    bad = np.array([r["quality"] == 0 for r in rows])
    assert got.count() == docs.count() and right.mean() > 0.92 and right[bad].mean() > 0.6 and right[~bad].mean() > 0.97


def test_quality_of_awkward_rows(spark):
    docs = docs_of(spark, awkward())
    assert quality.classify(docs).count() == len(awkward())
    assert quality.classify(docs.limit(0)).count() == 0


def test_labeller_accuracies_recover_the_classes():
    rng = np.random.default_rng(1)
    truth = rng.random(5000) < 0.8
    right = (0.95, 0.85, 0.7, 0.8, 0.6)
    patterns, rows = {}, []
    for t in truth:
        p = "".join("-" if rng.random() < 0.2 else "g" if (rng.random() < a) == t else "b" for a in right)
        rows.append(p)
        patterns[p] = patterns.get(p, 0) + 1
    posterior = quality.estimate(patterns)
    assert np.mean([(posterior[p] >= 0.5) == t for p, t in zip(rows, truth)]) > 0.92
    assert quality.estimate({}) == {}


def test_linear_fit_of_soft_labels():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 30, 8)) for _ in range(600)]
    y = np.array([0.9 if 3 in r else 0.1 for r in rows])
    model = linear.fit(rows, y)
    assert model.score({3}) > 0.8 > 0.2 > model.score({4}) and math.isclose(linear.fit(rows, np.ones(600)).score(set()), 1, abs_tol=1e-3)
    assert linear.fit([], np.zeros(0)).score({1}) < 1e-6
