"""The corpus pipeline, every stage on its own input against brute force."""

import importlib
import random
from collections import Counter

import pytest
from test_decontaminate import lowered
from test_secrets import brute as secret_spans
from test_simjoin import brute as component_rows

from keelson.llm import simjoin

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    cp = importlib.import_module("corpus_pipeline")
    folder = tmp_path_factory.mktemp("corpus")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        out[name] = docs = spark.read.parquet(f"{folder}/{name}")
    return out


def test_all_but_the_last_stage_keep_the_columns(stages):
    names = list(stages)
    assert names[1:] == ["toxicity", "near_copies", "benchmark_passages", "secrets", "packing"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_one_document_of_each_group_stays(stages):
    cp = importlib.import_module("corpus_pipeline")
    rows = [(r["doc_id"], r["text"]) for r in stages["toxicity"].collect()]
    firsts = {c for _, _, c in component_rows(rows, percent=cp.NEAR_PERCENT, size=cp.NEAR_WORDS)}
    assert sorted(r["doc_id"] for r in stages["near_copies"].collect()) == sorted(firsts)


def test_near_copies_count_the_shingles_of_every_row(spark, monkeypatch):
    cp = importlib.import_module("corpus_pipeline")
    from helpers import awkward, docs_of, words

    rng = random.Random(13)
    passage = words(rng, 30)
    docs = awkward() + [(100 + k, f"{passage} {words(rng, 20)}") for k in range(30)]
    found, frequent = [], simjoin.frequent

    def seen(*args):
        found.append(frequent(*args))
        return found[-1]

    monkeypatch.setattr(simjoin, "frequent", seen)
    cp.drop_near_copies(spark, docs_of(spark, docs), SF).count()
    own = simjoin.Shingles(cp.NEAR_WORDS)
    times = Counter(h for _, t in docs for h in own.of((t or "").encode()).tolist())
    assert [dict(zip(s.tolist(), n.tolist())) for s, n in found] == [{h: c for h, c in times.items() if c > 4}]


def test_benchmark_windows_are_gone_and_clean_texts_stay(spark, stages):
    grams = set()
    for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect():
        w = lowered(r["text"])
        n = min(10, len(w))
        grams |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1) if n}
    sizes = {len(g) for g in grams}
    dirty = lambda t: any(tuple(w[i:i + n]) in grams for w in [lowered(t)] for n in sizes for i in range(len(w) - n + 1))
    before = {r["doc_id"]: r["text"] for r in stages["near_copies"].collect()}
    after = {r["doc_id"]: r for r in stages["benchmark_passages"].collect()}
    for key, text in before.items():
        if not dirty(text):
            assert after[key]["text"] == text
        elif key in after:
            assert not dirty(after[key]["text"]) and after[key]["n_chars"] == len(after[key]["text"])


def test_secrets_are_gone_and_clean_texts_stay(stages):
    before = {r["doc_id"]: r["text"] for r in stages["benchmark_passages"].collect()}
    after = {r["doc_id"]: r["text"] for r in stages["secrets"].collect()}
    assert before.keys() == after.keys()
    for key, text in before.items():
        assert not secret_spans(after[key])
        if not any(w in text.lower() for w in ("pass", "secret", "token", "key", "akia", "auth")) and not secret_spans(text):
            assert after[key] == text


def test_packed_tokens_are_all_there(stages):
    rows = stages["packing"].collect()
    total = {}
    for r in rows:
        total.setdefault(r["doc_id"], [0, r["doc_tokens"]])[0] += r["length"]
    assert total.keys() == {r["doc_id"] for r in stages["secrets"].collect()}
    assert all(a == b for a, b in total.values())


def test_run_equals_the_stages(spark, stages):
    cp = importlib.import_module("corpus_pipeline")
    key = lambda r: (r["doc_id"], r["start"], r["length"], bytes(r["ids"]))
    assert sorted(map(key, cp.run(spark, SF).collect())) == sorted(map(key, stages["packing"].collect()))


def test_toxic_documents_go(spark, stages):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in stages["toxicity"].collect()}
    clean = [i for i, t in labels.items() if not t]
    assert sum(i in left for i in clean) >= 0.95 * len(clean)


def test_near_copies_by_five_words_and_four_fifths(spark):
    """A tenth of new words at the end: 0.8 <= J5 and J3 < 0.9, so the copy goes."""
    from helpers import docs_of

    cp = importlib.import_module("corpus_pipeline")
    base = [f"w{k}" for k in range(100)]
    texts = [(1, " ".join(base)), (2, " ".join(base + [f"new{k}" for k in range(14)])),
             (3, " ".join(f"v{k}" for k in range(100))), (4, " ".join([f"v{k}" for k in range(100)] + [f"far{k}" for k in range(30)]))]
    assert sorted(r["doc_id"] for r in cp.drop_near_copies(spark, docs_of(spark, texts), SF).collect()) == [1, 3, 4]


def test_stages_take_awkward_rows_and_empty_tables(spark, tmp_path):
    """Nulls in every column, empty and blank texts, repeated rows and ids,
    extra columns whose names the operators use themselves."""
    from helpers import awkward, docs_of

    cp = importlib.import_module("corpus_pipeline")
    for name, docs in (("rows", docs_of(spark, awkward() + [(11, "password=hunter2hunter2 " + "w " * 9), (12, None)])), ("none", docs_of(spark, awkward()).limit(0))):
        before = docs.count()
        for stage, fn in cp.STAGES:
            fn(spark, docs, SF).write.parquet(f"{tmp_path}/{name}/{stage}")
            out = spark.read.parquet(f"{tmp_path}/{name}/{stage}")
            if stage != "packing":
                assert out.dtypes == docs.dtypes and out.count() <= before
            docs, before = out, out.count()
        assert (before > 0) == (name == "rows")
