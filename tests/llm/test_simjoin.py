import random
from collections import Counter

import pytest
from helpers import awkward, docs_of, words
from pyspark.sql import functions as F

from keelson.llm import components as cp
from keelson.llm import simjoin


def shingles(text, size=3):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def brute(docs, percent=90, size=3):
    sets = [shingles(t, size) for _, t in docs]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            both = len(s & sets[j])
            if s and 100 * both >= percent * len(s | sets[j]) and both:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, (d, s) in enumerate(zip([d for d, _ in docs], sets))), key=str)


def cases():
    rng = random.Random(6)
    docs = awkward()
    passage = words(rng, 40)
    chain = words(rng, 200).split()
    for k in range(25):  # a chain: neighbours are linked, ends are not
        chain = chain[3:] + words(rng, 3).split()
        docs.append((400 + k, " ".join(chain)))
    for k in range(30):  # a passage that unlike texts share
        docs.append((500 + k, passage + " " + words(rng, rng.randint(2, 60))))
    base = words(rng, 120).split()
    for k in range(40):  # near copies of one text
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(len(own))] = words(rng, 1)
        docs.append((600 + k, " ".join(own)))
    for k in range(12):  # short texts around the threshold
        docs.append((700 + k, " ".join(base[:22 - k % 3] + words(rng, k % 2).split())))
    return docs + [(800, "B a"), (801, "a"), (802, "A")]


@pytest.mark.parametrize("limits", [{}, {"long_list": 2}, {"long_list": 3, "pivot_rounds": 1}, {"pivot_rounds": 0, "longest_lists": 0}, {"percent": 70}])
def test_against_brute_force(spark, limits):
    docs = cases()
    got = simjoin.similar(docs_of(spark, docs), **limits)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, limits.get("percent", 90))


@pytest.mark.parametrize("flush", [2_000_000, 50])
def test_shingles_are_counted_over_all_rows(spark, flush):
    """The counts that decide the order are those of every row, however many blocks they come in."""
    docs, own = cases(), simjoin.Shingles()
    times = Counter(h for _, t in docs for h in own.of((t or "").encode()).tolist())
    for long_list, longest in ((4, 500_000), (2, 500_000), (4, 0)):
        found, n = simjoin.frequent(docs_of(spark, docs), 3, long_list, longest, flush)
        assert dict(zip(found.tolist(), n.tolist())) == ({h: c for h, c in times.items() if c > long_list} if longest else {})
        assert (found[1:] > found[:-1]).all()


def test_a_shared_passage_makes_no_pairs(spark, monkeypatch):
    """Texts that share nine tenths, but not enough for a link, never meet in the last join."""
    rng = random.Random(60)
    passage = words(rng, 200)
    docs = [(k, passage + " " + " ".join(f"own{k}x{i}" for i in range(20))) for k in range(60)]
    met, linked = [], simjoin.linked

    def seen(pairs, *rest):
        met.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(simjoin, "linked", seen)
    got = simjoin.similar(docs_of(spark, docs), pivot_rounds=0)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)
    assert sum(met) == 0  # 1,770 where every text puts its first shingles by hash into the lists


def test_roots_are_joined_once_to_a_kind(spark, monkeypatch):
    """What a round joins with the roots has a row for each distinct set, not one for each place in the lists."""
    rng = random.Random(61)
    base = words(rng, 150).split()
    docs = [(k, " ".join(base[:k] + [f"own{k}"] + base[k + 1:])) for k in range(60)]
    joined, rooted = [], simjoin.rooted

    def seen(table, roots):
        joined.append((table.count(), roots.count()))
        return rooted(table, roots)

    monkeypatch.setattr(simjoin, "rooted", seen)
    got = simjoin.similar(docs_of(spark, docs))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs)
    assert len(joined) > 1 and joined[1][1] > 0
    assert max(n for n, _ in joined) <= len(docs)


def test_one_row_of_each_component_stays(spark):
    docs = cases()
    frame = docs_of(spark, docs)
    kept = simjoin.one_of_each(frame)
    assert kept.columns == frame.columns
    want = {(c, n) for _, n, c in brute(docs) if n}
    rows = kept.collect()
    empty = [d for d, t in docs if not shingles(t)]
    assert sorted(str(r["doc_id"]) for r in rows) == sorted([str(c) for c in {c for c, _ in want}] + [str(d) for d in empty])


def test_empty_table(spark):
    assert simjoin.op6(docs_of(spark, cases()).limit(0)).count() == 0
    assert sorted(map(tuple, simjoin.op6(docs_of(spark, [(1, None), (2, "")])).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert simjoin.one_of_each(docs_of(spark, cases()).limit(0)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000)]
    got = dict(map(tuple, cp.components(spark.createDataFrame(links, "a long, b long").withColumn("a", F.col("a"))).collect()))
    assert set(got) == set(range(1, 301)) | set(range(1001, 1200))
    assert all(got[i] == 0 for i in range(1, 301)) and all(got[i] == 1000 for i in range(1001, 1200))
