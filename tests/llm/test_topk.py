import math
import random

from keelson.llm import topk


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(0, 700)]
    rows += [(i, [round(x) * 0.5 for x in rows[i % 50][1]]) for i in range(700, 900)]  # ties
    rows += [(1000, None), (1100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1200, [math.nan] * 6), (1300, [math.inf] * 6), (1400, []), (1500, [1.0, 2.0]), (1600, [-3.0, 5.0]),
             (None, [1.0] * 6), (1700, [1e6] * 6), (1800, [1.0, 2.0, 3.0])]
    frame = spark.createDataFrame([(i, x, 1, 2, 3) for i, x in rows], "vec_id long, embedding array<double>, score int, rank int, query_id int").repartition(4)
    fine = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for q, x in fine:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in fine if i != q and len(y) == len(x))
            want += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:10], 1)]
    got = topk.op8(frame)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    blocks = topk.top_k(frame, frame.filter("vec_id % 100 = 0"), block_queries=3, shard_rows=90)
    assert sorted(map(tuple, blocks.collect())) == sorted(want)
    assert topk.op8(frame.limit(0)).count() == 0
    twice = topk.op8(frame.filter("vec_id in (100, 101, 102)").union(frame.filter("vec_id = 100")))
    assert twice.count() == 2


def test_every_vector_of_a_query_id_is_searched(spark):
    rng = random.Random(8)
    rows = [(i, [float(rng.randint(-9, 9)) for _ in range(3)]) for i in range(1, 90)]
    rows += [(100, [1.0, 0.0, 0.0]), (100, [-1.0, 2.0, 0.0]), (100, [0.0, 0.0, 3.0]), (100, [0.0, 0.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    scored = sorted((-sum(1024 * 1024 * int(a * b) for a, b in zip(x, y)), i) for _, x in rows[-4:-1] for i, y in rows[:-4])
    want = [(100, r, i, -s) for r, (s, i) in enumerate(scored[:10], 1)]
    assert sorted(map(tuple, topk.op8(frame).collect())) == want
