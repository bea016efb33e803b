"""Group-wise operators must combine map-side (partial aggregation) and must
not sort a raw group in one task (no window over raw rows), so one key
holding a third of the rows costs no more than any other."""

import pytest
from pyspark.sql import functions as F

from keelson.operators import evaluate as EV
from keelson.operators import registry as RG
from keelson.operators import search as SR
from keelson.operators import tracking as TR


@pytest.fixture(scope="module")
def hot(spark):
    # key 0 holds a third of all rows
    n = 3000
    rows = [(0 if i % 3 == 0 else i, i % 7, float(i % 11), float(i % 13), i) for i in range(n)]
    return spark.createDataFrame(rows, "k long, key long, y double, p double, ts long")


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _assert_partial_no_window(df, partial):
    plan = _plan(df)
    assert partial in plan, plan
    assert "Window [" not in plan and "Window(" not in plan, plan


def test_latest_by_is_partial(hot):
    df = TR.latest_by(hot.withColumnRenamed("k", "run_id").withColumn("key", F.col("key").cast("string")),
                      ["run_id", "key"], ["ts"], ["y"])
    _assert_partial_no_window(df, "partial_max")
    # correctness on the hot key: latest ts per (0, key)
    got = {r["key"]: r["y"] for r in df.filter(F.col("run_id") == 0).collect()}
    want = {}
    for r in hot.filter(F.col("k") == 0).collect():
        if str(r["key"]) not in want or r["ts"] > want[str(r["key"])][0]:
            want[str(r["key"])] = (r["ts"], r["y"])
    assert got == {k: v[1] for k, v in want.items()}


def test_best_per_group_is_partial(hot):
    df = TR.best_per_group(hot.withColumnRenamed("ts", "run_id"), ["k"], "y", "run_id")
    _assert_partial_no_window(df, "partial_min")


def test_current_stage_is_partial(spark, hot):
    ev = hot.select(F.lit("m").alias("name"), F.col("k").alias("version"),
                    F.when(F.col("key") % 2 == 0, "Staging").otherwise("Archived").alias("stage"),
                    F.col("ts").cast("timestamp").alias("ts"), F.col("ts").alias("seq"))
    _assert_partial_no_window(RG.current_stage(ev), "partial_max")


def test_grouped_metrics_and_best_trial_are_partial(hot):
    _assert_partial_no_window(EV.regression_metrics(hot, "y", "p", 1, group_cols=["k"]), "partial_sum")
    trials = hot.select(F.col("k").cast("string").alias("family"), F.col("ts").alias("trial_id"),
                        F.col("y").alias("loss"), F.lit("ok").alias("status"))
    _assert_partial_no_window(SR.best_trial(trials), "partial_min")


def test_suggested_ranges_spread_a_hot_range(spark):
    """All trials of one range: they meet its points in many groups, and the densities are those of plain loops."""
    import math

    from keelson.operators import search as SR

    rows = [("f", i, float((i * 37) % 101), "p", float((i * 13) % 50) + 0.5) for i in range(400)]
    trials = spark.createDataFrame(rows, "family string, trial_id long, loss double, param string, value double")
    ranges = spark.createDataFrame([("f", "p", 0.0, 51.0)], "family string, param string, low double, high double")
    out = SR.suggest_ranges(trials, ranges, candidates=5)
    assert "dealt" in out._jdf.queryExecution().analyzed().toString()
    got = out.first()
    best = {t for _, t in sorted((loss, t) for _, t, loss, _, _ in rows)[:100]}
    cdf = lambda z: 0.5 * math.erfc(-z / math.sqrt(2))
    for column, side in (("good_density", [r[4] for r in rows if r[1] in best]), ("bad_density", [r[4] for r in rows if r[1] not in best])):
        sigma = 51.0 / 4 * (len(side) + 1) ** -0.2
        each = [math.exp(-0.5 * ((got["value"] - m) / sigma) ** 2) / (math.sqrt(2 * math.pi) * sigma) / (cdf((51 - m) / sigma) - cdf(-m / sigma)) for m in side]
        assert math.isclose(got[column], (1 / 51 + sum(each)) / (len(side) + 1), rel_tol=1e-4)
