"""Hand-made rows: edge cases named in the blueprint."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from keelson.operators import evaluate as EV
from keelson.operators import models as M
from keelson.operators import profile as PR
from keelson.operators import registry as RG
from keelson.operators import tracking as TR


def measured_rows(spark):
    # invented measurements, one zero target
    rows = [("A", 310.0, 21.0, 23.5, 27.0, 9.1, 3.9), ("B", 0.0, 17.5, 19.0, 21.5, 6.0, 3.1),
            ("C", 8.0, 8.1, 9.0, 9.6, 2.3, 1.5), ("D", 1500.0, 55.0, 60.0, 64.0, 10.0, 7.0),
            ("E", 21.0, 13.0, 14.2, 15.9, 2.8, 1.8), ("F", 60.0, 14.0, 15.1, 17.0, 6.7, 2.4)]
    return spark.createDataFrame(rows, "Species string, Weight double, Length1 double, Length2 double, "
                                       "Length3 double, Height double, Width double")


def test_strict_drop(spark):
    df = measured_rows(spark)
    assert "Species" not in PR.strict_drop(df, "Species").columns
    with pytest.raises(ValueError):
        PR.strict_drop(df, "Nope")


def test_mape_zero_label(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.0)], "y double, p double")
    m = EV.regression_metrics(df, "y", "p", 1).first()
    assert m["n_zero_labels"] == 1
    assert m["mape"] > 1e14  # |0-1| / eps, averaged


def test_adjusted_r2_null_when_too_few_rows(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5)], "y double, p double")
    m = EV.regression_metrics(df, "y", "p", 2).first()  # n=3, p=2: n <= p+1
    assert m["r2_adj"] is None
    assert m["r2"] is not None


def test_one_row_and_constant_label(spark):
    df = spark.createDataFrame([(5.0, 4.0)], "y double, p double")
    m = EV.regression_metrics(df, "y", "p", 1).first()
    assert m["n"] == 1 and m["mse"] == 1.0 and m["r2"] is None  # SST = 0


def test_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator

    df = spark.createDataFrame([(float(i), float(i) + (i % 3) - 1) for i in range(100)], "y double, p double")
    m = EV.regression_metrics(df, "y", "p", 1).first()
    ev = RegressionEvaluator(labelCol="y", predictionCol="p")
    assert math.isclose(m["rmse"], ev.evaluate(df, {ev.metricName: "rmse"}), rel_tol=1e-9)
    assert math.isclose(m["r2"], ev.evaluate(df, {ev.metricName: "r2"}), rel_tol=1e-9)
    assert math.isclose(m["mse"], ev.evaluate(df, {ev.metricName: "mse"}), rel_tol=1e-9)


def test_compat_rounding(spark):
    df = spark.createDataFrame([(float(i), float(i) * 1.01) for i in range(1, 50)], "y double, p double")
    a = EV.regression_metrics(df, "y", "p", 2).first()
    b = EV.regression_metrics(df, "y", "p", 2, compat_rounding=True).first()
    r2r = round(a["r2"], 2)
    assert math.isclose(b["r2_adj"], 1 - (1 - r2r) * (a["n"] - 1) / (a["n"] - 3))


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    rows = {(r["col_a"], r["col_b"]): r["r"] for r in PR.correlation(df, ["a", "b"]).collect()}
    assert rows[("a", "b")] is None and rows[("a", "a")] is None and rows[("b", "b")] == 1.0


def test_correlation_pairwise_complete(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, None), (3.0, 6.0), (None, 1.0)], "a double, b double")
    r = {(x["col_a"], x["col_b"]): x["r"] for x in PR.correlation(df, ["a", "b"]).collect()}
    assert math.isclose(r[("a", "b")], 1.0)


def test_missing_and_zero_counts(spark):
    df = measured_rows(spark)
    z = {r["column"]: r["n_zero"] for r in PR.zero_counts(df).collect()}
    assert z["Weight"] == 1 and z["Length1"] == 0
    m = {r["column"]: r["n_missing"] for r in PR.missing_counts(df).collect()}
    assert all(v == 0 for v in m.values())


def test_histogram_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    h = {r["bin"]: r["n"] for r in PR.histogram(df, ["x"], 5).collect()}
    assert sum(h.values()) == 11 and max(h) == 4  # top edge in the last bin


def test_normality_matches_numpy(spark):
    import numpy as np

    xs = [1.0, 2.0, 4.0, 9.0, 3.0, 3.5]
    r = PR.normality(spark.createDataFrame([(x,) for x in xs], "x double"), ["x"]).first()
    a = np.array(xs)
    m2 = ((a - a.mean()) ** 2).mean()
    sk = ((a - a.mean()) ** 3).mean() / m2 ** 1.5
    ku = ((a - a.mean()) ** 4).mean() / m2 ** 2 - 3
    assert math.isclose(r["skewness"], sk, rel_tol=1e-9) and math.isclose(r["kurtosis"], ku, rel_tol=1e-9)
    assert math.isclose(r["jarque_bera"], len(xs) / 6 * (sk ** 2 + ku ** 2 / 4), rel_tol=1e-9)


def test_category_eta2(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 3.0), ("b", 3.0)], "c string, y double")
    rows = PR.category_profile(df, "c", "y").collect()
    assert all(math.isclose(r["eta2"], 1.0) for r in rows)


def test_parameters_keep_their_effect():
    rf = M.random_forest({"max_depth": None, "min_samples_split": 10, "min_samples_leaf": 2, "max_features": "auto", "n_estimators": 5, "bootstrap": False}, ["a"], "y").plan
    assert (rf.settings.depth, rf.settings.split, rf.settings.leaf, rf.settings.features, rf.settings.bootstrap, rf.trees) == (None, 10, 2, 0, False, 5)
    assert M.random_forest({"max_depth": 100, "max_features": "sqrt"}, list("abcd"), "y").plan.settings.features == 2
    g = M.gbt_leafwise({"num_leaves": 250, "max_depth": 40, "reg_lambda": 3, "boosting_type": "goss"}, ["a"], "y").plan
    assert (g.settings.leaves, g.settings.depth, g.settings.lam, g.sampling) == (250, 40, 3.0, "goss")
    x = M.gbt_xgb({"max_depth": 100, "gamma": 0.08, "reg_lambda": 30, "scale_pos_weight": 4}, ["a"], "y").plan
    assert (x.settings.depth, x.settings.gamma, x.settings.lam, x.ones_weight) == (100, 0.08, 30.0, 4.0)


def _ts(m):
    return dt.datetime(2024, 1, 1, 0, m)


def test_latest_metric_and_params(spark):
    metrics = spark.createDataFrame(
        [("r1", "MAPE", 0.5, _ts(1)), ("r1", "MAPE", 0.3, _ts(2)), ("r2", "MAPE", 0.1, _ts(1))],
        "run_id string, key string, value double, ts timestamp")
    got = {r["run_id"]: r["value"] for r in TR.latest_metrics(metrics).collect()}
    assert got == {"r1": 0.3, "r2": 0.1}
    params = spark.createDataFrame(
        [("r1", "n_estimators", "200", _ts(1)), ("r1", "n_estimators", "200", _ts(2)),
         ("r1", "max_depth", "5", _ts(1)), ("r1", "max_depth", "6", _ts(3))],
        "run_id string, key string, value string, ts timestamp")
    d = {r["key"]: r for r in TR.dedup_params(params).collect()}
    assert d["n_estimators"]["n_logged"] == 2 and not d["n_estimators"]["conflict"]
    assert d["max_depth"]["value"] == "6" and d["max_depth"]["conflict"]


def test_order_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.2), ("c", 0.1)], "run_id string, m double")
    assert [r["run_id"] for r in TR.order_by_metric(df, "m").collect()] == ["c", "b", "a"]
    assert TR.best_run(df, "m").first()["run_id"] == "c"
    g = spark.createDataFrame([(1, "a", None), (1, "b", 0.5), (2, "c", None)], "e int, run_id string, m double")
    best = {r["e"]: r["run_id"] for r in TR.best_per_group(g, ["e"], "m").collect()}
    assert best == {1: "b", 2: "c"}


def _vs(spark, rows):
    return spark.createDataFrame(rows, "name string, version long, run_id string")


def _ev(spark, rows):
    return spark.createDataFrame(rows, "name string, version long, stage string, ts timestamp, seq long")


def _m(spark, rows):
    return spark.createDataFrame([(r, "MAPE", v, _ts(0)) for r, v in rows],
                                 "run_id string, key string, value double, ts timestamp")


def _events(spark, versions, events, metrics, cand_version):
    vs = RG.versions_with_stage(versions, events)
    cand = vs.filter(F.col("version") == cand_version).select("name", "version", "run_id")
    cmp = RG.compare(cand, RG.current_staging(vs, exclude=cand), metrics, "MAPE")
    return sorted((r["version"], r["stage"]) for r in RG.promotion_events(cmp).collect())


def test_bootstrap_when_no_staging(spark):
    v = _vs(spark, [("m", 1, "r1")])
    ev = _ev(spark, [("m", 0, "Archived", _ts(0), 0)])
    assert _events(spark, v, ev, _m(spark, [("r1", 0.2)]), 1) == [(1, "Staging")]


def test_tie_keeps_current_and_null_never_wins(spark):
    v = _vs(spark, [("m", 1, "r1"), ("m", 2, "r2")])
    ev = _ev(spark, [("m", 1, "Staging", _ts(1), 1)])
    assert _events(spark, v, ev, _m(spark, [("r1", 0.2), ("r2", 0.2)]), 2) == []
    assert _events(spark, v, ev, _m(spark, [("r1", 0.2)]), 2) == []
    assert _events(spark, v, ev, _m(spark, [("r1", 0.2), ("r2", 0.1)]), 2) == [(1, "Archived"), (2, "Staging")]


def test_candidate_already_staged_is_not_its_own_rival(spark):
    # the original put the candidate in Staging before comparing (compared with itself)
    v = _vs(spark, [("m", 1, "r1"), ("m", 2, "r2")])
    ev = _ev(spark, [("m", 1, "Staging", _ts(1), 1), ("m", 2, "Staging", _ts(2), 2)])
    assert _events(spark, v, ev, _m(spark, [("r1", 0.3), ("r2", 0.1)]), 2) == [(1, "Archived"), (2, "Staging")]


def test_csv_with_bom_and_staged_overwrite(spark, tmp_path):
    from keelson.sources import files as FL

    p = tmp_path / "rows.csv"
    p.write_bytes("﻿Species,Weight,Length1\nA,242,23.2\nB,0,19.0\n".encode("utf-8"))
    df = FL.read_csv(spark, str(p), "Species string, Weight double, Length1 double")
    assert df.columns == ["Species", "Weight", "Length1"]
    assert [r["Species"] for r in df.collect()] == ["A", "B"]
    inferred = FL.read_csv(spark, str(p), infer=True)
    assert inferred.columns[0] == "Species"
    out = str(tmp_path / "t")
    assert FL.current_version(spark, out) is None
    FL.overwrite_table(spark, df, out)
    cur = FL.read_version(spark, out)
    again = FL.overwrite_table(spark, cur.withColumn("Weight", F.col("Weight") + 1), out)
    assert sorted(r["Weight"] for r in again.collect()) == [1.0, 243.0]
    assert sorted(r["Weight"] for r in FL.read_version(spark, out).collect()) == [1.0, 243.0]
    assert sorted(r["Weight"] for r in cur.collect()) == [0.0, 242.0]  # a reader of the old version still has it
    # a version without its success mark does not count
    import os

    os.makedirs(f"{out}/v=99999999999999999999-half")
    assert "half" not in FL.current_version(spark, out)


def test_metrics_use_complete_rows_only(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0), (5.0, None), (None, 1.0), (9.0, nan), (nan, 2.0)], "y double, p double")
    m = EV.regression_metrics(df, "y", "p", 0).first()
    assert (m["n"], m["n_incomplete"], m["mse"], m["r2"]) == (2, 4, 1.0, 0.0)
    s = EV.residual_summary(df, "y", "p").first()
    assert s["n"] == 2 and s["mean"] == 0.0


def test_nan_is_missing_in_every_profile(spark):
    df = spark.createDataFrame([(float(i), float(i) * 2) for i in range(10)] + [(float("nan"), 1.0), (None, 2.0)], "a double, b double")
    clean = df.filter("a is not null and not isnan(a)")
    assert PR.correlation(df, ["a", "b"]).filter("col_a <> col_b").first()["r"] == pytest.approx(1.0)
    key = lambda d: sorted(map(tuple, d.filter("column = 'a'").collect()))
    assert key(PR.histogram(df, ["a"], 5)) == key(PR.histogram(clean, ["a"], 5))
    assert key(PR.normality(df, ["a"])) == key(PR.normality(clean, ["a"]))


def test_exact_holdout_with_null_and_repeated_keys(spark):
    from keelson.operators import split as SP

    nulls = spark.createDataFrame([(i if i % 2 else None, i) for i in range(50)], "a long, b long")
    out = SP.exact_holdout(nulls, ["a", "b"], 0.5)
    assert out.count() == 50 and out.filter("split = 'test'").count() == 25
    twice = spark.createDataFrame([(i // 2,) for i in range(40)], "a long")
    assert SP.exact_holdout(twice, ["a"], 0.5).filter("split = 'test'").count() == 20
    with pytest.raises(ValueError):
        SP.exact_holdout(twice, ["a"], 0.525)  # 21 rows: one of a pair
    assert SP.exact_holdout(nulls.limit(0), ["a"], 0.5).count() == 0


def test_row_numbers_of_a_null_group(spark):
    from keelson.functions.ranking import row_number_within

    df = spark.createDataFrame([(None, 3), (None, 1), ("x", 2), ("x", 5), ("y", 1), (None, 2)], "g string, v int")
    got = sorted(map(str, (tuple(r) for r in row_number_within(df, ["g"], ["v"], size="n").collect())))
    assert got == sorted(map(str, [(None, 1, 1, 3), (None, 2, 2, 3), (None, 3, 3, 3), ("x", 2, 1, 2), ("x", 5, 2, 2), ("y", 1, 1, 1)]))


def test_leafwise_trial_and_refit_settings():
    trial = M.build("lightgbm", {"n_estimators": 280, "num_leaves": 20}, ["x"], "y").plan
    refit = M.build("lightgbm", {"n_estimators": 280, "num_leaves": 20}, ["x"], "y", refit=True).plan
    assert (trial.rounds, trial.settings.leaf, trial.patience, trial.watch) == (200, 100, 200, "squared")
    assert (refit.rounds, refit.settings.leaf, refit.patience, refit.watch) == (280, 20, 100, "percentage")
    assert M.build("lightgbm", {"boosting_type": "dart"}, ["x"], "y").plan.patience == 0  # dart never stops early


def test_settings_without_effect_are_one_trial():
    from keelson.operators.search import fit_key

    a = fit_key("lightgbm", {"num_leaves": 20, "scale_pos_weight": 1, "n_estimators": 280}, ["x"], "y")
    b = fit_key("lightgbm", {"num_leaves": 20, "scale_pos_weight": 4, "n_estimators": 320}, ["x"], "y")
    c = fit_key("lightgbm", {"num_leaves": 40, "scale_pos_weight": 1, "n_estimators": 280}, ["x"], "y")
    assert a == b and a != c


def test_equal_times_are_decided_by_the_ties(spark):
    runs = spark.createDataFrame([(1,)], "run_id long")
    log = spark.createDataFrame([(1, "p", "F", 5, 2, 1), (1, "p", "O", 5, 1, 9), (1, "p", "A", 4, 9, 9)], "run_id long, key string, value string, ts long, tie1 long, tie2 long")
    metrics = spark.createDataFrame([], "run_id long, key string, value double, ts long")
    assert TR.runs_wide(runs, metrics, ["m"], params=log, param_keys=["p"]).first()["param_p"] == "F"
    assert TR.dedup_params(log).first()["value"] == "F"


def test_partition_sizing(spark):
    from keelson.session import input_bytes, size_partitions

    b = input_bytes(spark, ["/root/testdata/sf0.001/lineitem.parquet"])
    assert b > 0
    cores = spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_partitions(spark, b) == 2 * cores
        assert size_partitions(spark, 100 * (1 << 40)) == 100 * (1 << 40) // (128 << 20)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_grid_over_configured_space(spark):
    from keelson.config import RANDOM_FOREST_TEMPLATE_SPACE
    from keelson.operators import search as SR

    sp = SR.space_table(spark, "random_forest", RANDOM_FOREST_TEMPLATE_SPACE)
    g = SR.grid(sp, "random_forest")
    sizes = [len(v[1]) for v in RANDOM_FOREST_TEMPLATE_SPACE.values()]
    assert g.count() == math.prod(sizes)
    assert g.select("grid_id").distinct().count() == math.prod(sizes)
    assert g.filter(F.col("max_depth").isNull()).count() == math.prod(sizes) // 6  # the None choice


def test_random_draws_wide_and_dedupe(spark):
    from keelson.operators import search as SR

    space = {"a": ("choice", [1, 2]), "b": ("choice", ["x"]), "u": ("uniform", 0.0, 1.0)}
    sp = SR.space_table(spark, "f", space)
    long = SR.random_candidates(sp, "f", 50, seed=7)
    wide = SR.to_wide(long, ["a", "b", "u"])
    assert wide.count() == 50
    us = [float(r["u"]) for r in wide.collect()]
    assert all(0.0 <= u < 1.0 for u in us)
    ded = SR.dedupe_candidates(wide.drop("u"), ["a", "b"])
    assert ded.count() == 2  # two distinct configurations without the uniform parameter


def test_residual_summary(spark):
    import numpy as np

    df = spark.createDataFrame([(float(i), float(i) + (i % 5) - 2) for i in range(1000)], "y double, p double")
    r = EV.residual_summary(df, "y", "p").first()
    res = np.array([(i % 5) - 2 for i in range(1000)], dtype=float)
    assert math.isclose(r["mean"], res.mean(), abs_tol=1e-12)
    assert r["p05"] == -2.0 and r["p50"] == 0.0 and r["p95"] == 2.0


def test_next_versions_after_existing(spark):
    existing = spark.createDataFrame([("m", 1, "r0", None, _ts(0)), ("m", 2, "r1", None, _ts(1))], RG.VERSIONS)
    new = spark.createDataFrame([("m", "r3", None, _ts(5)), ("m", "r2", None, _ts(3)), ("n", "q", None, _ts(2))],
                                "name string, run_id string, source_uri string, created_at timestamp")
    got = sorted((r["name"], r["version"], r["run_id"]) for r in RG.next_versions(existing, new).collect())
    assert got == [("m", 3, "r2"), ("m", 4, "r3"), ("n", 1, "q")]


def test_wide_profiles_chunk(spark):
    # 40 columns: more aggregate buffer fields than one codegen'd aggregate holds
    cols = [f"c{i}" for i in range(40)]
    rows = [tuple(float((r * (i + 3)) % 7) for i in range(40)) for r in range(30)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    assert PR.normality(df, cols).count() == 40
    z = {r["column"]: r["n_zero"] for r in PR.zero_counts(df, cols).collect()}
    assert z["c0"] == sum(1 for r in rows if r[0] == 0)
    assert PR.missing_counts(df, cols).count() == 40


def test_quantiles_against_sorting(spark):
    import random

    from keelson.functions.quantiles import quantile_edges

    rng = random.Random(3)
    cols = {"a": [rng.choice([0.0, -0.0, 1.5, -2.0, 1e300, -1e-300]) for _ in range(600)], "b": [rng.gauss(0, 1) * 10 ** rng.randrange(-200, 200) for _ in range(600)],
            "c": [7.0] * 600, "d": [None] * 600, "e": [rng.choice([float("nan"), None, 3.0, 4.0]) for _ in range(600)], "f": [float(i) for i in range(600)]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols))
    shares = [0.0, 0.001, 0.1, 0.25, 0.5, 0.9, 1.0]
    for part in (df.repartition(5), df.coalesce(1)):
        for name, got in zip(cols, quantile_edges(part, list(cols), shares)):
            v = sorted(x for x in cols[name] if x is not None and not math.isnan(x))
            assert got == ([v[max(1, math.ceil(q * len(v) - 1e-9)) - 1] for q in shares] if v else [None] * len(shares)), name
    near = quantile_edges(df, list(cols), shares, error=0.02)
    assert near == quantile_edges(df.repartition(7), list(cols), shares, error=0.02)
    for name, got in zip(cols, near):
        v = sorted(x for x in cols[name] if x is not None and not math.isnan(x))
        for q, e in zip(shares, got) if v else ():
            assert sum(x <= e for x in v) >= q * len(v) - 1e-6 and sum(x < e for x in v) <= max(1, q * len(v)) + 0.02 * len(v)
    assert quantile_edges(df.limit(0), ["a"], [0.5]) == [[None]]


def test_range_suggestions_favour_the_good_side(spark):
    from keelson.operators import search as SR

    rows = [("f", i, abs(i / 40 - 0.8), "p", i / 40) for i in range(41)]
    long = spark.createDataFrame(rows, "family string, trial_id long, loss double, param string, value double")
    ends = spark.createDataFrame([("f", "p", 0.0, 1.0)], "family string, param string, low double, high double")
    got = [SR.suggest_ranges(long, ends, seed=s).first() for s in range(5)]
    assert all(0.6 < r["value"] <= 1.0 and r["good_density"] > r["bad_density"] for r in got) and len({r["value"] for r in got}) == 5


def test_pair_bins_by_combination_and_by_pair(spark, monkeypatch):
    df = spark.createDataFrame([(float(i % 7), float(i % 5), None if i % 3 else float(i)) for i in range(90)], "a double, b double, c double")
    got = []
    for cells in (PR.CELLS, 0):
        monkeypatch.setattr(PR, "CELLS", cells)
        got.append(sorted(map(tuple, PR.pair_bins(df, ["a", "b", "c"], 4).collect())))
    assert got[0] == got[1] and {r[:2] for r in got[0]} == {("a", "b"), ("a", "c"), ("b", "c")}
