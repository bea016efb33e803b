"""Queries that fit, tune, track, register and score models.

They read the regression table built from lineitem at full size, and run the
configured searches: every family's whole space, ten trials, refits without
limits of their own. Where SQL can grow a tree the twin does (first levels,
first split, predictions of the hand-set tree); otherwise a query returns facts
that have a twin: how many rows were held out and their key sum, whether the
model reaches its floor, how many trials succeeded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson import session as S
from keelson.config import MODEL_CONFIG, RANDOM_FOREST_HAND_SET, RUN_NAMES, SPACES, RunConfig, family_defaults
from keelson.functions.quantiles import quantile_edges
from keelson.operators import evaluate as EV
from keelson.operators import grow as G
from keelson.operators import models as M
from keelson.operators import search as SR
from keelson.operators.registry import ModelRegistry
from keelson.operators.tracking import TrackingStore
from keelson.plans import score as SC
from keelson.plans import select as SE
from keelson.plans import train as TN
from keelson.plans.queries import PRED_SQL, REG_SQL, sql_bucket, sql_hash32
from keelson.plans.tree_sql import first_levels_sql, predictions_sql, stump_sql
from keelson.sources import files as FL
from keelson.sources import tables as TB

CFG = RunConfig(keys=TB.LINEITEM_KEY)
TOGETHER = 5  # trials drawn and fitted side by side


def _splits(spark, sf) -> TN.Splits:
    S.prepare(spark)
    return TN.make_splits(TB.reg(spark, sf), CFG)


def _fit_metrics(spark, sf, family: str, params: dict):
    """One fit on the training part: (metrics of the held-out rows, their key
    sum, the model, its spec)."""
    s = _splits(spark, sf)
    spec = M.build(family, params, CFG.features, CFG.target, seed=CFG.seed, refit=True)
    model = M.fit(spec, s.frame)
    m = EV.regression_metrics(model.transform(s.test), CFG.target, "prediction", len(CFG.features)).first()
    keys = s.test.agg(F.sum("l_orderkey")).first()[0]
    return m, keys, model, spec


def _fit_facts(spark, sf, family: str, params: dict, floor: float) -> DataFrame:
    m, keys, model, spec = _fit_metrics(spark, sf, family, params)
    kept = model.n_trees
    row = [(family, int(m["n"]), int(keys), int(m["n_incomplete"]), m["r2"] >= floor, 0 < kept <= spec.trees if spec.boosted else kept == spec.trees,
            ",".join(f"{k}={v}" for k, v in sorted(spec.flags.items())))]
    return spark.createDataFrame(row, "family string, n_test long, test_key_sum long, n_incomplete long, reaches_floor boolean, "
                                      "trees_as_asked boolean, flags string")


TEST_SQL = (f"SELECT * FROM ({REG_SQL}) WHERE {sql_bucket(TB.LINEITEM_KEY, 'etl')} >= 200 "
            f"AND {sql_bucket(TB.LINEITEM_KEY, 'holdout')} < 200")
VALIDATION_SQL = f"SELECT * FROM ({REG_SQL}) WHERE {sql_bucket(TB.LINEITEM_KEY, 'etl')} < 200"


def _fit_sql(family: str, flags: str) -> str:
    return (f"SELECT '{family}' AS family, count(*) AS n_test, CAST(sum(l_orderkey) AS BIGINT) AS test_key_sum, "
            f"CAST(0 AS BIGINT) AS n_incomplete, true AS reaches_floor, true AS trees_as_asked, '{flags}' AS flags FROM ({TEST_SQL})")


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """A2 → C1/C2 → E2 (as configured) → E8 → F1–F5: one row of metrics."""
    m, _, model, spec = _fit_metrics(spark, sf, "random_forest", dict(RANDOM_FOREST_HAND_SET))
    row = [("random_forest", int(m["n"]), m["mse"], m["rmse"], m["r2"], m["r2_adj"], m["mape"], model.n_trees)]
    return spark.createDataFrame(row, "family string, n_test long, mse double, rmse double, r2 double, r2_adj double, "
                                      "mape double, n_trees int")


def q_fit_rf_default(spark, sf):
    """The original library's default forest (100 trees of any depth, every feature)."""
    return _fit_facts(spark, sf, "random_forest", {}, 0.99)


def q_fit_rf_fixed(spark, sf):
    """Depth 5, leaf 3, split 3, 200 trees, seed 42."""
    return _fit_facts(spark, sf, "random_forest", dict(RANDOM_FOREST_HAND_SET), 0.97)


def q_fit_extra_trees(spark, sf):
    """The configured 400 trees of depth 60."""
    return _fit_facts(spark, sf, "extra_trees", family_defaults("extra_trees"), 0.99)


def q_fit_gbt(spark, sf):
    """E5 + E7: 40 rounds of depth 4 at step 0.1, watched on the holdout."""
    params = family_defaults("xgboost") | {"max_depth": 4, "learning_rate": 0.1, "n_estimators": 40, "colsample_bytree": 1.0}
    return _fit_facts(spark, sf, "xgboost", params, 0.97)


def q_fit_gbt_leafwise(spark, sf):
    """250 leaves, one-sided sampling by gradient, 200 rounds, as configured."""
    return _fit_facts(spark, sf, "lightgbm", family_defaults("lightgbm"), 0.97)


FIRST_TREES, FIRST_LEVELS = 3, 2


def q_forest_first_levels(spark, sf):
    """Forests of the configured settings; the splits of the first
    levels of their first trees, with bootstrap weights, best cuts and random
    cuts of each node."""
    s = _splits(spark, sf)
    out = None
    for family, params in FIRST_LEVEL_FORESTS.items():
        spec = M.build(family, params | {"n_estimators": FIRST_TREES}, CFG.features, CFG.target, seed=CFG.seed)
        nodes = M.fit(spec, s.frame).nodes.filter(F.col("feature").isNotNull()).select("tree", "node", "feature", "cut", "left", "rows").filter(F.col("node") < 3)
        # a tree's nodes are numbered level by level; the root's children are 1 and 2
        names = F.array(*[F.lit(c) for c in CFG.features])
        part = nodes.select(F.lit(family).alias("family"), "tree", (F.col("node") + 1).alias("node"), names[F.col("feature")].alias("feature"),
                            F.round("cut", 6).alias("cut"), F.col("rows").alias("n_rows"))
        out = part if out is None else out.unionAll(part)
    return out


FIRST_LEVEL_FORESTS = {"random_forest": {}, "extra_trees": family_defaults("extra_trees")}
STUMPS = [(0.0, 0.01), (100.0, 0.01), (1e6, 0.01), (100.0, 1e15)]


def q_gbt_first_split(spark, sf):
    """E5: the first split of the configured booster and its leaf weights, by
    regularisation and least gain."""
    s = _splits(spark, sf)
    rows = []
    for lam, gamma in STUMPS:
        params = family_defaults("xgboost") | {"max_depth": 1, "n_estimators": 1, "reg_lambda": lam, "gamma": gamma}
        n = {r["node"]: r for r in M.fit(M.build("xgboost", params, CFG.features, CFG.target, seed=CFG.seed, refit=True), s.frame).nodes.collect()}
        split = len(n) == 3
        rows.append((lam, gamma, split, CFG.features[n[0]["feature"]] if split else None, round(n[0]["cut"], 6) if split else None, n[1]["rows"] if split else 0,
                     round(n[1]["value"], 6) if split else None, round(n[2]["value"], 6) if split else None))
    return spark.createDataFrame(rows, "reg_lambda double, gamma double, splits boolean, feature string, cut double, left_rows long, left_weight double, right_weight double")


TRAIN_SQL = (f"SELECT {', '.join(f'CAST({c} AS DOUBLE) AS x{i}' for i, c in enumerate(CFG.features))}, CAST({CFG.target} AS DOUBLE) AS y, "
             f"{sql_hash32(TB.LINEITEM_KEY, 'bag')} % {G.P} AS row_hash FROM ({REG_SQL}) WHERE {sql_bucket(TB.LINEITEM_KEY, 'etl')} >= 200 "
             f"AND {sql_bucket(TB.LINEITEM_KEY, 'holdout')} >= 200")


def _plan(family: str, params: dict):
    return M.build(family, params, CFG.features, CFG.target, seed=CFG.seed, refit=True).plan


SQL_FIRST_LEVELS = " UNION ALL ".join(f"SELECT * FROM ({first_levels_sql(TRAIN_SQL, CFG.features, CFG.seed, FIRST_TREES, FIRST_LEVELS, _plan(f, p).settings, f)})"
                                      for f, p in FIRST_LEVEL_FORESTS.items())
_XGB = _plan("xgboost", family_defaults("xgboost"))
SQL_FIRST_SPLIT = stump_sql(TRAIN_SQL, CFG.features, CFG.seed, STUMPS, _XGB.rate, _XGB.subsample, _XGB.columns, _XGB.ones_weight)

# without a bootstrap its 200 trees are one, which SQL can grow
HAND_SET_PLAIN = dict(RANDOM_FOREST_HAND_SET) | {"bootstrap": False}


def _forest(s: TN.Splits):
    """The hand-set forest on a fitting part."""
    return M.fit(M.build("random_forest", HAND_SET_PLAIN, CFG.features, CFG.target, seed=CFG.seed), s.frame)


def q_predict_batch(spark, sf):
    """Fit on training, predict every validation row."""
    s = _splits(spark, sf)
    return M.predict(_forest(s), s.validation, keep=CFG.keys).select(*CFG.keys, F.round("prediction", 3).alias("prediction"))


_KEYS = ", ".join(TB.LINEITEM_KEY)
_SCORED_SQL = f"SELECT {_KEYS}, {', '.join(f'CAST({c} AS DOUBLE) AS x{i}' for i, c in enumerate(CFG.features))} FROM ({VALIDATION_SQL})"
SQL_PREDICT_BATCH = predictions_sql(TRAIN_SQL, _SCORED_SQL, CFG.features, TB.LINEITEM_KEY, CFG.seed, _plan("random_forest", HAND_SET_PLAIN).settings)


def q_tune_rf(spark, sf):
    """The configured number of trials over the configured space, 5 side by side."""
    s = _splits(spark, sf)
    trials = SR.search(spark, "random_forest", s.frame, CFG.features, CFG.target, max_evals=MODEL_CONFIG["MAX_EVALS"], parallelism=TOGETHER, seed=CFG.seed)
    return trials.select("family", "trial_id", "status", (F.col("loss") > 0).alias("has_loss"), F.size("params").alias("n_params"))


SQL_TUNE_RF = f"""SELECT 'random_forest' AS family, range AS trial_id, 'ok' AS status, true AS has_loss,
  {len(SPACES['random_forest'])} AS n_params FROM range({MODEL_CONFIG['MAX_EVALS']})"""


def q_tune_refit(spark, sf):
    """Search, decode the best trial, refit, evaluate."""
    from keelson.config import encode_value, search_space_rows

    s = _splits(spark, sf)
    space = SPACES["xgboost"]
    trials = SR.search(spark, "xgboost", s.frame, CFG.features, CFG.target, max_evals=MODEL_CONFIG["MAX_EVALS"], parallelism=MODEL_CONFIG["MAX_EVALS"],
                       seed=CFG.seed, algo="random")
    params = SR.best_params(trials, "xgboost", search_space_rows("xgboost", space))
    _, spec, scored = SR.refit_and_score("xgboost", params, s.frame, s.test, CFG.features, CFG.target, seed=CFG.seed)
    m = EV.regression_metrics(scored, CFG.target, "prediction", len(CFG.features)).first()
    inside = {p: any(encode_value(v) == encode_value(params[p]) for v in c[1]) if c[0] == "choice" else c[1] <= params[p] <= c[2]
              for p, c in space.items()}
    rows = [("xgboost", p, inside[p], int(m["n"]), m["mape"] is not None) for p in sorted(params)]
    return spark.createDataFrame(rows, "family string, param string, in_space boolean, n_test long, has_mape boolean")


SQL_TUNE_REFIT = (f"WITH t AS (SELECT count(*) AS n FROM ({TEST_SQL})) "
                  + " UNION ALL ".join(f"SELECT 'xgboost' AS family, '{p}' AS param, true AS in_space, n AS n_test, true AS has_mape FROM t"
                                       for p in sorted(SPACES["xgboost"])))


def _store_and_registry(spark):
    root = S.work_dir(spark, "tracking")
    return TrackingStore(spark, root), ModelRegistry(spark, root + "/registry"), root


def q_score_staged(spark, sf):
    """Track a run of two families (the
    configured search of each and its refit), register the best, promote, load
    the staged model and score every validation row."""
    store, registry, root = _store_and_registry(spark)
    s = _splits(spark, sf)
    for fam in ("extra_trees", "lightgbm"):
        TN.train_family(spark, fam, s, CFG, store, "train", max_evals=MODEL_CONFIG["MAX_EVALS"], parallelism=TOGETHER)
    SE.select_and_promote(spark, store, registry, "train", CFG.model_name, CFG.comparison_metric)
    scored = SC.score(s.validation, registry, CFG.model_name, CFG.keys)
    out = root + "/scored"
    SC.write_scores(scored, out)
    return spark.read.parquet(out).select(*CFG.keys, "model_name", "model_version", F.col("prediction").isNotNull().alias("scored"))


SQL_SCORE_STAGED = (f"SELECT {_KEYS}, '{CFG.model_name}' AS model_name, CAST(1 AS BIGINT) AS model_version, true AS scored "
                    f"FROM ({VALIDATION_SQL})")


def q_roundtrip_model(spark, sf):
    """A5 + A6: log a model under a run, load it back by run, and compare
    predictions of the two objects on every test row."""
    store, _, _ = _store_and_registry(spark)
    s = _splits(spark, sf)
    model = _forest(s)
    with store.start_run("roundtrip", "RandomForest") as r:
        r.log_model(model, "RandomForest")
        run_id = r.run_id
    loaded = M.load(spark, store.artifact_uri(run_id, "RandomForest"))
    both = loaded.transform(model.transform(s.test).select(*CFG.features, F.col("prediction").alias("p1")))
    m = both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("p1") - F.col("prediction"))).alias("d")).first()
    return spark.createDataFrame([(m["n"], m["d"])], "n long, max_abs_diff double")


SQL_ROUNDTRIP_MODEL = f"SELECT count(*) AS n, CAST(0 AS DOUBLE) AS max_abs_diff FROM ({TEST_SQL})"


BIN_SHARES = [i / 16 for i in range(1, 16)]


def q_bin_edges(spark, sf):
    """Bin edges of every feature over all rows: the exact quantiles,
    and whether those of a stated rank error keep to it."""
    reg = TB.reg(spark, sf).persist()
    exact = quantile_edges(reg, CFG.features, BIN_SHARES)
    near = quantile_edges(reg.repartition(7), CFG.features, BIN_SHARES, error=0.002)
    ranks = reg.agg(*[F.count_if(F.col(c) <= v).alias(f"r{i}_{j}") for i, c in enumerate(CFG.features) for j, v in enumerate(near[i])],
                    *[F.count_if(F.col(c) < v).alias(f"b{i}_{j}") for i, c in enumerate(CFG.features) for j, v in enumerate(near[i])], F.count(F.lit(1)).alias("n")).first()
    reg.unpersist()
    rows = []
    for i, c in enumerate(CFG.features):
        for j, share in enumerate(BIN_SHARES):
            rank = share * ranks["n"]
            rows.append((c, j + 1, exact[i][j], ranks[f"r{i}_{j}"] >= rank and ranks[f"b{i}_{j}"] <= rank + 0.002 * ranks["n"]))
    return spark.createDataFrame(rows, "feature string, at int, edge double, keeps_to_error boolean")


SQL_BIN_EDGES = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({j} AS INTEGER) AS at, CAST(quantile_disc({c}, {share!r}) AS DOUBLE) AS edge, true AS keeps_to_error FROM ({REG_SQL})"
    for c in CFG.features for j, share in enumerate(BIN_SHARES, 1))


def q_run_artifacts(spark, sf):
    """A run that logs its predictions and residuals as files; what
    the run's artifact rows lead to, read back."""
    store, _, _ = _store_and_registry(spark)
    s = _splits(spark, sf)
    scored = _forest(s).transform(s.test)
    with store.start_run("files", "RandomForest") as r:
        TN.log_scored(r, scored, CFG)
        run_id = r.run_id
    out = None
    for name, fmt in (("predictions", "csv"), ("residuals", "parquet")):
        uri = store.artifact_uri(run_id, name)
        value = "prediction" if name == "predictions" else "residual"
        files = FL.read_csv(spark, uri, ", ".join(f"{k} long" for k in CFG.keys) + ", prediction double") if fmt == "csv" else spark.read.parquet(uri)
        logged = store.table("run_artifacts").filter((F.col("run_id") == run_id) & (F.col("path") == name)).count()
        part = files.agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum"), F.round(F.sum(value), 1).alias("total")).select(
            F.lit(name).alias("path"), F.lit(logged).cast("long").alias("n_logged"), "n", "key_sum", "total")
        out = part if out is None else out.unionAll(part)
    return out


_TEST_X = f"SELECT {_KEYS}, {', '.join(f'CAST({c} AS DOUBLE) AS x{i}' for i, c in enumerate(CFG.features))}, CAST({CFG.target} AS DOUBLE) AS y FROM ({TEST_SQL})"
_SAID = predictions_sql(TRAIN_SQL, _TEST_X, CFG.features, [*TB.LINEITEM_KEY, "y", "value"], CFG.seed, _plan("random_forest", HAND_SET_PLAIN).settings)
SQL_RUN_ARTIFACTS = (f"WITH said AS ({_SAID}) SELECT 'predictions' AS path, CAST(1 AS BIGINT) AS n_logged, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, "
                     "round(sum(value), 1) AS total FROM said UNION ALL SELECT 'residuals', CAST(1 AS BIGINT), count(*), CAST(sum(l_orderkey) AS BIGINT), "
                     "round(sum(value - y), 1) FROM said")


def q_csv_roundtrip(spark, sf):
    """A1 + A4: write the scored table as CSV with a header, read it back
    with an explicit schema (no inference pass)."""
    path = S.work_dir(spark, "csv")
    FL.write_predictions_csv(TB.pred(spark, sf), CFG.keys, path)
    schema = "l_orderkey long, l_linenumber int, ship_epoch long, l_partkey long, l_suppkey long, prediction double"
    return FL.read_csv(spark, path, schema)


SQL_CSV_ROUNDTRIP = f"SELECT {_KEYS}, prediction FROM ({PRED_SQL})"


def q_table_overwrite(spark, sf):
    """A3: replace a saved table with a new version computed from itself."""
    from keelson.operators.profile import strict_drop

    path = S.work_dir(spark, "tables") + "/cleaned"
    cleaned = strict_drop(TB.reg(spark, sf), "l_returnflag", "l_linestatus")
    current = FL.overwrite_table(spark, cleaned, path)
    return FL.overwrite_table(spark, current.withColumn("l_quantity", F.col("l_quantity") + 1), path)


SQL_TABLE_OVERWRITE = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_epoch, l_quantity + 1 AS l_quantity,
  l_extendedprice, l_discount, l_tax, charge FROM ({REG_SQL})"""


def q_etl_tables(spark, sf):
    """A2 + A3 by name: the cleaned, training and validation tables are saved
    under names, read back by name, and counted."""
    import uuid

    db = f"keelson_etl_{uuid.uuid4().hex[:12]}"
    TN.save_etl_tables(spark, TB.reg(spark, sf), CFG, db, drop=("l_returnflag", "l_linestatus"))
    out = None
    for name in ("cleaned", "training", "validation"):
        t = FL.read_table(spark, f"{db}.{name}")
        part = t.agg(F.count(F.lit(1)).alias("n"), F.sum("l_orderkey").alias("key_sum")).select(
            F.lit(name).alias("name"), F.lit(len(t.columns)).alias("n_columns"), "n", "key_sum")
        out = part if out is None else out.unionByName(part)
    return out


SQL_ETL_TABLES = (f"WITH r AS (SELECT l_orderkey, {sql_bucket(TB.LINEITEM_KEY, 'etl')} AS b FROM ({REG_SQL})) "
                  + " UNION ALL ".join(f"SELECT '{n}' AS name, 10 AS n_columns, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum "
                                       f"FROM r WHERE {c}" for n, c in (("cleaned", "true"), ("training", "b >= 200"), ("validation", "b < 200"))))


def q_train_all(spark, sf):
    """All four families with their configured searches, tracked and ranked."""
    store, _, _ = _store_and_registry(spark)
    S.prepare(spark)
    res, _ = TN.train_all(spark, TB.reg(spark, sf), CFG, store, "train", parallelism=TOGETHER)
    board = TN.leaderboard(res.drop("seconds", "phases"))
    logged = store.table("runs").filter("status = 'FINISHED'").groupBy("run_name").agg(F.count(F.lit(1)).alias("n_runs"))
    names = F.create_map(*[F.lit(x) for kv in RUN_NAMES.items() for x in kv])
    # the ranks are those of the metric, whichever family wins
    return board.withColumn("run_name", names[F.col("family")]).join(logged, "run_name").select(
        "family", "run_name", "n_test", "n_trials", "n_runs", (F.col("r2") > 0.95).alias("reaches_floor"),
        F.sum("rank").over(TN.everything()).alias("rank_sum"))


SQL_TRAIN_ALL = (f"WITH t AS (SELECT count(*) AS n FROM ({TEST_SQL})) "
                 + " UNION ALL ".join(f"SELECT '{f}' AS family, '{r}' AS run_name, n AS n_test, CAST({MODEL_CONFIG['MAX_EVALS']} AS BIGINT) AS n_trials, "
                                      "CAST(2 AS BIGINT) AS n_runs, true AS reaches_floor, CAST(10 AS BIGINT) AS rank_sum FROM t"
                                      for f, r in RUN_NAMES.items()))

ML_QUERIES = {
    "fit_rf_default": (q_fit_rf_default, _fit_sql("random_forest", "")),
    "fit_rf_fixed": (q_fit_rf_fixed, _fit_sql("random_forest", "")),
    "fit_extra_trees": (q_fit_extra_trees, _fit_sql("extra_trees", "")),
    "fit_gbt": (q_fit_gbt, _fit_sql("xgboost", "")),
    "fit_gbt_leafwise": (q_fit_gbt_leafwise, _fit_sql("lightgbm", "scale_pos_weight=no effect")),
    "forest_first_levels": (q_forest_first_levels, SQL_FIRST_LEVELS),
    "gbt_first_split": (q_gbt_first_split, SQL_FIRST_SPLIT),
    "bin_edges": (q_bin_edges, SQL_BIN_EDGES),
    "run_artifacts": (q_run_artifacts, SQL_RUN_ARTIFACTS),
    "predict_batch": (q_predict_batch, SQL_PREDICT_BATCH),
    "tune_rf": (q_tune_rf, SQL_TUNE_RF),
    "tune_refit": (q_tune_refit, SQL_TUNE_REFIT),
    "score_staged": (q_score_staged, SQL_SCORE_STAGED),
    "roundtrip_model": (q_roundtrip_model, SQL_ROUNDTRIP_MODEL),
    "csv_roundtrip": (q_csv_roundtrip, SQL_CSV_ROUNDTRIP),
    "table_overwrite": (q_table_overwrite, SQL_TABLE_OVERWRITE),
    "etl_tables": (q_etl_tables, SQL_ETL_TABLES),
    "train_all": (q_train_all, SQL_TRAIN_ALL),
}
