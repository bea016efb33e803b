"""Training pipeline (J1–J3): ETL, then per family search → refit →
evaluate → track, all on one prepared split.

Only scalars and small trial tables reach the driver; fitting, scoring and
metric aggregation are Spark jobs; every artifact is written by executors.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.config import RUN_NAMES, RunConfig
from keelson.operators import evaluate as EV
from keelson.operators import forests as FO
from keelson.operators import search as SR
from keelson.operators import split as SP
from keelson.operators.tracking import TrackingStore

METRIC_NAMES = {"rmse": "RMSE", "r2": "R2", "r2_adj": "R2_Adj", "mape": "MAPE"}


@dataclass
class Splits:
    training: DataFrame    # ETL training table (80 %)
    validation: DataFrame  # ETL validation table (20 %)
    train: DataFrame       # fitting part of training (64 % overall)
    test: DataFrame        # holdout inside training (16 % overall)
    frame: FO.Frame        # both, prepared for fits


def etl(df: DataFrame, cfg: RunConfig, drop: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean (strict drop) and split by key hash (C1): (clean, training, validation)."""
    from keelson.operators.profile import strict_drop

    clean = strict_drop(df, *drop) if drop else df
    training, validation = SP.split_pair(clean, cfg.keys, cfg.test_size, SP.ETL_SALT)
    return clean, training, validation


def save_etl_tables(spark: SparkSession, df: DataFrame, cfg: RunConfig, database: str, drop: Sequence[str] = ()) -> None:
    """A3: the cleaned table and its two parts under names in ``database``.
    One scan of the input writes the cleaned table; the parts come from it."""
    from keelson.operators.profile import strict_drop
    from keelson.sources import files as FL

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    FL.write_table(strict_drop(df, *drop) if drop else df, f"{database}.cleaned")
    training, validation = SP.split_pair(FL.read_table(spark, f"{database}.cleaned"), cfg.keys, cfg.test_size, SP.ETL_SALT)
    FL.write_table(training, f"{database}.training")
    FL.write_table(validation, f"{database}.validation")


def everything():
    """A window over a handful of rows (one per family)."""
    from pyspark.sql import Window

    return Window.partitionBy()


def make_splits(df: DataFrame, cfg: RunConfig, drop: Sequence[str] = ()) -> Splits:
    """C1 + C2 (+C4). The fitting and test rows are written once for the whole
    search (``frame``); draws are functions of the row keys, so a fit does not
    depend on how the rows are laid out."""
    cols = list(dict.fromkeys([*cfg.keys, *cfg.features, cfg.target]))
    _, training, validation = etl(df, cfg, drop)
    training = training.select(*cols)
    train, test = SP.split_pair(training, cfg.keys, cfg.test_size, SP.HOLDOUT_SALT)
    return Splits(training, validation.select(*cols), train, test, FO.prepare(train, test, cfg.features, cfg.target, cfg.keys))


@dataclass
class FamilyResult:
    family: str
    run_id: str | None
    params: dict
    metrics: dict
    trials: int
    seconds: float
    flags: dict = field(default_factory=dict)
    phases: dict = field(default_factory=dict)


def log_scored(run, scored: DataFrame, cfg: RunConfig) -> None:
    """Predictions (key and value) and residuals as files of the run."""
    uri = run.artifact_dir("predictions")
    scored.select(*cfg.keys, "prediction").write.mode("overwrite").option("header", True).csv(uri)
    run.log_artifact("predictions", uri)
    uri = run.artifact_dir("residuals")
    EV.with_residual(scored, cfg.target, "prediction").select(*cfg.keys, "residual").write.mode("overwrite").parquet(uri)
    run.log_artifact("residuals", uri)


def train_family(spark: SparkSession, family: str, s: Splits, cfg: RunConfig, store: TrackingStore | None,
                 experiment: str, max_evals: int, parallelism: int, space: dict | None = None) -> FamilyResult:
    """One family: search (its own run), then refit and evaluate (a second
    run with parameters, metrics, model and artifacts), as the original did."""
    t0 = time.monotonic()
    run_name = RUN_NAMES[family]
    seed = cfg.seed

    def _search():
        return SR.search(spark, family, s.frame, cfg.features, cfg.target, max_evals,
                         parallelism=parallelism, seed=seed, space=space)

    phases = {}
    if store is not None:
        with store.start_run(experiment, run_name) as r:
            trials = _search()
            r.log_metric("n_trials", trials.count())
    else:
        trials = _search()
    phases["search"] = time.monotonic() - t0
    from keelson.config import search_space_rows
    params = SR.best_params(trials, family, search_space_rows(family, space))
    n_trials = trials.count()

    def _refit(run=None):
        model, spec, scored = SR.refit_and_score(family, params, s.frame, s.test, cfg.features, cfg.target, seed=seed)
        scored = scored.select(*cfg.keys, cfg.target, "prediction").persist()
        m = EV.regression_metrics(scored, cfg.target, "prediction", len(cfg.features)).first().asDict()
        m["n_train"] = s.frame.n_fit
        phases["refit_eval"] = time.monotonic() - t0 - phases["search"]
        if run is not None:
            run.log_params(params)
            for k, v in spec.flags.items():
                run.log_param(f"flag.{k}", v)
            run.log_params(model.info)
            rep = EV.REPORT_DIGITS
            run.log_metric("MSE", m["mse"])
            for col, key in METRIC_NAMES.items():
                v = m[col]
                if v is not None and col in rep:
                    v = round(v, rep[col])
                run.log_metric(key, v)
            run.log_metric("Dataset_Size", m["n_train"])
            run.log_metric("Number_of_variables", len(cfg.features))
            run.log_model(model, run_name)
            log_scored(run, scored, cfg)
        scored.unpersist()
        return m, spec.flags

    run_id = None
    if store is not None:
        with store.start_run(experiment, run_name) as r:
            m, flags = _refit(r)
            run_id = r.run_id
    else:
        m, flags = _refit()
    total = time.monotonic() - t0
    phases["track"] = total - phases["search"] - phases.get("refit_eval", 0.0)
    return FamilyResult(family, run_id, params, m, n_trials, total, flags,
                        {k: round(v, 2) for k, v in phases.items()})


def train_all(spark: SparkSession, df: DataFrame, cfg: RunConfig, store: TrackingStore | None,
              experiment: str = "train", families: Sequence[str] = ("extra_trees", "xgboost", "random_forest",
                                                                     "lightgbm"),
              max_evals: int | None = None, parallelism: int | None = None, spaces: dict | None = None,
              drop: Sequence[str] = (), family_parallelism: int = 4) -> tuple[DataFrame, float]:
    """J1 + J3: every family on one cached split; results as one table
    (``unionByName`` of per-family rows) and the elapsed seconds, which is
    also logged as a metric of a pipeline run.

    ``parallelism`` trials are drawn and fitted together; ``family_parallelism``
    families are searched at once, which fills the cores that the rounds of a
    few boosters leave idle."""
    from concurrent.futures import ThreadPoolExecutor

    t0 = time.monotonic()
    s = make_splits(df, cfg, drop)

    def one(fam):
        return train_family(spark, fam, s, cfg, store, experiment, max_evals or cfg.max_evals,
                            parallelism or cfg.parallelism, (spaces or {}).get(fam))

    with ThreadPoolExecutor(max_workers=max(1, family_parallelism)) as pool:
        results = list(pool.map(one, families))
    elapsed = time.monotonic() - t0
    if store is not None:
        with store.start_run(experiment, "Pipeline") as r:
            r.log_metric("processing_seconds", elapsed)
    rows = [(r.family, r.run_id, float(r.metrics["mse"]), r.metrics["rmse"], r.metrics["r2"],
             r.metrics["r2_adj"], r.metrics["mape"], int(r.metrics["n"]), int(r.trials), float(r.seconds),
             {k: float(v) for k, v in r.phases.items()})
            for r in results]
    out = spark.createDataFrame(rows, "family string, run_id string, mse double, rmse double, r2 double, "
                                      "r2_adj double, mape double, n_test long, n_trials long, seconds double, "
                                      "phases map<string,double>")
    return out, elapsed


def leaderboard(results: DataFrame, metric: str = "mape") -> DataFrame:
    """Family results ranked by metric, runs without it last."""
    rk = F.expr(f"rank() OVER (ORDER BY {metric} ASC NULLS LAST, family)")
    return results.withColumn("rank", rk.cast("long"))
