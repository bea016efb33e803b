"""Tracked training → selection → promotion → batch scoring, end to end."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from keelson.operators.registry import ModelRegistry
from keelson.operators.tracking import TrackingStore, experiment_id_for
from keelson.plans import score as SC
from keelson.plans import select as SE
from keelson.plans import train as TN
from keelson.plans.ml_queries import CFG
from keelson.sources import tables as TB


SPACE = {"max_depth": ("choice", [4, 6, 8]), "n_estimators": ("choice", [10, 15])}


def test_train_select_promote_score(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "track"))
    registry = ModelRegistry(spark, str(tmp_path / "reg"))
    s = TN.make_splits(TB.reg(spark, SF_SMALL), CFG)
    res = TN.train_family(spark, "random_forest", s, CFG, store, "train", max_evals=3, parallelism=3, space=SPACE)
    assert res.trials == 3 and res.metrics["r2"] > 0.9

    runs = store.search_runs(experiment_id_for("train"))
    assert runs.count() == 2  # search run + refit run
    refit = runs.filter(F.col("metric_MAPE").isNotNull()).first()
    assert refit["status"] == "FINISHED" and refit["metric_Number_of_variables"] == 4
    arts = {r["path"] for r in store.table("run_artifacts").collect()}
    assert {"RandomForest_Hyperopt", "predictions", "residuals"} <= arts

    first = SE.select_and_promote(spark, store, registry, "train", "m")
    assert first.version == 1 and first.events == [(1, "Staging")]
    # same best run again: a new version that does not beat the current one
    again = SE.select_and_promote(spark, store, registry, "train", "m")
    assert again.version == 2 and again.events == []

    scored = SC.score(s.validation, registry, "m", CFG.keys)
    assert scored.count() == s.validation.count()
    assert {r["model_version"] for r in scored.select("model_version").distinct().collect()} == {1}
    # nothing finished on another day
    assert SE.best_run_of_day(store, "train", day=dt.date(2000, 1, 1)).count() == 0


def test_failed_run_is_recorded(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "track"))
    try:
        with store.start_run("e", "boom") as r:
            r.log_param("a", 1)
            raise RuntimeError("x")
    except RuntimeError:
        pass
    row = store.table("runs").first()
    assert row["status"] == "FAILED" and store.running().isEmpty()
    with store.start_run("e", "now") as r:
        assert [(x["run_id"], x["status"], x["end_time"]) for x in store.running().collect()] == [(r.run_id, "RUNNING", None)]
    assert store.running().isEmpty() and store.table("runs").count() == 2
    assert store.table("run_params").count() == 1


REGISTER = """
import sys
sys.path.insert(0, {root!r})
from keelson.session import get_session
from keelson.operators.registry import ModelRegistry
spark = get_session(app="other", master="local[1]", shuffle_partitions=2)
r = ModelRegistry(spark, {folder!r})
print("GOT", [r.register("m", "other-%d" % i, "u") for i in range(4)])
"""


def test_writers_of_two_processes_get_different_versions(spark, tmp_path):
    import subprocess
    import sys
    from concurrent.futures import ThreadPoolExecutor

    from conftest import ROOT

    folder = str(tmp_path / "r")
    other = subprocess.Popen([sys.executable, "-c", REGISTER.format(root=ROOT, folder=folder)], stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True)

    def some(k):
        registry = ModelRegistry(spark, folder)
        return [registry.register("m", f"run-{k}-{i}", "u") for i in range(5)]

    with ThreadPoolExecutor(3) as pool:
        own = [v for part in pool.map(some, range(3)) for v in part]
    told = next(line for line in other.communicate(timeout=200)[0].splitlines() if line.startswith("GOT"))
    everyone = own + eval(told[4:])
    assert sorted(everyone) == list(range(1, 20))
    rows = ModelRegistry(spark, folder).versions("m").collect()
    assert sorted(r["version"] for r in rows) == list(range(1, 20)) and len({r["run_id"] for r in rows}) == 19


def test_a_claim_left_behind_leaves_no_gap(spark, tmp_path, monkeypatch):
    from keelson.operators import registry as RG

    r = ModelRegistry(spark, str(tmp_path / "r"))
    with monkeypatch.context() as m:
        m.setattr(r, "_add_versions", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        try:
            r.register("m", "lost", "u")
        except OSError:
            pass
    assert r.register("m", "second", "u") == 2 and {x["version"] for x in r.versions("m").collect()} == {2}
    monkeypatch.setattr(RG, "UNFINISHED", -1)
    assert r.register("m", "third", "u") == 3
    assert {(x["version"], x["run_id"]) for x in r.versions("m").collect()} == {(1, "lost"), (2, "second"), (3, "third")}


def test_a_promotion_on_an_older_state_is_refused(spark, tmp_path):
    import pytest

    from keelson.operators.registry import StaleState

    r = ModelRegistry(spark, str(tmp_path / "r"))
    metrics = spark.createDataFrame([("a", "MAPE", 0.3, dt.datetime(2024, 1, 1)), ("b", "MAPE", 0.2, dt.datetime(2024, 1, 1))],
                                    "run_id string, key string, value double, ts timestamp")
    for run in ("a", "b"):
        r.register("m", run, "u")
    before = r.state("m")
    r.transition("m", 1, "Staging")
    with pytest.raises(StaleState):
        r.promote_if_better("m", 2, metrics, state=before)
    assert [(x["version"], x["stage"]) for x in r.promote_if_better("m", 2, metrics).collect()] == [(2, "Staging"), (1, "Archived")]
