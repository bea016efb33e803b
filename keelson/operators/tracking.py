"""Run tracking kept as append-only Spark tables.

Tables (Parquet folders under one shared root):
  experiments(experiment_id long, name string, created_at timestamp)
  runs(run_id string, experiment_id long, run_name string, status string,
       start_time timestamp, end_time timestamp)
  run_params(run_id, key, value string, ts timestamp)
  run_metrics(run_id, key, value double, ts timestamp, step long)
  run_artifacts(run_id, path, uri, ts timestamp)

Writers only append; readers resolve "latest wins" with partial aggregates
(``max(struct(ts, …, value))``), which pre-aggregate before the shuffle and
so stay balanced when one run or key dominates. The query functions take
DataFrames, so they serve the store and any table of the same shape.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.config import METRIC_KEYS

EXPERIMENTS = T.StructType([
    T.StructField("experiment_id", T.LongType()), T.StructField("name", T.StringType()),
    T.StructField("created_at", T.TimestampType())])
RUNS = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("experiment_id", T.LongType()),
    T.StructField("run_name", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("start_time", T.TimestampType()), T.StructField("end_time", T.TimestampType())])
PARAMS = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()), T.StructField("ts", T.TimestampType())])
METRICS = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("key", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("ts", T.TimestampType()),
    T.StructField("step", T.LongType())])
ARTIFACTS = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("path", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("ts", T.TimestampType())])


# --- query operators ----------------------------------------------------------

def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              value_cols: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the values of the row that is greatest by
    ``order`` (later ts wins, then the tie columns). A partial aggregate."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    s = F.struct(*[c.alias(f"__o{i}") for i, c in enumerate(order_cols)],
                 *[F.col(v).alias(v) for v in value_cols])
    return (df.groupBy(*keys).agg(F.max(s).alias("__s"))
            .select(*keys, *[F.col(f"__s.{v}").alias(v) for v in value_cols]))


def latest_metrics(metrics: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """H3: (run_id, key, value) — latest by ts; ties by ``ties``."""
    return latest_by(metrics, ["run_id", "key"], ["ts", *ties], ["value"])


def param_order(params: DataFrame) -> list[str]:
    """What decides which of several values of a parameter is the last."""
    return [c for c in ("ts", "tie1", "tie2") if c in params.columns]


def dedup_params(params: DataFrame) -> DataFrame:
    """H2: a key logged twice with the same value is one parameter; a key
    logged with different values is flagged (the last value is kept). One
    aggregate: one scan, one shuffle."""
    last = F.max(F.struct(*[F.col(c) for c in param_order(params)], F.col("value").alias("value")))
    return (params.groupBy("run_id", "key")
            .agg(last.alias("__s"), F.count(F.lit(1)).alias("n_logged"), F.min("value").alias("__lo"), F.max("value").alias("__hi"))
            .select("run_id", "key", F.col("__s.value").alias("value"), "n_logged",
                    F.coalesce(F.col("__lo") != F.col("__hi"), F.lit(False)).alias("conflict")))


def runs_wide(runs: DataFrame, metrics: DataFrame, metric_keys: Sequence[str] = METRIC_KEYS,
              ties: Sequence[str] = (), params: DataFrame | None = None,
              param_keys: Sequence[str] = (), selective: bool = False) -> DataFrame:
    """H6: one row per run with ``metric_<key>`` (and ``param_<key>``)
    columns. The pivot has explicit values: one conditional aggregate per
    key, no extra pass to discover keys.

    ``selective=True`` when ``runs`` is a small, filtered set (one day, one
    experiment): the metric log is first semi-joined to those run ids, so
    only their rows are aggregated (the planner broadcasts the id list when
    its measured size allows, otherwise it shuffles)."""
    if selective:
        ids = runs.select("run_id")
        metrics = metrics.join(ids, "run_id", "left_semi")
        if params is not None:
            params = params.join(ids, "run_id", "left_semi")
    # latest-wins and the pivot in one aggregate keyed by run: per metric key,
    # the greatest (ts, ties…, value) among that key's rows (one shuffle)
    order = [F.col("ts"), *[F.col(t) for t in ties]]
    latest = [F.max(F.when(F.col("key") == k, F.struct(*order, F.col("value").alias("value")))).alias(f"__m{i}")
              for i, k in enumerate(metric_keys)]
    wide = (metrics.filter(F.col("key").isin(list(metric_keys))).groupBy("run_id").agg(*latest)
            .select("run_id", *[F.col(f"__m{i}.value").alias(f"metric_{k}") for i, k in enumerate(metric_keys)]))
    out = runs.join(wide, "run_id", "left")
    if params is not None and param_keys:
        lp = latest_by(params.filter(F.col("key").isin(list(param_keys))), ["run_id", "key"], param_order(params), ["value"])
        pw = lp.groupBy("run_id").pivot("key", list(param_keys)).agg(F.max("value"))
        out = out.join(pw.select("run_id", *[F.col(k).alias(f"param_{k}") for k in param_keys]), "run_id", "left")
    return out


def order_by_metric(df: DataFrame, metric_col: str, key: str = "run_id") -> DataFrame:
    """H7: best (smallest) first, runs without the metric last."""
    return df.orderBy(F.col(metric_col).asc_nulls_last(), F.col(key).asc())


def finished(df: DataFrame) -> DataFrame:
    """B3."""
    return df.filter(F.col("status") == "FINISHED")


def on_day(df: DataFrame, day: str | dt.date, col: str = "end_time") -> DataFrame:
    """``col`` within one UTC day, as a range (prunable, pushable)."""
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    start = dt.datetime(d.year, d.month, d.day)
    end = start + dt.timedelta(days=1)
    # Literals of the column's own type, so no cast wraps the column and the
    # range reaches the Parquet reader as pushed filters.
    ctype = dict(df.dtypes)[col]
    lo = F.lit(start.isoformat(" ")).cast(ctype)
    hi = F.lit(end.isoformat(" ")).cast(ctype)
    c = F.col(col)
    return df.filter((c >= lo) & (c < hi))


def best_run(df: DataFrame, metric_col: str, key: str = "run_id") -> DataFrame:
    """H9: top-1 by metric (nulls last), ties by key: TakeOrderedAndProject."""
    return order_by_metric(df, metric_col, key).limit(1)


def best_per_group(df: DataFrame, group: Sequence[str], metric_col: str, key: str = "run_id",
                   value_cols: Sequence[str] = ()) -> DataFrame:
    """H9 per group as an arg-min aggregate: partial aggregation, so a group
    holding most rows is combined map-side instead of sorted in one task."""
    m = F.col(metric_col)
    s = F.struct(m.isNull().alias("__null"), m.alias(metric_col), F.col(key).alias(key),
                 *[F.col(v).alias(v) for v in value_cols])
    return (df.groupBy(*group).agg(F.min(s).alias("__s"))
            .select(*group, F.col(f"__s.{key}").alias(key), F.col(f"__s.{metric_col}").alias(metric_col),
                    *[F.col(f"__s.{v}").alias(v) for v in value_cols]))


def run_metric(runs: DataFrame, metrics: DataFrame, key: str, ties: Sequence[str] = ()) -> DataFrame:
    """The latest value of metric ``key`` of every run (NULL if none)."""
    lm = latest_metrics(metrics.filter(F.col("key") == key), ties).select(
        "run_id", F.col("value").alias(key))
    return runs.select("run_id").join(lm, "run_id", "left")


def list_experiments(experiments: DataFrame, runs: DataFrame) -> DataFrame:
    """H4: experiments with run counts (runs are aggregated before the join)."""
    counts = runs.groupBy("experiment_id").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("status") == "FINISHED").alias("n_finished"))
    return (experiments.join(counts, "experiment_id", "left")
            .select("experiment_id", "name", F.coalesce("n_runs", F.lit(0)).alias("n_runs"),
                    F.coalesce("n_finished", F.lit(0)).alias("n_finished")))


def experiment_by_name(experiments: DataFrame, name: str) -> DataFrame:
    """H5: name → experiment row."""
    return experiments.filter(F.col("name") == name)


# --- store ---------------------------------------------------------------------

def experiment_id_for(name: str) -> int:
    """Stable id from the name (no read-modify-write race between writers)."""
    import hashlib

    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def append_rows(df: DataFrame, path: str) -> None:
    """Add rows to an append-only table: one new folder for every append, so
    that writers never meet in one folder, whatever process they are in."""
    df.coalesce(1).write.parquet(f"{path}/a-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}")


def appended(spark: SparkSession, path: str) -> list[str]:
    """The complete appends to a table."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    return sorted(str(s.getPath()) for s in fs.listStatus(root) if s.getPath().getName().startswith("a-")
                  and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")))


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    folders = appended(spark, path)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


class TrackingStore:
    """Append-only run log on shared storage."""

    TABLES = {"experiments": EXPERIMENTS, "runs": RUNS, "run_starts": RUNS, "run_params": PARAMS,
              "run_metrics": METRICS, "run_artifacts": ARTIFACTS}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def table(self, name: str) -> DataFrame:
        return read_appended(self.spark, self.path(name), self.TABLES[name])

    def append(self, name: str, rows: list[tuple]) -> None:
        if rows:
            append_rows(self.spark.createDataFrame(rows, self.TABLES[name]), self.path(name))

    def running(self) -> DataFrame:
        """Runs that were started and have not ended (or whose process is gone)."""
        return self.table("run_starts").join(self.table("runs").select("run_id"), "run_id", "left_anti").select(*[f.name for f in RUNS.fields])

    def create_experiment(self, name: str) -> int:
        eid = experiment_id_for(name)
        if self.table("experiments").filter(F.col("experiment_id") == eid).limit(1).count() == 0:
            self.append("experiments", [(eid, name, dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))])
        return eid

    @contextmanager
    def start_run(self, experiment: str, run_name: str):
        """H1: a run. Its start is appended at once (see :func:`running`), its
        rows when it ends, with status FINISHED, or FAILED if the block raised."""
        eid = self.create_experiment(experiment)
        run = Run(self, uuid.uuid4().hex, eid, run_name)
        self.append("run_starts", [(run.run_id, eid, run_name, run.status, run.start_time, None)])
        try:
            yield run
            run.status = "FINISHED"
        except BaseException:
            run.status = "FAILED"
            raise
        finally:
            run.flush()

    # queries over the store
    def search_runs(self, experiment_id: int, metric_keys=METRIC_KEYS, param_keys=(),
                    runs: DataFrame | None = None) -> DataFrame:
        """H6 over the store; ``runs`` may pre-filter the experiment's runs
        (e.g. B3/B4), which then restricts the metric scan too."""
        exp_runs = self.table("runs").filter(F.col("experiment_id") == experiment_id)
        if runs is not None:
            exp_runs = runs(exp_runs) if callable(runs) else runs
        return runs_wide(exp_runs, self.table("run_metrics"), metric_keys,
                         params=self.table("run_params"), param_keys=param_keys, selective=True)

    def artifact_uri(self, run_id: str, path: str) -> str | None:
        row = (latest_by(self.table("run_artifacts").filter((F.col("run_id") == run_id) & (F.col("path") == path)),
                         ["run_id", "path"], ["ts"], ["uri"]).first())
        return None if row is None else row["uri"]


class Run:
    def __init__(self, store: TrackingStore, run_id: str, experiment_id: int, run_name: str):
        self.store = store
        self.run_id = run_id
        self.experiment_id = experiment_id
        self.run_name = run_name
        self.status = "RUNNING"
        self.start_time = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._params: list[tuple] = []
        self._metrics: list[tuple] = []
        self._artifacts: list[tuple] = []
        self._t0 = time.monotonic()

    @staticmethod
    def _now():
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def log_param(self, key: str, value) -> None:
        """H2 (string value; repeated equal keys collapse at read time)."""
        from keelson.config import encode_value

        self._params.append((self.run_id, key, encode_value(value), self._now()))

    def log_params(self, params: dict) -> None:
        for k, v in params.items():
            self.log_param(k, v)

    def log_metric(self, key: str, value: float, step: int = 0) -> None:
        """H3."""
        self._metrics.append((self.run_id, key, None if value is None else float(value), self._now(), step))

    def log_metrics_row(self, row, keys: dict) -> None:
        for col, key in keys.items():
            if row[col] is not None:
                self.log_metric(key, row[col])

    def log_artifact(self, path: str, uri: str) -> None:
        """Attach a written file or table folder to the run."""
        self._artifacts.append((self.run_id, path, uri, self._now()))

    def artifact_dir(self, name: str) -> str:
        return f"{self.store.root}/artifacts/{self.run_id}/{name}"

    def log_model(self, model, name: str) -> str:
        """A5: save a model under the run and record its location."""
        from keelson.operators import models as M

        uri = M.save(model, self.artifact_dir(name))  # unique per run: safe to write concurrently
        self.log_artifact(name, uri)
        return uri

    def flush(self) -> None:
        st = self.store
        st.append("run_params", self._params)
        st.append("run_metrics", self._metrics)
        st.append("run_artifacts", self._artifacts)
        st.append("runs", [(self.run_id, self.experiment_id, self.run_name, self.status,
                            self.start_time, self._now())])
        self._params, self._metrics, self._artifacts = [], [], []
