"""Model registry as append-only tables.

  model_versions(name, version long, run_id string, source_uri, created_at)
  version_notes(name, version, description, ts)
  stage_events(name, version, stage, ts, seq long)

The current stage of a version is its latest stage event (ts, then seq);
a version with no event is in stage 'None'. Promotion is one plan over
versions, stage events and run metrics that yields the event rows, appended
in a single write.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import os
import time
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.config import STAGES
from keelson.operators.tracking import append_rows, latest_by, latest_metrics, read_appended

VERSIONS = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("run_id", T.StringType()), T.StructField("source_uri", T.StringType()),
    T.StructField("created_at", T.TimestampType())])
NOTES = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("description", T.StringType()), T.StructField("ts", T.TimestampType())])
EVENTS = T.StructType([
    T.StructField("name", T.StringType()), T.StructField("version", T.LongType()),
    T.StructField("stage", T.StringType()), T.StructField("ts", T.TimestampType()),
    T.StructField("seq", T.LongType())])


#: seconds after which a claimed version without a row is taken for left behind
UNFINISHED = 60

# --- query operators ----------------------------------------------------------

def current_stage(events: DataFrame) -> DataFrame:
    """(name, version, stage): latest event per version (partial aggregate)."""
    return latest_by(events, ["name", "version"], ["ts", "seq"], ["stage"])


def versions_with_stage(versions: DataFrame, events: DataFrame) -> DataFrame:
    """I4: every version with its current stage ('None' without events)."""
    cs = current_stage(events)
    return (versions.join(cs, ["name", "version"], "left")
            .withColumn("stage", F.coalesce("stage", F.lit("None"))))


def current_staging(vs: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Per name the highest version now in Staging, optionally ignoring
    the versions in ``exclude`` (name, version) — the candidate (Q6/Q7)."""
    staged = vs.filter(F.col("stage") == "Staging")
    if exclude is not None:
        staged = staged.join(exclude.select("name", "version"), ["name", "version"], "left_anti")
    return latest_by(staged, ["name"], ["version"], ["version", "run_id"]) \
        .withColumnRenamed("version", "cur_version").withColumnRenamed("run_id", "cur_run_id")


def compare(candidates: DataFrame, current: DataFrame, metrics: DataFrame, key: str,
            ties: Sequence[str] = ()) -> DataFrame:
    """Candidate versus current per name on metric ``key``; the
    candidate wins only when strictly smaller; a NULL metric never wins.

    ``candidates``: (name, version, run_id); ``current`` from
    :func:`current_staging`."""
    lm = latest_metrics(metrics.filter(F.col("key") == key), ties).select("run_id", "value")
    cand = (candidates.select("name", F.col("version").alias("cand_version"), F.col("run_id").alias("cand_run_id"))
            .join(lm.withColumnRenamed("run_id", "cand_run_id").withColumnRenamed("value", "cand_metric"),
                  "cand_run_id", "left"))
    cur = current.join(lm.withColumnRenamed("run_id", "cur_run_id").withColumnRenamed("value", "cur_metric"),
                       "cur_run_id", "left")
    out = cand.join(cur, "name", "left")
    wins = (F.col("cur_version").isNotNull() & F.col("cand_metric").isNotNull()
            & (F.col("cur_metric").isNull() | (F.col("cand_metric") < F.col("cur_metric"))))
    return out.select("name", "cand_version", "cand_metric", "cur_version", "cur_metric",
                      F.coalesce(wins, F.lit(False)).alias("promote"),
                      F.col("cur_version").isNull().alias("bootstrap"))


def promotion_events(cmp: DataFrame) -> DataFrame:
    """I7 + I8: 0, 1 or 2 event rows per name — (name, version, stage, ord).

    No current Staging → the candidate becomes Staging (bootstrap).
    Candidate wins → candidate to Staging, old version to Archived."""
    boot, win = F.col("bootstrap"), F.col("promote")
    both = F.array(
        F.struct(F.col("cand_version").alias("version"), F.lit("Staging").alias("stage"),
                 F.lit(0).alias("ord"), (boot | win).alias("active")),
        F.struct(F.col("cur_version").alias("version"), F.lit("Archived").alias("stage"),
                 F.lit(1).alias("ord"), (win & ~boot).alias("active")))
    return (cmp.select("name", F.explode(both).alias("e")).filter(F.col("e.active"))
            .select("name", F.col("e.version").cast("long").alias("version"), F.col("e.stage").alias("stage"),
                    F.col("e.ord").alias("ord")))


def next_versions(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Number new registrations per name after the existing maximum.

    ``new``: (name, run_id, source_uri, created_at), one row per model to
    register; numbered by created_at then run_id."""
    from keelson.functions.ranking import row_number_within

    base = existing.groupBy("name").agg(F.max("version").alias("__base"))
    numbered = row_number_within(new, ["name"], ["created_at", "run_id"], out="__rn")
    base = base.withColumnRenamed("name", "__name")
    return (numbered.join(base, F.col("name").eqNullSafe(F.col("__name")), "left")
            .select("name", (F.coalesce("__base", F.lit(0)) + F.col("__rn")).alias("version"),
                    "run_id", "source_uri", "created_at"))


# --- store ---------------------------------------------------------------------

class StaleState(RuntimeError):
    """The stages of a model changed between reading and writing them."""


def claim(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file if it is absent, as one step of the file system; False if
    it is there already. On local disks that is the exclusive open; elsewhere
    the file system's create without overwriting."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if fs.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x") as f:
                f.write(content)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(target, False)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def claims(spark: SparkSession, folder: str) -> dict[int, str]:
    """The numbers claimed in a folder, with what was written there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return {}
    found = [str(f.getPath()) for f in fs.listStatus(root) if f.getPath().getName().isdigit()]
    return {int(r["path"].rsplit("/", 1)[1]): r["value"] for r in spark.read.text(found, wholetext=True).select(
        "value", F.input_file_name().alias("path")).collect()} if found else {}


class ModelRegistry:
    """Append-only registry for any number of writers. A version number is
    claimed by creating a file of that number, which one writer alone can; the
    file holds the registration, so that a writer that ends before its row is
    appended leaves no gap: the next one appends it. A change of stages claims
    the number of the state it was decided on, and is refused (``StaleState``)
    if another change came first."""

    TABLES = {"model_versions": VERSIONS, "version_notes": NOTES, "stage_events": EVENTS}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return read_appended(self.spark, self.path(name), self.TABLES[name])

    def _append(self, name: str, df: DataFrame) -> None:
        append_rows(df, self.path(name))

    @staticmethod
    def _now():
        return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)

    def _claims(self, kind: str, name: str) -> str:
        return f"{self.root}/claims/{kind}-{hashlib.md5(name.encode()).hexdigest()}"

    def _add_versions(self, name: str, told: dict[int, str]) -> None:
        rows = []
        for version, content in told.items():
            run_id, source_uri, at = json.loads(content)
            rows.append((name, version, run_id, source_uri, dt.datetime.fromisoformat(at)))
        self._append("model_versions", self.spark.createDataFrame(rows, VERSIONS))

    def register(self, name: str, run_id: str, source_uri: str) -> int:
        """I1 for one model: the next version number of the name that no
        other writer has. Rows that a writer left unappended for a minute are appended."""
        folder = self._claims("version", name)
        told = json.dumps([run_id, source_uri, self._now().isoformat()])
        row = self.table("model_versions").filter(F.col("name") == name).agg(F.max("version"), F.collect_set("version")).first()
        version = max([row[0] or 0, *claims(self.spark, folder)]) + 1
        while not claim(self.spark, f"{folder}/{version}", told):
            version += 1
        own = {version: told}
        limit = (self._now() - dt.timedelta(seconds=UNFINISHED)).isoformat()
        own |= {v: c for v, c in claims(self.spark, folder).items() if v not in row[1] and v < version and c and json.loads(c)[2] < limit}
        self._add_versions(name, own)
        return version

    def describe(self, name: str, version: int, description: str) -> None:
        """Latest description wins."""
        self._append("version_notes", self.spark.createDataFrame(
            [(name, int(version), description, self._now())], NOTES))

    def transition(self, name: str, version: int, stage: str) -> None:
        """I3; stages other than the configured ones are refused."""
        if stage not in STAGES:
            raise ValueError(f"unknown stage {stage!r}; one of {STAGES}")
        state = self.state(name)
        while not claim(self.spark, f"{self._claims('stage', name)}/{state}", stage):
            state += 1
        self.append_events(self.spark.createDataFrame(
            [(name, int(version), stage)], "name string, version long, stage string"))

    def state(self, name: str) -> int:
        """The number of the next change of the model's stages."""
        return max(claims(self.spark, self._claims("stage", name)), default=-1) + 1

    def append_events(self, ev: DataFrame) -> None:
        seq0 = time.time_ns()
        ordered = ev.withColumn("ord", F.col("ord") if "ord" in ev.columns else F.lit(0))
        out = ordered.select("name", F.col("version").cast("long"), "stage",
                             F.lit(self._now()).alias("ts"), (F.lit(seq0) + F.col("ord")).cast("long").alias("seq"))
        self._append("stage_events", out)

    def versions(self, name: str | None = None) -> DataFrame:
        """I4 (B5 when a name is given)."""
        v = self.table("model_versions").dropDuplicates(["name", "version"])  # a row may have been appended for its writer
        if name is not None:
            v = v.filter(F.col("name") == name)
        return versions_with_stage(v, self.table("stage_events"))

    def staged(self, name: str, stage: str = "Staging"):
        """A7 lookup: (version, source_uri) of the highest version in ``stage``."""
        vs = self.versions(name).filter(F.col("stage") == stage)
        return vs.orderBy(F.col("version").desc()).select("version", "source_uri").first()

    def promote_if_better(self, name: str, candidate_version: int, metrics: DataFrame,
                          key: str = "MAPE", state: int | None = None) -> DataFrame:
        """I6–I8 in one plan, one append. Returns the events written. ``state``
        is the state the caller decided on, by default the one found here."""
        state = self.state(name) if state is None else state
        vs = self.versions(name)
        cand = vs.filter(F.col("version") == candidate_version).select("name", "version", "run_id")
        cur = current_staging(vs, exclude=cand)
        # at most two rows
        rows = promotion_events(compare(cand, cur, metrics, key)).collect()
        ev = self.spark.createDataFrame(rows, "name string, version long, stage string, ord int")
        if rows:
            if not claim(self.spark, f"{self._claims('stage', name)}/{state}", f"version {candidate_version}"):
                raise StaleState(f"the stages of {name} have changed since state {state}")
            self.append_events(ev)
        return ev
