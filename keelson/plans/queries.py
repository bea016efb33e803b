"""The query catalogue: one Spark plan per operator and, where the operator
is relational, the equivalent SQL (DuckDB dialect) over the same tables.

Every query reads whole driver tables (or data Spark derives from them).
Computed columns carry the same alias on both sides; aggregated doubles are
rounded to the same number of places on both sides, chosen so that summation
order cannot change the printed value.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson import session as S
from keelson.config import METRIC_KEYS, STAGES
from keelson.operators import evaluate as EV
from keelson.operators import profile as PR
from keelson.operators import registry as RG
from keelson.operators import search as SR
from keelson.operators import split as SP
from keelson.operators import tracking as TR
from keelson.sources import tables as TB

SparkQuery = Callable[[SparkSession, str], DataFrame]

NUMERIC = TB.FEATURES + [TB.TARGET]
KEY = TB.LINEITEM_KEY
FINISHED_DAY = "1995-01-13"
EXPERIMENT_NAME = "Customer#000000042"
HIST_BINS = 10
PAIR_BINS = 10
TVP_BINS = 20
RANDOM_DRAWS = 1000
SEARCH_PARAMS = ["p_brand", "p_name", "p_size"]
SUGGEST_PARAMS = ["p_brand", "p_size"]

# --- SQL fragments (DuckDB) ----------------------------------------------------

REG_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(epoch(l_shipdate) AS BIGINT) AS ship_epoch,
  l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
FROM lineitem"""

PRED_SQL = f"SELECT *, l_extendedprice * (1 - l_discount) AS prediction FROM ({REG_SQL})"

RUNS_SQL = """SELECT o_orderkey AS run_id, o_custkey AS experiment_id, o_orderpriority AS run_name,
  CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' WHEN 'P' THEN 'FAILED' END AS status,
  o_orderdate AS end_time, o_totalprice AS metric
FROM orders"""

METRICS_SQL = ("SELECT l_orderkey AS run_id, CASE l_linenumber "
               + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(METRIC_KEYS, start=1))
               + " END AS key, l_extendedprice AS value, CAST(epoch(l_shipdate) AS BIGINT) AS ts,"
               " l_partkey AS tie1, l_suppkey AS tie2 FROM lineitem")

LATEST_METRICS_SQL = f"""SELECT run_id, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY run_id, key ORDER BY ts DESC, tie1 DESC, tie2 DESC, value DESC) AS rn
  FROM ({METRICS_SQL})) WHERE rn = 1"""

TRIALS_SQL = """SELECT p_type AS family, p_partkey AS trial_id, p_brand, p_name, p_size,
  p_retailprice AS loss, 'ok' AS status FROM part"""

STAGES_SQL = ("SELECT event_type AS name, user_id AS version, CASE event_id % 4 "
              + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(STAGES))
              + " END AS stage, ts, event_id AS seq, props AS note FROM events")

EXPERIMENTS_SQL = "SELECT c_custkey AS experiment_id, c_name AS name FROM customer"


def sql_hash32(cols: list[str], salt: str, part: int = 0) -> str:
    parts = ", ".join([f"'{salt}'"] + [f"CAST({c} AS VARCHAR)" for c in cols])
    return f"(('0x' || substr(md5(concat_ws('|', {parts})), {1 + 8 * part}, 8))::BIGINT)"


def sql_bucket(cols: list[str], salt: str) -> str:
    return f"({sql_hash32(cols, salt)} % 1000)"


def sql_bin(x: str, lo: str, hi: str, bins: int) -> str:
    return (f"CAST(CASE WHEN {hi} = {lo} THEN 0 ELSE least(floor(({x} - {lo}) / ({hi} - {lo}) * {bins}), {bins - 1}) END"
            " AS INTEGER)")


# --- helpers -------------------------------------------------------------------

def _prep(spark: SparkSession) -> None:
    S.prepare(spark)


# --- A / B: sources, cleaning ----------------------------------------------------

def q_clean_drop_category(spark, sf):
    _prep(spark)
    return PR.strict_drop(TB.reg(spark, sf), "l_returnflag", "l_linestatus")


SQL_CLEAN_DROP_CATEGORY = f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ship_epoch,
  l_quantity, l_extendedprice, l_discount, l_tax, charge FROM ({REG_SQL})"""


# --- C: splits -----------------------------------------------------------------

def q_split_counts(spark, sf):
    _prep(spark)
    o = TB.table(spark, sf, "orders").select("o_orderkey")
    s = SP.hash_split(o, ["o_orderkey"], 0.2, SP.ETL_SALT, names=("training", "validation"))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


SQL_SPLIT_COUNTS = f"""SELECT CASE WHEN {sql_bucket(['o_orderkey'], 'etl')} < 200 THEN 'validation' ELSE 'training' END AS split,
  count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1"""


def q_split_nested(spark, sf):
    _prep(spark)
    o = TB.table(spark, sf, "orders").select("o_orderkey")
    s = SP.nested_split(o, ["o_orderkey"])
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


SQL_SPLIT_NESTED = f"""SELECT CASE WHEN {sql_bucket(['o_orderkey'], 'etl')} < 200 THEN 'validation'
  WHEN {sql_bucket(['o_orderkey'], 'holdout')} < 200 THEN 'test' ELSE 'train' END AS split,
  count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM orders GROUP BY 1"""


def q_holdout_exact(spark, sf):
    _prep(spark)
    o = TB.table(spark, sf, "orders").select("o_orderkey")
    training, _ = SP.split_pair(o, ["o_orderkey"], 0.2, SP.ETL_SALT)
    return SP.exact_holdout(training, ["o_orderkey"], 0.2, SP.HOLDOUT_SALT).select("o_orderkey", "split")


SQL_HOLDOUT_EXACT = f"""WITH t AS (
  SELECT o_orderkey, {sql_hash32(['o_orderkey'], 'holdout', 0)} AS ha, {sql_hash32(['o_orderkey'], 'holdout', 1)} AS hb
  FROM orders WHERE {sql_bucket(['o_orderkey'], 'etl')} >= 200),
r AS (SELECT o_orderkey, row_number() OVER (ORDER BY ha, hb, o_orderkey) AS rn, count(*) OVER () AS n FROM t)
SELECT o_orderkey, CASE WHEN rn <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r"""


def q_score_holdout(spark, sf):
    _prep(spark)
    o = TB.table(spark, sf, "orders").select("o_orderkey")
    return SP.hash_split(o, ["o_orderkey"], 0.3, SP.SCORE_SALT, names=("rest", "holdout"))


SQL_SCORE_HOLDOUT = f"""SELECT o_orderkey,
  CASE WHEN {sql_bucket(['o_orderkey'], 'score')} < 300 THEN 'holdout' ELSE 'rest' END AS split FROM orders"""


# --- D: profiling ----------------------------------------------------------------

def q_profile_preview(spark, sf):
    _prep(spark)
    return PR.preview(TB.reg(spark, sf), KEY, 10)


SQL_PROFILE_PREVIEW = f"""SELECT * FROM ({REG_SQL})
ORDER BY l_orderkey, l_linenumber, ship_epoch, l_partkey, l_suppkey LIMIT 10"""

LINEITEM_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LINEITEM_DOUBLES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"] + LINEITEM_DOUBLES


def q_profile_missing(spark, sf):
    _prep(spark)
    out = PR.missing_counts(TB.table(spark, sf, "lineitem"), LINEITEM_COLS)
    return out.withColumnRenamed("column", "col_name")


SQL_PROFILE_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c in LINEITEM_DOUBLES else "") + ") AS n_missing, count(*) AS n_rows FROM lineitem"
    for c in LINEITEM_COLS)


def q_profile_zero(spark, sf):
    _prep(spark)
    return PR.zero_counts(TB.table(spark, sf, "lineitem"), LINEITEM_NUMERIC).withColumnRenamed("column", "col_name")


SQL_PROFILE_ZERO = " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count(*) FILTER (WHERE {c} = 0) AS n_zero FROM lineitem" for c in LINEITEM_NUMERIC)


def q_profile_hist(spark, sf):
    _prep(spark)
    return PR.histogram(TB.reg(spark, sf), NUMERIC, HIST_BINS).withColumnRenamed("column", "col_name")


_MM = ", ".join(f"min({c}) AS mn_{c}, max({c}) AS mx_{c}" for c in NUMERIC)
SQL_PROFILE_HIST = (f"WITH reg AS ({REG_SQL}), mm AS (SELECT {_MM} FROM reg) "
                    + " UNION ALL ".join(
                        f"SELECT '{c}' AS col_name, {sql_bin(c, f'mn_{c}', f'mx_{c}', HIST_BINS)} AS bin, count(*) AS n "
                        f"FROM reg, mm WHERE {c} IS NOT NULL GROUP BY 2" for c in NUMERIC))


def q_profile_pair_bins(spark, sf):
    _prep(spark)
    return PR.pair_bins(TB.reg(spark, sf), NUMERIC, PAIR_BINS)


SQL_PROFILE_PAIR_BINS = (f"WITH reg AS ({REG_SQL}), mm AS (SELECT {_MM} FROM reg) "
                         + " UNION ALL ".join(
                             f"SELECT '{a}' AS x_col, '{b}' AS y_col, {sql_bin(a, f'mn_{a}', f'mx_{a}', PAIR_BINS)} AS x_bin, "
                             f"{sql_bin(b, f'mn_{b}', f'mx_{b}', PAIR_BINS)} AS y_bin, count(*) AS n "
                             f"FROM reg, mm WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 3, 4"
                             for a, b in combinations(NUMERIC, 2)))


def q_profile_corr(spark, sf):
    _prep(spark)
    return PR.correlation(TB.reg(spark, sf), NUMERIC).withColumn("r", F.round("r", 6))


def _sql_r(a, b):
    return f"covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0)"


SQL_PROFILE_CORR = (f"WITH reg AS ({REG_SQL}) "
                    + " UNION ALL ".join(
                        f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                        + ("CASE WHEN stddev_pop(" + a + ") > 0 THEN 1.0::DOUBLE END" if a == b
                           else f"round({_sql_r(a, b)}, 6)")
                        + " AS r FROM reg"
                        for a in NUMERIC for b in NUMERIC))


def q_profile_target_corr(spark, sf):
    _prep(spark)
    out = PR.target_correlation(TB.reg(spark, sf), TB.TARGET, TB.FEATURES)
    return out.select(F.col("column").alias("col_name"), F.round("r", 6).alias("r"),
                      F.round("abs_r", 6).alias("abs_r"), F.col("rank").cast("long").alias("rank"))


SQL_PROFILE_TARGET_CORR = (f"WITH reg AS ({REG_SQL}), c AS ("
                           + " UNION ALL ".join(f"SELECT '{c}' AS col_name, {_sql_r(c, 'charge')} AS r FROM reg"
                                                for c in TB.FEATURES)
                           + ") SELECT col_name, round(r, 6) AS r, round(abs(r), 6) AS abs_r, "
                             "CAST(rank() OVER (ORDER BY abs(r) DESC NULLS LAST, col_name) AS BIGINT) AS rank FROM c")


def q_profile_normality(spark, sf):
    _prep(spark)
    out = PR.normality(TB.reg(spark, sf), NUMERIC)
    return out.select(F.col("column").alias("col_name"), "n", F.round("mean", 4).alias("mean"),
                      F.round("stddev", 4).alias("stddev"), F.round("skewness", 6).alias("skewness"),
                      F.round("kurtosis", 6).alias("kurtosis"), F.round("jarque_bera", 3).alias("jarque_bera"))


SQL_PROFILE_NORMALITY = (f"WITH reg AS ({REG_SQL}), mu AS (SELECT "
                         + ", ".join(f"avg({c}) AS mu_{c}, count({c}) AS n_{c}" for c in NUMERIC)
                         + " FROM reg), mom AS (SELECT "
                         + ", ".join(f"avg(power({c} - mu_{c}, 2)) AS m2_{c}, avg(power({c} - mu_{c}, 3)) AS m3_{c}, "
                                     f"avg(power({c} - mu_{c}, 4)) AS m4_{c}" for c in NUMERIC)
                         + " FROM reg, mu), s AS ("
                         + " UNION ALL ".join(
                             f"SELECT '{c}' AS col_name, n_{c} AS n, mu_{c} AS mean, sqrt(m2_{c}) AS sd, "
                             f"m3_{c} / power(m2_{c}, 1.5) AS sk, m4_{c} / (m2_{c} * m2_{c}) - 3 AS ku FROM mu, mom"
                             for c in NUMERIC)
                         + ") SELECT col_name, n, round(mean, 4) AS mean, round(sd, 4) AS stddev, "
                           "round(sk, 6) AS skewness, round(ku, 6) AS kurtosis, "
                           "round(n / 6 * (sk * sk + ku * ku / 4), 3) AS jarque_bera FROM s")


def q_profile_category(spark, sf):
    _prep(spark)
    out = PR.category_profile(TB.reg(spark, sf), TB.CATEGORY, TB.TARGET)
    return out.select("l_returnflag", "n", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
                      F.round("eta2", 8).alias("eta2"))


SQL_PROFILE_CATEGORY = f"""WITH reg AS ({REG_SQL}),
g AS (SELECT l_returnflag, count(charge) AS n, avg(charge) AS mean, stddev_pop(charge) AS sd,
             var_pop(charge) * count(charge) AS ssw FROM reg GROUP BY l_returnflag),
t AS (SELECT var_pop(charge) * count(charge) AS sst FROM reg),
w AS (SELECT sum(ssw) AS ssw_total FROM g)
SELECT l_returnflag, n, round(mean, 4) AS mean, round(sd, 4) AS stddev,
       round(1 - ssw_total / nullif(sst, 0), 8) AS eta2 FROM g, t, w"""


def q_profile_shape(spark, sf):
    _prep(spark)
    return PR.shape(TB.reg(spark, sf), TB.FEATURES)


SQL_PROFILE_SHAPE = f"SELECT count(*) AS n_rows, {len(TB.FEATURES)} AS n_features FROM ({REG_SQL})"


# --- F: evaluation ---------------------------------------------------------------

METRIC_DIGITS = {"mse": 3, "rmse": 4, "r2": 8, "r2_adj": 8, "mape": 8}


def _sql_metrics(group: str | None, src: str) -> str:
    g = f"{group}, " if group else ""
    gb = f" GROUP BY {group}" if group else ""
    p = len(TB.FEATURES)
    return f"""WITH src AS ({src}), c AS (SELECT {g}CASE WHEN prediction IS NOT NULL THEN charge END AS y,
  CASE WHEN charge IS NOT NULL THEN prediction END AS p FROM src),
a AS (SELECT {g}count(y) AS n, sum(power(y - p, 2)) AS sse, var_pop(y) * count(y) AS sst,
  avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) AS mape_raw,
  count(*) FILTER (WHERE y = 0) AS n_zero_labels, count(*) - count(y) AS n_incomplete FROM c{gb})
SELECT {g}n, round(sse / n, 3) AS mse, round(sqrt(sse / n), 4) AS rmse, round(1 - sse / nullif(sst, 0), 8) AS r2,
  round(CASE WHEN n > {p} + 1 THEN 1 - (1 - (1 - sse / nullif(sst, 0))) * (n - 1) / (n - {p} - 1) END, 8) AS r2_adj,
  round(mape_raw, 8) AS mape, n_zero_labels, n_incomplete FROM a"""


def q_eval_metrics(spark, sf):
    _prep(spark)
    return EV.regression_metrics(TB.pred(spark, sf), TB.TARGET, "prediction", len(TB.FEATURES), digits=METRIC_DIGITS)


SQL_EVAL_METRICS = _sql_metrics(None, PRED_SQL)


def q_eval_by_group(spark, sf):
    _prep(spark)
    return EV.regression_metrics(TB.pred(spark, sf), TB.TARGET, "prediction", len(TB.FEATURES),
                                 group_cols=["l_returnflag"], digits=METRIC_DIGITS)


SQL_EVAL_BY_GROUP = _sql_metrics("l_returnflag", PRED_SQL)


def q_eval_adjusted_r2(spark, sf):
    _prep(spark)
    p = len(TB.FEATURES)
    exact = EV.regression_metrics(TB.pred(spark, sf), TB.TARGET, "prediction", p)
    compat = EV.regression_metrics(TB.pred(spark, sf), TB.TARGET, "prediction", p, compat_rounding=True)
    one = compat.select(F.round("r2_adj", 8).alias("c")).scalar()
    return exact.select("n", F.lit(p).alias("p"), F.round("r2", 8).alias("r2"), F.round("r2_adj", 8).alias("r2_adj"),
                        F.round("r2", 2).alias("r2_2dp"), one.alias("r2_adj_compat"))


SQL_EVAL_ADJUSTED_R2 = f"""WITH a AS (SELECT count(*) AS n, sum(power(charge - prediction, 2)) AS sse,
  var_pop(charge) * count(charge) AS sst FROM ({PRED_SQL})),
b AS (SELECT n, 1 - sse / nullif(sst, 0) AS r2 FROM a)
SELECT n, {len(TB.FEATURES)} AS p, round(r2, 8) AS r2,
  round(CASE WHEN n > {len(TB.FEATURES)} + 1 THEN 1 - (1 - r2) * (n - 1) / (n - {len(TB.FEATURES)} - 1) END, 8) AS r2_adj,
  round(r2, 2) AS r2_2dp,
  round(CASE WHEN n > {len(TB.FEATURES)} + 1 THEN 1 - (1 - round(r2, 2)) * (n - 1) / (n - {len(TB.FEATURES)} - 1) END, 8) AS r2_adj_compat
FROM b"""


def q_residuals(spark, sf):
    _prep(spark)
    r = EV.with_residual(TB.pred(spark, sf), TB.TARGET, "prediction")
    return r.select(*KEY, TB.TARGET, "prediction", "residual")


SQL_RESIDUALS = f"""SELECT l_orderkey, l_linenumber, ship_epoch, l_partkey, l_suppkey, charge, prediction,
  prediction - charge AS residual FROM ({PRED_SQL})"""


def q_truth_vs_pred_bins(spark, sf):
    _prep(spark)
    return EV.truth_vs_pred_bins(TB.pred(spark, sf), TB.TARGET, "prediction", TVP_BINS)


SQL_TRUTH_VS_PRED_BINS = f"""WITH p AS ({PRED_SQL}),
mm AS (SELECT least(min(charge), min(prediction)) AS lo, greatest(max(charge), max(prediction)) AS hi FROM p)
SELECT {sql_bin('charge', 'lo', 'hi', TVP_BINS)} AS truth_bin, {sql_bin('prediction', 'lo', 'hi', TVP_BINS)} AS pred_bin,
  count(*) AS n FROM p, mm GROUP BY 1, 2"""


def q_residual_hist(spark, sf):
    _prep(spark)
    return EV.residual_histogram(TB.pred(spark, sf), TB.TARGET, "prediction", TVP_BINS)


SQL_RESIDUAL_HIST = f"""WITH r AS (SELECT prediction - charge AS residual FROM ({PRED_SQL})),
mm AS (SELECT min(residual) AS lo, max(residual) AS hi FROM r)
SELECT {sql_bin('residual', 'lo', 'hi', TVP_BINS)} AS bin, count(*) AS n FROM r, mm GROUP BY 1"""


# --- G: search tables ----------------------------------------------------------

def _trial_space(spark, sf, params, per_family=False):
    tv = TB.trials_v(spark, sf)
    if per_family:
        return SR.space_from_columns(tv, params, family_col="family")
    return SR.space_from_columns(tv, params, family="all")


def _sql_space(params, per_family=False) -> str:
    fam = "family" if per_family else "'all'"
    parts = []
    for p in params:
        order = f"{p}" if p != "p_size" else "p_size"
        parts.append(f"SELECT family, '{p}' AS param, CAST({p} AS VARCHAR) AS value, "
                     f"CAST(row_number() OVER (PARTITION BY family ORDER BY {order}) - 1 AS INTEGER) AS idx "
                     f"FROM (SELECT DISTINCT {fam} AS family, {p} FROM ({TRIALS_SQL}))")
    return " UNION ALL ".join(parts)


def q_space_grid(spark, sf):
    _prep(spark)
    return SR.grid(_trial_space(spark, sf, SEARCH_PARAMS), "all")


def _sql_space_grid() -> str:
    ps = sorted(SEARCH_PARAMS)
    sizes = " , ".join(f"(SELECT count(*) FROM sp WHERE param = '{p}') AS n_{p}" for p in ps)
    gid = f"s_{ps[0]}.idx + n_{ps[0]} * (s_{ps[1]}.idx + n_{ps[1]} * s_{ps[2]}.idx)"
    frm = ", ".join(f"(SELECT idx, value FROM sp WHERE param = '{p}') AS s_{p}" for p in ps)
    return (f"WITH sp AS ({_sql_space(ps)}), z AS (SELECT {sizes}) "
            f"SELECT 'all' AS family, CAST({gid} AS BIGINT) AS grid_id, "
            + ", ".join(f"s_{p}.value AS {p}" for p in ps) + f" FROM z, {frm}")


SQL_SPACE_GRID = _sql_space_grid()


def q_space_random(spark, sf):
    _prep(spark)
    return SR.random_candidates(_trial_space(spark, sf, SEARCH_PARAMS), "all", RANDOM_DRAWS, seed=42)


SQL_SPACE_RANDOM = f"""WITH sp AS ({_sql_space(SEARCH_PARAMS)}),
sizes AS (SELECT param, count(*) AS size FROM sp GROUP BY param),
t AS (SELECT range AS trial_id FROM range({RANDOM_DRAWS})),
d AS (SELECT t.trial_id, s.param, CAST({sql_hash32(['t.trial_id', 's.param'], '42')} % s.size AS INTEGER) AS idx
      FROM t, sizes s)
SELECT 'all' AS family, d.trial_id, d.param, sp.value FROM d JOIN sp ON d.param = sp.param AND d.idx = sp.idx"""


def q_trial_best(spark, sf):
    _prep(spark)
    return SR.best_trial(TB.trials_v(spark, sf), ["family"], SEARCH_PARAMS)


SQL_TRIAL_BEST = f"""SELECT family, loss, trial_id, p_brand, p_name, p_size FROM (
  SELECT *, row_number() OVER (PARTITION BY family ORDER BY loss, trial_id) AS rn
  FROM ({TRIALS_SQL}) WHERE status = 'ok' AND loss IS NOT NULL) WHERE rn = 1"""


def _best_long(spark, sf):
    best = SR.best_trial(TB.trials_v(spark, sf), ["family"], SEARCH_PARAMS)
    arr = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("value")) for p in SEARCH_PARAMS])
    return best.select("family", "trial_id", F.explode(arr).alias("kv")).select("family", "trial_id", "kv.*")


def q_space_decode(spark, sf):
    _prep(spark)
    sp = _trial_space(spark, sf, SEARCH_PARAMS, per_family=True)
    # the search hands back list positions; encode the best trial that way …
    enc = _best_long(spark, sf).join(sp.select("family", "param", "value", "idx"), ["family", "param", "value"])
    # … and decode them back to values (space_eval).
    return SR.decode(enc.select("family", "trial_id", "param", "idx"), sp).select(
        "family", "trial_id", "param", "idx", "value")


SQL_SPACE_DECODE = f"""WITH sp AS ({_sql_space(SEARCH_PARAMS, per_family=True)}),
b AS ({SQL_TRIAL_BEST}),
l AS (""" + " UNION ALL ".join(
    f"SELECT family, trial_id, '{p}' AS param, CAST({p} AS VARCHAR) AS value FROM b" for p in SEARCH_PARAMS) + """)
SELECT l.family, l.trial_id, l.param, sp.idx, sp.value
FROM l JOIN sp ON l.family = sp.family AND l.param = sp.param AND l.value = sp.value"""


# trials fail where the family's name has an even number of letters, or the size is odd
FAILED_SQL = "(length(family) % 2 = 0 OR p_size % 2 = 1)"


def _with_failures(tv):
    failed = (F.length("family") % 2 == 0) | (F.col("p_size") % 2 == 1)
    return tv.withColumn("status", F.when(failed, "fail").otherwise("ok"))


def q_param_fallback(spark, sf):
    _prep(spark)
    tv = TB.trials_v(spark, sf)
    arr = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("value")) for p in SEARCH_PARAMS])
    # defaults: the first trial of each family; best: the best of its successful trials
    first = (tv.groupBy("family").agg(F.min(F.struct("trial_id", *SEARCH_PARAMS)).alias("s")).select("family", "s.*"))
    defaults = first.select("family", F.explode(arr).alias("kv")).select("family", "kv.*")
    best = SR.best_trial(_with_failures(tv), ["family"], SEARCH_PARAMS)
    best_long = best.select("family", F.explode(arr).alias("kv")).select("family", "kv.*")
    return SR.with_defaults(best_long, defaults)


SQL_PARAM_FALLBACK = f"""WITH tv AS ({TRIALS_SQL}),
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY trial_id) AS rn FROM tv) WHERE rn = 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY loss, trial_id) AS rn FROM tv
                     WHERE {FAILED_SQL} IS NOT TRUE) WHERE rn = 1),
d AS (""" + " UNION ALL ".join(f"SELECT family, '{p}' AS param, CAST({p} AS VARCHAR) AS value FROM f"
                               for p in SEARCH_PARAMS) + """),
bl AS (""" + " UNION ALL ".join(f"SELECT family, '{p}' AS param, CAST({p} AS VARCHAR) AS value FROM b"
                                for p in SEARCH_PARAMS) + """)
SELECT d.family, d.param, coalesce(bl.value, d.value) AS value,
  CASE WHEN bl.value IS NOT NULL THEN 'search' ELSE 'default' END AS source
FROM d LEFT JOIN bl ON d.family = bl.family AND d.param = bl.param"""


def q_suggest_density(spark, sf):
    _prep(spark)
    tv = TB.trials_v(spark, sf)
    arr = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("value")) for p in SUGGEST_PARAMS])
    long = tv.select("family", "trial_id", "loss", F.explode(arr).alias("kv")).select(
        "family", "trial_id", "loss", "kv.*")
    out = SR.suggest(long, ["family"], gamma=0.25)
    return out.select("family", "param", "value", F.round("score", 9).alias("score"), "n_good", "n_bad")


SQL_SUGGEST_DENSITY = f"""WITH tv AS ({TRIALS_SQL}),
r AS (SELECT family, trial_id, row_number() OVER (PARTITION BY family ORDER BY loss, trial_id) AS rk,
             count(*) OVER (PARTITION BY family) AS n FROM tv),
lab AS (SELECT family, trial_id, rk <= ceil(n * 0.25) AS good, ceil(n * 0.25) AS g, n - ceil(n * 0.25) AS b FROM r),
l AS (""" + " UNION ALL ".join(f"SELECT family, trial_id, '{p}' AS param, CAST({p} AS VARCHAR) AS value FROM tv"
                               for p in SUGGEST_PARAMS) + """),
pv AS (SELECT l.family, l.param, l.value, count(*) FILTER (WHERE good) AS n_good,
              count(*) FILTER (WHERE NOT good) AS n_bad, max(g) AS g, max(b) AS b
       FROM l JOIN lab ON l.family = lab.family AND l.trial_id = lab.trial_id GROUP BY 1, 2, 3),
k AS (SELECT family, param, count(*) AS kk FROM pv GROUP BY 1, 2),
sc AS (SELECT pv.*, (CAST(n_good + 1 AS DOUBLE) / (g + kk)) / (CAST(n_bad + 1 AS DOUBLE) / (b + kk)) AS score
       FROM pv JOIN k ON pv.family = k.family AND pv.param = k.param),
top AS (SELECT *, row_number() OVER (PARTITION BY family, param ORDER BY score DESC, value) AS rn FROM sc)
SELECT family, param, value, round(score, 9) AS score, n_good, n_bad FROM top WHERE rn = 1"""


RANGE = (1.0, 50.0)


def q_suggest_ranges(spark, sf):
    """G6 for ranges: part sizes as a range, one suggestion for each part type."""
    _prep(spark)
    tv = TB.trials_v(spark, sf)
    long = tv.select("family", "trial_id", "loss", F.lit("p_size").alias("param"), F.col("p_size").cast("double").alias("value"))
    ranges = tv.select("family").distinct().select("family", F.lit("p_size").alias("param"), F.lit(RANGE[0]).alias("low"), F.lit(RANGE[1]).alias("high"))
    out = SR.suggest_ranges(long, ranges, gamma=0.25)
    return out.select("family", "param", *[F.round(c, 6).alias(c) for c in ("value", "good_density", "bad_density")])


def _suggest_ranges_sql() -> str:
    unit = lambda what: f"({sql_hash32(['family', 'param', 'j'], f'42|{what}')} / 4294967296.0)"
    names = ["pick", "flat", *[f"{a}{i}" for i in range(SR.TRIES) for a in "ab"]]
    point = SR.drawn("mu", SR.bandwidth("low", "high", "n_good"), "low", "high", [(f"a{i}", f"b{i}") for i in range(SR.TRIES)], "flat")
    dense = {side: f"(1.0 / (high - low) + coalesce(sum({SR.kernel('x', 'mu', SR.bandwidth('low', 'high', f'n_{side}'), 'low', 'high')}) FILTER ({flag}), 0)) / (n_{side} + 1)"
             for side, flag in (("good", "good"), ("bad", "NOT good"))}
    return f"""WITH tv AS ({TRIALS_SQL}),
lab AS (SELECT family, trial_id, 'p_size' AS param, CAST(p_size AS DOUBLE) AS mu, row_number() OVER (PARTITION BY family ORDER BY loss, trial_id) AS rk,
  count(*) OVER (PARTITION BY family) AS n FROM tv),
seen AS (SELECT *, rk <= ceil(n * 0.25) AS good, ceil(n * 0.25) AS g FROM lab WHERE mu IS NOT NULL),
sides AS (SELECT family, param, max(g) AS g, count(*) FILTER (good) AS n_good, count(*) FILTER (NOT good) AS n_bad, {RANGE[0]} AS low, {RANGE[1]} AS high FROM seen GROUP BY ALL),
c AS (SELECT *, floor(pick * (g + 1)) AS component FROM (SELECT *, {', '.join(f'{unit(w)} AS {w}' for w in names)} FROM sides, (SELECT unnest(range(24)) AS j))),
p AS (SELECT c.family, c.param, c.j, c.low, c.high, c.n_good, c.n_bad, {point} AS x FROM c LEFT JOIN (SELECT family, rk, mu FROM seen WHERE good) s
  ON c.family = s.family AND c.component = s.rk),
d AS (SELECT p.family, p.param, p.j, p.x, {dense['good']} AS good_density, {dense['bad']} AS bad_density FROM p JOIN seen USING (family, param)
  GROUP BY p.family, p.param, p.j, p.x, low, high, n_good, n_bad)
SELECT family, param, round(x, 6) AS value, round(good_density, 6) AS good_density, round(bad_density, 6) AS bad_density FROM d
QUALIFY row_number() OVER (PARTITION BY family, param ORDER BY round(good_density / bad_density, 9) DESC, j) = 1"""


SQL_SUGGEST_RANGES = _suggest_ranges_sql()


# --- H: tracking ---------------------------------------------------------------

def _runs_wide(spark, sf):
    return TR.runs_wide(TB.runs_v(spark, sf).drop("metric"), TB.metrics_v(spark, sf), METRIC_KEYS,
                        ties=["tie1", "tie2"])


def _sql_runs_wide() -> str:
    cols = ", ".join(f"max(value) FILTER (WHERE key = '{k}') AS metric_{k}" for k in METRIC_KEYS)
    return (f"WITH lm AS ({LATEST_METRICS_SQL}), w AS (SELECT run_id, {cols} FROM lm GROUP BY run_id) "
            f"SELECT r.run_id, r.experiment_id, r.run_name, r.status, CAST(epoch(r.end_time) AS BIGINT) AS end_epoch, "
            + ", ".join(f"w.metric_{k}" for k in METRIC_KEYS)
            + f" FROM ({RUNS_SQL}) r LEFT JOIN w ON r.run_id = w.run_id")


def _wide_out(df):
    return df.select("run_id", "experiment_id", "run_name", "status",
                     F.unix_timestamp("end_time").alias("end_epoch"), *[f"metric_{k}" for k in METRIC_KEYS])


def q_experiments_list(spark, sf):
    _prep(spark)
    return TR.list_experiments(TB.experiments_v(spark, sf), TB.runs_v(spark, sf))


SQL_EXPERIMENTS_LIST = f"""WITH c AS (SELECT experiment_id, count(*) AS n_runs,
  count(*) FILTER (WHERE status = 'FINISHED') AS n_finished FROM ({RUNS_SQL}) GROUP BY 1)
SELECT e.experiment_id, e.name, coalesce(c.n_runs, 0) AS n_runs, coalesce(c.n_finished, 0) AS n_finished
FROM ({EXPERIMENTS_SQL}) e LEFT JOIN c ON e.experiment_id = c.experiment_id"""


def q_experiment_by_name(spark, sf):
    _prep(spark)
    ex = TR.experiment_by_name(TB.experiments_v(spark, sf), EXPERIMENT_NAME)
    own = TB.runs_v(spark, sf).join(ex.select("experiment_id"), "experiment_id", "left_semi")
    return TR.list_experiments(ex, own)


SQL_EXPERIMENT_BY_NAME = f"SELECT * FROM ({SQL_EXPERIMENTS_LIST}) WHERE name = '{EXPERIMENT_NAME}'"


def q_runs_wide(spark, sf):
    _prep(spark)
    return _wide_out(_runs_wide(spark, sf))


SQL_RUNS_WIDE = _sql_runs_wide()


def q_runs_ordered(spark, sf):
    _prep(spark)
    return TR.order_by_metric(_wide_out(_runs_wide(spark, sf)), "metric_MAPE").limit(10)


SQL_RUNS_ORDERED = f"SELECT * FROM ({SQL_RUNS_WIDE}) ORDER BY metric_MAPE ASC NULLS LAST, run_id LIMIT 10"


def q_runs_finished_day(spark, sf):
    _prep(spark)
    runs = TR.on_day(TR.finished(TB.runs_v(spark, sf).drop("metric")), FINISHED_DAY)
    wide = TR.runs_wide(runs, TB.metrics_v(spark, sf), METRIC_KEYS, ties=["tie1", "tie2"], selective=True)
    return _wide_out(wide)


SQL_RUNS_FINISHED_DAY = (f"SELECT * FROM ({SQL_RUNS_WIDE}) WHERE status = 'FINISHED' "
                         f"AND end_epoch >= CAST(epoch(TIMESTAMP '{FINISHED_DAY}') AS BIGINT) "
                         f"AND end_epoch < CAST(epoch(TIMESTAMP '{FINISHED_DAY}' + INTERVAL 1 DAY) AS BIGINT)")


def q_best_run(spark, sf):
    _prep(spark)
    day = q_runs_finished_day(spark, sf)
    return TR.best_run(day, "metric_MAPE").select("run_id", "run_name", "metric_MAPE")


SQL_BEST_RUN = (f"SELECT run_id, run_name, metric_MAPE FROM ({SQL_RUNS_FINISHED_DAY}) "
                "ORDER BY metric_MAPE ASC NULLS LAST, run_id LIMIT 1")


def q_best_run_per_experiment(spark, sf):
    _prep(spark)
    wide = _wide_out(_runs_wide(spark, sf)).filter(F.col("status") == "FINISHED")
    return TR.best_per_group(wide, ["experiment_id"], "metric_MAPE", "run_id", ["run_name"])


SQL_BEST_RUN_PER_EXPERIMENT = f"""SELECT experiment_id, run_id, metric_MAPE, run_name FROM (
  SELECT *, row_number() OVER (PARTITION BY experiment_id ORDER BY metric_MAPE ASC NULLS LAST, run_id) AS rn
  FROM ({SQL_RUNS_WIDE}) WHERE status = 'FINISHED') WHERE rn = 1"""


def q_run_metric(spark, sf):
    _prep(spark)
    return TR.run_metric(TB.runs_v(spark, sf), TB.metrics_v(spark, sf), "MAPE", ties=["tie1", "tie2"])


SQL_RUN_METRIC = f"""SELECT r.run_id, lm.value AS MAPE FROM ({RUNS_SQL}) r
LEFT JOIN (SELECT * FROM ({LATEST_METRICS_SQL}) WHERE key = 'MAPE') lm ON r.run_id = lm.run_id"""


def _params_v(spark, sf):
    li = TB.table(spark, sf, "lineitem")
    return li.select(F.col("l_orderkey").alias("run_id"), F.col("l_returnflag").alias("key"),
                     F.col("l_linestatus").alias("value"), F.unix_timestamp("l_shipdate").alias("ts"),
                     F.col("l_partkey").alias("tie1"), F.col("l_suppkey").alias("tie2"))


PARAMS_SQL = """SELECT l_orderkey AS run_id, l_returnflag AS key, l_linestatus AS value,
  CAST(epoch(l_shipdate) AS BIGINT) AS ts, l_partkey AS tie1, l_suppkey AS tie2 FROM lineitem"""


def q_param_log_dedup(spark, sf):
    _prep(spark)
    return TR.dedup_params(_params_v(spark, sf))


SQL_PARAM_LOG_DEDUP = f"""WITH p AS ({PARAMS_SQL}),
l AS (SELECT run_id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY run_id, key
      ORDER BY ts DESC, tie1 DESC, tie2 DESC, value DESC) AS rn FROM p) WHERE rn = 1),
c AS (SELECT run_id, key, count(*) AS n_logged, count(DISTINCT value) AS n_values FROM p GROUP BY 1, 2)
SELECT l.run_id, l.key, l.value, c.n_logged, c.n_values > 1 AS conflict
FROM l JOIN c ON l.run_id = c.run_id AND l.key = c.key"""


def q_metric_latest(spark, sf):
    _prep(spark)
    return TR.latest_metrics(TB.metrics_v(spark, sf), ["tie1", "tie2"])


SQL_METRIC_LATEST = LATEST_METRICS_SQL


# --- I: registry ---------------------------------------------------------------

def _versions(spark, sf):
    """Distinct (name, version) of the stage log, registered at first event."""
    st = TB.stages_v(spark, sf)
    return st.groupBy("name", "version").agg(F.min("ts").alias("created_at"))


VERSIONS_SQL = f"SELECT name, version, min(ts) AS created_at FROM ({STAGES_SQL}) GROUP BY 1, 2"


def q_register_versions(spark, sf):
    _prep(spark)
    new = _versions(spark, sf).select("name", F.col("version").cast("string").alias("run_id"),
                                      F.lit(None).cast("string").alias("source_uri"), "created_at",
                                      F.col("version").alias("source_version"))
    existing = spark.createDataFrame([], RG.VERSIONS)
    out = RG.next_versions(existing, new.drop("source_version"))
    return out.select("name", F.col("run_id").cast("long").alias("source_version"), "version",
                      F.unix_micros("created_at").alias("created_us"))


SQL_REGISTER_VERSIONS = f"""SELECT name, version AS source_version,
  CAST(row_number() OVER (PARTITION BY name ORDER BY created_at, CAST(version AS VARCHAR)) AS BIGINT) AS version,
  epoch_us(created_at) AS created_us FROM ({VERSIONS_SQL})"""


def q_version_notes(spark, sf):
    _prep(spark)
    st = TB.stages_v(spark, sf).withColumn(
        "description", F.format_string("Model Type = %s, version %d, %s", "name", "version", "note"))
    return TR.latest_by(st, ["name", "version"], ["ts", "seq"], ["description"])


SQL_VERSION_NOTES = f"""SELECT name, version, description FROM (
  SELECT name, version, 'Model Type = ' || name || ', version ' || CAST(version AS VARCHAR) || ', ' || note AS description,
         row_number() OVER (PARTITION BY name, version ORDER BY ts DESC, seq DESC) AS rn FROM ({STAGES_SQL})) WHERE rn = 1"""


def q_versions_stage(spark, sf):
    _prep(spark)
    vs = RG.versions_with_stage(_versions(spark, sf), TB.stages_v(spark, sf))
    return vs.select("name", "version", "stage")


CURRENT_STAGE_SQL = f"""SELECT name, version, stage FROM (SELECT name, version, stage,
  row_number() OVER (PARTITION BY name, version ORDER BY ts DESC, seq DESC) AS rn FROM ({STAGES_SQL})) WHERE rn = 1"""

SQL_VERSIONS_STAGE = f"""SELECT v.name, v.version, coalesce(c.stage, 'None') AS stage
FROM ({VERSIONS_SQL}) v LEFT JOIN ({CURRENT_STAGE_SQL}) c ON v.name = c.name AND v.version = c.version"""


def q_current_staging(spark, sf):
    _prep(spark)
    vs = RG.versions_with_stage(_versions(spark, sf).withColumn("run_id", F.col("version")), TB.stages_v(spark, sf))
    return RG.current_staging(vs).select("name", "cur_version")


SQL_CURRENT_STAGING = f"SELECT name, max(version) AS cur_version FROM ({SQL_VERSIONS_STAGE}) WHERE stage = 'Staging' GROUP BY 1"


def _comparison(spark, sf, unstaged: bool = False):
    log = TB.stages_v(spark, sf)
    versions = log.groupBy("name", "version").agg(F.min("ts").alias("created_at")).withColumn("run_id", F.col("version"))
    st = log.filter((F.col("stage") != "Staging") | (F.length("name") % 2 == 0)) if unstaged else log
    vs = RG.versions_with_stage(versions, st)
    # candidate: the most recently registered version of each name
    cand = TR.latest_by(versions, ["name"], ["created_at", "version"], ["version", "run_id"])
    cur = RG.current_staging(vs, exclude=cand)
    return RG.compare(cand, cur, TB.metrics_v(spark, sf), "MAPE", ties=["tie1", "tie2"])


def _sql_comparison(unstaged: bool = False) -> str:
    st = f"SELECT * FROM ({STAGES_SQL})" + (" WHERE stage <> 'Staging' OR length(name) % 2 = 0" if unstaged else "")
    return f"""WITH v AS ({VERSIONS_SQL}),
cs AS (SELECT name, version, stage FROM (SELECT name, version, stage,
       row_number() OVER (PARTITION BY name, version ORDER BY ts DESC, seq DESC) AS rn FROM ({st})) WHERE rn = 1),
vs AS (SELECT v.name, v.version, coalesce(cs.stage, 'None') AS stage FROM v
       LEFT JOIN cs ON v.name = cs.name AND v.version = cs.version),
cand AS (SELECT name, version FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY created_at DESC, version DESC) AS rn
         FROM v) WHERE rn = 1),
cur AS (SELECT vs.name, max(vs.version) AS cur_version FROM vs LEFT JOIN cand ON vs.name = cand.name AND vs.version = cand.version
        WHERE vs.stage = 'Staging' AND cand.version IS NULL GROUP BY 1),
lm AS (SELECT run_id, value FROM ({LATEST_METRICS_SQL}) WHERE key = 'MAPE'),
j AS (SELECT cand.name, cand.version AS cand_version, lc.value AS cand_metric, cur.cur_version, lu.value AS cur_metric
      FROM cand LEFT JOIN lm lc ON lc.run_id = cand.version LEFT JOIN cur ON cur.name = cand.name
      LEFT JOIN lm lu ON lu.run_id = cur.cur_version)
SELECT name, cand_version, cand_metric, cur_version, cur_metric,
  coalesce(cur_version IS NOT NULL AND cand_metric IS NOT NULL AND (cur_metric IS NULL OR cand_metric < cur_metric), false) AS promote,
  cur_version IS NULL AS bootstrap FROM j"""


def q_challenger_compare(spark, sf):
    _prep(spark)
    return _comparison(spark, sf)


SQL_CHALLENGER_COMPARE = _sql_comparison()


def _sql_events(cmp_sql: str) -> str:
    return f"""WITH c AS ({cmp_sql})
SELECT name, cand_version AS version, 'Staging' AS stage, 0 AS ord FROM c WHERE bootstrap OR promote
UNION ALL
SELECT name, cur_version AS version, 'Archived' AS stage, 1 AS ord FROM c WHERE promote AND NOT bootstrap"""


def q_promotion_events(spark, sf):
    _prep(spark)
    return RG.promotion_events(_comparison(spark, sf))


SQL_PROMOTION_EVENTS = _sql_events(SQL_CHALLENGER_COMPARE)


def q_bootstrap_stage(spark, sf):
    _prep(spark)
    return RG.promotion_events(_comparison(spark, sf, unstaged=True))


SQL_BOOTSTRAP_STAGE = _sql_events(_sql_comparison(True))


# --- written operators without a key of their own -----------------------------------

def q_residual_summary(spark, sf):
    """mean exactly; the approximate quantiles by the shares of residuals
    below and up to each, which must enclose the one asked for."""
    _prep(spark)
    p = TB.pred(spark, sf)
    s = EV.residual_summary(p, TB.TARGET, "prediction")
    r = F.col("prediction") - F.col(TB.TARGET)
    q = s.first()
    wanted = (("p05", 0.05), ("p50", 0.5), ("p95", 0.95))
    shares = p.agg(*[F.avg((r < F.lit(q[c])).cast("double")).alias(f"{c}_below") for c, _ in wanted],
                   *[F.avg((r <= F.lit(q[c])).cast("double")).alias(f"{c}_to") for c, _ in wanted]).first()
    near = all(shares[f"{c}_below"] <= x + 0.002 and shares[f"{c}_to"] >= x - 0.002 for c, x in wanted)
    return s.select("n", F.round("mean", 4).alias("mean"), F.lit(near).alias("quantiles_near"))


SQL_RESIDUAL_SUMMARY = f"SELECT count(*) AS n, round(avg(prediction - charge), 4) AS mean, true AS quantiles_near FROM ({PRED_SQL})"

PARAM_KEYS = ["A", "N", "R"]


def q_runs_with_params(spark, sf):
    """H6 with its parameter pivot."""
    _prep(spark)
    out = TR.runs_wide(TB.runs_v(spark, sf).drop("metric"), TB.metrics_v(spark, sf), ["MAPE"], ties=["tie1", "tie2"],
                       params=_params_v(spark, sf), param_keys=PARAM_KEYS)
    return out.select("run_id", "metric_MAPE", *[f"param_{k}" for k in PARAM_KEYS])


SQL_RUNS_WITH_PARAMS = (f"WITH l AS (SELECT run_id, key, value FROM (SELECT *, row_number() OVER (PARTITION BY run_id, key "
                        f"ORDER BY ts DESC, tie1 DESC, tie2 DESC, value DESC) AS rn FROM ({PARAMS_SQL})) WHERE rn = 1), "
                        "w AS (SELECT run_id, " + ", ".join(f"max(value) FILTER (WHERE key = '{k}') AS param_{k}" for k in PARAM_KEYS)
                        + f" FROM l GROUP BY run_id) SELECT r.run_id, m.value AS metric_MAPE, "
                        + ", ".join(f"w.param_{k}" for k in PARAM_KEYS) + f" FROM ({RUNS_SQL}) r LEFT JOIN w ON r.run_id = w.run_id "
                        f"LEFT JOIN (SELECT * FROM ({LATEST_METRICS_SQL}) WHERE key = 'MAPE') m ON r.run_id = m.run_id")

ONE_MODEL = "click"


def q_versions_of_model(spark, sf):
    """The versions of one named model, with their stages."""
    _prep(spark)
    named = TB.stages_v(spark, sf).filter(F.col("name") == ONE_MODEL)
    versions = named.groupBy("name", "version").agg(F.min("ts").alias("created_at"))
    return RG.versions_with_stage(versions, named).select("name", "version", "stage")


SQL_VERSIONS_OF_MODEL = f"SELECT * FROM ({SQL_VERSIONS_STAGE}) WHERE name = '{ONE_MODEL}'"


def q_register_on_existing(spark, sf):
    """I1 on top of versions that are there: the earlier half of the time
    range is registered first, the rest goes on from its numbers."""
    _prep(spark)
    new = _versions(spark, sf).select("name", F.col("version").cast("string").alias("run_id"),
                                      F.lit(None).cast("string").alias("source_uri"), "created_at")
    middle = new.agg((F.avg(F.unix_micros("created_at"))).alias("m")).first()["m"]
    early = F.unix_micros("created_at") < F.lit(middle)
    old = RG.next_versions(spark.createDataFrame([], RG.VERSIONS), new.filter(early))
    out = old.unionByName(RG.next_versions(old, new.filter(~early)))
    return out.select("name", F.col("run_id").cast("long").alias("source_version"), "version")


SQL_REGISTER_ON_EXISTING = f"SELECT name, source_version, version FROM ({SQL_REGISTER_VERSIONS})"


def q_stage_store(spark, sf):
    """I3 through the store: the promotion events are appended to a registry
    that holds the log, and the stages are read back from it."""
    _prep(spark)
    registry = RG.ModelRegistry(spark, S.work_dir(spark, "registry"))
    registry._append("stage_events", TB.stages_v(spark, sf).select("name", "version", "stage", "ts", "seq"))
    registry.append_events(RG.promotion_events(_comparison(spark, sf)))
    return RG.current_stage(registry.table("stage_events")).select("name", "version", "stage")


SQL_STAGE_STORE = f"""WITH e AS ({SQL_PROMOTION_EVENTS})
SELECT coalesce(e.name, c.name) AS name, coalesce(e.version, c.version) AS version, coalesce(e.stage, c.stage) AS stage
FROM ({CURRENT_STAGE_SQL}) c FULL JOIN e ON e.name = c.name AND e.version = c.version"""


# --- the same operators over missing, NaN and repeated values ------------------------

def _messy(spark, sf):
    """The scored table; every 7th order's price is NULL and every 11th's NaN,
    and so are what derives from it; every 13th order has no prediction."""
    k = F.col("l_orderkey")
    price = F.when(k % 7 == 0, F.lit(None)).when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice"))
    r = TB.pred(spark, sf).withColumn("l_extendedprice", price.cast("double"))
    return r.withColumn("charge", F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).withColumn(
        "prediction", F.when(k % 13 != 0, F.col("prediction")))


MESSY_SQL = """SELECT l_orderkey, l_quantity, l_discount, l_tax, l_returnflag,
  CASE WHEN l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 THEN l_extendedprice END AS l_extendedprice,
  CASE WHEN l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0 THEN l_extendedprice * (1 - l_discount) * (1 + l_tax) END AS charge,
  CASE WHEN l_orderkey % 13 <> 0 THEN l_extendedprice * (1 - l_discount) END AS prediction
FROM lineitem"""


def q_profile_hist_messy(spark, sf):
    _prep(spark)
    return PR.histogram(_messy(spark, sf), NUMERIC, HIST_BINS).withColumnRenamed("column", "col_name")


def q_profile_corr_messy(spark, sf):
    _prep(spark)
    return PR.correlation(_messy(spark, sf), NUMERIC).withColumn("r", F.round("r", 6))


def q_profile_normality_messy(spark, sf):
    _prep(spark)
    out = PR.normality(_messy(spark, sf), NUMERIC)
    return out.select(F.col("column").alias("col_name"), "n", F.round("mean", 4).alias("mean"),
                      F.round("stddev", 4).alias("stddev"), F.round("skewness", 6).alias("skewness"),
                      F.round("kurtosis", 6).alias("kurtosis"), F.round("jarque_bera", 3).alias("jarque_bera"))


def q_profile_category_messy(spark, sf):
    _prep(spark)
    out = PR.category_profile(_messy(spark, sf), TB.CATEGORY, TB.TARGET)
    return out.select("l_returnflag", "n", F.round("mean", 4).alias("mean"), F.round("stddev", 4).alias("stddev"),
                      F.round("eta2", 8).alias("eta2"))


def q_eval_metrics_messy(spark, sf):
    _prep(spark)
    return EV.regression_metrics(_messy(spark, sf), TB.TARGET, "prediction", len(TB.FEATURES), digits=METRIC_DIGITS)


SQL_PROFILE_HIST_MESSY = SQL_PROFILE_HIST.replace(REG_SQL, MESSY_SQL)
SQL_PROFILE_CORR_MESSY = (f"WITH reg AS ({MESSY_SQL}) " + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + ("CASE WHEN stddev_pop(" + a + ") > 0 THEN 1.0::DOUBLE END" if a == b else
                                                  f"round({_sql_r(a, b)}, 6)")
    + f" AS r FROM reg WHERE {a} IS NOT NULL AND {b} IS NOT NULL" for a in NUMERIC for b in NUMERIC))
SQL_PROFILE_NORMALITY_MESSY = SQL_PROFILE_NORMALITY.replace(REG_SQL, MESSY_SQL)
SQL_PROFILE_CATEGORY_MESSY = SQL_PROFILE_CATEGORY.replace(REG_SQL, MESSY_SQL)
SQL_EVAL_METRICS_MESSY = _sql_metrics(None, MESSY_SQL)


def q_holdout_exact_messy(spark, sf):
    """Two key columns, one of them NULL for every third order."""
    _prep(spark)
    o = TB.table(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("cust"))
    out = SP.exact_holdout(o, ["cust", "o_orderkey"], 0.5, SP.HOLDOUT_SALT)
    return out.select("o_orderkey", F.col("cust").isNull().alias("no_cust"), "split")


SQL_HOLDOUT_EXACT_MESSY = f"""WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS cust FROM orders),
h AS (SELECT *, {sql_hash32(['cust', 'o_orderkey'], 'holdout', 0)} AS ha, {sql_hash32(['cust', 'o_orderkey'], 'holdout', 1)} AS hb FROM t),
r AS (SELECT *, row_number() OVER (ORDER BY ha, hb, cust NULLS FIRST, o_orderkey) AS rn, count(*) OVER () AS n FROM h)
SELECT o_orderkey, cust IS NULL AS no_cust, CASE WHEN rn <= ceil(n * 0.5) THEN 'test' ELSE 'train' END AS split FROM r"""


def q_suggest_density_messy(spark, sf):
    """Trials of no family, and values that are missing."""
    _prep(spark)
    tv = TB.trials_v(spark, sf).withColumn("family", F.when(F.col("trial_id") % 3 != 0, F.col("family"))).withColumn(
        "p_size", F.when(F.col("trial_id") % 5 != 0, F.col("p_size")))
    arr = F.array(*[F.struct(F.lit(p).alias("param"), F.col(p).cast("string").alias("value")) for p in SUGGEST_PARAMS])
    long = tv.select("family", "trial_id", "loss", F.explode(arr).alias("kv")).select("family", "trial_id", "loss", "kv.*")
    out = SR.suggest(long, ["family"], gamma=0.25)
    return out.select("family", "param", "value", F.round("score", 9).alias("score"), "n_good", "n_bad")


SQL_SUGGEST_DENSITY_MESSY = (SQL_SUGGEST_DENSITY.replace(TRIALS_SQL, f"""SELECT CASE WHEN trial_id % 3 <> 0 THEN family END AS family, trial_id, p_brand,
  CASE WHEN trial_id % 5 <> 0 THEN p_size END AS p_size, loss FROM ({TRIALS_SQL})""")
                             .replace("l.family = lab.family", "l.family IS NOT DISTINCT FROM lab.family")
                             .replace("pv.family = k.family", "pv.family IS NOT DISTINCT FROM k.family")
                             .replace("ORDER BY score DESC, value)", "ORDER BY score DESC, value NULLS FIRST)"))


def q_register_versions_messy(spark, sf):
    """Models without a name are numbered as one name."""
    _prep(spark)
    v = _versions(spark, sf).withColumn("name", F.when(F.col("name") != ONE_MODEL, F.col("name")))
    new = v.select("name", F.col("version").cast("string").alias("run_id"), F.lit(None).cast("string").alias("source_uri"), "created_at")
    out = RG.next_versions(spark.createDataFrame([], RG.VERSIONS), new)
    return out.select("name", F.col("run_id").cast("long").alias("source_version"), "version")


SQL_REGISTER_VERSIONS_MESSY = f"""SELECT name, version AS source_version,
  CAST(row_number() OVER (PARTITION BY name ORDER BY created_at, CAST(version AS VARCHAR)) AS BIGINT) AS version
FROM (SELECT CASE WHEN name <> '{ONE_MODEL}' THEN name END AS name, version, created_at FROM ({VERSIONS_SQL}))"""


# --- J: leaderboard --------------------------------------------------------------

def q_leaderboard(spark, sf):
    _prep(spark)
    m = EV.regression_metrics(TB.pred(spark, sf).withColumnRenamed("l_returnflag", "family"), TB.TARGET,
                              "prediction", len(TB.FEATURES), group_cols=["family"], digits=METRIC_DIGITS)
    # rank over one row per family (bounded)
    rk = F.expr("rank() OVER (ORDER BY mape ASC NULLS LAST, family)").cast("long")
    return m.select("family", "n", "mse", "rmse", "r2", "mape", rk.alias("rank"))


SQL_LEADERBOARD = (f"WITH m AS ({_sql_metrics('l_returnflag', PRED_SQL)}) "
                   "SELECT l_returnflag AS family, n, mse, rmse, r2, mape, "
                   "CAST(rank() OVER (ORDER BY mape ASC NULLS LAST, l_returnflag) AS BIGINT) AS rank FROM m")


# --- catalogue -----------------------------------------------------------------

SQL_QUERIES: dict[str, tuple[SparkQuery, str]] = {
    "clean_drop_category": (q_clean_drop_category, SQL_CLEAN_DROP_CATEGORY),
    "split_counts": (q_split_counts, SQL_SPLIT_COUNTS),
    "split_nested": (q_split_nested, SQL_SPLIT_NESTED),
    "holdout_exact": (q_holdout_exact, SQL_HOLDOUT_EXACT),
    "score_holdout": (q_score_holdout, SQL_SCORE_HOLDOUT),
    "profile_preview": (q_profile_preview, SQL_PROFILE_PREVIEW),
    "profile_missing": (q_profile_missing, SQL_PROFILE_MISSING),
    "profile_zero": (q_profile_zero, SQL_PROFILE_ZERO),
    "profile_hist": (q_profile_hist, SQL_PROFILE_HIST),
    "profile_pair_bins": (q_profile_pair_bins, SQL_PROFILE_PAIR_BINS),
    "profile_corr": (q_profile_corr, SQL_PROFILE_CORR),
    "profile_target_corr": (q_profile_target_corr, SQL_PROFILE_TARGET_CORR),
    "profile_normality": (q_profile_normality, SQL_PROFILE_NORMALITY),
    "profile_category": (q_profile_category, SQL_PROFILE_CATEGORY),
    "profile_shape": (q_profile_shape, SQL_PROFILE_SHAPE),
    "eval_metrics": (q_eval_metrics, SQL_EVAL_METRICS),
    "eval_by_group": (q_eval_by_group, SQL_EVAL_BY_GROUP),
    "eval_adjusted_r2": (q_eval_adjusted_r2, SQL_EVAL_ADJUSTED_R2),
    "residuals": (q_residuals, SQL_RESIDUALS),
    "truth_vs_pred_bins": (q_truth_vs_pred_bins, SQL_TRUTH_VS_PRED_BINS),
    "residual_hist": (q_residual_hist, SQL_RESIDUAL_HIST),
    "space_grid": (q_space_grid, SQL_SPACE_GRID),
    "space_random": (q_space_random, SQL_SPACE_RANDOM),
    "trial_best": (q_trial_best, SQL_TRIAL_BEST),
    "space_decode": (q_space_decode, SQL_SPACE_DECODE),
    "param_fallback": (q_param_fallback, SQL_PARAM_FALLBACK),
    "suggest_density": (q_suggest_density, SQL_SUGGEST_DENSITY),
    "suggest_ranges": (q_suggest_ranges, SQL_SUGGEST_RANGES),
    "experiments_list": (q_experiments_list, SQL_EXPERIMENTS_LIST),
    "experiment_by_name": (q_experiment_by_name, SQL_EXPERIMENT_BY_NAME),
    "runs_wide": (q_runs_wide, SQL_RUNS_WIDE),
    "runs_ordered": (q_runs_ordered, SQL_RUNS_ORDERED),
    "runs_finished_day": (q_runs_finished_day, SQL_RUNS_FINISHED_DAY),
    "best_run": (q_best_run, SQL_BEST_RUN),
    "best_run_per_experiment": (q_best_run_per_experiment, SQL_BEST_RUN_PER_EXPERIMENT),
    "run_metric": (q_run_metric, SQL_RUN_METRIC),
    "param_log_dedup": (q_param_log_dedup, SQL_PARAM_LOG_DEDUP),
    "metric_latest": (q_metric_latest, SQL_METRIC_LATEST),
    "register_versions": (q_register_versions, SQL_REGISTER_VERSIONS),
    "version_notes": (q_version_notes, SQL_VERSION_NOTES),
    "versions_stage": (q_versions_stage, SQL_VERSIONS_STAGE),
    "current_staging": (q_current_staging, SQL_CURRENT_STAGING),
    "challenger_compare": (q_challenger_compare, SQL_CHALLENGER_COMPARE),
    "promotion_events": (q_promotion_events, SQL_PROMOTION_EVENTS),
    "bootstrap_stage": (q_bootstrap_stage, SQL_BOOTSTRAP_STAGE),
    "leaderboard": (q_leaderboard, SQL_LEADERBOARD),
    "residual_summary": (q_residual_summary, SQL_RESIDUAL_SUMMARY),
    "runs_with_params": (q_runs_with_params, SQL_RUNS_WITH_PARAMS),
    "versions_of_model": (q_versions_of_model, SQL_VERSIONS_OF_MODEL),
    "register_on_existing": (q_register_on_existing, SQL_REGISTER_ON_EXISTING),
    "stage_store": (q_stage_store, SQL_STAGE_STORE),
    "profile_hist_messy": (q_profile_hist_messy, SQL_PROFILE_HIST_MESSY),
    "profile_corr_messy": (q_profile_corr_messy, SQL_PROFILE_CORR_MESSY),
    "profile_normality_messy": (q_profile_normality_messy, SQL_PROFILE_NORMALITY_MESSY),
    "profile_category_messy": (q_profile_category_messy, SQL_PROFILE_CATEGORY_MESSY),
    "eval_metrics_messy": (q_eval_metrics_messy, SQL_EVAL_METRICS_MESSY),
    "holdout_exact_messy": (q_holdout_exact_messy, SQL_HOLDOUT_EXACT_MESSY),
    "suggest_density_messy": (q_suggest_density_messy, SQL_SUGGEST_DENSITY_MESSY),
    "register_versions_messy": (q_register_versions_messy, SQL_REGISTER_VERSIONS_MESSY),
}
