"""Evaluation aggregates (MSE, RMSE, R², adjusted R², MAPE), residuals and
truth-versus-prediction bins.

Every metric is one partial aggregate over (label, prediction): map-side
combine, one small shuffle, no collect. The grouped form shuffles only the
per-group partial sums, so a hot group costs nothing extra.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import abs_pct_err, safe_div, sq_err


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def present(c: Column) -> Column:
    """Neither NULL nor NaN."""
    return c.isNotNull() & ~F.isnan(c.cast("double"))


def number(name: str) -> Column:
    """The column with NaN read as NULL, so that every aggregate skips it."""
    c = F.col(name)
    return F.when(present(c), c)


def metric_aggs(label: str, prediction: str) -> list[Column]:
    """Raw partial-aggregate inputs of all metrics, over the complete rows
    (label and prediction present) only; the others are counted."""
    complete = present(F.col(label)) & present(F.col(prediction))
    y, p = F.when(complete, F.col(label)), F.when(complete, F.col(prediction))
    return [
        F.count(y).alias("n"),
        F.sum(sq_err(y, p)).alias("sse"),
        (F.var_pop(y) * F.count(y)).alias("sst"),
        F.avg(abs_pct_err(y, p)).alias("mape_raw"),
        F.count_if(y == 0).alias("n_zero_labels"),
        F.count_if(~complete).alias("n_incomplete"),
    ]


def regression_metrics(df: DataFrame, label: str, prediction: str, n_features: int,
                       group_cols: Sequence[str] = (), compat_rounding: bool = False,
                       digits: dict | None = None) -> DataFrame:
    """F1–F5 in one pass: n, mse, rmse, r2, r2_adj, mape, n_zero_labels and
    n_incomplete (rows without a label or a prediction, left out of the rest).

    ``digits`` maps metric → decimal places for the reported value (defaults:
    none = unrounded). Adjusted R² uses the unrounded R² unless
    ``compat_rounding`` (the original rounded R² to 2 digits first).
    """
    digits = digits or {}
    agg = (df.groupBy(*group_cols) if group_cols else df.groupBy()).agg(*metric_aggs(label, prediction))
    mse = safe_div(F.col("sse"), F.col("n"))
    r2 = 1 - safe_div(F.col("sse"), F.col("sst"))
    r2_for_adj = F.round(r2, 2) if compat_rounding else r2
    p = F.lit(n_features)
    r2_adj = 1 - safe_div((1 - r2_for_adj) * (F.col("n") - 1), F.col("n") - p - 1)
    r2_adj = F.when(F.col("n") > p + 1, r2_adj)
    return agg.select(
        *group_cols,
        F.col("n"),
        _round(mse, digits.get("mse")).alias("mse"),
        _round(F.sqrt(mse), digits.get("rmse")).alias("rmse"),
        _round(r2, digits.get("r2")).alias("r2"),
        _round(r2_adj, digits.get("r2_adj")).alias("r2_adj"),
        _round(F.col("mape_raw"), digits.get("mape")).alias("mape"),
        F.col("n_zero_labels"),
        F.col("n_incomplete"),
    )


# The original's reported precision: RMSE and R² to 2 places, MAPE to 3.
REPORT_DIGITS = {"rmse": 2, "r2": 2, "mape": 3}


def with_residual(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Signed error, prediction minus truth."""
    return df.withColumn("residual", F.col(prediction) - F.col(label))


def residual_summary(df: DataFrame, label: str, prediction: str, accuracy: int = 10000) -> DataFrame:
    """F6 summary: mean and approximate p05/p50/p95 of the residual.

    Quantiles use ``percentile_approx`` (bounded memory per task); an exact
    percentile would buffer a whole column in one task.
    """
    r = number(prediction) - number(label)
    return df.agg(
        F.count(r).alias("n"),
        F.avg(r).alias("mean"),
        F.percentile_approx(r, [0.05, 0.5, 0.95], accuracy).alias("q"),
    ).select("n", "mean", F.col("q")[0].alias("p05"), F.col("q")[1].alias("p50"), F.col("q")[2].alias("p95"))


def bin_expr(x: Column, lo: float, hi: float, bins: int) -> Column:
    """Equal-width bin 0..bins-1 on [lo, hi]; the top edge falls in the last
    bin; NULL and NaN have none."""
    x = F.when(present(x), x)
    if hi == lo:
        return F.when(x.isNotNull(), F.lit(0))
    b = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)).cast("int")
    return F.when(x.isNotNull(), F.least(b, F.lit(bins - 1)))


def min_max(df: DataFrame, cols: Sequence[str], per_pass: int = 45) -> dict[str, tuple[float, float]]:
    """Bounds of each column (NULL and NaN apart); only 2×len(cols) scalars reach the driver.
    One aggregate per ``per_pass`` columns keeps the buffer under the
    whole-stage-codegen field limit."""
    cols = list(cols)
    out: dict[str, tuple[float, float]] = {}
    for k in range(0, len(cols), per_pass):
        chunk = cols[k:k + per_pass]
        row = df.agg(*[F.min(number(c)).alias(f"mn_{i}") for i, c in enumerate(chunk)],
                     *[F.max(number(c)).alias(f"mx_{i}") for i, c in enumerate(chunk)]).first()
        out.update({c: (float(row[f"mn_{i}"]), float(row[f"mx_{i}"])) for i, c in enumerate(chunk)
                    if row[f"mn_{i}"] is not None})
    return out


def truth_vs_pred_bins(df: DataFrame, label: str, prediction: str, bins: int = 20) -> DataFrame:
    """2-D bin counts of (truth, prediction) on a shared axis range.

    Output size is bounded by bins² whatever the row count."""
    df = df.filter(present(F.col(label)) & present(F.col(prediction)))
    mm = min_max(df, [label, prediction])
    if len(mm) < 2:  # no complete row
        return df.select(F.lit(0).alias("truth_bin"), F.lit(0).alias("pred_bin"), F.lit(0).cast("long").alias("n")).limit(0)
    lo = min(mm[label][0], mm[prediction][0])
    hi = max(mm[label][1], mm[prediction][1])
    return (df.select(bin_expr(F.col(label), lo, hi, bins).alias("truth_bin"),
                      bin_expr(F.col(prediction), lo, hi, bins).alias("pred_bin"))
            .groupBy("truth_bin", "pred_bin").agg(F.count(F.lit(1)).alias("n")))


def residual_histogram(df: DataFrame, label: str, prediction: str, bins: int = 20) -> DataFrame:
    """F6 histogram of residuals."""
    r = with_residual(df.select(label, prediction), label, prediction).filter(present(F.col("residual")))
    lo, hi = min_max(r, ["residual"]).get("residual", (0.0, 0.0))
    return (r.select(bin_expr(F.col("residual"), lo, hi, bins).alias("bin"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
