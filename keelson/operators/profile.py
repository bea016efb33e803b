"""Column profiling: preview, missing / zero counts, histograms, pair-bin
grids, Pearson correlation, normality moments, categorical profile, shape.

Each profile is a single aggregate (or two: bounds, then bins) whose output
size depends on the number of columns and bins, never on the row count.
Wide-to-long reshaping happens after the aggregate, on one row.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions.exprs import safe_div
from keelson.operators.evaluate import bin_expr, min_max, number, present


def strict_drop(df: DataFrame, *cols: str) -> DataFrame:
    """B1: drop columns, refusing unknown names (Spark's drop ignores them)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown column(s): {missing}")
    return df.drop(*cols)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    num = ("double", "float", "int", "bigint", "smallint", "tinyint")
    return [c for c, t in df.dtypes if (t in num or t.startswith("decimal")) and c not in exclude]


def preview(df: DataFrame, order_cols: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (repeatable, unlike ``head``)."""
    return df.orderBy(*order_cols).limit(n)


def _long_form(row_df: DataFrame, names: Sequence[str], value_cols: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate with columns ``{value}_{i}`` into one row per
    input column (``column``, value...)."""
    structs = [F.struct(F.lit(c).alias("column"), *[F.col(f"{v}_{i}").alias(v) for v in value_cols])
               for i, c in enumerate(names)]
    return row_df.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


CODEGEN_FIELDS = 90  # aggregate buffer fields per aggregate, under spark.sql.codegen.maxFields (100)


def _per_column(df: DataFrame, cols: Sequence[str], aggs_for, value_cols: Sequence[str],
                fields_per_col: int) -> DataFrame:
    """Long form (column, values…) of per-column aggregates, computed in
    chunks of columns small enough that each aggregate stays inside
    whole-stage codegen; chunks are unioned (one scan each)."""
    cols = list(cols)
    step = max(1, CODEGEN_FIELDS // fields_per_col)
    out = None
    for k in range(0, len(cols), step):
        chunk = cols[k:k + step]
        one = df.agg(*[a for i, c in enumerate(chunk) for a in aggs_for(c, i)])
        part = _long_form(one, chunk, value_cols)
        out = part if out is None else out.unionByName(part)
    return out


def missing_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL (or NaN for floating columns) cells per column."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def aggs(c, i):
        cond = F.col(c).isNull()
        if types[c] in ("double", "float"):
            cond = cond | F.isnan(c)
        return [F.count_if(cond).alias(f"n_missing_{i}"), F.count(F.lit(1)).alias(f"n_rows_{i}")]

    return _per_column(df, cols, aggs, ["n_missing", "n_rows"], 2)


def zero_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cells equal to zero per numeric column."""
    cols = list(cols or numeric_columns(df))
    return _per_column(df, cols, lambda c, i: [F.count_if(F.col(c) == 0).alias(f"n_zero_{i}")], ["n_zero"], 1)


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bin counts per column (pair-plot diagonal).

    Pass 1: min/max of every column (one aggregate). Pass 2: one stacked
    (column, bin) key per cell, partially aggregated before the shuffle."""
    cols = list(cols)
    mm = min_max(df, cols)
    stacked = [F.struct(F.lit(c).alias("column"), bin_expr(F.col(c), *mm[c], bins).alias("bin"))
               for c in cols if c in mm]
    return (df.select(F.explode(F.array(*stacked)).alias("s")).select("s.*")
            .filter(F.col("bin").isNotNull())
            .groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n")))


def pair_bins(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """D3: 2-D bin counts for every column pair (pair-plot off-diagonal).

    Output is at most pairs × bins² rows at any input size. Where the bins of
    all columns together have at most :data:`CELLS` combinations the rows are
    grouped once by their combination, and the pairs are sums over those.
    Otherwise pairs are taken :data:`PAIRS_PER_AGGREGATE` at a time, so that a
    wide table's row is never exploded into all of its pairs at once."""
    cols = list(cols)
    mm = min_max(df, cols)
    binned = {c: bin_expr(F.col(c), *mm[c], bins) for c in cols if c in mm}
    pairs = list(combinations([c for c in cols if c in binned], 2))
    out, rows, per_part = None, df.withColumn("__n", F.lit(1)), PAIRS_PER_AGGREGATE
    if pairs and (bins + 1) ** len(binned) <= CELLS:
        names = {c: f"__b{i}" for i, c in enumerate(binned)}
        rows = df.select(*[binned[c].alias(n) for c, n in names.items()]).groupBy(*names.values()).agg(F.count(F.lit(1)).alias("__n"))
        binned, per_part = {c: F.col(n) for c, n in names.items()}, len(pairs)
    for k in range(0, len(pairs), per_part):
        stacked = [F.struct(F.lit(a).alias("x_col"), F.lit(b).alias("y_col"),
                            binned[a].alias("x_bin"), binned[b].alias("y_bin")) for a, b in pairs[k:k + per_part]]
        part = (rows.select("__n", F.explode(F.array(*stacked)).alias("s")).select("__n", "s.*")
                .filter(F.col("x_bin").isNotNull() & F.col("y_bin").isNotNull())
                .groupBy("x_col", "y_col", "x_bin", "y_bin").agg(F.sum("__n").alias("n")))
        out = part if out is None else out.unionByName(part)
    return out


CELLS = 1_000_000
PAIRS_PER_AGGREGATE = 15  # 6 sum buffers per pair: stays under spark.sql.codegen.maxFields (100)


def _pair_sums(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame | None:
    """One row of centred sums for ``pairs`` (rows where both sides are present).

    Pass 1 (one aggregate, scalars to the driver): the pairwise-complete
    means. Pass 2: n, Σdx, Σdy, Σdx·dy, Σdx², Σdy² of the centred values.
    Plain sums keep the aggregate inside whole-stage codegen (covar_pop /
    stddev_pop need far more buffer fields and fall back to the interpreted
    path), and centring keeps the sums free of cancellation."""
    both = [present(F.col(a)) & present(F.col(b)) for a, b in pairs]
    mrow = df.agg(*[F.avg(F.when(both[i], F.col(a))).alias(f"ma_{i}") for i, (a, _) in enumerate(pairs)],
                  *[F.avg(F.when(both[i], F.col(b))).alias(f"mb_{i}") for i, (_, b) in enumerate(pairs)]).first()
    aggs = []
    for i, (a, b) in enumerate(pairs):
        ma = 0.0 if mrow[f"ma_{i}"] is None else float(mrow[f"ma_{i}"])
        mb = 0.0 if mrow[f"mb_{i}"] is None else float(mrow[f"mb_{i}"])
        dx = F.when(both[i], F.col(a) - F.lit(ma))
        dy = F.when(both[i], F.col(b) - F.lit(mb))
        aggs += [F.count(dx).alias(f"n_{i}"), F.sum(dx).alias(f"sx_{i}"), F.sum(dy).alias(f"sy_{i}"),
                 F.sum(dx * dy).alias(f"sxy_{i}"), F.sum(dx * dx).alias(f"sxx_{i}"), F.sum(dy * dy).alias(f"syy_{i}")]
    return df.agg(*aggs)


def _pair_r(i: int) -> Column:
    n = F.col(f"n_{i}")
    cxy = F.col(f"sxy_{i}") - F.col(f"sx_{i}") * F.col(f"sy_{i}") / n
    cxx = F.col(f"sxx_{i}") - F.col(f"sx_{i}") * F.col(f"sx_{i}") / n
    cyy = F.col(f"syy_{i}") - F.col(f"sy_{i}") * F.col(f"sy_{i}") / n
    # NULL for a constant column (zero spread) instead of a division error
    return safe_div(cxy, F.sqrt(F.greatest(cxx, F.lit(0.0)) * F.greatest(cyy, F.lit(0.0))))


def pearson_pairs(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson r per pair in long form (col_a, col_b, r), pairwise complete.
    Pairs are processed in chunks of :data:`PAIRS_PER_AGGREGATE`."""
    pairs = list(pairs)
    out = None
    for k in range(0, len(pairs), PAIRS_PER_AGGREGATE):
        chunk = pairs[k:k + PAIRS_PER_AGGREGATE]
        sums = _pair_sums(df, chunk)
        rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), _pair_r(i).cast("double").alias("r"))
                for i, (a, b) in enumerate(chunk)]
        part = sums.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
        out = part if out is None else out.unionByName(part)
    return out


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (col_a, col_b, r), all ordered pairs.

    Pairwise complete (rows NULL in either column are skipped, like pandas);
    NULL r for a constant column instead of a division error; the diagonal is
    1 for a column that varies."""
    cols = list(cols)
    pairs = [(cols[i], cols[j]) for i, j in combinations(range(len(cols)), 2)]
    long = pearson_pairs(df, pairs + [(c, c) for c in cols])
    a, b, r = F.col("col_a"), F.col("col_b"), F.col("r")
    # one pass over the pair rows: (a, b) and (b, a) off the diagonal,
    # 1 (or NULL for a constant column) on it
    both_ways = F.array(F.struct(a.alias("col_a"), b.alias("col_b"), r.alias("r")),
                        F.struct(b.alias("col_a"), a.alias("col_b"), r.alias("r")))
    diagonal = F.array(F.struct(a.alias("col_a"), b.alias("col_b"),
                                F.when(r.isNotNull(), F.lit(1.0)).alias("r")))
    return long.select(F.explode(F.when(a == b, diagonal).otherwise(both_ways)).alias("s")).select("s.*")


def target_correlation(df: DataFrame, target: str, cols: Sequence[str]) -> DataFrame:
    """Correlation of each feature with the target, strongest first."""
    cols = [c for c in cols if c != target]
    out = pearson_pairs(df, [(c, target) for c in cols]).select(F.col("col_a").alias("column"), "r")
    # Rank on a bounded frame (one row per feature).
    ranked = out.select("column", "r", F.abs("r").alias("abs_r"))
    w_rank = F.expr("rank() OVER (ORDER BY abs(r) DESC NULLS LAST, column)")
    return ranked.select("column", "r", "abs_r", w_rank.alias("rank"))


def normality(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Mean, population stddev, skewness, excess kurtosis and the
    Jarque–Bera statistic n/6·(s² + k²/4) per column."""

    def aggs(c, i):
        x = number(c)
        return [F.count(x).alias(f"n_{i}"), F.avg(x).alias(f"mean_{i}"), F.stddev_pop(x).alias(f"stddev_{i}"),
                F.skewness(x).alias(f"skewness_{i}"), F.kurtosis(x).alias(f"kurtosis_{i}")]

    # buffers per column: count 1, avg 2, stddev 3, skewness 4, kurtosis 5
    out = _per_column(df, list(cols), aggs, ["n", "mean", "stddev", "skewness", "kurtosis"], 15)
    jb = F.col("n") / 6 * (F.col("skewness") * F.col("skewness") + F.col("kurtosis") * F.col("kurtosis") / 4)
    return out.withColumn("jarque_bera", jb)


def category_profile(df: DataFrame, category: str, target: str) -> DataFrame:
    """Per category count / mean / population stddev of the target, and
    eta² = 1 − within-group SS / total SS (how much the category explains).

    Groups are partially aggregated; the two totals are scalar subqueries,
    so no join and no collect."""
    y = number(target)
    groups = df.groupBy(category).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"), F.stddev_pop(y).alias("stddev"),
        (F.var_pop(y) * F.count(y)).alias("ss_within"))
    sst = df.agg((F.var_pop(y) * F.count(y)).alias("sst")).scalar()
    ssw = groups.agg(F.sum("ss_within")).scalar()
    eta2 = 1 - safe_div(ssw, sst)
    return groups.select(category, "n", "mean", "stddev", eta2.alias("eta2"))


def shape(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(rows, feature count) as one row."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_features", F.lit(len(features)))
