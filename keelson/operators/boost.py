"""Boosted regression trees on squared error with second-order, regularised
gains, fitted round by round.

A **booster** is one trial. It keeps its margins (what it says so far of every
row) between rounds, watches a metric of the test rows and stops ``patience``
rounds after its best one; what it keeps are the rounds up to that, nothing is
fitted twice. Rounds come in segments: every segment's trees and state are
written, so a lost task repeats a segment and :func:`boosters` can go on from a
state. Boosters of a search run side by side as rows of the same jobs.

Trees grow level by level to a depth (``grow.grow``), or best leaf first to a
number of leaves over binned features (:func:`best_first`). Rows are sampled
by their hashes, by the size of their gradients (one-sided sampling), or earlier
trees are dropped (dart).

Where the rows do not fit a task, :func:`boost_apart` runs the same rounds
with each tree grown by the jobs of ``forests``, or by passes over the rows
(:func:`leafwise_apart`), and the margins as a column of a written table.
"""

from __future__ import annotations

import heapq
import pickle
import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson import session as S
from keelson.functions.exprs import MAPE_EPS
from keelson.functions.quantiles import quantile_edges
from keelson.operators import grow as G
from keelson.operators.forests import PIECES, ForestModel, Frame, Plan, bin_edges, gathered, grown_apart, piece_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: rounds of a segment
SEGMENT = 250
ROWS, COLUMNS, DROP, SKIP, OTHERS = 901, 902, 903, 904, 905  # what a hash is drawn for


@dataclass(frozen=True)
class Boost:
    """How a booster is fitted. ``sampling``: 'rows' (each with probability
    ``subsample``), 'goss' (all of the ``top`` share by gradient and ``other``
    of the rest, weighted up, once 1 / rate rounds are done), 'dart' (all
    rows, earlier trees dropped) or 'none'."""

    settings: G.Settings
    rounds: int
    rate: float
    subsample: float = 1.0
    columns: float = 1.0
    sampling: str = "rows"
    bins: int = 0  # for trees grown best first
    watch: str = "squared"  # or 'percentage'
    patience: int = 0
    ones_weight: float = 1.0  # weight of rows whose label is exactly 1
    seed: int = 42
    top: float = 0.2
    other: float = 0.1
    drop: float = 0.1
    skip: float = 0.5


def best_first(codes: np.ndarray, edges: list[np.ndarray], y: np.ndarray, w: np.ndarray, rows: np.ndarray, s: G.Settings, root_hash: int) -> G.Tree:
    """Grow the leaf of the greatest gain until there are ``s.leaves``.
    ``codes``: bins by feature and row. Only the smaller child of a split is
    counted, the other is what its parent has besides."""
    n_features, size = len(edges), max(len(e) for e in edges) + 1
    flat = codes + (np.arange(n_features) * size)[:, None]
    wy = w * y

    def count(idx: np.ndarray) -> np.ndarray:
        at = flat[:, idx].ravel()
        some = [np.bincount(at, None if v is None else np.broadcast_to(v[idx], (n_features, len(idx))).ravel(), n_features * size) for v in (None, w, wy)]
        return np.stack(some).reshape(3, n_features, size).astype(np.float64)

    def best(sums: np.ndarray, depth: int) -> tuple[float, int, int]:
        n, sw, sy = sums[:, 0].sum(1)
        if n < max(s.split, 2 * s.leaf) or (s.depth is not None and depth >= s.depth):
            return -np.inf, -1, 0
        ln, lw, ly = np.cumsum(sums, 2)[:, :, :-1]
        ok = (ln >= s.leaf) & (n - ln >= s.leaf) & (lw > 0) & (sw - lw > 0) & (lw >= s.least_weight) & (sw - lw >= s.least_weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(ok, ly**2 / (lw + s.lam) + (sy - ly) ** 2 / (sw - lw + s.lam), -np.inf)
        at = int(score.argmax())
        f, b = divmod(at, size - 1)
        gain = (score.flat[at] - sy**2 / (sw + s.lam)) / 2
        return (float(gain), f, b) if gain > s.gamma else (-np.inf, -1, 0)

    feature, cut, left, value, n_rows, hashes = [], [], [], [], [], []

    def leaf(idx: np.ndarray, sums: np.ndarray, depth: int, node_hash: int) -> None:
        _, sw, sy = sums[:, 0].sum(1)
        feature.append(-1), cut.append(0.0), left.append(-1), value.append(sy / max(sw + s.lam, 1e-300)), n_rows.append(len(idx)), hashes.append(node_hash)
        gain, f, b = best(sums, depth)
        if f >= 0:
            heapq.heappush(queue, (-gain, len(value) - 1, f, b, depth, idx, sums))

    queue: list[tuple] = []
    leaf(rows, count(rows), 0, root_hash)
    leaves = 1
    while queue and (not s.leaves or leaves < s.leaves):
        _, node, f, b, depth, idx, sums = heapq.heappop(queue)
        side = codes[f, idx] <= b
        parts = idx[side], idx[~side]
        small = int(len(parts[0]) > len(parts[1]))
        few = count(parts[small])
        each = [few, sums - few] if not small else [sums - few, few]
        feature[node], cut[node], left[node] = f, float(edges[f][b]), len(value)
        for k, way in ((0, G.LEFT), (1, G.RIGHT)):
            leaf(parts[k], each[k], depth + 1, int(G.mixed(np.int64(hashes[node]), np.int64(way))))
        leaves += 1
    as_array = [np.array(c, t) for c, t in zip((feature, cut, left, value, n_rows, hashes), (np.int16, float, np.int32, float, np.int64, np.int64))]
    return G.Tree(*as_array)


@dataclass
class State:
    """A booster between two segments."""

    said: np.ndarray  # margins of the fitting rows
    told: np.ndarray  # margins of the test rows
    base: float
    done: int = 0
    best: float = np.inf
    best_round: int = 0
    finished: bool = False
    trees: list = field(default_factory=list)  # dart: (tree, weight), both needed to drop a tree
    best_told: np.ndarray | None = None


def uniform(hashes: np.ndarray, key: int, what: int) -> np.ndarray:
    return G.mixed(hashes, G.mixed(np.int64(key), np.int64(what))) / G.P


def loss(y: np.ndarray, p: np.ndarray, watch: str) -> float:
    if watch == "percentage":
        return float(np.mean(np.abs(y - p) / np.maximum(np.abs(y), MAPE_EPS)))
    return float(np.mean((y - p) ** 2))


def tree_columns(key: int, n: int, share: float) -> np.ndarray:
    """The features a round's tree may use."""
    m = max(1, int(share * n + 1e-9))
    return np.flatnonzero(G.chosen_features(np.array([G.mixed(np.int64(key), np.int64(COLUMNS))]), n, m)[0])


def row_weights(b: Boost, done: int, key: int, hashes: np.ndarray, y: np.ndarray, residual: np.ndarray) -> np.ndarray:
    w = np.where(y == 1.0, b.ones_weight, 1.0)
    if b.sampling == "rows" and b.subsample < 1:
        w = np.where(uniform(hashes, key, ROWS) < b.subsample, w, 0.0)
    if b.sampling == "goss" and done >= int(1 / b.rate):
        size = np.abs(residual) * w
        large = size >= np.partition(size, len(size) - max(1, int(b.top * len(size))))[len(size) - max(1, int(b.top * len(size)))]
        chosen = uniform(hashes, key, OTHERS) < b.other / (1 - b.top)
        w = np.where(large, w, np.where(chosen, w * (1 - b.top) / b.other, 0.0))
    return w if w.any() else np.ones(len(y))  # of a few rows none may be drawn


class Rows:
    """The arrays a task boosts over."""

    def __init__(self, fit: dict[str, np.ndarray], test: dict[str, np.ndarray], bins: int):
        self.fit, self.test = fit, test
        self.edges = self.codes = None
        if bins:
            self.edges = [binned_edges(v, bins) for v in fit["x"]]
            self.codes = np.stack([np.searchsorted(e, v, "left") for e, v in zip(self.edges, fit["x"])]).astype(np.int64)


def binned_edges(v: np.ndarray, bins: int) -> np.ndarray:
    """The values at equal ranks: what :func:`quantile_edges` gives of a table."""
    ranks = np.ceil(np.arange(1, bins) / bins * len(v) - 1e-9).astype(np.int64)
    return np.unique(np.sort(v)[np.maximum(ranks, 1) - 1]) if len(v) else v


def one_round(b: Boost, st: State, rows: Rows) -> G.Tree:
    """Fit the next tree and move the margins by it. Returns the tree with its values as they count."""
    fit, test = rows.fit, rows.test
    key = G.tree_hash(b.seed, st.done)
    dropped = []
    said = st.said
    if b.sampling == "dart" and st.trees and uniform(np.array([key]), key, SKIP)[0] >= b.skip:
        dropped = np.flatnonzero(uniform(np.arange(len(st.trees), dtype=np.int64), key, DROP) < b.drop)[:50].tolist()
        for i in dropped:
            tree, weight, leaves, _ = st.trees[i]
            said = said - weight * tree.value[leaves]
    residual = fit["y"] - said
    w = row_weights(b, st.done, key, fit["hash"], fit["y"], residual)
    cols = tree_columns(key, len(fit["x"]), b.columns)
    if b.bins:
        tree = best_first(rows.codes[cols], [rows.edges[c] for c in cols], residual, w, np.flatnonzero(w > 0), b.settings, key)
    else:
        order = fit["order"][cols]
        order = order[np.broadcast_to(w[order] > 0, order.shape)].reshape(len(cols), -1)
        tree, _ = G.grow(fit["x"][cols], order, residual, w, b.settings, key)
    tree.feature = np.where(tree.feature >= 0, cols[tree.feature], -1).astype(np.int16)
    leaves, told = tree.leaf_of(fit["x"]), tree.leaf_of(test["x"])
    k = len(dropped)
    weight = b.rate / (k + b.rate) if k else b.rate  # dropped and new trees share what the dropped ones said
    for i in dropped:
        old, own, at, test_at = st.trees[i]
        less = own * k / (k + b.rate)
        st.said = st.said + (less - own) * old.value[at]
        st.told = st.told + (less - own) * old.value[test_at]
        st.trees[i] = (old, less, at, test_at)
    st.said = st.said + weight * tree.value[leaves]
    st.told = st.told + weight * tree.value[told]
    if b.sampling == "dart":
        st.trees.append((tree, weight, leaves.astype(np.int16), told.astype(np.int16)))
    st.done += 1
    if len(test["y"]):
        now = loss(test["y"], st.told, b.watch)
        if b.sampling == "dart":  # later rounds change earlier trees: all are kept
            st.best, st.best_round = now, st.done
        elif now < st.best:
            st.best, st.best_round, st.best_told = now, st.done, st.told
        st.finished = bool(b.patience) and st.done - st.best_round >= b.patience
    else:
        st.best_round = st.done
    st.finished |= st.done >= b.rounds
    return G.Tree(tree.feature, tree.cut, tree.left, weight * tree.value, tree.rows, tree.hash)


def start(b: Boost, rows: Rows) -> State:
    y = rows.fit["y"]
    base = float(np.average(y, weights=np.where(y == 1.0, b.ones_weight, 1.0))) if len(y) else 0.0
    return State(np.full(len(y), base), np.full(len(rows.test["y"]), base), base)


STATE = "trial long, done long, best double, best_round long, finished boolean, base double, state binary"


def boosters(frame: Frame, plans: dict[int, Boost], states: DataFrame | None = None, nodes: str | None = None) -> DataFrame:
    """Fit every booster of ``plans``; the table of their last states. Trees
    are written under ``nodes`` if given, one folder a segment. ``states``
    goes on from such a table (the boosters in it that are not finished)."""
    spark = frame.rows.sparkSession
    shared = frame.whole()
    folder = S.work_dir(spark, "boost")
    ended, segment = None, 0
    live = spark.createDataFrame([(t, None) for t in plans], "trial long, state binary") if states is None else states.filter("not finished").select("trial", "state")
    ended = None if states is None else states.filter("finished")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, test = shared.value
        for batch in batches:
            for trial, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                b = plans[trial]
                rows = Rows(fit, test, b.bins)
                st = pickle.loads(raw) if raw is not None else start(b, rows)
                for _ in range(SEGMENT):
                    if st.finished:
                        break
                    at, tree = st.done, one_round(b, st, rows)
                    if nodes and b.sampling != "dart":
                        yield padded(piece_of(tree, trial, 1, at))
                if nodes and b.sampling == "dart" and st.finished:  # weights are final only now
                    for at, (tree, weight, _, _) in enumerate(st.trees):
                        yield padded(piece_of(G.Tree(tree.feature, tree.cut, tree.left, weight * tree.value, tree.rows, tree.hash), trial, 1, at))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in ((trial, pa.int64()), (st.done, pa.int64()), (st.best, pa.float64()), (st.best_round, pa.int64()),
                                                   (st.finished, pa.bool_()), (st.base, pa.float64()), (cloudpickle.dumps(st), pa.binary()))]
                    + [pa.nulls(1, f.type) for f in list(EMPTY.schema)[1:]], [*STATE_NAMES, *EMPTY.schema.names[1:]])

    while not live.isEmpty():
        out = f"{folder}/{segment}"
        n = max(1, live.count())
        live.repartitionByRange(n, "trial").mapInArrow(run, f"{STATE}, {PIECES}").write.parquet(out)
        found = spark.read.parquet(out)
        if nodes:
            found.filter("tree is not null").drop(*STATE_NAMES[1:]).write.parquet(f"{nodes}/segment={segment}")
        now = found.filter("state is not null").select(*STATE_NAMES)
        ended = now.filter("finished") if ended is None else ended.unionAll(now.filter("finished"))
        live = now.filter("not finished").select("trial", "state")
        segment += 1
    return ended


STATE_NAMES = ["trial", "done", "best", "best_round", "finished", "base", "state"]
EMPTY = piece_of(G.Tree(*(np.zeros(1, t) for t in (np.int16, float, np.int32, float, np.int64, np.int64))), 0, 1, 0)


def padded(piece: pa.RecordBatch) -> pa.RecordBatch:
    """A tree, of one row or more, among the rows of states."""
    types = (pa.int64(), pa.float64(), pa.int64(), pa.bool_(), pa.float64(), pa.binary())
    return pa.RecordBatch.from_arrays([piece.column(0), *(pa.nulls(piece.num_rows, t) for t in types), *piece.columns[1:]], [*STATE_NAMES, *piece.schema.names[1:]])


def boosters_of(frame: Frame, plans: dict[int, Boost]) -> DataFrame:
    """What every booster's best rounds say of every test row: trial, id, y, prediction."""
    labels = frame.rows.filter("part = 1").select("id", "y")
    if not frame.fits:
        out = None
        for trial, b in plans.items():
            model = boost_apart(frame, b)
            test = frame.rows.filter("part = 1").select("id", "y", *[F.col("x")[i].alias(c) for i, c in enumerate(frame.features)])
            own = model.transform(test).select(F.lit(trial).cast("long").alias("trial"), "id", "y", "prediction")
            out = own if out is None else out.unionAll(own)
        return out
    shared = frame.whole()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, test = shared.value
        for batch in batches:
            for trial, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                st = pickle.loads(raw)
                said = st.told if st.best_told is None else st.best_told
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(said), trial, np.int64)), pa.array(test["id"]), pa.array(said)], ["trial", "id", "prediction"])

    said = boosters(frame, plans).select("trial", "state").mapInArrow(run, "trial long, id long, prediction double")
    return said.join(labels, "id").select("trial", "id", "y", "prediction")


def fit_boosted(frame: Frame, b: Boost) -> ForestModel:
    """Fit one booster and keep its rounds up to the best one."""
    if not frame.fits:
        return boost_apart(frame, b)
    spark = frame.rows.sparkSession
    path = S.work_dir(spark, "boosted")
    end = boosters(frame, {0: b}, nodes=f"{path}/rounds").select("done", "best_round", "base").first()
    kept = spark.read.parquet(f"{path}/rounds").filter(F.col("tree") < end["best_round"]).drop("segment", "trial")
    kept.write.parquet(f"{path}/trees")
    return ForestModel.written(spark, path, frame.features, "sum", end["base"], {"rounds_fitted": end["done"], "rounds_kept": end["best_round"]})


def said_by(trees: list[tuple[G.Tree, float]], features: int):
    """A column: the sum of small trees' values for the features of ``x``, each
    times its number. At most as many nodes as the rounds have leaves are sent along."""
    packed = cloudpickle.dumps([(t.feature, t.cut, t.left, c * t.value) for t, c in trees])

    @F.pandas_udf("double")
    def add(x):
        import pandas as pd

        flat = np.stack(x.to_numpy()).T if len(x) else np.empty((features, 0))
        out = np.zeros(len(x))
        for feature, cut, left, value in pickle.loads(packed):
            out += value[G.Tree(feature, cut, left, value, value, value).leaf_of(flat)]
        return pd.Series(out)

    return add(F.col("x"))


def node_sums(rows: DataFrame, tree: G.Tree, wanted: list[int], edges: list[np.ndarray], cols: np.ndarray) -> dict[int, np.ndarray]:
    """Sums (rows, weight, weighted target) over (node, feature, bin) of the
    wanted nodes: partial in the tasks, added up by Spark; a node's sums are
    at most features x bins rows."""
    size = max(len(edges[c]) for c in cols) + 1
    n_features, cells = len(cols), len(cols) * size
    packed = cloudpickle.dumps((tree, [edges[c] for c in cols], {n: i for i, n in enumerate(wanted)}))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, own, slot = pickle.loads(packed)
        slots = np.full(len(tree.feature), -1, np.int64)
        slots[list(slot)] = list(slot.values())
        sums = np.zeros((3, len(slot) * cells))
        for batch in gathered(batches):
            n = batch.num_rows
            x = np.ascontiguousarray(batch.column("x").flatten().to_numpy().reshape(n, -1).T) if n else np.empty((1, 0))
            if not n:
                continue
            y, w = batch.column("y").to_numpy(), batch.column("w").to_numpy()
            at = slots[tree.leaf_of(x)]
            some = np.flatnonzero((at >= 0) & (w > 0))
            for f in range(n_features):
                cell = at[some] * cells + f * size + np.searchsorted(own[f], x[cols[f], some], "left")
                for k, v in enumerate((None, w[some], w[some] * y[some])):
                    sums[k] += np.bincount(cell, v, sums.shape[1])
        full = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(v[full]) for v in sums)], ["cell", "n", "w", "wy"])

    found = rows.select("x", "y", "w").mapInArrow(run, "cell long, n double, w double, wy double").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("w").alias("w"), F.sum("wy").alias("wy")).toArrow()
    out = np.zeros((3, len(wanted) * cells))
    out[:, found.column("cell").to_numpy()] = [found.column(c).to_numpy() for c in ("n", "w", "wy")]
    by_node = out.reshape(3, len(wanted), n_features, size)
    return {n: by_node[:, i] for i, n in enumerate(wanted)}


def best_first_apart(rows: DataFrame, edges: list[np.ndarray], cols: np.ndarray, s: G.Settings, root_hash: int) -> G.Tree:
    """The tree of :func:`best_first` over a table (x, y, w). A pass counts
    the leaves that are not yet known and, ahead of time, the children that
    the best known leaves would have, so passes are about as many as levels."""
    feature, cut, left, value, n_rows, depth = [-1], [0.0], [-1], [0.0], [0], [0]
    known: dict[int, tuple] = {}  # node -> (gain, column, bin)
    children: dict[int, int] = {}

    def best(sums: np.ndarray, node: int) -> tuple[float, int, int]:
        n, sw, sy = sums[:, 0].sum(1)
        value[node], n_rows[node] = sy / max(sw + s.lam, 1e-300), int(n)
        if n < max(s.split, 2 * s.leaf) or (s.depth is not None and depth[node] >= s.depth):
            return -np.inf, -1, 0
        ln, lw, ly = np.cumsum(sums, 2)[:, :, :-1]
        ok = (ln >= s.leaf) & (n - ln >= s.leaf) & (lw > 0) & (sw - lw > 0) & (lw >= s.least_weight) & (sw - lw >= s.least_weight)
        with np.errstate(divide="ignore", invalid="ignore"):
            score = np.where(ok, ly**2 / (lw + s.lam) + (sy - ly) ** 2 / (sw - lw + s.lam), -np.inf)
        at = int(score.argmax())
        gain = (score.flat[at] - sy**2 / (sw + s.lam)) / 2
        return (float(gain), *divmod(at, score.shape[1])) if gain > s.gamma else (-np.inf, -1, 0)

    def ahead(node: int) -> None:
        """Give a known node the children its best split makes."""
        if node not in children and known[node][1] >= 0:
            children[node] = len(value)
            for _ in range(2):
                for v, new in ((feature, -1), (cut, 0.0), (left, -1), (value, 0.0), (n_rows, 0), (depth, depth[node] + 1)):
                    v.append(new)
            _, f, b = known[node]
            feature[node], cut[node], left[node] = int(cols[f]), float(edges[cols[f]][b]), children[node]

    def arrays(splits: set[int]) -> G.Tree:
        inner = np.isin(np.arange(len(value)), list(splits))
        return G.Tree(np.where(inner, feature, -1).astype(np.int16), np.array(cut), np.array(left, np.int32), np.array(value), np.array(n_rows), np.zeros(len(value), np.int64))

    leaves, splits = {0}, set()
    while True:
        unknown = [n for n in leaves if n not in known]
        if not unknown:
            node = max(leaves, key=lambda n: (known[n][0], -n))
            if known[node][1] < 0 or (s.leaves and len(leaves) >= s.leaves):
                break
            ahead(node)
            splits.add(node)
            leaves = leaves - {node} | {children[node], children[node] + 1}
            continue
        room = (s.leaves or 1 << 30) - len(leaves)
        for node in sorted((n for n in leaves if n in known and known[n][1] >= 0), key=lambda n: -known[n][0])[:max(room, 0)]:
            ahead(node)
        wanted = sorted({c for n, first in children.items() for c in (first, first + 1) if c not in known} | set(unknown))
        for n, sums in node_sums(rows, arrays(set(children)), wanted, edges, cols).items():
            known[n] = best(sums, n)
    # only what was split stays, numbered as it was made
    order = sorted(n for n in range(len(value)) if n in leaves or n in splits)
    place = {n: i for i, n in enumerate(order)}
    t, keep = arrays(splits), np.array(order)
    hashes = np.full(len(order), root_hash, np.int64)
    return G.Tree(t.feature[keep], t.cut[keep], np.array([place[left[n]] if n in splits else -1 for n in order], np.int32), t.value[keep], t.rows[keep], hashes)


def leafwise_apart(frame: Frame, b: Boost) -> ForestModel:
    """The rounds of a leaf-wise booster over more rows than a task takes:
    trees by passes over the rows, margins as a column of a written table,
    the trees (of a bounded number of leaves) on the driver."""
    spark = frame.rows.sparkSession
    folder = S.work_dir(spark, "boosted")
    n_features = len(frame.features)
    fit_part = F.col("part") == 0
    edges = [np.unique(np.array([v for v in e if v is not None])) for e in quantile_edges(
        frame.rows.filter(fit_part), [F.col("x")[f] for f in range(n_features)], [i / b.bins for i in range(1, b.bins)])]
    own = F.when(F.col("y") == 1.0, F.lit(float(b.ones_weight))).otherwise(F.lit(1.0))
    base = float(frame.rows.filter(fit_part).agg(F.sum(own * F.col("y")) / F.sum(own)).first()[0])
    rows = frame.rows.withColumn("said", F.lit(base))
    trees: list[list] = []
    best, best_round, done = np.inf, 0, 0
    draw = lambda key, what: F.expr(G.mixed_sql("row_hash", str(int(G.mixed(np.int64(key), np.int64(what)))))) / F.lit(float(G.P))
    while done < b.rounds:
        key = G.tree_hash(b.seed, done)
        dropped = []
        if b.sampling == "dart" and trees and uniform(np.array([key]), key, SKIP)[0] >= b.skip:
            dropped = np.flatnonzero(uniform(np.arange(len(trees), dtype=np.int64), key, DROP) < b.drop)[:50].tolist()
        said = F.col("said") - said_by([(trees[i][0], trees[i][1]) for i in dropped], n_features) if dropped else F.col("said")
        fit = rows.filter(fit_part).select("x", "row_hash", own.alias("own"), (F.col("y") - said).alias("y"))
        w = F.col("own")
        if b.sampling == "rows" and b.subsample < 1:
            w = F.when(draw(key, ROWS) < b.subsample, w).otherwise(0.0)
        if b.sampling == "goss" and done >= int(1 / b.rate):
            size = F.abs("y") * F.col("own")
            top_n = max(1, int(b.top * frame.n_fit))
            bound = quantile_edges(fit, [size], [(frame.n_fit - top_n + 1) / frame.n_fit])[0][0]
            w = F.when(size >= bound, w).otherwise(F.when(draw(key, OTHERS) < b.other / (1 - b.top), w * (1 - b.top) / b.other).otherwise(0.0))
        cols = tree_columns(key, n_features, b.columns)
        tree = best_first_apart(fit.withColumn("w", w), edges, cols, b.settings, key)
        k = len(dropped)
        weight = b.rate / (k + b.rate) if k else b.rate
        moves = [(tree, weight)]
        for i in dropped:
            less = trees[i][1] * k / (k + b.rate)
            moves.append((trees[i][0], less - trees[i][1]))
            trees[i][1] = less
        trees.append([tree, weight])
        rows.withColumn("said", F.col("said") + said_by(moves, n_features)).write.parquet(f"{folder}/rows/{done}")
        rows = spark.read.parquet(f"{folder}/rows/{done}")
        done += 1
        now = watched(rows, b.watch)
        if now is None or b.sampling == "dart":
            best_round = done
        elif now < best:
            best, best_round = now, done
        if b.patience and now is not None and done - best_round >= b.patience:
            break
    pieces = [piece_of(G.Tree(t.feature, t.cut, t.left, c * t.value, t.rows, t.hash), 0, 1, i) for i, (t, c) in enumerate(trees[:best_round])]
    spark.createDataFrame(pa.Table.from_batches(pieces)).drop("trial").write.parquet(f"{folder}/trees")
    return ForestModel.written(spark, folder, frame.features, "sum", base, {"rounds_fitted": done, "rounds_kept": best_round})


def watched(rows: DataFrame, watch: str) -> float | None:
    """The metric of the test rows, None without any."""
    err = F.abs(F.col("y") - F.col("said")) / F.greatest(F.abs("y"), F.lit(MAPE_EPS)) if watch == "percentage" else F.pow(F.col("y") - F.col("said"), 2)
    return rows.filter("part = 1").select(F.avg(err)).first()[0]


def boost_apart(frame: Frame, b: Boost, every: int = 1) -> ForestModel:
    """The rounds of a booster over more rows than a task takes: a tree by the
    jobs of ``forests`` over the residuals, then the margins moved by it and
    written."""
    if b.bins:
        return leafwise_apart(frame, b)
    spark = frame.rows.sparkSession
    folder = S.work_dir(spark, "boosted")
    own = F.when(F.col("y") == 1.0, F.lit(float(b.ones_weight))).otherwise(F.lit(1.0))
    base = frame.rows.filter("part = 0").select(F.sum(own * F.col("y")) / F.sum(own)).first()[0]
    rows = frame.rows.withColumn("said", F.lit(float(base))).withColumn("w", own)
    edges = bin_edges(frame.rows.filter("part = 0"), len(frame.features))  # of all rounds: features do not change
    best, best_round, done = np.inf, 0, 0
    while done < b.rounds:
        key = G.tree_hash(b.seed, done)
        cols = tree_columns(key, len(frame.features), b.columns)
        hashed = f"{G.mixed_sql('row_hash', str(int(G.mixed(np.int64(key), np.int64(ROWS)))))} / {G.P}"
        fit = rows.withColumn("y", F.when(F.col("part") == 0, F.col("y") - F.col("said")).otherwise(F.col("y"))).withColumn(
            "x", F.array(*[F.col("x")[int(c)] for c in cols]))
        if b.subsample < 1 and b.sampling == "rows":
            fit = fit.filter(F.expr(f"part = 1 or {hashed} < {b.subsample}"))
        own = Frame(fit.drop("said"), [frame.features[c] for c in cols], frame.n_fit, frame.n_test, frame.handoff)
        path = f"{folder}/nodes/round={done}"
        plan = {0: Plan(b.settings, 1, b.seed)}
        scaled = F.zip_with("feature", "number", lambda f, v: F.when(f < 0, v * b.rate).otherwise(v))
        grown_apart(own, plan, [(0, done, 1)], [edges[c] for c in cols]).drop("trial").withColumn("number", scaled).write.parquet(path)
        tree = ForestModel(spark.read.schema(PIECES).parquet(path), own.features, "sum")
        wide = rows.select("*", *[F.col("x")[int(c)].alias(frame.features[c]) for c in cols])
        moved = tree.transform(wide).withColumn("said", F.col("said") + F.col("prediction")).select(*rows.columns)
        moved.write.parquet(f"{folder}/rows/{done}")
        rows = spark.read.parquet(f"{folder}/rows/{done}")
        done += 1
        now = watched(rows, b.watch)
        if now is not None and now < best:
            best, best_round = now, done
        if now is None:
            best_round = done
        if b.patience and done - best_round >= b.patience:
            break
    # features of a round are numbered among its own columns
    kept = None
    for r in range(best_round):
        cols = tree_columns(G.tree_hash(b.seed, r), len(frame.features), b.columns)
        of = F.array(*[F.lit(int(c)) for c in cols])
        renamed = F.transform("feature", lambda f: F.when(f >= 0, F.element_at(of, f + 1)).otherwise(-1)).cast("array<smallint>")
        part = spark.read.schema(PIECES).parquet(f"{folder}/nodes/round={r}").withColumn("feature", renamed)
        kept = part if kept is None else kept.unionAll(part)
    kept.write.parquet(f"{folder}/trees")
    return ForestModel.written(spark, folder, frame.features, "sum", float(base), {"rounds_fitted": done, "rounds_kept": best_round})
