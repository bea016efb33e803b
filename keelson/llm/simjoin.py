"""N-gram Jaccard join (operator 6).

Documents whose sets of distinct ``size``-word shingles (three) overlap by at least
``percent`` of their union are linked; the result is each document's component.

Documents with equal sets are one class from the start. Classes find each
other by a prefix-filter join over inverted lists of hashed shingles. A set of
n shingles can only be linked to one that holds at least one of its first
n - T + 1 shingles, T the overlap the threshold asks for, in any one order of
all shingles. The order puts shingles in more than ``long_list`` documents behind
the others, the most frequent last, so most lists joined are short; there is no
merge that counts occurrences and no probe of long lists apart from the others.
A pair meets only in a shingle that is among the first n - T + 1 of both sets,
T for their own two sizes: the first shingle that two linked sets share always
is. A pair is decided by hashing both texts again and looking up all shingles
in sorted sets.

Only a linked component matters, so where many pairs of a list are apart its
classes are compared with a few pivots first; classes that the pivots link are
merged, and other pivots follow while many pairs are still apart. All pairs of a
list that are then in different components are compared in full. No link between
different texts is lost.

Shingles are counted over all rows; the counts only decide the order, any order
gives the same links. First shingles that one set alone has cannot lead to
another document; a bitmap of fixed size drops them before they are shuffled.

Cases: a text of fewer than ``size`` words has its whole sequence as its one shingle;
null, empty and blank texts have no shingles and are linked with nothing;
repeated rows are one class; a null id never names a component, unless all of
its rows are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.common import Shared, cutoff, id_and_bytes, kept, let_go, maybe_in, seen_bits, table, written
from keelson.llm.components import components

LOW = np.uint64(2**64 // 5)  # the fifth of the shingles that pairs are ruled out by
PIVOTS, LISTS, TRIES = 8, 4, 6  # of a round: pivots of a list, lists that a kind asks in, pairs of a kind
BUCKETS = 10  # bits of a shingle that say where it is counted
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Hashes(dict):
    """64-bit word hashes, computed once."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingles:
    """Sorted distinct 64-bit shingle hashes of a text."""

    def __init__(self, size: int = 3, cache_words: int = 400_000):
        self.size, self.most, self.cache = size, cache_words, Hashes()

    def of(self, text: bytes) -> np.ndarray:
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        cache = self.cache
        if len(cache) > self.most:
            cache.clear()
        x = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
        k = min(self.size, len(x))
        n = len(x) - k + 1
        h = np.full(n, k, np.uint64)
        for j in range(k):
            h = (h ^ x[j:j + n]) * M1
            h ^= h >> np.uint64(32)
        h *= M2
        return np.unique(h ^ (h >> np.uint64(29)))


def needed(n: int, other: int, percent: int) -> int:
    """The least overlap of two sets of these sizes that are linked."""
    return -(-percent * (n + other) // (100 + percent))


def reach(n: int, percent: int) -> int:
    """How many first shingles every linked set must share one of."""
    return n - -(-percent * n // 100) + 1


def named_texts(docs: DataFrame) -> DataFrame:
    return id_and_bytes(docs, F.xxhash64("doc_id", "text").alias("row"))


def name_of(shingles: np.ndarray) -> int:
    """The name of a set, as a signed 64-bit number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def describe(docs: DataFrame, order: Shared, percent: int, size: int = 3) -> DataFrame:
    """Per row: doc_id, row (a name of id and text), n_shingles, kind (a name
    of the set), the fifth of the shingles that pairs are ruled out by, cut
    to 31 bits, and the set's first shingles in the order of :func:`frequent`
    (null where this worker gave those of an equal set a short while ago)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs, counts = order.value
        shingles, seen = Shingles(size), set()
        for batch in batches:
            sets = [shingles.of(t) for t in batch.column(1).to_pylist()]
            kinds = [name_of(s) if len(s) else None for s in sets]
            low = [np.unique((s[:np.searchsorted(s, LOW)] & np.uint64(0x7FFFFFFF)).astype(np.int32)) for s in sets]
            first = []
            for s, kind in zip(sets, kinds):
                new = kind is not None and kind not in seen
                if new:
                    if len(seen) > 500_000:
                        seen.clear()
                    seen.add(kind)
                first.append(first_shingles(s, reach(len(s), percent), longs, counts) if new else s[:0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(kinds, pa.int64()),
                 pa.ListArray.from_arrays(np.cumsum([0, *map(len, low)]).astype(np.int32), np.concatenate([*low, np.zeros(0, np.int32)])),
                 pa.ListArray.from_arrays(np.cumsum([0, *map(len, first)]).astype(np.int32), np.concatenate([*first, np.zeros(0, np.uint64)]).view(np.int64))],
                ["doc_id", "row", "n_shingles", "kind", "low", "first"])

    return named_texts(docs).mapInArrow(run, "doc_id long, row long, n_shingles long, kind long, low array<int>, first array<long>")


def packed(x: np.ndarray) -> bytes:
    """Numbers byte by byte, the first bytes of all before the second ones: sorted ones compress well so."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()


def unpacked(raw: bytes, kind: type) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """One sorted list of shingles with their counts from several."""
    if len(parts) == 1:
        return parts[0]
    found, n = (np.concatenate(v) for v in zip(*parts))
    order = np.argsort(found)
    found, n = found[order], n[order]
    heads = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return found[heads], np.add.reduceat(n, heads)


def frequent(docs: DataFrame, size: int, long_list: int, longest_lists: int, flush: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """The shingles in more than ``long_list`` documents, the ``longest_lists``
    most frequent at most, and their counts over all rows. Tasks count blocks
    of about ``flush`` shingles; the sorted parts of a block are shuffled, not
    a row for each shingle, and added up a part at a time."""
    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held, n_held = Shingles(size), [], 0

        def emit() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            ends = np.searchsorted(found, np.arange(1, 1 << BUCKETS, dtype=np.uint64) << np.uint64(64 - BUCKETS))
            own = [(k, packed(f), packed(c)) for k, (f, c) in enumerate(zip(np.split(found, ends), np.split(n.astype(np.int32), ends))) if len(f)]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in own], t) for i, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], ["bucket", "shingle", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(shingles.of(text))
                n_held += len(held[-1])
                if n_held > flush:
                    yield emit()
                    held, n_held = [], 0
        yield emit()

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, n_new, at = [], 0, None

        def emit() -> pa.RecordBatch:
            found, n = added_up(own)
            often = n > long_list
            return pa.RecordBatch.from_arrays([pa.array(found[often].view(np.int64)), pa.array(n[often])], ["shingle", "n"])

        for batch in batches:
            for bucket, raw, n in zip(*(batch.column(i) for i in range(3))):
                if own and bucket.as_py() != at:
                    yield emit()
                    own, n_new = [], 0
                at = bucket.as_py()
                own.append((unpacked(raw.as_py(), np.uint64), unpacked(n.as_py(), np.int32).astype(np.int64)))
                n_new += len(own[-1][0])
                if n_new > max(flush, len(own[0][0])):  # as many as are added up already
                    own, n_new = [added_up(own)], 0
        if own:
            yield emit()

    dealt = named_texts(docs).select("text").mapInArrow(blocks, "bucket int, shingle binary, n binary").repartition("bucket").sortWithinPartitions("bucket")
    counts = kept(dealt.mapInArrow(add, "shingle long, n long"))
    longs = counts.filter(F.col("n") >= cutoff(counts, "n", longest_lists)).toArrow()  # at most longest_lists rows
    let_go(counts)
    found, n = longs.column(0).to_numpy().view(np.uint64), longs.column(1).to_numpy()
    order = np.argsort(found)
    return found[order], n[order]


def first_shingles(s: np.ndarray, most: int, longs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set: those not in ``longs`` come before
    the others, these by their counts."""
    if not len(longs):
        return s[:most]
    at = np.minimum(np.searchsorted(longs, s), len(longs) - 1)
    late = longs[at] == s
    first = s[~late][:most]
    if len(first) < most:
        behind = s[late]
        first = np.concatenate([first, behind[np.argsort(counts[at[late]], kind="stable")][:most - len(first)]])
    return first


def merged_shingles(rows: DataFrame) -> DataFrame:
    """(shingle, kind, n, at): what each set puts into the inverted lists, with
    its place among the set's first ones."""
    entries = rows.filter("kind is not null").select("kind", F.col("n_shingles").cast("int").alias("n"), F.posexplode("first").alias("at", "shingle")).select(
        "shingle", "kind", "n", "at")
    twice = kept(entries.groupBy("shingle").agg(F.count(F.lit(1)).alias("times")).filter("times > 1").select("shingle"))
    found = kept(maybe_only(entries, "shingle", seen_bits(twice, "shingle")).distinct())
    let_go(twice)
    return found


def maybe_only(df: DataFrame, key: str, bitmap, keep: bool = True) -> DataFrame:
    """The rows whose key may be in the bitmap (or, not ``keep``, is surely
    not), before any shuffle."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe_in(bitmap.value, batch.column(key).to_numpy()) == keep))

    return df.mapInArrow(run, df.schema)


def both_sides(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """(a, b) with the columns of ``table`` (by kind) for a and, with a ``2``
    at the end, for b."""
    one = table.withColumnRenamed("kind", "a")
    two = table.select(F.col("kind").alias("b"), *[F.col(c).alias(f"{c}2") for c in table.columns if c != "kind"])
    return pairs.join(one, "a").join(two, "b")


def overlap(n, other, percent: int):
    """T, the least overlap of two linked sets of these sizes."""
    return F.ceil((n + other) * percent / (100 + percent))


def possible(pairs: DataFrame, kinds: DataFrame, percent: int) -> DataFrame:
    """The pairs whose counted shingles overlap enough for a link. Two linked
    sets differ by at most n - T shingles of either, so no more than that may
    be missing among the counted ones. (Those are cut to 32 bits here: a clash
    can only let a pair pass.)"""
    ids = seen_bits(pairs.select(F.explode(F.array("a", "b")).alias("id")), "id")
    met = both_sides(pairs, maybe_only(kinds, "kind", ids))
    least = overlap(F.col("n"), F.col("n2"), percent)
    shared = F.size(F.array_intersect("low", "low2"))
    return met.filter((shared >= F.size("low") - (F.col("n") - least)) & (shared >= F.size("low2") - (F.col("n2") - least))).select(
        "a", "b", "row", "row2")


def linked(pairs: DataFrame, docs: DataFrame, kinds: DataFrame, percent: int, size: int = 3) -> DataFrame:
    """The pairs (a, b) of kinds that are linked: shingles of the smaller set
    are looked up in the larger, sorted one."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        last_text, last_set = None, None
        for batch in batches:
            a, b, ta, tb = (c.to_pylist() for c in batch.columns)
            keep = []
            for x, y in zip(ta, tb):
                if x != last_text:
                    last_text, last_set = x, shingles.of(x)
                s, t = sorted((last_set, shingles.of(y)), key=len)
                at = np.minimum(np.searchsorted(t, s), len(t) - 1)
                keep.append(int((t[at] == s).sum()) >= needed(len(s), len(t), percent))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = kept(possible(pairs, kinds, percent))
    # one text of each kind that is left
    wanted = kept(pairs.select(F.explode(F.array(F.struct(F.col("a").alias("kind"), "row"), F.struct(
        F.col("b").alias("kind"), F.col("row2").alias("row")))).alias("x")).select("x.kind", "x.row").distinct())
    own = id_and_bytes(docs, F.xxhash64("doc_id", "text").alias("row")).select("row", "text")
    texts = kept(maybe_only(own, "row", seen_bits(wanted, "row")).join(wanted, "row").dropDuplicates(["kind"]).select("kind", "text"))
    return both_sides(pairs.select("a", "b"), texts).select("a", "b", "text", "text2").mapInArrow(run, "a long, b long")


def by_kind(lists: DataFrame) -> DataFrame:
    """(kind, n, places): a row for each kind, with all that it has in the lists."""
    return lists.groupBy("kind", "n").agg(F.collect_list(F.struct("shingle", "at")).alias("places"))


def rooted(places: DataFrame, roots: DataFrame) -> DataFrame:
    """The lists again, with each kind's root; kinds are joined, not what they have in the lists."""
    return places.join(roots, F.col("kind") == F.col("node"), "left").select(
        "kind", "n", F.coalesce("root", "kind").alias("root"), F.explode("places").alias("x")).select("x.shingle", "kind", "n", "x.at", "root")


def close(n, other, percent: int):
    """Whether sizes allow a link."""
    return (n * 100 >= other * percent) & (other * 100 >= n * percent)


def with_pivots(lists: DataFrame, r: int, percent: int) -> DataFrame:
    """(a, b): of each list's kinds outside its largest component, each with a
    few pivots, in the lists where it has most company; at most ``TRIES`` for a
    kind. Pivots are the kinds in most lists: those with few shingles of their
    own, which most others are near to; every round takes the next ones."""
    hot = lists.groupBy("kind").agg(F.count(F.lit(1)).alias("hot"))
    rank = Window.partitionBy("shingle").orderBy(F.desc("hot"), "pivot")
    pivots = lists.select("shingle", F.col("kind").alias("pivot"), F.col("n").alias("m"), F.col("at").alias("there"), F.col("root").alias("other")).join(
        hot.withColumnRenamed("kind", "pivot"), "pivot").withColumn("rank", F.row_number().over(rank)).filter(
        F.col("rank") <= (r + 1) * PIVOTS).filter(F.col("rank") > r * PIVOTS)
    company = Window.partitionBy("kind").orderBy(F.desc("all"), "shingle")
    askers = lists.filter((F.col("root") != F.col("lead")) & (F.col("at") <= F.col("n") - overlap(F.col("n"), F.col("n"), percent))).withColumn(
        "place", F.row_number().over(company)).filter(F.col("place") <= LISTS)
    least = overlap(F.col("n"), F.col("m"), percent)
    met = askers.join(pivots, "shingle").filter((F.col("root") != F.col("other")) & close(F.col("n"), F.col("m"), percent)
                                                & (F.col("at") <= F.col("n") - least) & (F.col("there") <= F.col("m") - least))
    often = Window.partitionBy("kind").orderBy(F.desc("times"), F.desc("hot"), "pivot")
    best = met.groupBy("kind", "pivot").agg(F.count(F.lit(1)).alias("times"), F.max("hot").alias("hot")).withColumn(
        "place", F.row_number().over(often)).filter(F.col("place") <= TRIES)
    return best.select(F.least("kind", "pivot").alias("a"), F.greatest("kind", "pivot").alias("b")).distinct()


def link_classes(docs: DataFrame, rows: DataFrame, percent: int, pivot_rounds: int, shingle_size: int = 3) -> DataFrame:
    """(node, root) of the kinds that are linked with another kind."""
    spark = docs.sparkSession
    all_lists = merged_shingles(rows)
    shared = all_lists.groupBy("shingle").agg(F.min("kind").alias("a"), F.max("kind").alias("b")).filter("a <> b").select("shingle")
    places = kept(by_kind(all_lists.join(shared, "shingle")))
    let_go(all_lists)
    # each kind in the lists: a row that has it, its size, a fifth of its shingles
    bits = seen_bits(places, "kind")
    kinds = kept(maybe_only(rows.filter("kind is not null").select("kind", "row", F.col("n_shingles").alias("n"), "low"),
                            "kind", bits).dropDuplicates(["kind"]))
    links = spark.createDataFrame([], "a long, b long")
    tested = spark.createDataFrame([], "a long, b long")
    roots = spark.createDataFrame([], "node long, root long")
    for r in range(pivot_rounds + 1):
        now = kept(rooted(places, roots))
        # of each list its components: how many kinds they have, and the largest one
        parts = now.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("c"))
        lead = parts.groupBy("shingle").agg(F.max(F.struct("c", "root")).getField("root").alias("lead"), F.count(F.lit(1)).alias("parts"),
                                            F.sum("c").alias("all"), F.sum(F.col("c") * F.col("c")).alias("within")).filter("parts > 1")
        # (lists whose kinds are one component by now have nothing left to tell)
        lead = kept(lead)
        size = lead.agg(F.sum("all").alias("rows"), F.sum(F.col("all") * F.col("all") - F.col("within")).alias("apart")).first()
        if r == pivot_rounds or (size["apart"] or 0) <= 6 * (size["rows"] or 0):
            break  # few enough to compare all that are apart
        pairs = kept(with_pivots(now.join(lead.filter("`all` * `all` - within > 6 * `all`").select("shingle", "lead", "all"), "shingle"), r, percent).join(
            tested, ["a", "b"], "left_anti"))
        new = kept(linked(pairs, docs, kinds, percent, shingle_size))
        tested, links = tested.union(pairs), links.union(new)
        if new.isEmpty():
            break
        let_go(now)
        roots = components(links)
    left = kept(now.join(lead.select("shingle"), "shingle"))
    let_go(now, places)
    x, y = left.alias("x"), left.alias("y")
    least = overlap(F.col("x.n"), F.col("y.n"), percent)
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.kind") < F.col("y.kind")) & (F.col("x.root") != F.col("y.root"))
                   & close(F.col("x.n"), F.col("y.n"), percent)
                   & (F.col("x.at") <= F.col("x.n") - least) & (F.col("y.at") <= F.col("y.n") - least)).select(
        F.col("x.kind").alias("a"), F.col("y.kind").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
    return components(links.union(linked(kept(pairs), docs, kinds, percent, shingle_size)))


def grouped(docs: DataFrame, percent: int = 90, long_list: int = 4, longest_lists: int = 500_000, pivot_rounds: int = 3,
            size: int = 3) -> DataFrame:
    """doc_id, row, n_shingles and root (a name of the component; null for a
    text without shingles) of every row."""
    order = Shared(docs.sparkSession, frequent(docs, size, long_list, longest_lists))
    rows = written(describe(docs, order, percent, size))
    roots = link_classes(docs, rows, percent, pivot_rounds, size)
    return written(rows.join(roots, F.col("kind") == F.col("node"), "left").select(
        "doc_id", "row", "n_shingles", F.coalesce("root", "kind").alias("root")))


def similar(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    named = grouped(docs, **limits)
    least = named.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "root", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, **limits) -> DataFrame:
    """The rows of ``docs`` without all but the least id's row of each
    component; texts without shingles stay."""
    named = grouped(docs, **limits).filter("root is not null")
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    # of rows with the least id (more than one if ids repeat) the least row name
    first = named.join(least, "root").filter(F.col("doc_id").eqNullSafe(F.col("least"))).groupBy("root").agg(F.min("row").alias("kept"))
    judged = written(named.join(first, "root").groupBy(F.col("row").alias("__row")).agg(
        F.count(F.lit(1)).alias("__n"), F.max(F.col("row") == F.col("kept")).alias("__keep")).filter((F.col("__n") > 1) | ~F.col("__keep")))
    bitmap = seen_bits(judged, "__row")
    rows = docs.withColumn("__row", F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).cast("binary")))

    untouched = maybe_only(rows, "__row", bitmap, keep=False)
    looked_at = maybe_only(rows, "__row", bitmap).join(judged, "__row", "left")
    other = looked_at.filter("__keep is null")
    once = looked_at.filter("__keep").dropDuplicates(["__row"])
    return untouched.union(other.select(*rows.columns)).union(once.select(*rows.columns)).drop("__row")


def op6(docs: DataFrame) -> DataFrame:
    return similar(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6(table(spark, sf_dir, "documents"))


SQL = """
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
grams AS (SELECT rid, unnest(s) AS g FROM sets),
often AS (SELECT g FROM grams GROUP BY g HAVING count(*) > 1),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS n FROM (SELECT * FROM grams SEMI JOIN often USING (g)) a
           JOIN (SELECT * FROM grams SEMI JOIN often USING (g)) b USING (g) WHERE a.rid < b.rid GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sets x ON x.rid = a JOIN sets y ON y.rid = b
          WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
reach AS (
  WITH RECURSIVE r(rid, other) AS (
    SELECT rid, rid FROM sets
    UNION
    SELECT r.rid, l.b FROM r JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.other)
  SELECT rid, other FROM r)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id
FROM sets s JOIN (SELECT reach.rid, min(o.doc_id) AS component_id FROM reach JOIN sets o ON o.rid = reach.other GROUP BY 1) c ON c.rid = s.rid
"""
