"""Near-duplicate classes: a Jaccard self-join on word shingles with filters of several global token orders.

Texts link when their shingle sets' Jaccard similarity is at least ``num / den``. The work narrows in steps; each is
exact, so that no link between different texts is lost:

1. Texts with equal sets form a class, whose least id stands for it.
2. First order (ascending hash), long prefix: sets of size n that link share at least k(n) of their first
   n - ceil(t n) + k(n) tokens, k(n) = n // 10 + 1. Sets with fewer such tokens that occur in any other set are
   out. Most are. All tokens of the rest are counted; those of many sets are hot, and their number is bounded by
   raising the limit.
3. Second and third order (hot tokens last, then another hash each), short prefixes n - ceil(t n) + 1: sets that link
   share a token in the prefixes of each order.
   a. Sets with the same least token in an order of its own (hash alone, as groups of copies share their least
      tokens) are compared to a few leaders of that token, which joins large groups of copies to a few components at
      a cost that grows with the group, not its square. Later rounds take other orders and leaders, and only sets
      outside the largest component of their token.
   b. Sets joined by tokens that still have sets of several components, and more than ``CROWD`` of them, are compared
      block by block: two blocks of ``BLOCK`` sets are multiplied as 0/1 matrices in one task, which gives a star for
      each of their components, never a row for each pair.
   c. Only sets of different components still need comparing. A token whose sets are all of one component gives
      nothing; else sets outside its largest component meet the others. These candidates must share a token in
      the third order's prefixes as well before they are verified.
4. Verified pairs are linked to components.

Defined cases: null texts, empty texts and texts without words have empty sets and link with nothing; equal texts
share a class; rows of one id are one document; a null id has a null class; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closebook.llm.common import ARROW_ROWS, TEXT_BYTES, forget, measured, prepared, settings, slices, store
from closebook.llm.components import components, merged
from closebook.llm.shingles import mix64, shingle_sets

HOT = 4  # a token of so many prefixes is hot
MOST_HOT = 1 << 18  # hot tokens, at most: 2 MB for each Python worker; beyond, the limit is doubled
LEADERS = 8
CROWD = 64  # sets of a prefix token; more are compared in blocks
BLOCK = 512
VERIFY_ROWS = 64  # rows of an Arrow batch with token arrays
ORDERS = (0x5851F42D4C957F2D, 0x14057B7EF767814F)
KEY_ORDERS = (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85, 0x6C62272E07BB0142, 0x7B1C3F2A9D8E5B47)
ROUNDS = ((0, 1), (2,), (3,))  # of leaders: the key orders of each


def keep_at_least(n, num: int, den: int):
    """ceil(n num / den): what a set of size n must share with any set that it links to."""
    return -(-n * num // den)


def shared_at_least(n):
    return n // 10 + 1


def long_prefix(n: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.minimum(n, n - keep_at_least(n, num, den) + shared_at_least(n))


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    edges = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(values.view(np.int64)))


def _firsts(sizes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of the first ``wanted`` values of consecutive groups of ``sizes``."""
    start = np.cumsum(sizes) - sizes
    return np.repeat(start - (np.cumsum(wanted) - wanted), wanted) + np.arange(int(wanted.sum()))


def set_heads(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """``doc_id, n_shingles, f1, f2, head``: a 128-bit mark of the set and its long prefix in the first order."""

    def heads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", TEXT_BYTES):
            hashes, sizes = shingle_sets(batch.column("text").to_pylist(), width)
            group = np.repeat(np.arange(len(sizes)), sizes)
            marks = []
            for seed in ORDERS:
                sums = np.zeros(len(sizes), dtype=np.uint64)
                np.add.at(sums, group, mix64(hashes ^ np.uint64(seed)))
                marks.append(pa.array(sums.view(np.int64)))
            wanted = long_prefix(sizes, num, den)
            head = _lists(hashes[_firsts(sizes, wanted)], wanted)
            yield pa.record_batch([batch.column("doc_id"), pa.array(sizes), *marks, head], names=["doc_id", "n_shingles", "f1", "f2", "head"])

    return docs.mapInArrow(heads, "doc_id long, n_shingles long, f1 long, f2 long, head array<long>")


def token_sets(docs: DataFrame, width: int) -> DataFrame:
    """``id, n, tokens, keys``: all tokens of every set that has any, and the least token in each of the key orders."""

    def sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", TEXT_BYTES):
            hashes, sizes = shingle_sets(batch.column("text").to_pylist(), width)
            filled = np.flatnonzero(sizes)
            least = np.zeros((len(filled), len(KEY_ORDERS)), dtype=np.uint64)
            if len(filled):
                starts = (np.cumsum(sizes) - sizes)[filled]
                for i, seed in enumerate(KEY_ORDERS):  # a bijection's least value stands for the token
                    least[:, i] = np.minimum.reduceat(mix64(hashes ^ np.uint64(seed)), starts)
            keys = _lists(least.ravel(), np.full(len(filled), len(KEY_ORDERS)))
            ids = batch.column("doc_id").take(pa.array(filled))
            yield pa.record_batch([ids, pa.array(sizes[filled]), _lists(hashes, sizes[filled]), keys], names=["id", "n", "tokens", "keys"])

    return docs.mapInArrow(sets, "id long, n long, tokens array<long>, keys array<long>")


def ordered_prefixes(full: DataFrame, hot: np.ndarray, num: int, den: int) -> DataFrame:
    """``id, n, p2, p3``: the short prefixes in the second and third order, hot tokens last in both."""
    held = full.sparkSession.sparkContext.broadcast(np.sort(hot))

    def prefixes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = held.value
        for batch in batches:
            lists = batch.column("tokens")
            hashes = np.asarray(lists.flatten()).view(np.uint64)
            sizes = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            group = np.repeat(np.arange(len(sizes)), sizes)
            at = np.searchsorted(late, hashes)
            is_hot = late[np.minimum(at, len(late) - 1)] == hashes if len(late) else np.zeros(len(hashes), dtype=bool)
            wanted = np.where(sizes > 0, sizes - keep_at_least(sizes, num, den) + 1, 0)
            found = []
            for seed in ORDERS:
                order = np.lexsort((mix64(hashes ^ np.uint64(seed)), is_hot, group))
                found.append(_lists(hashes[order][_firsts(sizes, wanted)], wanted))
            yield pa.record_batch([batch.column("id"), batch.column("n"), *found], names=["id", "n", "p2", "p3"])

    return full.select("id", "n", "tokens").mapInArrow(prefixes, "id long, n long, p2 array<long>, p3 array<long>")


def verified(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b`` of those rows (``a, tokens, others``: structs ``id, tokens``) whose sets link."""
    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = [], []
            mine, others = batch.column("tokens"), batch.column("others")
            ids, edges = batch.column("a").to_pylist(), np.asarray(others.offsets)
            mine_at, mine_all = np.asarray(mine.offsets), np.asarray(mine.values)
            theirs = others.values
            their_ids, their_lists = theirs.field("id").to_pylist(), theirs.field("tokens")
            their_at, their_all = np.asarray(their_lists.offsets), np.asarray(their_lists.values)
            for i, a in enumerate(ids):
                x = mine_all[mine_at[i] : mine_at[i + 1]]
                for k in range(edges[i], edges[i + 1]):
                    y = their_all[their_at[k] : their_at[k + 1]]
                    if their_ids[k] == a or min(len(x), len(y)) * den < max(len(x), len(y)) * num:
                        continue
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if den * both >= num * (len(x) + len(y) - both):
                        one.append(a)
                        two.append(their_ids[k])
            yield pa.record_batch([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])

    return pairs.select("a", "tokens", "others").mapInArrow(check, "a long, b long")


def hot_tokens(shared: DataFrame) -> np.ndarray:
    """The most frequent tokens (``token, n``), at most ``MOST_HOT``."""
    steps = shared.where(F.col("n") >= HOT).groupBy(F.floor(F.log2("n")).alias("step")).count().collect()
    least, count = None, 0
    for row in sorted(steps, key=lambda r: -r["step"]):
        count += row["count"]
        if count > MOST_HOT:
            break
        least = row["step"]
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    rows = shared.where((F.col("n") >= HOT) & (F.floor(F.log2("n")) >= least)).select("token").toArrow()
    return np.array(rows.column("token"), dtype=np.int64).view(np.uint64)


def leader_links(full: DataFrame, comps: DataFrame | None, order: int, num: int, den: int) -> DataFrame | None:
    """Links between sets and the leaders of their least token in a key order; None if no token has several components.

    With ``comps`` only tokens with sets of several components count, and of their sets those outside the largest.
    """
    keyed = full.select("id", F.col("keys")[order].alias("key"))
    if comps is None:
        keyed = keyed.withColumn("comp", F.col("id"))
    else:
        keyed = keyed.join(comps, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    keyed = store(keyed, "near-keys")
    per = keyed.groupBy("key", "comp").agg(F.count("*").alias("c"))
    major = F.max_by(F.struct("comp", "c"), F.struct("c", "comp"))
    several = per.groupBy("key").agg(major.alias("m"), F.count("*").alias("k")).where("k > 1").select("key", "m.comp", "m.c")
    several, seen = measured(several.withColumnRenamed("comp", "major"), "near-key-groups", n=F.count("*"))
    if not seen["n"]:
        return None
    in_key = Window.partitionBy("key").orderBy(F.xxhash64("id", F.lit(order)), "id")
    few = keyed.join(several, "key", "left_semi").select("key", "id")
    few = few.withColumn("r", F.row_number().over(in_key)).where(F.col("r") <= LEADERS).select("id", "key")
    sets = full.select("id", "tokens")
    heads = few.join(sets, "id").groupBy("key").agg(F.collect_list(F.struct("id", "tokens")).alias("others"))
    members = keyed.join(several, "key").where("comp != major or c = 1").select("id", "key").join(sets, "id")
    return verified(members.join(heads, "key").select(F.col("id").alias("a"), "tokens", "others"), num, den)


def prefix_rows(prefixes: DataFrame, comps: DataFrame) -> DataFrame:
    """``id, n, comp, token``: the tokens of the second order's short prefixes, with the set's component."""
    placed = prefixes.select("id", "n", "p2").join(comps, "id", "left")
    return placed.select("id", "n", F.coalesce("component", "id").alias("comp"), F.explode("p2").alias("token"))


def open_tokens(rows: DataFrame) -> DataFrame:
    """``token, major, sets``: tokens with sets of several components, and the component with most of them."""
    per = rows.groupBy("token", "comp").agg(F.count("*").alias("c"))
    major = F.max_by("comp", F.struct("c", "comp")).alias("major")
    return per.groupBy("token").agg(major, F.sum("c").alias("sets"), F.count("*").alias("k")).where("k > 1").drop("k")


def block_links(full: DataFrame, rows: DataFrame, tokens: DataFrame, num: int, den: int) -> DataFrame:
    """Links (as stars) among all sets that crowded tokens join, by products of blocks."""
    crowded = rows.join(tokens.where(F.col("sets") > CROWD).select("token"), "token").select("token", "id")
    first = crowded.groupBy("token").agg(F.min("id").alias("hub"))
    groups = store(components(crowded.join(first, "token").select(F.col("id").alias("a"), F.col("hub").alias("b"))), "near-crowds")
    sizes = groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks"))
    dealt = groups.join(sizes, "component").select("id", "component", mine.alias("block"), "blocks")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    dealt = dealt.select("id", "component", "block", other).join(full.select("id", "tokens"), "id")
    pair = [F.col("component"), F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y")]
    side = F.collect_list(F.struct("id", "tokens")).alias("sets")
    return dealt.groupBy(*pair).agg(side).select("sets").mapInArrow(_multiplied(num, den), "a long, b long")


def _multiplied(num: int, den: int):
    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = [], []
            edges = np.asarray(batch.column("sets").offsets)
            for begin, end in zip(edges, edges[1:]):
                sets = batch.column("sets").values.slice(begin, end - begin)
                ids, lists = np.asarray(sets.field("id")), sets.field("tokens")
                stars = linked_stars(np.asarray(lists.flatten()), np.diff(np.asarray(lists.offsets)), num, den)
                away = np.flatnonzero(stars != np.arange(len(ids)))
                one.append(ids[away])
                two.append(ids[stars[away]])
            pairs = [pa.array(np.concatenate(x) if x else np.zeros(0), pa.int64()) for x in (one, two)]
            yield pa.record_batch(pairs, names=["a", "b"])

    return compare


def linked_stars(tokens: np.ndarray, sizes: np.ndarray, num: int, den: int, columns: int = 2048) -> np.ndarray:
    """For each of some sets the first set of its component, by intersections as products of 0/1 matrices."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes)
    _, place, often = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = often > 1  # others add to no intersection
    number = np.cumsum(shared) - 1
    keep = shared[place]
    owner, place = owner[keep], number[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    both = np.zeros((n, n), dtype=np.float32)
    for at in range(0, int(shared.sum()), columns):
        a, b = np.searchsorted(place, [at, at + columns])
        block = np.zeros((n, columns), dtype=np.float32)
        block[owner[a:b], place[a:b] - at] = 1
        both += block @ block.T
    linked = den * both.astype(np.float64) >= num * (sizes[:, None] + sizes[None, :] - both)
    stars = np.arange(n)
    while True:
        least = np.minimum(stars, np.where(linked, stars[None, :], n).min(1, initial=n))
        least = least[least]
        if (least == stars).all():
            return stars
        stars = least


def cross_candidates(prefixes: DataFrame, rows: DataFrame, tokens: DataFrame, num: int, den: int) -> DataFrame:
    """``a, b``: sets of different components with a common token in both short prefixes and sizes near enough."""
    mixed = rows.join(tokens.where(F.col("sets") <= CROWD).select("token", "major"), "token")
    minor = mixed.where("comp != major").select("token", F.col("id").alias("a"), F.col("n").alias("na"), F.col("comp").alias("ca"))
    every = mixed.select("token", F.col("id").alias("b"), F.col("n").alias("nb"), F.col("comp").alias("cb"), "major")
    once = (F.col("cb") == F.col("major")) | (F.col("a") < F.col("b"))
    near = F.least("na", "nb") * den >= F.greatest("na", "nb") * num
    pairs = minor.join(every, "token").where((F.col("ca") != F.col("cb")) & once & near).select("a", "b").distinct()
    third = prefixes.select("id", "p3")
    pairs = pairs.join(third.withColumnsRenamed({"id": "a", "p3": "pa"}), "a")
    pairs = pairs.join(third.withColumnsRenamed({"id": "b", "p3": "pb"}), "b")
    return pairs.where(F.arrays_overlap("pa", "pb")).select("a", "b")


def cross_links(full: DataFrame, prefixes: DataFrame, rows: DataFrame, tokens: DataFrame, num: int, den: int) -> DataFrame:
    """Links between sets of different components that tokens join which are not crowded."""
    pairs = store(cross_candidates(prefixes, rows, tokens, num, den), "near-candidates")
    one = full.select(F.col("id").alias("a"), "tokens")
    other = full.select(F.col("id").alias("b"), F.array(F.struct("id", "tokens")).alias("others"))
    with settings(full.sparkSession, {ARROW_ROWS: str(VERIFY_ROWS)}):
        return store(verified(pairs.join(one, "a").join(other, "b"), num, den), "near-links")


def near_duplicates(
    docs: DataFrame, width: int = 5, num: int = 80, den: int = 100, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    spark = prepared(docs.sparkSession)
    # The ids that step 2 keeps also filter the texts before these are shuffled, by a Bloom filter of bounded size.
    bloom = "spark.sql.optimizer.runtime.bloomFilter."
    with settings(spark, {f"{bloom}enabled": "true", f"{bloom}applicationSideScanSizeThreshold": "0"}):
        return store(_classes(spark, docs, width, num, den, doc_id, text), "near-classes-found")


def _classes(spark: SparkSession, docs: DataFrame, width: int, num: int, den: int, doc_id: str, text: str) -> DataFrame:
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    mark = ["n_shingles", "f1", "f2"]
    # Sets are made twice, here and for the members at the end: dearer than storing all prefixes, but far less to store.
    sets = set_heads(texts, width, num, den)
    some = sets.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = store(some.groupBy(*mark).agg(F.min("doc_id").alias("rep"), F.first("head").alias("head")), "near-classes")

    tokens = classes.select("rep", F.explode("head").alias("token"))
    counted = tokens.groupBy("token").agg(F.count("*").alias("n"))
    shared = store(counted.where("n > 1").select("token"), "near-shared")
    hits = tokens.join(shared, "token").groupBy("rep").agg(F.count("*").alias("hits"))
    need = F.floor(F.ceil(F.col("n_shingles") * num / den) / 10) + 1
    hits = hits.join(classes.select("rep", need.alias("need")), "rep").groupBy(F.col("rep").alias("doc_id"))
    hits = store(hits.agg(F.max(F.col("hits") - F.col("need")).alias("over")), "near-hits")

    kept = texts.join(hits.where("over >= 0"), "doc_id", "left_semi")
    full = store(token_sets(kept, width), "near-full")
    often = full.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= HOT)
    hot = hot_tokens(store(often, "near-often"))
    with settings(spark, {ARROW_ROWS: str(VERIFY_ROWS)}):
        prefixes = store(ordered_prefixes(full, hot, num, den), "near-prefixes")
        comps = None
        for orders in ROUNDS:
            found = [x for x in (leader_links(full, comps, order, num, den) for order in orders) if x is not None]
            if found:
                comps = merged(comps, store(reduce(DataFrame.unionAll, found), "near-links"))
    if comps is None:  # no two sets share a key
        comps = spark.createDataFrame([], "id long, component long")
    rows = store(prefix_rows(prefixes, comps), "near-rows")
    tokens, seen = measured(open_tokens(rows), "near-open", n=F.count("*"), crowded=F.count_if(F.col("sets") > CROWD))
    if seen["crowded"]:
        with settings(spark, {ARROW_ROWS: "1"}):
            comps = merged(comps, store(block_links(full, rows, tokens, num, den), "near-links"))
        # A crowded token's sets have all met. The others are looked at with the components as they are now.
        rows = rows.join(tokens.where(F.col("sets") <= CROWD).select("token"), "token", "left_semi")
        settled = comps.withColumnRenamed("component", "now")
        rows = rows.join(settled, "id", "left").select("id", "n", F.coalesce("now", "id").alias("comp"), "token")
        rows = store(rows, "near-rows")
        tokens, seen = measured(open_tokens(rows), "near-open", n=F.count("*"))
    if seen["n"]:
        comps = merged(comps, cross_links(full, prefixes, rows, tokens, num, den))
    joined = comps.withColumnRenamed("id", "rep")
    members = sets.select("doc_id", *mark).join(classes.select("rep", *mark), mark, "left").join(joined, "rep", "left")
    return members.select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
