"""Mixing sources to target weights by a splitting tree of exact block quotas.

1. Every document has a size; sources share the total by weight, each at most ``repeats`` times its own size.
2. A source's documents fall into blocks by hash. Each pass (epoch) over a source draws its blocks in an order of its
   own: whole passes take all blocks, the last one the first blocks of the order, of the last block the first
   documents of theirs, up to the document that brings the source nearest to its target.
3. The block draws are shared out among output shards by a binary tree. A node that holds a quota of every source
   splits the vector of quotas between its two halves by a multivariate hypergeometric draw; the leaves hold how
   many blocks of each source every shard gets. A shard then takes the next blocks of each source's order, so the
   shards' blocks are disjoint, and within a shard the rows are ordered by a hash.

All draws are hashes of the seed and of what they decide, so that reruns and repeated tasks agree. Only DataFrame
functions are used. Tables per source and per block are small: ``blocks`` bounds the second, whatever the input.

Defined cases: null sources are one source of their own, last in order; null and empty texts have size 0 and are
taken when their block is; equal documents are taken alike; a table without words takes nothing; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from closebook.llm.common import store, word_count

WEIGHTS = (5, 2, 1)
REPEATS = 3
SHARDS = 16
BLOCKS = 4096
SEED = 20


def unit(*parts: Column | int | str) -> Column:
    """A double from 0 up to 1 that depends on the parts alone."""
    values = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.shiftrightunsigned(F.xxhash64(*values), 11).cast("double") / F.lit(float(1 << 53))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size`` with ``target``: the total shared by weight, none above ``repeats`` times its size.

    Weights repeat over the sources in code point order, null last. Sources whose limit is below the common level stop
    at it; the level is the first at which the rest of the total fits the rest of the weights. One row per source.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("n", F.row_number().over(by_name) - 1).withColumn("weight", w)
    rows = rows.withColumn("limit", (F.col("source_size") * repeats).cast("double"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "n")
    before, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    all_rows = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(all_rows) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    rows = rows.withColumn("k", F.row_number().over(by_limit))
    fits = F.when(F.col("level") <= F.col("limit") / F.col("weight"), F.struct("k", "level"))
    rows = rows.withColumn("level", F.min(fits).over(all_rows)["level"])
    target = F.least("limit", F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return rows.select("source", "source_size", target.alias("target"))


def split(quotas: Column, node: Column | int, seed: int) -> Column:
    """A multivariate hypergeometric draw: how many of each quota go to a node's left half.

    Every block in turn goes left with the chance (left places still open) / (blocks still to come).
    """
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda a, q: a + q)
    none = F.array().cast("array<long>")
    start = F.struct(total.alias("rest"), F.shiftright(total + 1, 1).alias("open"), none.alias("left"))

    def source(state: Column, quota: Column) -> Column:
        i = F.size(state["left"])
        begin = F.struct(state["rest"].alias("rest"), state["open"].alias("open"))

        def block(s: Column, k: Column) -> Column:
            go = unit(F.lit(seed), node if isinstance(node, Column) else F.lit(node), i, k) * s["rest"] < s["open"]
            return F.struct((s["rest"] - 1).alias("rest"), (s["open"] - go.cast("long")).alias("open"))

        blocks = F.when(quota > 0, F.sequence(F.lit(1).cast("long"), quota)).otherwise(none)
        end = F.aggregate(blocks, begin, block)
        took = F.array(state["open"] - end["open"])
        return F.struct(end["rest"].alias("rest"), end["open"].alias("open"), F.concat(state["left"], took).alias("left"))

    return F.aggregate(quotas, start, source)["left"]


def shard_quotas(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row (``sources``, ``quotas``: arrays side by side) to rows ``shard, quotas``; ``shards`` is a power of two."""
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    nodes = quotas.select(F.lit(1).cast("long").alias("node"), "sources", "quotas")
    for _ in range(shards.bit_length() - 1):
        both = nodes.withColumn("left", split(F.col("quotas"), F.col("node"), seed))
        right = F.zip_with("quotas", "left", lambda q, x: q - x)
        halves = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), right.alias("quotas")),
        )
        nodes = both.select("sources", F.explode(halves).alias("half")).select("half.node", "sources", "half.quotas")
    return nodes.select((F.col("node") - shards).alias("shard"), "sources", "quotas")


def cut_blocks(rows: DataFrame, sources: DataFrame, repeats: int, seed: int) -> DataFrame:
    """The block draws, one row each: ``source, block, epoch, n, room``. ``n`` counts a source's draws from 0; ``room``,
    null for a whole block, is how many words of the block still fit."""
    size = rows.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    each = size.alias("b").join(sources.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    each = each.select("b.*", "t.source_size", "t.target")
    each = each.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    quota = F.col("target") - F.col("epoch") * F.col("source_size")
    each = each.withColumn("quota", F.least(quota, F.col("source_size").cast("double")))
    each = each.withColumn("order", F.xxhash64(F.lit(seed), "source", "epoch", "block"))
    in_order = Window.partitionBy("source", "epoch").orderBy("order", "block")
    before = F.coalesce(F.sum("block_size").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.where(F.col("quota") > 0).withColumn("before", before)
    whole = F.col("before") + F.col("block_size") <= F.col("quota")
    each = each.where(whole | (F.col("before") < F.col("quota")))
    each = each.withColumn("room", F.when(~whole, F.col("quota") - F.col("before")))
    n = F.row_number().over(Window.partitionBy("source").orderBy("epoch", "order", "block")) - 1
    return each.select("source", "block", "epoch", n.cast("long").alias("n"), "room")


def cutoffs(rows: DataFrame, draws: DataFrame) -> DataFrame:
    """For every block that is drawn in part: the last hash that still fits best (null where none does)."""
    part = draws.where(F.col("room").isNotNull()).select("source", "block", "room").alias("p")
    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.block") == F.col("p.block"))
    docs = rows.groupBy("source", "block", "place").agg(F.sum("size").alias("size"))
    inside = docs.alias("d").join(part, same).select("d.*", "p.room")
    upto = Window.partitionBy("source", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.sum("size").over(upto) - F.col("size") / 2
    fits = inside.withColumn("middle", middle).where(F.col("middle") < F.col("room"))
    return fits.groupBy("source", "block").agg(F.max("place").alias("cutoff"))


def block_shards(draws: DataFrame, shards: int, seed: int) -> DataFrame:
    """``source, upto``: for every source an array over the shards, how many of its block draws end at each."""
    counts = draws.groupBy("source").agg(F.count("*").alias("quota"))
    entry = F.struct(F.col("source").isNull().alias("last"), "source", "quota")
    all_sources = counts.agg(F.array_sort(F.collect_list(entry)).alias("s"))
    vectors = all_sources.select(F.col("s.source").alias("sources"), F.col("s.quota").alias("quotas"))
    leaves = shard_quotas(vectors, shards, seed).select("shard", F.explode(F.arrays_zip("sources", "quotas")).alias("x"))
    per = leaves.groupBy(F.col("x.sources").alias("source")).agg(
        F.array_sort(F.collect_list(F.struct("shard", F.col("x.quotas").alias("quota")))).alias("q")
    )
    none = F.array().cast("array<long>")
    add = lambda a, q: F.concat(a, F.array(F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + q["quota"]))
    return per.select("source", F.aggregate("q", none, add).alias("upto"))


RESULTS = ("size", "source_size", "target", "draws")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    repeats: int = REPEATS,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``draws``, which replace columns of these names.

    ``draws`` has a struct ``(epoch, shard, position)`` for each time the mix takes the document. The text is read
    twice and never shuffled; only tables per source and per block are joined to it.
    """
    # Draws depend on a document's own values, never on its place in a file.
    rows = docs.select(
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("place"),
    )
    rows = store(rows, "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.col("source_size") / F.greatest(F.sum("source_size").over(total), F.lit(1))
    n_blocks = F.greatest(F.lit(1), F.floor(share * blocks)).cast("long")
    sources = store(source_targets(sizes, weights, repeats).withColumn("n_blocks", n_blocks), "mix-sources")

    def block(place: Column) -> Column:
        return F.floor(unit(F.lit(seed), place) * F.col("t.n_blocks")).cast("long")

    same = F.col("d.source").eqNullSafe(F.col("t.source"))
    placed = rows.alias("d").join(sources.alias("t"), same).select("d.*", block(F.col("d.place")).alias("block"))
    draws = store(cut_blocks(placed, sources, repeats, seed), "mix-blocks")
    ends = block_shards(draws, shards, seed)
    cut = cutoffs(placed, draws)
    sharded = draws.alias("b").join(ends.alias("e"), F.col("b.source").eqNullSafe(F.col("e.source")))
    shard = F.size(F.filter("e.upto", lambda x: x <= F.col("b.n")))
    sharded = sharded.select("b.*", shard.alias("shard")).alias("b")
    at = F.col("b.source").eqNullSafe(F.col("c.source")) & (F.col("b.block") == F.col("c.block"))
    draw = F.struct("b.epoch", "b.shard", F.col("b.room").isNotNull().alias("part"), "c.cutoff")
    per_block = sharded.join(cut.alias("c"), at, "left").groupBy("b.source", "b.block").agg(
        F.array_sort(F.collect_list(draw)).alias("block_draws")
    )
    per_block = store(per_block, "mix-draws")

    # The names of docs may clash with those of the small tables, so all of its columns travel as one struct.
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)).alias("place"),
    ).alias("d")
    full = packed.join(sources.alias("t"), same).select(
        "d.*", "t.source_size", "t.target", block(F.col("d.place")).alias("block")
    ).alias("d")
    here = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.block") == F.col("p.block"))
    taken = F.filter("p.block_draws", lambda x: ~x["part"] | (F.col("d.place") <= x["cutoff"]))
    position = lambda x: F.xxhash64(F.lit(seed), x["shard"], x["epoch"], F.col("d.place"))
    draws_of = F.transform(
        F.coalesce(taken, F.array().cast(per_block.schema["block_draws"].dataType)),
        lambda x: F.struct(x["epoch"].alias("epoch"), x["shard"].alias("shard"), position(x).alias("position")),
    )
    kept = [F.col(f"d.row.`{c}`") for c in docs.columns if c not in RESULTS]
    out = full.join(per_block.alias("p"), here, "left")
    return out.select(*kept, "d.size", "d.source_size", "d.target", draws_of.alias("draws"))


def shard_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: a row for each draw, with ``epoch``, ``shard`` and ``position``, in place of ``draws``."""
    return mixed.withColumn("draw", F.explode("draws")).select(
        *[c for c in mixed.columns if c != "draws"], "draw.epoch", "draw.shard", "draw.position"
    )


def write_shards(mixed: DataFrame, path: str) -> None:
    """One folder a shard; a shard's files hold its rows in ranges of position, sorted: its local shuffle."""
    rows = shard_rows(mixed)
    ordered = rows.repartitionByRange("shard", "position").sortWithinPartitions("shard", "position")
    ordered.write.partitionBy("shard").mode("overwrite").parquet(path)
