"""Ranked lexical search by bit-sliced Bloom signatures: bounds from bitmaps, then exact scores of all that could matter.

The score of a document is a sum over an item's terms of the term's weight times a damped frequency (``impact``); all of
it is whole numbers, see ``weight``, ``damping`` and ``impact``.

1. Index. One pass takes every whole text apart. A document's signature holds each of its terms once per frequency
   level it reaches (``LEVELS``), ``HASHES`` bits each. Documents of like numbers of entries form blocks with signatures
   of one width, ``BITS_PER_ENTRY`` bits or more per entry, stored as bit slices: one bitmap over the block's
   documents per signature bit. Blocks come with their documents' ids and lengths, and the pass also counts in how many
   documents each term occurs. The index covers all rows, and knows nothing of the items.
2. Bounds. For an item's terms a block's slices are intersected: the bitmap of a (term, level) overestimates the
   documents that reach it. Each document's greatest possible impact at its own length, times the weight, is summed
   over the terms: no document's score is above its sum.
3. First look: the ``SEEDS`` documents of greatest bound per item are scored exactly. The k-th of these scores, with
   its id, is the item's floor.
4. Every document whose bound reaches the floor, by score or by a smaller id at the same score, is scored exactly from its
   text, and the best k are kept. All others are provably below. Nothing else is left out.

Items are handled in blocks of about ``TERMS_TOGETHER`` terms, each stored before the next begins.

Defined cases: null texts and texts without terms count nowhere; null ids take part and come after all ids at equal
scores; documents that share an id are ranked apart; items that share an id are ranked apart, each with its own ranks;
null items and items without a known term get no rows; empty tables give no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closebook.llm.common import ARROW_ROWS, prepared, settings, slices, store

LEVELS = (1, 2, 3, 4, 5, 7, 11, 21)
HASHES = 4
BITS_PER_ENTRY = 14
LEAST_WIDTH = 256
BLOCK_DOCS = 1024
BLOCK_BYTES = 8 << 20
KNOWN_TERMS = 400_000
PIECE = 4 << 20
SEEDS = 20
CELLS = 4 << 20
TERMS_TOGETHER = 50_000
ITEMS_TOGETHER = 2_000
# Fixed values of the score.
UNIT, FLAT, SLOPE, STEP = 1_000_000_000, 100 - 90, 90, 8

# Everything but digits, ASCII letters and bytes of other characters ends a term; only A to Z change.
_TABLE = bytes(
    b if chr(b).isdigit() or chr(b).islower() or b >= 128 else b + 32 if chr(b).isupper() else 32 for b in range(256)
)
_BLANK = re.compile(rb" ")

INDEX = "width long, docs long, ids array<long>, sizes array<long>, slices binary, term binary, df long, n_docs long, n_terms long"


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def damping(size, n_docs: int, n_terms: int):
    """What a document's length adds to the divisor: longer than the mean damps more."""
    return FLAT + (SLOPE * size * n_docs) // n_terms


def impact(tf, damp):
    return (UNIT * tf) // (1000 * tf + STEP * damp)


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """All terms of a whole text, in pieces of bounded size that end between terms."""
    text = text.translate(_TABLE)
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            blank = _BLANK.search(text, end)
            end = blank.start() if blank else len(text)
        yield text[at:end].split()
        at = end


class _Codes(dict):
    """Term to number, new terms numbered as they come, with two hashes of each."""

    def __init__(self):
        self.terms: list[bytes] = []

    def __missing__(self, term: bytes) -> int:
        code = self[term] = len(self.terms)
        self.terms.append(term)
        return code


def hashes(terms: list[bytes]) -> np.ndarray:
    """Two numbers per term, from which all its bits are made."""
    both = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, terms)), dtype="<u8").reshape(-1, 2)
    return both | np.array([0, 1], dtype=np.uint64)


def bits(both: np.ndarray, level: np.ndarray, width: int | np.ndarray) -> np.ndarray:
    """Signature bits of (term, level), one column per hash; ``width``, one for all or each its own, is a power of two."""
    at = both[:, 0] + level.astype(np.uint64) * (both[:, 1] * np.uint64(2 * HASHES))
    mask = np.asarray(width - 1, dtype=np.uint64)
    out = np.empty((len(both), HASHES), dtype=np.int64)
    for i in range(HASHES):
        out[:, i] = at >> np.uint64(20) & mask
        at += both[:, 1]
    return out


class Indexer:
    """Takes the texts of one task; gives blocks and the task's document counts of terms."""

    def __init__(self):
        self._reset()
        self.waiting: dict[int, list[tuple]] = {}

    def _reset(self) -> None:
        self.codes, self.counts, self.hashed = _Codes(), np.zeros(0, dtype=np.int64), np.zeros((0, 2), dtype=np.uint64)

    def add(self, ids: list[int | None], texts: list[bytes | None]) -> Iterator[pa.RecordBatch]:
        """Index some documents; yields what became full."""
        found, owners, sizes = [], [], []
        look = self.codes.__getitem__
        for place, text in enumerate(texts):
            size = 0
            for piece in terms_of(text or b""):
                found.append(np.fromiter(map(look, piece), dtype=np.int64, count=len(piece)))
                owners.append(np.full(len(piece), place, dtype=np.int64))
                size += len(piece)
            sizes.append(size)
        if not sum(sizes):
            return
        self._learn()
        known = len(self.codes.terms)
        keys, tf = np.unique(np.concatenate(owners) * known + np.concatenate(found), return_counts=True)
        owner, code = keys // known, keys % known
        self.counts += np.bincount(code, minlength=known)
        # One entry for each level that a term's frequency reaches.
        reached = np.searchsorted(LEVELS, tf, "right")
        entry = np.repeat(np.arange(len(keys)), reached)
        level = np.arange(len(entry)) - np.repeat(np.cumsum(reached) - reached, reached)
        owner = owner[entry]
        n_entries = np.bincount(owner, minlength=len(ids))
        widths = np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(BITS_PER_ENTRY * n_entries, 1))).astype(np.int64))
        places = bits(self.hashed[code[entry]], level, widths[owner])
        stops = np.cumsum(n_entries)
        for i in np.flatnonzero(n_entries):
            width = int(widths[i])
            group = self.waiting.setdefault(width, [])
            group.append((ids[i], sizes[i], places[int(stops[i] - n_entries[i]) : int(stops[i])].ravel()))
            if len(group) >= max(8, min(BLOCK_DOCS, 8 * BLOCK_BYTES // width)):
                yield self._block(width)
        if known > KNOWN_TERMS:
            yield from self._terms()

    def finish(self) -> Iterator[pa.RecordBatch]:
        for width in sorted(self.waiting):
            if self.waiting[width]:
                yield self._block(width)
        yield from self._terms()

    def _learn(self) -> None:
        new = self.codes.terms[len(self.hashed) :]
        if new:
            self.hashed = np.vstack([self.hashed, hashes(new)])
            self.counts = np.concatenate([self.counts, np.zeros(len(new), dtype=np.int64)])

    def _block(self, width: int) -> pa.RecordBatch:
        group, self.waiting[width] = self.waiting[width], []
        per_slice = -(-len(group) // 8)
        bitmap = np.zeros((width, per_slice), dtype=np.uint8)
        for i, (_, _, own) in enumerate(group):
            bitmap[own, i // 8] |= np.uint8(128 >> i % 8)  # equal places get the same value, so repeats do no harm
        sizes = [size for _, size, _ in group]
        row = [[width], [len(group)], [[i for i, _, _ in group]], [sizes], [bitmap.tobytes()], [None], [None], [len(group)], [sum(sizes)]]
        return _index_rows(row)

    def _terms(self) -> Iterator[pa.RecordBatch]:
        used = np.flatnonzero(self.counts)
        for at in range(0, len(used), 50_000):
            some = used[at : at + 50_000]
            nothing = [None] * len(some)
            terms = [self.codes.terms[i] for i in some]
            yield _index_rows([nothing] * 5 + [terms, self.counts[some], nothing, nothing])
        self._reset()


_KINDS = {
    "width": pa.int64(), "docs": pa.int64(), "ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "slices": pa.binary(),
    "term": pa.binary(), "df": pa.int64(), "n_docs": pa.int64(), "n_terms": pa.int64(),
}


def _index_rows(columns: list) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, _KINDS.values(), strict=True)], names=list(_KINDS))


@dataclass(frozen=True)
class Index:
    """Stored blocks, document counts of all terms, and the numbers of documents and terms."""

    blocks: DataFrame
    terms: DataFrame
    n_docs: int
    n_terms: int


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    spark = prepared(docs.sparkSession)

    def index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indexer = Indexer()
        for batch in slices(batches, "text"):
            yield from indexer.add(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())
        yield from indexer.finish()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    with settings(spark, {ARROW_ROWS: "1000"}):
        stored = store(rows.mapInArrow(index, INDEX), "lexical-index")
    counted = store(stored.where("term is not null").groupBy("term").agg(F.sum("df").alias("df")), "lexical-terms")
    n_docs, n_terms = stored.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    return Index(stored.where("width is not null").drop("term", "df"), counted, n_docs, n_terms)


@dataclass(frozen=True)
class Asked:
    """A block of items: their distinct terms with hashes and weights, and the places of each item's terms."""

    items: list[int]
    terms: dict[bytes, int]
    both: np.ndarray
    weights: np.ndarray
    places: list[np.ndarray]


def item_terms(index: Index, items: DataFrame, item_id: str, text: str) -> DataFrame:
    """``item, item_id, terms``: an item's distinct terms that occur in any document, with their document counts.

    ``item`` numbers the rows, so that items of one id stay apart; it is written, hence the same in every task.
    """

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            own = [sorted(set().union(*terms_of(t or b""))) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("item_id"), pa.array(own, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("binary").alias("text"))
    found = rows.mapInArrow(split, "item_id long, terms array<binary>").withColumn("item", F.monotonically_increasing_id())
    found = store(found, "lexical-items")
    single = found.select("item", "item_id", F.explode("terms").alias("term")).join(index.terms, "term")
    pair = F.struct("term", "df")
    return store(single.groupBy("item", "item_id").agg(F.sort_array(F.collect_list(pair)).alias("terms")), "lexical-items")


def asked_of(rows: list, n_docs: int) -> Asked:
    terms: dict[bytes, int] = {}
    df: list[int] = []
    places = []
    for row in rows:
        for term, count in row["terms"]:
            if terms.setdefault(bytes(term), len(terms)) == len(df):
                df.append(count)
        places.append(np.array([terms[bytes(term)] for term, _ in row["terms"]], dtype=np.int64))
    weights = np.array([weight(n_docs, count) for count in df], dtype=np.int64)
    return Asked([row["item"] for row in rows], terms, hashes(list(terms)), weights, places)


def block_bounds(block: dict, asked: Asked, n_docs: int, n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each item that a block may hold anything of: its place among the items, and every document's bound."""
    width, docs = block["width"], block["docs"]
    bitmap = block["slices"]
    damp = damping(np.array(block["sizes"], dtype=np.int64), n_docs, n_terms)
    most = np.zeros((len(asked.both), docs), dtype=np.int64)
    before = np.zeros(docs, dtype=np.int64)
    alive, reach = np.arange(len(asked.both)), None
    for level, _ in enumerate(LEVELS):
        rows = bits(asked.both[alive], np.full(len(alive), level), width)
        hit = np.bitwise_and.reduce(bitmap[rows], axis=1)
        reach = hit if reach is None else hit & reach
        some = reach.any(1)
        alive, reach = alive[some], reach[some]
        if not len(alive):
            break
        # The greatest impact on this level is that of the last frequency before the next, or of any at all.
        top = impact(LEVELS[level + 1] - 1, damp) if level + 1 < len(LEVELS) else np.full(docs, UNIT // 1000)
        most[alive] += np.unpackbits(reach, axis=1, count=docs) * (top - before)
        before = top
    most *= asked.weights[:, None]
    present = most.any(1)
    for place, own in enumerate(asked.places):
        if present[own].any():
            yield place, most[own].sum(0)


def _seeds(asked: Asked, n_docs: int, n_terms: int, seeds: int):
    """The documents of greatest bound per item, of the task's blocks."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}
        for block in _blocks(batches, len(asked.weights)):
            ids = block["ids"]
            for place, bound in block_bounds(block, asked, n_docs, n_terms):
                kept = best.get(place, (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
                scores, own = np.concatenate([kept[0], bound]), np.concatenate([kept[1], ids])
                order = np.argsort(-scores, kind="stable")[:seeds]
                best[place] = (scores[order], own[order])
        for place, (scores, own) in best.items():
            good = scores > 0
            yield _pairs(asked.items[place], own[good], scores[good])

    return look


def _reaching(asked: Asked, n_docs: int, n_terms: int, floors: dict[int, tuple[int, int]]):
    """All documents that are not provably below an item's floor."""

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, len(asked.weights)):
            ids = block["ids"]
            for place, bound in block_bounds(block, asked, n_docs, n_terms):
                score, last = floors.get(asked.items[place], (1, NO_ID))
                good = (bound > score) | ((bound == score) & (ids <= last))
                if good.any():
                    yield _pairs(asked.items[place], ids[good], bound[good])

    return look


# Null ids are this number within blocks and floors, after all others.
NO_ID = np.iinfo(np.int64).max
PAIR = "item long, doc_id long, bound long"


def _blocks(batches: Iterable[pa.RecordBatch], n_terms: int) -> Iterator[dict]:
    """The stored blocks, in parts of so many documents that terms times documents stay below ``CELLS``."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.array([NO_ID if i is None else i for i in row["ids"]], dtype=np.int64)
            bitmap = np.frombuffer(row["slices"], dtype=np.uint8).reshape(row["width"], -1)
            step = max(CELLS // max(n_terms, 1) // 8, 1)
            for at in range(0, bitmap.shape[1], step):
                own = slice(8 * at, 8 * (at + step))
                part = {"width": row["width"], "slices": bitmap[:, at : at + step], "ids": ids[own], "sizes": row["sizes"][own]}
                yield part | {"docs": len(part["sizes"])}


def _pairs(item: int, ids: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(np.full(len(ids), item)), pa.array(ids, mask=ids == NO_ID), pa.array(bound)], names=["item", "doc_id", "bound"]
    )


def exact_scores(pairs: DataFrame, docs: DataFrame, asked: Asked, n_docs: int, n_terms: int) -> DataFrame:
    """``item, doc_id, score`` of every document that shares an id with a pair, from its whole text."""
    wanted = store(pairs.groupBy("doc_id").agg(F.collect_set("item").alias("items")), "lexical-wanted")
    wanted = wanted.withColumnRenamed("doc_id", "wanted_id")
    texts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id"))).select("doc_id", "text", "items")
    places = {item: own for item, own in zip(asked.items, asked.places, strict=True)}

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            items, ids, scores = [], [], []
            for doc_id, text, own in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "text", "items")), strict=True):
                size, tf = 0, np.zeros(len(asked.weights), dtype=np.int64)
                for piece in terms_of(text or b""):
                    size += len(piece)
                    known = [asked.terms[t] for t in piece if t in asked.terms]
                    tf += np.bincount(np.array(known, dtype=np.int64), minlength=len(tf))
                held = asked.weights * impact(tf, damping(size, n_docs, n_terms))
                items += own
                ids += [doc_id] * len(own)
                scores += [int(held[places[item]].sum()) for item in own]
            yield pa.record_batch(
                [pa.array(items, pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())], names=["item", "doc_id", "score"]
            )

    return texts.mapInArrow(look, "item long, doc_id long, score long").where("score > 0")


def best_of(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    index: Index, docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0, ranks from 1.

    ``docs`` must be the documents that the index was built from.
    """
    spark: SparkSession = prepared(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    known = item_terms(index, items, item_id, item_text)
    n_items, total = known.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    parts = max(-(-total // TERMS_TOGETHER), -(-n_items // ITEMS_TOGETHER))
    found = None
    for part in range(parts):
        # Dealt by hash into blocks of bounded size on average; one item's own terms are never divided.
        rows = known.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).orderBy("item").collect()
        asked = asked_of(rows, index.n_docs)
        best = store(_searched(spark, index, texts, asked, k), "lexical-best")
        found = best if found is None else found.unionAll(best)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found.join(known.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _searched(spark: SparkSession, index: Index, texts: DataFrame, asked: Asked, k: int) -> DataFrame:
    n_docs, n_terms = index.n_docs, index.n_terms
    columns = index.blocks.select("width", "docs", "ids", "sizes", "slices")
    # A block of slices has up to BLOCK_BYTES: few of them in an Arrow batch.
    with settings(spark, {ARROW_ROWS: "4"}):
        seeds = store(columns.mapInArrow(_seeds(asked, n_docs, n_terms, SEEDS), PAIR), "lexical-seeds")
    place = Window.partitionBy("item").orderBy(F.col("bound").desc(), F.col("doc_id").asc_nulls_last())
    first = seeds.withColumn("r", F.row_number().over(place)).where(F.col("r") <= SEEDS)
    # At most k rows per item of the block.
    known = best_of(exact_scores(first, texts, asked, n_docs, n_terms), k).where(F.col("rank") == k).collect()
    floors = {row["item"]: (row["score"], NO_ID if row["doc_id"] is None else row["doc_id"]) for row in known}
    with settings(spark, {ARROW_ROWS: "4"}):
        pairs = store(columns.mapInArrow(_reaching(asked, n_docs, n_terms, floors), PAIR), "lexical-candidates")
    return best_of(exact_scores(pairs, texts, asked, n_docs, n_terms), k).select("item", "rank", "doc_id", "score")
