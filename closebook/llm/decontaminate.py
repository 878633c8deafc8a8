"""Benchmark decontamination by latent semantic retrieval.

1. TF-IDF over the benchmark's vocabulary: document frequencies count over all passages (blocks of ``PASSAGE`` words)
   of all texts. The same scan writes each text as places in the vocabulary, which the later steps read.
2. Randomised SVD: every task turns its passages A into a part of A'(A W) for one random matrix W; the parts are summed
   in Spark, and the Nystroem form of that sum gives the leading right singular vectors. The benchmark's own rows
   take part, with as much weight as all passages together. The rank is ``RANK``, or a quarter of the block's items when
   that is more.
3. Every text is cut into overlapping windows, for each length of items such that an item lies in one whole, wherever
   it stands, with up to a quarter as many words put in between. Windows and items are compared in the latent space,
   by cosine and by how much of the item the window covers. As a latent space of any rank may lose a passage, the
   words around every run of ``LEAST`` words that an item holds, too, are candidates as well: no verbatim item is lost.
4. Candidates are verified word by word: the longest common subsequence must hold ``MATCH`` of the item's words, and
   ``ANSWER`` of the words of the item's last sentence, which bears its answer.

The benchmark is the query set. It is handled in blocks of ``ITEMS`` items, so what is broadcast has a bound
(``ITEMS`` items of at most ``WORDS`` words in all); texts are scanned once for a block and never shuffled.

Defined cases: null or empty texts and items match nothing; an item of fewer than ``LEAST`` words is too common to
judge and matches nothing; equal texts match alike; an empty table or benchmark gives no rows; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from closebook.llm.common import TEXT_BYTES, forget, prepared, slices, store
from closebook.llm.shingles import mix64, word_hashes

PASSAGE = 32
STRIDE = 16
RANK = 64
ITEMS, WORDS = 1000, 50_000
LEAST = 5
COSINE, COVER = 0.25, 0.5
MATCH, ANSWER = 0.6, 0.5


@dataclass
class Item:
    """One benchmark item: its words, where its last sentence starts, and the bit masks of its words' places."""

    item_id: int
    words: list[int]
    answer: int
    masks: dict[int, int] = field(default_factory=dict)

    def __post_init__(self):
        for place, word in enumerate(self.words):
            self.masks[word] = self.masks.get(word, 0) | 1 << place

    def common(self, text: list[int]) -> tuple[int, int]:
        """Length of the longest common subsequence with a text, of the whole item and of its last sentence."""
        held = self._held(text)
        return _subsequence(held, len(self.words), 0), _subsequence(held, len(self.words) - self.answer, self.answer)

    def match(self, text: list[int]) -> tuple[float, float] | None:
        """Both lengths as shares, if they reach ``MATCH`` and ``ANSWER``. A text with too few of the item's words, in any
        order, is out at once, and the last sentence is compared only if the whole item matches."""
        held, size = self._held(text), len(self.words)
        if len(held) / size < MATCH or (whole := _subsequence(held, size, 0) / size) < MATCH:
            return None
        answer = _subsequence(held, size - self.answer, self.answer) / (size - self.answer)
        return (whole, answer) if answer >= ANSWER else None

    def _held(self, text: list[int]) -> list[int]:
        """The masks of the words of a text that the item has, too."""
        return [self.masks[word] for word in text if word in self.masks]


def _subsequence(held: list[int], size: int, skip: int) -> int:
    """Bit-parallel length of the longest common subsequence of a text, given by masks, and the words from ``skip`` on."""
    full = (1 << size) - 1
    row = full
    for here in held:
        step = row & (here >> skip)
        row = ((row + step) | (row - step)) & full
    return size - row.bit_count()


def last_sentence(text: str) -> int:
    """How many words stand before a text's last sentence."""
    words = text.split()
    for i in range(len(words) - 2, -1, -1):
        if words[i][-1] in ".?!:":
            return i + 1 if len(words) - i - 1 >= 3 else 0
    return 0


def read_items(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[Item]]:
    """The benchmark in blocks of bounded size, in the order of ids."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    block, words = [], 0
    for row in rows.orderBy("i", "t").toLocalIterator():
        hashes, _ = word_hashes([row["t"]])
        if len(hashes) < LEAST:
            continue
        if block and (len(block) >= ITEMS or words + len(hashes) > WORDS):
            yield block
            block, words = [], 0
        block.append(Item(row["i"], hashes.tolist(), min(last_sentence(row["t"]), len(hashes) - 1)))
        words += len(hashes)
    if block:
        yield block


class Vocabulary:
    """Places of known word hashes, by a table of buckets that is then checked."""

    def __init__(self, words: np.ndarray):
        self.words = np.sort(words)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash, -1 where unknown."""
        if not hasattr(self, "table"):
            bits = max(16, int(len(self.words)).bit_length() + 4)
            self.mask = np.uint64((1 << bits) - 1)
            self.table = np.zeros(1 << bits, dtype=bool)
            self.table[(self.words & self.mask).astype(np.int64)] = True
        out = np.full(len(hashes), -1, dtype=np.int64)
        maybe = np.flatnonzero(self.table[(hashes & self.mask).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.words, hashes[maybe]), len(self.words) - 1)
        good = self.words[at] == hashes[maybe]
        out[maybe[good]] = at[good]
        return out


class ItemRuns:
    """All runs of ``LEAST`` words of the items, and where they are found in texts."""

    def __init__(self, items: list[Item]):
        runs = [run_hashes(np.array(x.words, dtype=np.int64)) for x in items]
        item = np.repeat(np.arange(len(items)), [len(r) for r in runs])
        place = np.concatenate([np.arange(len(r)) for r in runs])
        every = np.concatenate(runs)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.table = Vocabulary(np.unique(every))
        self.edges = np.append(np.searchsorted(every[order], self.table.words), len(every))

    def found(self, words: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, item and the place where the item would begin, for every run that a text shares with an item; places of
        one item that lie close together are given once."""
        at = self.table.places(run_hashes(words))
        hits = np.flatnonzero(at >= 0)
        doc = np.searchsorted(np.cumsum(counts), hits, side="right")
        inside = hits + LEAST <= np.cumsum(counts)[doc] if len(hits) else hits.astype(bool)
        hits, doc = hits[inside], doc[inside]
        size = self.edges[at[hits] + 1] - self.edges[at[hits]]
        entry = np.repeat(self.edges[at[hits]] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        doc, item = np.repeat(doc, size), self.item[entry]
        start = np.repeat(hits, size) - self.place[entry]
        keys = np.unique(np.stack([doc, item, start // STRIDE], axis=1), axis=0, return_index=True)[1] if len(doc) else []
        for i in keys:
            yield int(doc[i]), int(item[i]), int(start[i])


def run_hashes(words: np.ndarray) -> np.ndarray:
    """A hash of the ``LEAST`` words, given by their places, from every word on, across texts; callers leave out those
    that end in another."""
    size, own = max(len(words) - LEAST + 1, 0), (words + 1).astype(np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for k in range(LEAST):
        out = out * np.uint64(0x9E3779B97F4A7C15) + own[k : k + size]
    return mix64(out)


def _blocks(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Block of every word when each text is cut into blocks of ``size`` words, and the number of blocks of each text."""
    n = -(-counts // size)
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.repeat(np.cumsum(n) - n, counts) + inside // size, n


def known_words(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id, places``: every text as the places of its words, -1 where unknown; and, in rows without places, how many
    of a task's passages hold each word, the number of passages last."""
    held = texts.sparkSession.sparkContext.broadcast(vocabulary)

    def look(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        known = held.value
        found, passages = np.zeros(len(known.words) + 1, dtype=np.int64), 0
        for batch in slices(batches, "text", TEXT_BYTES):
            hashes, counts = word_hashes(batch.column("text").to_pylist())
            place = known.places(hashes)
            block, n = _blocks(counts, PASSAGE)
            there = place >= 0
            size = np.int64(len(known.words))
            found[:-1] += np.bincount(np.unique(block[there] * size + place[there]) % size, minlength=len(known.words))
            passages += int(n.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.insert(np.cumsum(counts), 0, 0), pa.int32()), pa.array(place, pa.int32()))
            yield pa.record_batch([batch.column("doc_id"), lists, pa.nulls(len(counts), pa.list_(pa.int64()))], names=["doc_id", "places", "found"])
        found[-1] = passages
        nothing = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.list_(pa.int32()))]
        yield pa.record_batch([*nothing, pa.array([found], pa.list_(pa.int64()))], names=["doc_id", "places", "found"])

    return texts.mapInArrow(look, "doc_id long, places array<int>, found array<long>")


def _parts(batches: Iterable[pa.RecordBatch], most: int = 1 << 18) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Ids, places of words and numbers of words of consecutive rows, of about ``most`` words together, one row at least."""
    for batch in batches:
        lists = batch.column("places")
        edges = np.asarray(lists.offsets).astype(np.int64)
        cuts = np.flatnonzero(np.diff((edges - edges[0]) // most, append=-1)) if len(edges) > 1 else []
        a = 0
        for b in sorted({max(int(c), 1) for c in cuts} | {batch.num_rows}):
            if b > a:
                part = lists.slice(a, b - a)
                yield batch.column("doc_id").slice(a, b - a), np.asarray(part.flatten()).astype(np.int64), np.diff(edges[a : b + 1])
                a = b


def _passages(place: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Passage, word place and count of every pair of both that occurs, and the number of passages."""
    block, n = _blocks(counts, PASSAGE)
    known = place >= 0
    pairs, times = np.unique(block[known] * np.int64(size) + place[known], return_counts=True)
    return pairs // size, pairs % size, times, int(n.sum())


def _segments(table: np.ndarray, at: np.ndarray, group: np.ndarray, n: int, factor: np.ndarray | None = None, most: int = 32) -> np.ndarray:
    """Sums by ascending ``group`` of the rows ``at`` of ``table``, each times its ``factor``."""
    out = np.zeros((n, table.shape[1]), dtype=np.float32)
    if not len(group):
        return out
    first = np.flatnonzero(np.diff(group, prepend=-1))
    inside = np.arange(len(group)) - np.repeat(first, np.diff(first, append=len(group)))
    # Groups are cut into pieces of ``most`` rows; the k-th rows of all pieces, long ones first, are added at once.
    start = np.flatnonzero(inside % most == 0)
    size = np.diff(start, append=len(group))
    order = np.argsort(-size, kind="stable")
    longer = len(size) - np.cumsum(np.bincount(size))
    sums = np.zeros((len(start), table.shape[1]), dtype=np.float32)
    for k in range(len(longer) - 1):
        rows = start[order[: longer[k]]] + k
        part = table[at[rows]]
        if factor is not None:
            part *= factor[rows, None]
        sums[: len(rows)] += part
    pieces = np.empty_like(sums)
    pieces[order] = sums
    whole = np.flatnonzero(inside[start] == 0)
    out[group[first]] = pieces if len(whole) == len(start) else np.add.reduceat(pieces, whole, axis=0)
    return out


def _weights(times: np.ndarray, idf: np.ndarray | float, group: np.ndarray, n: int) -> np.ndarray:
    """Unit-length weights of the words of passages."""
    value = (1 + np.log(times)) * idf
    norm = np.sqrt(np.bincount(group, weights=value * value, minlength=n))
    return (value / np.maximum(norm[group], 1e-12)).astype(np.float32)


def _project(group: np.ndarray, place: np.ndarray, value: np.ndarray, n: int, random: np.ndarray, into: np.ndarray) -> None:
    """Adds A'(A W) of some passages, given by their entries, to ``into``."""
    seen = _segments(random, place, group, n, value)
    order = np.argsort(place, kind="stable")
    into += _segments(seen, group[order], place[order], len(into), value[order])


def latent_space(known: DataFrame, size: int, items: list[Item]) -> tuple[np.ndarray, np.ndarray]:
    """Weights of the words, and the leading right singular vectors of all passages and items: words x rank, orthonormal
    columns."""
    counts, passages = np.zeros(size, dtype=np.int64), 0
    for row in known.where("found is not null").select(F.posexplode("found")).groupBy("pos").agg(F.sum("col").alias("n")).collect():
        if row["pos"] == size:
            passages = row["n"]
        else:
            counts[row["pos"]] = row["n"]
    idf = np.log((passages + len(items) + 1) / (counts + 1.0))
    rank = min(max(RANK, len(items) // 4), size)
    sketch = np.random.default_rng(5).standard_normal((size, rank)).astype(np.float32)
    held = known.sparkSession.sparkContext.broadcast((idf, sketch))

    def sketched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, random = held.value
        total = np.zeros(random.shape, dtype=np.float32)
        for _, places, lengths in _parts(batches):
            group, place, times, n = _passages(places, lengths, len(random))
            _project(group, place, _weights(times, weight[place], group, n), n, random, total)
        there = np.flatnonzero(total.any(1))
        edges = np.arange(len(there) + 1, dtype=np.int32) * random.shape[1]
        rows = pa.ListArray.from_arrays(pa.array(edges), pa.array(total[there].astype(np.float64).ravel()))
        yield pa.record_batch([pa.array(there), rows], names=["place", "part"])

    parts = known.where("places is not null").select("doc_id", "places").mapInArrow(sketched, "place long, part array<double>")
    sums = F.array(*[F.sum(F.col("part")[i]) for i in range(rank)]).alias("part")
    gram = np.zeros((size, rank))
    for row in parts.groupBy("place").agg(sums).collect():
        gram[row["place"]] = row["part"]

    pairs = [np.unique(x.words, return_counts=True) for x in items]
    group = np.repeat(np.arange(len(items)), [len(p[0]) for p in pairs])
    place, times = np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])
    own = np.zeros((size, rank), dtype=np.float32)
    _project(group, place, _weights(times, idf[place], group, len(items)), len(items), sketch, own)
    gram += own * max(1.0, passages / len(items))
    return idf, nystroem(gram, sketch)


def nystroem(gram: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Eigenvectors of a positive matrix G from G W and the random W, leading first."""
    shift = 1e-7 * max(float(np.linalg.norm(gram)), 1e-12)
    moved = gram + shift * sketch
    core = sketch.T @ moved
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > 1e-12 * max(values.max(initial=0.0), 1e-30)
    root = moved @ (vectors[:, good] / np.sqrt(values[good]))
    left, _, _ = np.linalg.svd(root, full_matrices=False)
    return np.ascontiguousarray(left, dtype=np.float32)


def windows(words: int) -> tuple[int, int]:
    """Length of the windows for items of so many words, and how far apart they begin, both in strides."""
    need = -(-(words + words // 4) // STRIDE)
    step = max(1, need // 2)
    return need + step, step


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``doc_id, item_id, lcs, answer_lcs``: the pairs of documents and benchmark items that match, the latter two as
    shares of the item's words and of its last sentence's. One row per pair and row of ``docs``."""
    spark = prepared(docs.sparkSession)
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("text is not null")
    found = spark.createDataFrame([], RESULT)
    for items in read_items(benchmark, item_id, item_text):
        found = found.unionAll(_block_leaks(spark, texts, items))
    return found


RESULT = "doc_id long, item_id long, lcs double, answer_lcs double"


def _block_leaks(spark: SparkSession, texts: DataFrame, items: list[Item]) -> DataFrame:
    vocabulary = Vocabulary(np.unique(np.concatenate([np.array(x.words, dtype=np.uint64) for x in items])))
    # From here on a word is its place in the vocabulary.
    items = [Item(x.item_id, vocabulary.places(np.array(x.words, dtype=np.uint64)).tolist(), x.answer) for x in items]
    known = store(known_words(texts, vocabulary), "known-words")
    idf, basis = latent_space(known, len(vocabulary.words), items)
    weighted = (basis * idf[:, None]).astype(np.float32)
    latent = np.array([weighted[x.words].sum(0) for x in items])
    held = spark.sparkContext.broadcast((weighted, latent, items, ItemRuns(items)))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, queries, wanted, runs = held.value
        # Items by the windows that surely hold them whole.
        spans = defaultdict(list)
        for k, item in enumerate(wanted):
            spans[windows(len(item.words))].append(k)
        for ids, places, counts in _parts(batches):
            yield _matches(ids, places, counts, weight, queries, wanted, spans, runs)

    return known.where("places is not null").select("doc_id", "places").mapInArrow(search, RESULT)


def _matches(
    doc_ids: pa.Array, place: np.ndarray, counts: np.ndarray, weight: np.ndarray, queries: np.ndarray, items: list[Item],
    spans: dict[tuple[int, int], list[int]], runs: ItemRuns,
) -> pa.RecordBatch:
    block, n = _blocks(counts, STRIDE)
    there = np.flatnonzero(place >= 0)
    strides = _segments(weight, place[there], block[there], int(n.sum()))
    first_word, first_block = np.cumsum(counts) - counts, np.cumsum(n) - n
    doc_of = np.repeat(np.arange(len(n)), n)
    last = (first_block + n)[doc_of]
    sums = np.vstack([np.zeros((1, strides.shape[1])), np.cumsum(strides, axis=0, dtype=np.float64)])
    out: dict[tuple[int, int], tuple[float, float]] = {}

    def judge(doc: int, k: int, a: int, b: int) -> None:
        found = items[k].match(place[a:b].tolist())
        if found:
            out[doc, k] = max(out.get((doc, k), (0.0, 0.0)), found)

    stops = first_word + counts
    for doc, k, start in runs.found(place, counts):
        slack = len(items[k].words) // 4 + 1
        judge(doc, k, max(start - slack, first_word[doc]), min(start + len(items[k].words) + slack, stops[doc]))
    for (span, step), ks in spans.items():
        # A window of ``span`` strides begins at every ``step``; those at a text's end are shorter.
        begin = np.flatnonzero((np.arange(len(doc_of)) - first_block[doc_of]) % step == 0)
        end = np.minimum(begin + span, last[begin])
        window = (sums[end] - sums[begin]).astype(np.float32)
        q = queries[ks]
        energy = np.maximum((q * q).sum(1), 1e-12)
        length = np.sqrt((window * window).sum(1))
        for at in range(0, len(begin), 8192):
            dots = window[at : at + 8192] @ q.T
            near = (dots >= COVER * energy) & (dots >= COSINE * np.sqrt(energy) * np.maximum(length[at : at + 8192], 1e-12)[:, None])
            for w, k in zip(*np.nonzero(near), strict=True):
                doc = int(doc_of[begin[at + w]])
                offset = first_word[doc] - first_block[doc] * STRIDE
                judge(doc, ks[k], begin[at + w] * STRIDE + offset, min(end[at + w] * STRIDE + offset, stops[doc]))
    ids = doc_ids.to_pylist()
    keys = sorted(out)
    columns = [
        pa.array([ids[d] for d, _ in keys], pa.int64()),
        pa.array([items[k].item_id for _, k in keys], pa.int64()),
        pa.array([out[x][0] for x in keys], pa.float64()),
        pa.array([out[x][1] for x in keys], pa.float64()),
    ]
    return pa.record_batch(columns, names=["doc_id", "item_id", "lcs", "answer_lcs"])
