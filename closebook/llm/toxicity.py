"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

Words are runs of ASCII letters and non-ASCII bytes, ASCII-lowered. A word's input is its hashed word vector beside
the mean of its hashed letter trigrams' vectors. Two gated recurrent layers read a window of words forwards and
backwards; attention weighs their states, and a logistic unit judges the weighted mean. A text is cut into windows of
``WINDOW`` words that overlap by half, all windows are scored, and the worst gives the text's score.

Training sees a bounded sample of labelled texts. A toxic text need not be toxic throughout, so of each text the
windows that score worst are learned from, chosen anew as the network learns. First vectors carry the smoothed log
odds of words and trigrams, so that learning needs few passes.

Defined cases: null texts and texts without words are one window without words, scored like any other; equal texts
get equal scores; without labels of both kinds every score is the share of toxic rows (0 without rows); an empty
table gives no rows; other columns are kept, but for those named like the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from closebook.llm.common import prepared, slices
from closebook.llm.shingles import words_of

WINDOW, STRIDE = 32, 16
STATES = 8
VECTOR = 8
# Buckets enough that few words share one: a frequent word would hide another's odds.
WORDS, TRIGRAMS = 1 << 19, 1 << 15
# The bound of the fitted sample: rows of each label, and words of a row.
TOXIC_ROWS, OTHER_ROWS, ROW_WORDS = 1500, 3000, 3000
ROUNDS, EPOCHS, BATCH, RATE = 2, 2, 256, 0.01
# Texts that a word or trigram must stand in before its odds count, and how slowly they then grow.
SUPPORT, SLOW = 8, 10
# The weight of toxic texts in learning, however many they are.
TOXIC_SHARE = 0.5
RESULTS = ("score", "predicted")

_SEPARATES = np.ones(256, dtype=bool)
_SEPARATES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Words:
    """The distinct words of some texts: their buckets, their trigrams' buckets, and where each stands."""

    def __init__(self, texts: list[str | None]):
        data, starts, ends, hashes, self.counts = words_of(texts, _SEPARATES)
        _, first, self.place = np.unique(hashes, return_index=True, return_inverse=True)
        starts, ends = starts[first], ends[first]
        self.bucket = (hashes[first] % np.uint64(WORDS)).astype(np.int64)
        # A word's trigrams are centred on each of its bytes; its first and last reach a separator.
        self.sizes = ends - starts
        total = int(self.sizes.sum())
        at = np.repeat(starts - (np.cumsum(self.sizes) - self.sizes), self.sizes) + np.arange(total)
        edge = np.zeros(len(data) + 2, dtype=np.uint32)
        edge[1:-1] = np.where(_SEPARATES[data], 0, data)
        mixed = edge[at] * np.uint32(0x9E3779B1) + edge[at + 1] * np.uint32(0x85EBCA6B) + edge[at + 2] * np.uint32(0xC2B2AE35)
        mixed ^= mixed >> np.uint32(15)
        self.trigram = (mixed % np.uint32(TRIGRAMS)).astype(np.int64)

    def only(self, used: np.ndarray) -> Words:
        """Some of the distinct words, without their places."""
        some = Words.__new__(Words)
        some.bucket, some.sizes = self.bucket[used], self.sizes[used]
        first = (np.cumsum(self.sizes) - self.sizes)[used]
        begin = np.cumsum(some.sizes) - some.sizes
        some.trigram = self.trigram[np.repeat(first - begin, some.sizes) + np.arange(int(some.sizes.sum()))]
        return some

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows of word places, one past the last word where a window has none, and the text of each row."""
        n = np.maximum(-(-(self.counts - WINDOW) // STRIDE), 0) + 1
        doc = np.repeat(np.arange(len(n)), n)
        begin = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
        inside = begin[:, None] + np.arange(WINDOW)
        there = inside < self.counts[doc][:, None]
        first = (np.cumsum(self.counts) - self.counts)[doc][:, None]
        places = np.append(self.place, 0)[np.where(there, first + inside, len(self.place))]
        return np.where(there, places, len(self.bucket)), doc


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, seed: int = 9):
        draws = np.random.default_rng(seed)
        make = lambda *shape: (draws.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        h, x = STATES, 2 * VECTOR
        self.p = {"words": make(WORDS, VECTOR) * 0.1, "trigrams": make(TRIGRAMS, VECTOR) * 0.1}
        for side in "fb":  # gates: update, reset, new
            self.p |= {f"w{side}": make(x, 3 * h), f"u{side}": make(h, 3 * h), f"c{side}": np.zeros(3 * h, np.float32)}
        self.p |= {"a": make(2 * h, h), "ac": np.zeros(h, np.float32), "av": make(h), "o": make(2 * h), "oc": np.zeros(1, np.float32)}
        self.share = 0.0  # the answer while nothing was learned
        self.fitted = False

    def inputs(self, words: Words) -> np.ndarray:
        """The input of every distinct word, and zeros for a place without word."""
        mean = np.zeros((len(words.bucket), VECTOR), dtype=np.float32)
        if len(words.bucket):
            first = np.cumsum(words.sizes) - words.sizes
            mean = np.add.reduceat(self.p["trigrams"][words.trigram], first, axis=0) / words.sizes[:, None]
        both = np.hstack([self.p["words"][words.bucket], mean.astype(np.float32)])
        return np.vstack([both, np.zeros((1, 2 * VECTOR), np.float32)])

    def _side(self, side: str, gates: np.ndarray, rows: np.ndarray, there: np.ndarray, keep: bool):
        """States after every step of one direction; with what the way back needs if asked for."""
        h, u = np.zeros((len(rows), STATES), np.float32), self.p[f"u{side}"]
        out, kept = np.zeros((WINDOW, len(rows), STATES), np.float32), {}
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            x, r = gates[rows[:, t]], h @ u
            both = _sigmoid(x[:, : 2 * STATES] + r[:, : 2 * STATES])
            update, reset = both[:, :STATES], both[:, STATES:]
            new = np.tanh(x[:, 2 * STATES :] + reset * r[:, 2 * STATES :])
            on = there[:, t, None]
            if keep:
                kept[t] = (h, update, reset, new, r[:, 2 * STATES :])
            h = np.where(on, new + update * (h - new), h)
            out[t] = h
        return out, kept

    def forward(self, inputs: np.ndarray, rows: np.ndarray, keep: bool = False):
        p, there = self.p, rows < len(inputs) - 1
        sides = [self._side(s, inputs @ p[f"w{s}"] + p[f"c{s}"], rows, there, keep) for s in "fb"]
        states = np.concatenate([s[0] for s in sides], axis=2)  # step, row, state
        hidden = np.tanh(states @ p["a"] + p["ac"])
        weight = np.where(there.T, hidden @ p["av"], np.float32(-1e4))
        weight = np.exp(weight - weight.max(0))
        weight *= there.T
        weight /= np.maximum(weight.sum(0), 1e-12)
        pooled = (weight[:, :, None] * states).sum(0)
        return pooled @ p["o"] + p["oc"][0], (there, sides, states, hidden, weight, pooled)

    def gradients(self, words: Words, rows: np.ndarray, wanted: np.ndarray, weights: np.ndarray) -> tuple[float, dict]:
        """Loss and slopes of all parameters for some windows, back through time."""
        used = np.unique(rows[rows < len(words.bucket)])
        rows = np.where(rows < len(words.bucket), np.searchsorted(used, rows), len(used))
        words = words.only(used)
        p, inputs = self.p, self.inputs(words)
        logit, (there, sides, states, hidden, weight, pooled) = self.forward(inputs, rows, keep=True)
        chance = _sigmoid(logit)
        loss = -(weights * np.log(np.where(wanted > 0, chance, 1 - chance) + 1e-9)).sum()
        error = (weights * (chance - wanted)).astype(np.float32)
        g = {"o": pooled.T @ error, "oc": np.array([error.sum()], np.float32)}
        d_pooled = error[:, None] * p["o"]
        d_states = weight[:, :, None] * d_pooled
        d_weight = (states * d_pooled).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["av"] = (d_score[:, :, None] * hidden).sum((0, 1))
        d_hidden = d_score[:, :, None] * p["av"] * (1 - hidden * hidden)
        flat = d_hidden.reshape(-1, STATES)
        g["a"], g["ac"] = states.reshape(-1, 2 * STATES).T @ flat, flat.sum(0)
        d_states = d_states + d_hidden @ p["a"].T
        d_inputs = np.zeros_like(inputs)
        for i, side in enumerate("fb"):
            u, kept = p[f"u{side}"], sides[i][1]
            d_u, d_h = np.zeros_like(u), np.zeros((len(rows), STATES), np.float32)
            d_gates = np.zeros((len(inputs), 3 * STATES), np.float32)
            for t in range(WINDOW - 1, -1, -1) if side == "f" else range(WINDOW):
                h, update, reset, new, r_new = kept[t]
                d_h = d_h + d_states[t, :, i * STATES : (i + 1) * STATES]
                on = there[:, t, None]
                d_here = d_h * on
                d_new = d_here * (1 - update) * (1 - new * new)
                d_update = d_here * (h - new) * update * (1 - update)
                d_reset = d_new * r_new * reset * (1 - reset)
                d_x = np.concatenate([d_update, d_reset, d_new], axis=1)
                d_r = np.concatenate([d_update, d_reset, d_new * reset], axis=1)
                np.add.at(d_gates, rows[:, t], d_x)
                d_u += h.T @ d_r
                d_h = np.where(on, d_here * update + d_r @ u.T, d_h)
            d_gates[-1] = 0
            g[f"u{side}"], g[f"w{side}"], g[f"c{side}"] = d_u, inputs.T @ d_gates, d_gates.sum(0)
            d_inputs += d_gates @ p[f"w{side}"].T
        g["words"] = np.zeros_like(p["words"])
        np.add.at(g["words"], words.bucket, d_inputs[:-1, :VECTOR])
        g["trigrams"] = np.zeros_like(p["trigrams"])
        each = d_inputs[:-1, VECTOR:] / words.sizes[:, None]
        np.add.at(g["trigrams"], words.trigram, np.repeat(each, words.sizes, axis=0))
        return float(loss), g

    def window_logits(self, inputs: np.ndarray, rows: np.ndarray, together: int = 4096) -> np.ndarray:
        return np.concatenate([self.forward(inputs, rows[i : i + together])[0] for i in range(0, len(rows), together)])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The chance that each text is toxic: that of its worst window."""
        if not self.fitted:
            return np.full(len(texts), self.share)
        words = Words(texts)
        rows, doc = words.windows()
        logits = self.window_logits(self.inputs(words), rows)
        return _sigmoid(np.maximum.reduceat(logits, np.flatnonzero(np.diff(doc, prepend=-1))).astype(np.float64))


def _odds(words: Words, toxic: np.ndarray, entry: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Smoothed log odds of toxic texts having each bucket, less where few texts have it, none where hardly any has: the
    odds of words that only the sample's own texts have would be learned by heart."""
    pairs = np.unique(doc * np.int64(size) + entry)
    doc, entry = pairs // size, pairs % size
    yes = np.bincount(entry[toxic[doc]], minlength=size)
    no = np.bincount(entry[~toxic[doc]], minlength=size)
    odds = np.log((yes + 0.5) / (toxic.sum() + 1)) - np.log((no + 0.5) / ((~toxic).sum() + 1))
    return np.where(yes + no >= SUPPORT, odds * (yes + no) / (yes + no + SLOW), 0).astype(np.float32)


def fit(texts: list[str], labels: list[int], seed: int = 9) -> Network:
    """Train on a sample by Adam; both labels weigh as ``TOXIC_SHARE`` says."""
    network, toxic = Network(seed), np.array(labels, dtype=bool)
    network.share = float(toxic.mean()) if len(toxic) else 0.0
    if not toxic.any() or toxic.all():
        return network
    network.fitted = True
    words = Words(texts)
    rows, doc = words.windows()
    word_doc = np.repeat(np.arange(len(texts)), words.counts)
    network.p["words"][:, 0] = 0.5 * _odds(words, toxic, words.bucket[words.place], word_doc, WORDS)
    first = np.cumsum(words.sizes) - words.sizes
    seen = np.unique(word_doc * np.int64(max(len(words.bucket), 1)) + words.place)
    seen_doc, seen_word = seen // max(len(words.bucket), 1), seen % max(len(words.bucket), 1)
    sizes = words.sizes[seen_word]
    at = np.repeat(first[seen_word] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    network.p["trigrams"][:, 0] = 0.5 * _odds(words, toxic, words.trigram[at], np.repeat(seen_doc, sizes), TRIGRAMS)

    draws = np.random.default_rng(seed)
    inputs = network.inputs(words)
    value = np.append(inputs[:-1, 0], 0)[rows].max(1)
    mean = {k: np.zeros_like(v) for k, v in network.p.items()}
    square = {k: np.zeros_like(v) for k, v in network.p.items()}
    step = 0
    for _ in range(ROUNDS):
        # The worst window of every text, and another of each that is not toxic.
        order = np.lexsort((-value, doc))
        worst = order[np.flatnonzero(np.diff(doc[order], prepend=-1))]
        other = draws.permutation(len(rows))
        other = other[~toxic[doc[other]]][: len(worst)]
        chosen = np.concatenate([worst, other])
        wanted = toxic[doc[chosen]].astype(np.float32)
        share = np.where(wanted > 0, TOXIC_SHARE / wanted.sum(), (1 - TOXIC_SHARE) / (len(wanted) - wanted.sum())) * len(wanted)
        for _ in range(EPOCHS):
            mixed = draws.permutation(len(chosen))
            for i in range(0, len(mixed), BATCH):
                some = mixed[i : i + BATCH]
                _, slopes = network.gradients(words, rows[chosen[some]], wanted[some], share[some] / len(some))
                step += 1
                for k, slope in slopes.items():
                    mean[k] = 0.9 * mean[k] + 0.1 * slope
                    square[k] = 0.999 * square[k] + 0.001 * slope * slope
                    rate = RATE * (0.3 if k in ("words", "trigrams") else 1.0)
                    network.p[k] -= (rate * mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        value = network.window_logits(network.inputs(words), rows)
    return network


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Network:
    """Fit on a bounded sample of the labelled rows: the least hashes of ids of each label, texts of bounded length."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    known = known.select(F.col(doc_id).alias("id"), (F.col(label) == 1).cast("int").alias("y"))
    wanted = F.when(F.col("y") == 1, F.lit(TOXIC_ROWS)).otherwise(F.lit(OTHER_ROWS))
    # A part of the hash range that surely holds enough of each label comes first, so that no window holds all labels.
    sizes = {row["y"]: row["n"] for row in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    part = F.lit(0.0)
    for y, most in ((1, TOXIC_ROWS), (0, OTHER_ROWS)):
        part = F.when(F.col("y") == y, F.lit(min(1.0, 2 * most / max(sizes.get(y, 0), 1)))).otherwise(part)
    known = known.where(F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 20)) < part * (1 << 20))
    place = F.row_number().over(Window.partitionBy("y").orderBy(F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(1 << 20)), "id"))
    few = known.withColumn("r", place).where(F.col("r") <= TOXIC_ROWS + OTHER_ROWS).where(F.col("r") <= wanted).select("id", "y")
    # At most the two bounds of rows, so sent to all tasks.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("t")).join(F.broadcast(few), "id")
    rows = rows.where(F.col("t").isNotNull() & (F.regexp_count("t", F.lit(r"\s+")) < ROW_WORDS) & (F.length("t") <= 12 * ROW_WORDS))
    got = sorted((r["y"], r["id"], r["t"]) for r in rows.limit(2 * (TOXIC_ROWS + OTHER_ROWS)).collect())
    return fit([t for *_, t in got], [y for y, *_ in got])


def score(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5) for every whole text."""
    spark = prepared(docs.sparkSession)
    kept = [c for c in docs.columns if c not in RESULTS]
    held = spark.sparkContext.broadcast(network)  # bounded: the two tables of vectors

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "scored_text", 1 << 20):
            chances = held.value.scores(batch.column(batch.num_columns - 1).to_pylist())
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(chances), pa.array((chances >= 0.5).astype(np.int32))]
            yield pa.record_batch(columns, names=[*kept, *RESULTS])

    schema = StructType([*(docs.schema[c] for c in kept), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("scored_text")).mapInArrow(judge, schema)
