"""Language identification by error-correcting output codes.

Every language has a codeword, and a binary classifier on byte n-grams predicts each of its bits. The classifiers are
logistic regressions on hashed 2-, 3- and 4-grams of the ASCII-lowered UTF-8 bytes (log counts, unit length), fitted
together in numpy on a bounded sample of labelled rows. A text is decoded to the language whose codeword has the
least loss, each bit weighted by how well its classifier does; if the second is too near, the answer is ambiguous.

Defined cases: null texts and texts without any letter are ``und`` with score 0, not ambiguous; equal texts get equal
answers; without labelled rows every text is ``und``; with one known language it is always the answer; empty tables
give no rows; other columns are kept, but for those named like the results, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from closebook.llm.common import forget, prepared, slices

UNKNOWN = "und"
# The bound of the fitted sample: so many texts of each language, and so many in all.
PER_LANGUAGE = 250
SAMPLE_ROWS = 4000
MOST_LANGUAGES = 256
DIMENSIONS = 1 << 12
MARGIN = 0.2  # of the summed bit weights: a lead of less is ambiguous
RESULTS = ("lang_pred", "score", "ambiguous")


def _tables() -> np.ndarray:
    return np.random.default_rng(10).integers(0, 1 << 32, (9, 256), dtype=np.uint32)


_HASH = _tables()


def features(text: str, dimensions: int = DIMENSIONS) -> np.ndarray:
    """The unit vector of the logs of hashed n-gram counts of a whole text."""
    data = np.frombuffer(text.encode("utf-8", "replace").lower(), dtype=np.uint8)
    counts = np.zeros(dimensions, dtype=np.int64)
    first = 0
    for n in (2, 3, 4):
        size = len(data) - n + 1
        if size > 0:
            # A text is hashed a piece at a time, so that a long one takes no more memory.
            for at in range(0, size, 1 << 20):
                stop = min(at + (1 << 20), size)
                mixed = _HASH[first][data[at:stop]].copy()
                for i in range(1, n):
                    mixed += _HASH[first + i][data[at + i : stop + i]]
                mixed ^= mixed >> np.uint32(15)
                counts += np.bincount(mixed % np.uint32(dimensions), minlength=dimensions)
        first += n
    out = np.log1p(counts).astype(np.float32)
    norm = float(np.sqrt((out * out).sum()))
    return out / norm if norm else out


def codewords(n: int) -> np.ndarray:
    """``n`` distinct rows of bits: all splits in two for up to five languages, else the best of random codes."""
    if n <= 1:
        return np.zeros((n, 1), dtype=np.int8)
    if n <= 5:
        columns = [[1] + [(c >> (n - 2 - i)) & 1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(columns, dtype=np.int8).T
    length = int(np.ceil(10 * np.log2(n)))
    draws = np.random.default_rng(n)
    best, best_distance = None, -1
    for _ in range(50):
        code = draws.integers(0, 2, (n, length)).astype(np.int8)
        apart = (code[:, None] != code[None]).sum(2) + np.eye(n, dtype=int) * length
        useful = (code.any(0) & ~code.all(0)).all()
        if useful and apart.min() > best_distance:
            best, best_distance = code, int(apart.min())
    return best


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # dimensions x bits
    bias: np.ndarray
    bit_weights: np.ndarray  # how far each bit is trusted

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The language's place, its score and whether the choice is ambiguous, for rows of features."""
        margins = x @ self.weights + self.bias
        signs = self.code.astype(np.float32) * 2 - 1
        # Logistic loss of every bit against every codeword.
        losses = np.log1p(np.exp(-np.clip(margins[:, None, :] * signs[None], -30, 30))) @ self.bit_weights
        best = losses.argmin(1)
        chances = np.exp(losses.min(1, keepdims=True) - losses)
        score = 1 / chances.sum(1)
        if len(self.languages) == 1:
            return best, score, np.zeros(len(x), dtype=bool)
        lead = np.diff(np.partition(losses, 1, axis=1)[:, :2], axis=1)[:, 0]
        return best, score, lead < MARGIN * self.bit_weights.sum()


def fit(x: np.ndarray, labels: list[str], steps: int = 300, rate: float = 0.5, decay: float = 1e-4) -> Model | None:
    """Logistic regressions of all bits at once, by Adam over the whole sample, rows weighted alike per language."""
    languages = sorted(set(labels))
    if not languages:
        return None
    place = np.array([languages.index(y) for y in labels])
    code = codewords(len(languages))
    goal = code[place].astype(np.float32)
    share = (1 / np.bincount(place))[place].astype(np.float32)[:, None] / len(languages)
    w, b = np.zeros((x.shape[1], code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    mean, square = [np.zeros_like(w), np.zeros_like(b)], [np.zeros_like(w), np.zeros_like(b)]
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - goal) * share
        for i, (value, slope) in enumerate(((w, x.T @ error + decay * w), (b, error.sum(0)))):
            mean[i] = 0.9 * mean[i] + 0.1 * slope
            square[i] = 0.999 * square[i] + 0.001 * slope**2
            value -= rate * mean[i] / (1 - 0.9**step) / (np.sqrt(square[i] / (1 - 0.999**step)) + 1e-8)
    right = (((x @ w + b > 0) == goal.astype(bool)) * share).sum(0)
    trust = np.log((right + 0.01) / (1.01 - right))
    return Model(languages, code, w, b, np.maximum(trust, 0.01).astype(np.float32))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model | None:
    """Fit on a bounded sample of the labelled rows: of each language the texts with the least hashes of their ids.

    Features are made on the executors; the driver gets ``SAMPLE_ROWS`` vectors at most.
    """
    prepared(labelled.sparkSession)
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = rows.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.lit(10), doc_id).alias("h"))
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MOST_LANGUAGES + 1).collect()
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not counts:
        return None
    wanted = min(PER_LANGUAGE, SAMPLE_ROWS // len(counts))
    # Hashes are even, so below such a limit lie about twice the wanted rows, and only these are put in order.
    limits = {r["lang"]: min(int(min(1.0, (2 * wanted + 20) / r["n"]) * 2**64) - 2**63, 2**63 - 1) for r in counts}
    limit = F.create_map(*[F.lit(v) for pair in limits.items() for v in pair])[F.col("lang")]
    near = rows.where(F.col("h") <= limit)
    first = Window.partitionBy("lang").orderBy("h", "text")
    picked = near.withColumn("n", F.row_number().over(first)).where(F.col("n") <= wanted).select("lang", "text")

    def vectors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("lang"), pa.array(found, pa.binary())], names=["lang", "vector"])

    got = sorted((r["lang"], bytes(r["vector"])) for r in picked.mapInArrow(vectors, "lang string, vector binary").collect())
    return fit(np.array([np.frombuffer(v, dtype=np.float32) for _, v in got]), [name for name, _ in got])


def identify(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` for every whole text."""
    spark = prepared(docs.sparkSession)
    kept = [c for c in docs.columns if c not in RESULTS]
    judged = docs.select(*[F.col(f"`{c}`") for c in kept], _with_letters(F.col(text)).alias("lang_text"))
    held = spark.sparkContext.broadcast(model)  # bounded: dimensions x bits

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        use = held.value
        for batch in slices(batches, "lang_text"):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            unsure = np.zeros(len(texts), dtype=bool)
            there = [i for i, t in enumerate(texts) if t is not None] if use else []
            for at in range(0, len(there), 256):
                some = there[at : at + 256]
                best, score, close = use.predict(np.array([features(texts[i]) for i in some]))
                scores[some], unsure[some] = score, close
                for i, k in zip(some, best.tolist(), strict=True):
                    names[i] = use.languages[k]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(names), pa.array(scores), pa.array(unsure)]
            yield pa.record_batch(columns, names=[*kept, *RESULTS])

    fields = [docs.schema[c] for c in kept]
    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType()), StructField("ambiguous", BooleanType())])
    return judged.mapInArrow(judge, schema)


def _with_letters(text: Column) -> Column:
    """The text, or null where it has no letter."""
    return F.when(text.rlike(r"\p{L}"), text)
