"""What the operators of this subpackage share: reading tables, storing intermediate tables, and words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterable, Iterator, Mapping
from contextlib import contextmanager
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from closebook.workspace import store  # noqa: F401  (used by the operators)

# Runs of anything but the ASCII blanks: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"

# Texts can be long: few rows in an Arrow batch keep a Python worker small.
BATCH_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


# Bytes of texts that are hashed or encoded at once: the numbers made of them take a hundred times as much.
TEXT_BYTES = 1 << 19

# What this Python worker keeps from task to task, for one operator at a time.
_remembered: dict[Hashable, Any] = {}


def remembered(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker for all tasks up to those that ``forget``."""
    if key not in _remembered:
        forget()
        _remembered[key] = make()
    return _remembered[key]


def forget() -> None:
    """Give back what another operator left in this Python worker: Spark uses its workers again for all of them."""
    if _remembered:
        _remembered.clear()
        gc.collect()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):  # glibc keeps freed memory otherwise
            libc.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings for texts: small Arrow batches, and skewed joins split at run time.

    Python workers find this package where the driver has it, whatever their working folder.
    """
    spark.sparkContext.environment["PYTHONPATH"] = str(Path(__file__).resolve().parents[2])
    spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def measured(df: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, dict]:
    """``df`` stored, and aggregates of its rows that are taken while it is written: no job of their own reads it again."""
    if not figures:
        return store(df, name), {}
    seen = Observation()
    kept = store(df.observe(seen, *[value.alias(key) for key, value in figures.items()]), name)
    found = seen.get
    # What Spark optimises away is not observed.
    return kept, found if found.keys() == figures.keys() else kept.agg(*[value.alias(key) for key, value in figures.items()]).first().asDict()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the jobs that run inside; the old values are back afterwards, also after a failure."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case; every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_count(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches: Iterable[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterable[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of a string column, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(lengths, dtype=np.int64) // most
        edges = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                yield batch.slice(a, b - a)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is left out of learning: the CRC-32 of its id as text is a multiple of ``folds``."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))
