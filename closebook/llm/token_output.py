"""Token ids as Parquet: encode whole texts, write list columns in id order, read tokens or only their metadata.

Layout of a token table (one row per document, files and rows in ascending order of the id):

* the id, ``part``, ``part_start``, ``n_tokens``: longs, delta encoded, so that metadata reads touch a few bytes a row;
* ``token_ids``: ``array<int>``, dictionary encoded (a vocabulary of 2^16 ids costs at most 16 bits a token).

Row groups and pages are bounded, and pages carry min and max, so a reader of an id range skips the others.

Defined cases: a null text counts as empty and gets the end id alone; equal or null ids are kept, in the order of
their texts (null ids first); an empty table writes no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from closebook.llm.common import TEXT_BYTES, prepared, remembered, slices, store

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2000
# Distinct words that a Python worker remembers; beyond it starts afresh. Results do not depend on it.
KNOWN_WORDS = 1_200_000
# After so many new words it forgets those that came once only: most words do, and hold most of its memory.
NEW_WORDS = 200_000

OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(ROW_GROUP_BYTES),
    "parquet.page.size": str(PAGE_BYTES),
    "parquet.page.row.count.limit": str(PAGE_ROWS),
    # Version 2 pages without a dictionary are delta encoded for whole numbers.
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#token_ids.list.element": "true",
}


class WordEncoder:
    """Ids of texts, exactly as the tokenizer gives them, by encoding each distinct blank-free piece once.

    Pieces are independent for a tokenizer that splits on white space and drops it. Texts are cut as UTF-8 at ASCII
    blanks alone, which both take as white space; a piece with any other kind in it is encoded as it is.
    """

    def __init__(self, path: str, end_id: int, known: int = KNOWN_WORDS):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id, self.known = end_id, known
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.tails = {t: i + 1 for i, t in enumerate(".,")}
        self.tail_ids = {t: np.array(e.ids, dtype=np.int32) for t, e in zip(self.tails, self._batch(list(self.tails)), strict=True)}
        self._reset()

    def _reset(self) -> None:
        self.codes = _Codes()
        self.ids = [np.array([self.end_id], dtype=np.int32)]
        self.lengths = [np.array([1], dtype=np.int64)]
        self.uses, self.settled = np.zeros(1, dtype=np.int64), 0

    def _sweep(self) -> None:
        """Forget the words that were not used again."""
        values, sizes = self._tables()
        self.uses[0] = 2  # the end id stays
        kept = np.flatnonzero(self.uses > 1)
        pieces = list(self.codes)  # in the order of their codes
        self.codes = _Codes(pieces[i - 1] for i in kept[1:].tolist())
        values, sizes = _gather(values, sizes, kept)
        self.ids, self.lengths = [values], [sizes]
        self.uses, self.settled = np.ones(len(kept), dtype=np.int64), len(self.codes)

    def encode(self, texts: list[bytes | str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, with the end id after each text, and the number of ids of each text."""
        if len(self.codes) > self.known:
            self._reset()
        elif len(self.codes) - self.settled > NEW_WORDS:
            self._sweep()
        pieces = [self._pieces(t.encode() if isinstance(t, str) else t) for t in texts]
        counts = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        found = np.fromiter(
            map(self.codes.__getitem__, chain.from_iterable(pieces)), dtype=np.int64, count=int(counts.sum())
        )
        if self.codes.new:
            self._learn(self.codes.take())
        uses = np.bincount(found, minlength=len(self.codes) + 1)
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        ends = np.cumsum(counts)
        values, sizes = _gather(*self._tables(), np.insert(found, ends, 0))
        return values, np.diff(np.cumsum(sizes)[ends + np.arange(len(ends))], prepend=0)

    @staticmethod
    def _pieces(text: bytes) -> list[bytes]:
        if b"<|" in text:  # may hold a special token, whose case matters
            return text.split()
        # Lowering ASCII letters commutes with composing characters and with the tokenizer's own lower case.
        return text.lower().split()

    def _tables(self) -> tuple[np.ndarray, np.ndarray]:
        self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        return self.ids[0], self.lengths[0]

    def _learn(self, new: list[bytes]) -> None:
        """Encode new pieces. Letters and one final comma or full stop are token groups of their own, so that words
        share their ids with and without it. The last letter must be ASCII: others may end in a mark once they are
        normalised, and a mark does not part from what follows it."""
        pieces = [piece.decode("utf-8", "replace") for piece in new]
        stems: dict[str, int] = {}
        at, tails = [], []
        for piece in pieces:
            tail = self.tails.get(piece[-1:], 0)
            if tail and piece[:-1].isalpha() and piece[-2].isascii():
                piece = piece[:-1]
            else:
                tail = 0
            tails.append(tail)
            at.append(stems.setdefault(piece, len(stems)))
        ids, lengths = self._encode_pieces(list(stems))
        # Twice as many parts: a stem, then its tail or nothing.
        ids = np.concatenate([ids, *self.tail_ids.values()])
        lengths = np.concatenate([lengths, [len(t) for t in self.tail_ids.values()], [0]])
        parts = np.empty(2 * len(pieces), dtype=np.int64)
        parts[::2] = at
        tails = np.array(tails, dtype=np.int64)
        parts[1::2] = np.where(tails > 0, len(stems) + tails - 1, len(lengths) - 1)
        values, sizes = _gather(ids, lengths, parts)
        self.ids.append(values.astype(np.int32))
        self.lengths.append(sizes[::2] + sizes[1::2])

    def _encode_pieces(self, pieces: list[str], together: int = 500) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters are encoded many at once where a word's last token says so; all others one by one."""
        words = [i for i, p in enumerate(pieces) if p.isalpha()]
        rest = [i for i, p in enumerate(pieces) if not p.isalpha()]
        done, ids, lengths = [], [], []
        groups = [words[i : i + together] for i in range(0, len(words), together)]
        for group, got in zip(groups, self._batch([" ".join([pieces[i] for i in g]) for g in groups]), strict=True):
            own = np.array(got.ids, dtype=np.int32)
            cuts = np.flatnonzero(self.ends_word[own]) + 1
            if len(cuts) == len(group) and cuts[-1] == len(own):
                done.extend(group)
                ids.append(own)
                lengths.append(np.diff(cuts, prepend=0))
            else:
                rest.extend(group)
        alone = [e.ids for e in self._batch([pieces[i] for i in rest])]
        ids.append(np.fromiter(chain.from_iterable(alone), dtype=np.int32))
        lengths.append(np.fromiter(map(len, alone), dtype=np.int64, count=len(alone)))
        place = np.empty(len(pieces), dtype=np.int64)
        place[done + rest] = np.arange(len(pieces))
        return _gather(np.concatenate(ids), np.concatenate(lengths), place)

    def _batch(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []


def _gather(values: np.ndarray, lengths: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picked runs of ``values`` one after another, and their lengths."""
    starts = np.cumsum(lengths) - lengths
    sizes = lengths[picked]
    stops = np.cumsum(sizes)
    return values[np.repeat(starts[picked] - (stops - sizes), sizes) + np.arange(int(sizes.sum()))], sizes


class _Codes(dict):
    """Piece to code; unknown pieces get the next code and are remembered as new. Code 0 is the end id."""

    def __init__(self, known: Iterable[bytes] = ()):
        super().__init__(zip(known, count(1)))
        self.new: list[bytes] = []
        self.next = len(self) + 1

    def __missing__(self, piece: bytes) -> int:
        code = self[piece] = self.next
        self.next += 1
        self.new.append(piece)
        return code

    def take(self) -> list[bytes]:
        new, self.new = self.new, []
        return new


def encoder(path: str, end_id: int) -> WordEncoder:
    """One encoder per Python worker."""
    return remembered((path, end_id), lambda: WordEncoder(path, end_id))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text with the tokenizer file and write the token table to ``path``."""
    prepared(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use, part, start = encoder(tokenizer, end_id), TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", TEXT_BYTES):
            ids, sizes = use.encode(batch.column("text").cast(pa.binary()).to_pylist())
            ends = np.cumsum(sizes)
            lists = pa.ListArray.from_arrays(pa.array(np.insert(ends, 0, 0), pa.int32()), pa.array(ids))
            starts = pa.array(start + ends - sizes)
            parts = pa.array(np.full(len(sizes), part, dtype=np.int64))
            start += int(ends[-1])
            yield pa.record_batch(
                [batch.column("doc_id"), parts, starts, pa.array(sizes), lists],
                names=["doc_id", "part", "part_start", "n_tokens", "token_ids"],
            )

    schema = "doc_id long, part long, part_start long, n_tokens long, token_ids array<int>"
    # Ranges of a unique id are even; the hash of the text divides rows that share an id.
    encoded = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(encode, schema)
    encoded.write.options(**OPTIONS).mode("overwrite").parquet(path)


def read_tokens(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """The table's rows with ``start``, the ids before each document; without ``tokens`` only metadata is read.

    One sum per written file gives the files' own starts.
    """
    rows = spark.read.parquet(path)
    # Stored, so that its size is known: small enough, it is broadcast, and the token lists stay where they are.
    starts = store(_starts(rows.groupBy("part").agg(F.sum("n_tokens").alias("ids"))), "token-starts")
    out = rows.join(starts, "part").withColumn("start", F.col("base") + F.col("part_start"))
    return out.select("doc_id", "start", "n_tokens", *(["token_ids"] if tokens else []))


def _starts(sums: DataFrame) -> DataFrame:
    """``part`` and the ids of all earlier parts: a running sum over one row per file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def checksums(tokens: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32``: the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids")
            values = np.asarray(lists.values.to_numpy(zero_copy_only=False), dtype="<u4")
            edges = np.asarray(lists.offsets)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(edges, edges[1:])]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return tokens.mapInArrow(crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
