"""Best-fit packing of tokenised documents into sequences of a fixed length.

Tokenising is a narrow map. Only the pieces' lengths (some 40 bytes each, no ids) are shuffled, then each
partition packs what it gets by bounded-space online best fit: a fixed number of open bins, found through
a bitset keyed by free space; when a piece fits none and no bin may be opened, the fullest closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.bpe import WordEncoder
from tidewright.llm.common import stretches

LENGTH = 2048
OPEN_BINS = 512
#: Texts tokenised at once, and their bytes.
_TEXTS, _BYTES = 2500, 4 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = f"{PIECES}, sequence_id long, offset long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """One row for each piece of at most `length` ids of each document; id 0 ends a document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder.at(tokenizer)
        for batch in batches:
            for lo, hi in stretches(batch.column(1), _TEXTS, _BYTES):
                yield of(encoder, batch.slice(lo, hi - lo))

    def of(encoder: WordEncoder, part: pa.RecordBatch) -> pa.RecordBatch:
        ids, counts = encoder.encode(part.column(1))
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends, 0).tobytes()
        out: list[list] = [[], [], [], [], []]
        for doc, first, last in zip(part.column(0).to_pylist(), (ends - counts + np.arange(len(ends))).tolist(), (ends + np.arange(1, len(ends) + 1)).tolist()):
            for k, start in enumerate(range(first, last, length)):
                stop = min(last, start + length)
                for column, v in zip(out, (doc, k, start - first, stop - start, zlib.crc32(ids[4 * start : 4 * stop]))):
                    column.append(v)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


class BestFit:
    """Bounded-space online best fit. put() returns bins that closed: lists of (item, offset)."""

    def __init__(self, room: int, open_bins: int):
        self.room, self.most = room, open_bins
        self.free_bits = 0
        self.by_free: dict[int, list[list]] = {}
        self.n_open = 0

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        taken = bins.pop()
        if not bins:
            del self.by_free[free]
            self.free_bits &= ~(1 << free)
        self.n_open -= 1
        return taken

    def _open(self, free: int, items: list) -> None:
        self.by_free.setdefault(free, []).append(items)
        self.free_bits |= 1 << free
        self.n_open += 1

    def put(self, item, size: int) -> list[list]:
        if size >= self.room:
            return [[(item, 0)]]
        closed = []
        fits = self.free_bits >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            items = self._take(free)
            items.append((item, self.room - free))
        else:
            if self.n_open >= self.most:
                fullest = (self.free_bits & -self.free_bits).bit_length() - 1
                closed.append(self._take(fullest))
            free, items = self.room, [(item, 0)]
        if free == size:
            closed.append(items)
        else:
            self._open(free - size, items)
        return closed

    def rest(self) -> list[list]:
        return [items for bins in self.by_free.values() for items in bins]


def pack(found: DataFrame, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """Adds sequence_id and offset to pieces. Pieces are dealt out and ordered by a hash, so a lost task
    gives the same rows again and no partition gets one kind of document."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        bins = BestFit(length, open_bins)
        done: list[tuple] = []
        n = 0

        def close(closed: list[list]) -> None:
            nonlocal n
            for items in closed:
                done.extend((*row, first + n, offset) for row, offset in items)
                n += 1

        def out() -> pa.RecordBatch:
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            kinds = [pa.int32() if x == "piece" else pa.int64() for x in names]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
            done.clear()
            return made

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                close(bins.put(row, row[3]))
            if len(done) > 10_000:
                yield out()
        close(bins.rest())
        if done:
            yield out()

    order = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    return found.repartition(order).sortWithinPartitions(order, "doc_id", "piece", "ids_crc32").mapInArrow(fit, PACKED)


def best_fit(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, open_bins: int = OPEN_BINS) -> DataFrame:
    """Packs documents (doc_id, text) into sequences of at most `length` ids.

    Returns one row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.
    Null or empty text: one piece holding id 0 alone. Repeated rows and null doc_ids are packed as rows of
    their own. Texts of any length are cut into pieces. An empty table gives no rows. Other columns of
    `docs` are ignored.
    """
    return pack(pieces(docs, tokenizer or default_tokenizer(), length), length, open_bins)
