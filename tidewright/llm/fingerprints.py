"""Document fingerprints by locally consistent parsing.

A text's code points are cut into phrases whose ends depend on a few neighbouring symbols alone: runs of one
symbol are joined, deterministic coin tossing shrinks the symbols to six labels of which neighbours differ,
and local maxima begin phrases. A phrase's name is a hash of its symbols. Names are the next level's
symbols, so equal substrings get equal names inside, wherever they stand. The fingerprint is the least 64
hashes of the names of one level; likeness is the Jaccard index that two of them estimate.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import mix64

#: Phrases of level LEVEL have some 25 code points.
LEVEL = 3
SIZE = 64
_BATCH_CHARS = 400_000
_SEED = np.uint64(0x9E3779B97F4A7C15)


def _toss(label: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Each label as the place and value of the lowest bit in which it differs from its left neighbour."""
    left = np.empty_like(label)
    left[1:] = label[:-1]
    left[0] = 0
    left[head] = ~label[head]  # the first of a text differs in the lowest bit
    differ = label ^ left
    low = differ & (~differ + np.uint64(1))
    place = np.log2(low.astype(np.float64)).astype(np.uint64)
    return np.uint64(2) * place + ((label >> place) & np.uint64(1))


def _level(symbol: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of sequences of symbols that stand one after the other, and their texts."""
    new = np.empty(len(symbol), bool)
    new[0] = True
    new[1:] = (symbol[1:] != symbol[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    run = np.diff(first, append=len(symbol)).astype(np.uint64)
    text = text[first]
    symbol = np.where(run > 1, mix64(symbol[first] + run * _SEED), symbol[first])
    head = np.empty(len(symbol), bool)
    head[0] = True
    head[1:] = text[1:] != text[:-1]
    label = symbol
    for _ in range(4):
        label = _toss(label, head)
    up = np.empty(len(symbol), bool)
    up[0] = True
    up[1:] = label[1:] > label[:-1]
    down = np.empty(len(symbol), bool)
    down[-1] = True
    down[:-1] = label[:-1] > label[1:]
    tail = np.empty(len(symbol), bool)
    tail[-1] = True
    tail[:-1] = head[1:]
    begin = np.flatnonzero(head | (up & down & ~tail))
    place = np.arange(len(symbol)) - np.repeat(begin, np.diff(begin, append=len(symbol)))
    name = np.add.reduceat(mix64(symbol ^ (place.astype(np.uint64) * _SEED)), begin)
    return mix64(name), text[begin]


def phrases(texts: list[str], level: int = LEVEL) -> list[np.ndarray]:
    """The distinct names of each text's phrases at a level, sorted; none for an empty text."""
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    if len(code):
        code = mix64(code + np.uint64(1))
        for _ in range(level):
            code, of = _level(code, of)
    ends = np.searchsorted(of, np.arange(len(texts) + 1))
    return [np.unique(code[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def sketch(names: np.ndarray) -> np.ndarray:
    """The least SIZE names as 32-bit hashes, sorted."""
    return np.unique((mix64(names) >> np.uint64(32)).astype(np.uint32))[:SIZE]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard index of what two sketches were taken from; 1 for two empty ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:SIZE]
    return float(np.isin(both, a, assume_unique=True)[np.isin(both, b, assume_unique=True)].sum() / len(both))


def as_text(a: np.ndarray) -> str:
    return a.astype(">u4").tobytes().hex()


def fingerprint(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """doc_id and fingerprint of every row of docs (doc_id, text). Null and empty texts: an empty string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 200):
                part = batch.slice(lo, 200)
                made = [as_text(sketch(p)) for p in phrases([t or "" for t in part.column(1).to_pylist()], level)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def followed(docs: DataFrame) -> DataFrame:
    """docs in stretches of descending doc_id (null ids last; rows of one doc_id by a hash of their texts): place
    (of the stretch), extra (whether the row only stands there as the next of the last), doc_id, text.

    Only doc_ids and hashes are sorted to find the stretches, so many rows of one doc_id, or of none, are dealt
    over many. The rows like a stretch's first also go to the stretch before, so each stretch knows what
    follows it; texts are shuffled once.
    """
    spark = docs.sparkSession
    n = 8 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.rdd.getNumPartitions())
    order, text_hash = F.col("doc_id").desc_nulls_last(), F.xxhash64("text")
    keyed = docs.select(F.col("doc_id").cast("long"), "text")
    ids = keyed.select("doc_id", text_hash.alias("hash")).repartitionByRange(n, order, "hash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce(-F.col("doc_id"), F.lit(0)).alias("key"), "hash")).alias("first")
    heads = sorted(tuple(r.first) for r in ids.groupBy(F.spark_partition_id().alias("p")).agg(first).select("first").collect())  # one for each partition

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = [(d is None, -(d or 0), h) for d, h in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            place = np.array([bisect_right(heads, k) - 1 for k in keys])
            again = np.flatnonzero([heads[p] == k for p, k in zip(place.tolist(), keys)])
            take = np.concatenate([np.arange(batch.num_rows), again])
            extra = np.arange(len(take)) >= batch.num_rows
            some = batch.take(pa.array(take))
            to = np.concatenate([place, (place[again] - 1) % len(heads)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(extra), some.column(0), some.column(1)], ["place", "extra", "doc_id", "text"])

    dealt = keyed.select("doc_id", "text", text_hash.alias("hash")).mapInArrow(deal, "place int, extra boolean, doc_id long, text string")
    return dealt.repartition("place").sortWithinPartitions("place", "extra", order, F.xxhash64("text"), "text")


_FIELDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_edits(docs: DataFrame, level: int = LEVEL) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next document's are.

    Edited: the last floor(n/2) code points replaced by the first as many (or all) of the next document in
    descending doc_id; after the last comes the first. Rows with one doc_id follow each other by a hash of
    their texts, then by their texts; null doc_ids come last. A null text is an empty one; an empty text's
    fingerprint is empty, and like another empty one alone. Texts are read whole; other columns are
    ignored; an empty table gives no rows; a single row follows itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    yield from zip(*(c.to_pylist() for c in batch.slice(lo, 256).columns))

        def made(pairs: list[tuple]) -> pa.RecordBatch:
            texts = [a for _, a, _ in pairs]
            edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for _, a, b in pairs]
            nexts, at = [], []  # the next of a row is mostly the row after it
            for k, (_, _, b) in enumerate(pairs):
                if k + 1 < len(pairs) and texts[k + 1] is b:
                    at.append(k + 1)
                else:
                    at.append(len(pairs) + len(nexts))
                    nexts.append(b)
            own = [sketch(p) for p in phrases(texts + nexts, level)]
            new = [sketch(p) for p in phrases(edited, level)]
            columns = [
                pa.array([d for d, _, _ in pairs], pa.int64()), pa.array([len(a) for a in texts], pa.int64()),
                pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]),
                pa.array([as_text(s) for s in own[: len(pairs)]]), pa.array([as_text(s) for s in new]),
                pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()), pa.array([likeness(a, own[k]) for a, k in zip(own, at)], pa.float64()),
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FIELDS.split(", ")])

        pairs, size, before = [], 0, None
        done = None
        for place, extra, doc, text in rows():
            text = text or ""
            if before is not None and before[0] == place:
                pairs.append((before[1], before[2], text))
                size += len(before[2])
            before = None if extra else (place, doc, text)
            if extra and done == place:
                continue
            done = place if extra else None
            if size > _BATCH_CHARS:
                yield made(pairs)
                pairs, size = [], 0
        if pairs:
            yield made(pairs)

    return followed(docs).mapInArrow(run, _FIELDS)
