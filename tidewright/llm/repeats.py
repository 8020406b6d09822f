"""Windows of texts that repeat elsewhere, exactly, without a row for each window.

Both substring operators share these steps; they differ in units (words or bytes), in the length of a
window, and in what counts as a repeat.

1. occurrences: every text is cut into segments, runs of windows with one anchor (anchors.segments).
2. An anchor that occurs once needs no more work. For a shared one, aggregates with map-side combination count
   the kinds of its segments. Where all are alike, that decides for all their windows; else it decides for
   those of the most frequent kind, so what a common line or passage brings is settled here.
3. Contested anchors have segments that differ. One segment of each kind is fetched, and the operator judges
   their windows bucket by bucket. Buckets of more than `most` kinds are compared window by window by an
   aggregate instead, so no task holds an unbounded bucket.
4. Spans go back to their texts by a key.

What is joined on an anchor or a kind is stored first, so both sides of such a join are plain shuffles, which
Spark splits where one anchor holds many rows.

No step makes rows for pairs; the largest shuffle is the text itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm.anchors import segments
from tidewright.llm.common import NO_ID, mix64, removed, stored, tidied

#: Kinds of segments that are compared in one bucket, at most.
MOST = 20_000
#: Bytes of buckets that are judged together.
_JUDGED = 4 << 20


@dataclass
class Kind:
    """units(text column) yields each text's units in `dtype`; table: 64-bit names of units, where units aren't
    names themselves; window and gram count units; with `earlier` only windows of smaller doc_ids count as
    repeats, else any other place. judge: which windows repeat, for buckets of segments that are all
    different: (docs, units) of each bucket's segments; gives an array for each segment."""

    units: Callable[[pa.Array], Iterator[np.ndarray]]
    window: int
    gram: int
    earlier: bool
    judge: Callable[[list[tuple[np.ndarray, list[np.ndarray]]], int], list[np.ndarray]]
    dtype: str = "<u8"
    table: np.ndarray | None = None

    def names(self, units: np.ndarray) -> np.ndarray:
        return window_names(units if self.table is None else self.table[units], self.window)


def window_names(units: np.ndarray, window: int) -> np.ndarray:
    """64-bit names of all windows, by doubling from the names of single units; mixed at each step."""
    n = len(units) - window + 1
    names, length = units, 1
    made, have, rest = None, 0, window
    while rest:
        if rest & 1:  # the stretch so far goes on with this round's names, read at its end
            at = names[have : have + n]
            made = at.copy() if made is None else mix64(made * np.uint64(0xD6E8FEB86659FD93) + at)
            have += length
        rest >>= 1
        if rest:
            names = mix64(names[:-length] * np.uint64(0xA0761D6478BD642F) + names[length:])
            length *= 2
    return made


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def keyed(docs: DataFrame) -> DataFrame:
    """docs as row (a key of doc_id and text), doc (doc_id; null after all others), doc_id, text."""
    return docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("doc"), "doc_id", "text"
    )


def occurrences(rows: DataFrame, kind: Kind) -> DataFrame:
    """row, doc, first, k, n, a, s of each kind of segment of each text: first holds the k places where the text
    has it (32-bit integers, ascending), so a line that a text repeats is one row."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, doc = (batch.column(k).to_numpy() for k in (0, 1))
            found, size = [], 0
            for at, units in enumerate(kind.units(batch.column(2))):
                first, n, a, s = segments(units, kind.window, kind.gram, kind.table)
                if len(first):
                    order = np.argsort(s, kind="stable")
                    head = np.flatnonzero(np.concatenate([[True], s[order][1:] != s[order][:-1]]))
                    k = np.diff(head, append=len(s))
                    one = order[head]
                    found.append((first[order].astype("<i4"), np.full(len(head), at), k, n[one], a[one], s[one]))
                    size += len(first)
                if size > 100_000:
                    yield _occurred(found, row, doc)
                    found, size = [], 0
            if found:
                yield _occurred(found, row, doc)

    return rows.select("row", "doc", "text").mapInArrow(run, "row long, doc long, first binary, k long, n int, a long, s long")


def _occurred(found: list, row: np.ndarray, doc: np.ndarray) -> pa.RecordBatch:
    first, at, k, n, a, s = (np.concatenate(x) for x in zip(*found))
    ends = np.concatenate([[0], np.cumsum(4 * k)]).astype(np.int32)
    places = pa.Array.from_buffers(pa.binary(), len(k), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(first.tobytes())])
    columns = [pa.array(row[at]), pa.array(doc[at]), places, pa.array(k.astype(np.int64)), pa.array(n.astype(np.int32)), _long(a), _long(s)]
    return pa.RecordBatch.from_arrays(columns, ["row", "doc", "first", "k", "n", "a", "s"])


def _fetched(rows: DataFrame, wanted: DataFrame, kind: Kind) -> DataFrame:
    """The units of wanted segments (row, doc, first, n, a, s, doc0, large)."""
    lists = wanted.groupBy("row", "doc").agg(F.collect_list(F.struct("first", "n", "a", "s", "doc0", "large")).alias("segments"))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "s", "doc0", "large", "units"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        for batch in batches:
            out, size = [], 0
            for some, units in zip(batch.column(1), kind.units(batch.column(0))):
                for x in some.as_py():
                    at = int(np.frombuffer(x["first"], "<i4")[0])
                    part = units[at : at + x["n"] - 1 + kind.window]
                    out.append((x["a"], x["s"], x["doc0"], x["large"], part.tobytes()))
                    size += part.nbytes
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    joined = rows.select("row", "doc", "text").join(lists, ["row", "doc"]).select("text", "segments")
    return joined.mapInArrow(run, "a long, s long, doc0 long, large boolean, units binary")


_FLAGGED = "a long, s long, flags binary"


def _in_buckets(found: DataFrame, kind: Kind) -> DataFrame:
    """Which windows of each segment repeat in other segments of its bucket."""

    def judged(buckets: list[tuple[int, dict]]) -> pa.RecordBatch | None:
        ready = [(np.array([d for d, _ in b.values()], np.int64), [np.frombuffer(u, kind.dtype) for _, u in b.values()]) for _, b in buckets]
        named = [(a, s) for a, b in buckets for s in b]
        out = [(a, s, np.packbits(hit).tobytes()) for (a, s), hit in zip(named, kind.judge(ready, kind.window)) if hit.any()]
        kinds = [pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["a", "s", "flags"]) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, size = [], 0
        for batch in batches:
            for a, s, doc, units in zip(*(c.to_pylist() for c in batch.columns)):
                if not buckets or a != buckets[-1][0]:
                    if size > _JUDGED:
                        if (made := judged(buckets)) is not None:
                            yield made
                        buckets, size = [], 0
                    buckets.append((a, {}))
                buckets[-1][1][s] = (doc, units)
                size += len(units)
        if buckets and (made := judged(buckets)) is not None:
            yield made

    return found.select("a", "s", "doc0", "units").repartition("a").sortWithinPartitions("a").mapInArrow(run, _FLAGGED)


def _by_window(found: DataFrame, kind: Kind) -> DataFrame:
    """The same for buckets of any size: a row for each window, aggregated with map-side combination."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, s, doc = (batch.column(k).to_numpy() for k in range(3))
            for lo in range(0, batch.num_rows, 500):
                names = [kind.names(np.frombuffer(x, kind.dtype)) for x in batch.column(3).slice(lo, 500).to_pylist()]
                n = np.array([len(x) for x in names])
                k = np.repeat(np.arange(lo, lo + len(n)), n)
                at = np.concatenate([np.arange(x) for x in n])
                columns = [pa.array(a[k]), pa.array(s[k]), pa.array(doc[k]), pa.array(at.astype(np.int32)), _long(np.concatenate(names))]
                yield pa.RecordBatch.from_arrays(columns, ["a", "s", "doc0", "at", "name"])

    single = found.dropDuplicates(["a", "s"]).select("a", "s", "doc0", "units")
    windows = single.mapInArrow(explode, "a long, s long, doc0 long, at int, name long")
    if kind.earlier:
        least = windows.groupBy("a", "name").agg(F.min("doc0").alias("least"), F.max("doc0").alias("most")).where("least < most")
        hits = windows.join(least, ["a", "name"]).where("least < doc0")
    else:
        least = windows.groupBy("a", "name").agg(F.count("*").alias("times")).where("times > 1")
        hits = windows.join(least, ["a", "name"])
    places = hits.groupBy("a", "s").agg(F.collect_list("at").alias("places"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for x in batch.column(2).to_pylist():
                hit = np.zeros(max(x) + 1, np.uint8)
                hit[x] = 1
                flags.append(np.packbits(hit).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(flags, pa.binary())], ["a", "s", "flags"])

    return places.mapInArrow(pack, _FLAGGED)


def repeated(rows: DataFrame, kind: Kind, most: int = MOST) -> DataFrame:
    """row, doc, spans: the repeated windows of each text that has any. spans: array of (first, n, flags), n
    windows from each place in first, all of them repeated if flags is null, else those whose bits are set.

    rows: as keyed() gives them. Every window of every text is judged; `most` only says how a bucket is
    compared.
    """
    found = occurrences(rows, kind)
    by_kind = found.groupBy("a", "s").agg(F.sum("k").alias("times"), F.min("doc").alias("doc0"), F.max("doc").alias("doc1"))
    total = by_kind.groupBy("a").agg(
        F.sum("times").alias("times"), F.min("doc0").alias("doc_min"), F.max("doc1").alias("doc_max"), F.count("*").alias("m"), F.max(F.struct("times", "s", "doc0")).alias("top")
    )
    shared = total.where("doc_min < doc_max" if kind.earlier else "times > 1")
    shared = stored(shared.select("a", "doc_min", "m", F.col("top.s").alias("top"), F.col("top.doc0").alias("top_doc"), F.col("top.times").alias("top_times")), "shared")
    whole_top = F.col("top_doc") < F.col("doc") if kind.earlier else F.col("top_times") > 1
    known = found.join(shared, "a").where((F.col("m") > 1) | (F.col("doc_min") < F.col("doc")) if kind.earlier else F.lit(True))
    known = known.withColumns({"contested": F.col("m") > 1, "settled": (F.col("m") == 1) | (F.col("s") == F.col("top")) & whole_top})
    known = stored(known.drop("doc_min", "top", "top_times"), "segments")
    removed(shared)
    plain = known.where("settled").select("row", "doc", "first", "n", F.lit(None).cast("binary").alias("flags"))

    # of a settled kind one document's segments stand for all
    bucket = known.where("contested and (not settled or doc = top_doc)")
    kinds = stored(bucket.groupBy("a", "s").agg(F.sum("k").alias("times"), F.min("doc").alias("doc0"), F.min(F.struct("doc", "row", "first", "n")).alias("at"), F.max("m").alias("m")), "kinds")
    wanted = kinds.select("at.row", "at.doc", "at.first", "at.n", "a", "s", "doc0", (F.col("m") > most).alias("large"))
    fetched = stored(_fetched(rows, wanted, kind), "contested")
    flags = _in_buckets(fetched.where("not large"), kind).unionByName(_by_window(fetched.where("large"), kind))
    judged = stored(kinds.select("a", "s", "times", "doc0").join(flags, ["a", "s"], "left"), "judged")
    removed(kinds, fetched)
    whole: Column = F.col("doc0") < F.col("doc") if kind.earlier else F.col("times") > 1
    hits = (
        known.where("not settled").select("row", "doc", "first", "n", "a", "s").join(judged, ["a", "s"])
        .where(whole | F.col("flags").isNotNull())
        .select("row", "doc", "first", "n", F.when(whole, F.lit(None).cast("binary")).otherwise(F.col("flags")).alias("flags"))
    )
    spans = plain.unionByName(hits).distinct()
    return spans.groupBy("row", "doc").agg(F.collect_list(F.struct("first", "n", "flags")).alias("spans"))


def covered(n_units: int, window: int, spans: list[dict] | None) -> np.ndarray:
    """Which units lie in a repeated window."""
    edge = np.zeros(n_units + 1, np.int64)
    for x in spans or ():
        first = np.frombuffer(x["first"], "<i4").astype(np.int64)
        if x["flags"] is None:
            np.add.at(edge, first, 1)
            np.add.at(edge, first + x["n"] - 1 + window, -1)
        else:
            at = (first[:, None] + np.flatnonzero(np.unpackbits(np.frombuffer(x["flags"], np.uint8))[: x["n"]])).ravel()
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0
