"""N-gram Jaccard join by MinHash banding.

Documents are sets of word n-grams. Documents with equal sets are one class, whose members are counted
before anything else, so copies cost nothing further. Band hashes of the classes are shuffled; classes that
share a band value are candidates, and two classes are linked if they share one and their full n-gram sets are
similar enough: one rule at all sizes. Candidates are never written as pairs: band values give star edges,
whose components bound what has to be compared. Within a component (or, where that is large, among the classes
of one band value), classes are dealt into blocks, and pairs of blocks are compared on the full n-gram sets;
only the number of links of each class and a spanning forest leave a block pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import mix64, names as word_names, removed, stored, tidied, words
from tidewright.llm.graph import components

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.99999
ROWS = 5
#: Classes in a block of the comparison. Components of more than LARGE classes are compared by band value, which
#: gives the same links at another cost.
BLOCK = 1024
LARGE = 16_384
#: n-grams in at most so many sets of a comparison are counted pair by pair, others by a product.
_RARE = 12


def bands_for(similarity: float = SIMILARITY, recall: float = RECALL, rows: int = ROWS) -> int:
    """The least number of bands of `rows` hashes that finds pairs of this similarity with this recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def shingles(text: str | None, n: int = WORDS) -> np.ndarray:
    """The distinct 64-bit names of a text's word n-grams, sorted; all words are one n-gram if they are
    fewer than n; none without words."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = word_names.of(w)
    if len(w) < n:
        return mix64(np.array([xxhash.xxh3_64_intdigest(h.tobytes())], np.uint64))
    at = len(h) - n + 1
    g = np.zeros(at, np.uint64)
    for k in range(n):
        g = (g ^ h[k : k + at]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k)
        g ^= g >> np.uint64(29)
    return np.unique(mix64(g))


class Sketch:
    """MinHash by multiply-add on the names' upper 32 bits."""

    def __init__(self, bands: int, rows: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.by = rng.integers(0, 1 << 32, bands * rows, np.uint32) | np.uint32(1)
        self.plus = rng.integers(0, 1 << 32, bands * rows, np.uint32)

    def of(self, names: np.ndarray) -> np.ndarray:
        """A band value for each band; values of different bands differ."""
        low = np.full(self.bands * self.rows, (1 << 32) - 1, np.uint32)
        upper = (names >> np.uint64(32)).astype(np.uint32)
        for lo in range(0, len(upper), 2048):
            h = upper[lo : lo + 2048] * self.by[:, None]
            h += self.plus[:, None]
            np.minimum(low, h.min(axis=1), out=low)
        value = np.arange(self.bands, dtype=np.uint64) + np.uint64(1)
        least = low.reshape(self.bands, self.rows).astype(np.uint64)
        for k in range(self.rows):
            value = mix64(value * np.uint64(0x9E3779B97F4A7C15) ^ least[:, k])
        return value


def sketches(docs: DataFrame, bands: int, rows: int, n: int) -> DataFrame:
    """doc_id, row (a hash of doc_id and text), hi, lo (128-bit name of the n-gram set; null without words),
    bands (8 bytes each)."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(bands, rows)
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part, out = batch.slice(k, 500), []
                for text in part.column(2).to_pylist():
                    s = shingles(text, n)
                    if len(s):
                        hi, lo = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()
                        out.append((hi, lo, sketch.of(s).tobytes()))
                    else:
                        out.append((None, None, None))
                kinds = [pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))], ["doc_id", "row", "hi", "lo", "bands"])

    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("doc_id", "text").alias("row"), "text")
    return keyed.mapInArrow(run, "doc_id long, row long, hi long, lo long, bands binary")


def _band_rows(classes: DataFrame) -> DataFrame:
    """node, band: one row for each band value of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = [np.frombuffer(x, np.int64) for x in batch.column(1).to_pylist()]
                node = np.repeat(batch.column(0).to_numpy(), [len(v) for v in values])
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(values))], ["node", "band"])

    return classes.select("node", "bands").mapInArrow(run, "node long, band long")


def _sets(docs: DataFrame, members: DataFrame, n: int) -> DataFrame:
    """members (rep_row, hi, node, ...) with the n-gram sets of their documents."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows come to one task
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                keep, sets = [], []
                for i, (text, hi, lo) in enumerate(zip(*(part.column(x).to_pylist() for x in ("text", "hi", "node")))):
                    if lo in seen:
                        continue
                    s = shingles(text, n).tobytes()
                    if s and np.frombuffer(xxhash.xxh3_128_digest(s), "<i8").tolist() == [hi, lo]:
                        keep.append(i)
                        sets.append(s)
                        seen.add(lo)
                if keep:
                    cut = part.take(pa.array(keep))
                    yield pa.RecordBatch.from_arrays([cut.column("node"), cut.column("copies"), cut.column("root"), cut.column("size"), pa.array(sets, pa.binary()), cut.column("bands")], ["node", "copies", "root", "size", "names", "bands"])

    texts = docs.select(F.xxhash64("doc_id", "text").alias("rep_row"), "text")
    joined = texts.join(members, "rep_row").select("text", "hi", "node", "copies", "root", "size", "bands")
    return joined.mapInArrow(run, "node long, copies long, root long, size long, names binary, bands binary")


_LINKS = "node long, links long, top long"


def _compare(rows: list[tuple], similarity: float, key: tuple) -> list[tuple]:
    """Links between classes of one or two blocks: node, number of linked documents in other classes, and
    the least node linked through these links."""
    rows = list({r[0]: r for r in rows}.values())
    if len(rows) < 2:
        return []
    sets = [np.frombuffer(r[2], np.uint64) for r in rows]
    copies, block, node = (np.array([r[k] for r in rows], np.int64) for k in (1, 4, 0))
    values = np.array([np.frombuffer(r[3], np.int64) for r in rows])
    a, b = _similar(sets, similarity)
    lo, hi, band = key
    if lo != hi:  # pairs within a block belong to that block's own comparison
        other = block[a] != block[b]
        a, b = a[other], b[other]
    keep = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 16):
        shared = values[a[k : k + (1 << 16)]] == values[b[k : k + (1 << 16)]]
        keep[k : k + (1 << 16)] = shared.any(axis=1)
        if band is not None:  # pairs that share an earlier band value are compared there
            keep[k : k + (1 << 16)] &= values[a[k : k + (1 << 16)], shared.argmax(axis=1)] == band
    a, b = a[keep], b[keep]
    count = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
    top = node.copy()
    while True:
        new = top.copy()
        np.minimum.at(new, a, top[b])
        np.minimum.at(new, b, top[a])
        if (new == top).all():
            break
        top = new
    return [(x, int(y), z) for x, y, z in zip(node.tolist(), count.tolist(), top.tolist()) if y]


def _similar(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs a < b of sets whose Jaccard index is at least `similarity`, exactly."""
    m = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    start = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    count = np.diff(start, append=len(flat))
    both = np.zeros((m, m), np.float32)  # counts stay exact: no set has 2**24 names in a block's memory
    for c in range(2, _RARE + 1):
        of = owner[start[count == c][:, None] + np.arange(c)]
        for i in range(c):
            for j in range(i + 1, c):
                both += np.bincount(of[:, i] * m + of[:, j], minlength=m * m).reshape(m, m) if len(of) * 16 > m * m else _few(of[:, i] * m + of[:, j], m)
    often = count > _RARE
    inner = owner[np.repeat(often, count)]
    count = count[often]
    column, ends = np.repeat(np.arange(len(count)), count), np.cumsum(count)
    width = max(64, (1 << 22) // m)
    for lo in range(0, len(count), width):
        hi = min(len(count), lo + width)
        x, y = (ends[lo - 1] if lo else 0), ends[hi - 1]
        held = np.zeros((m, hi - lo), np.float32)
        held[inner[x:y], column[x:y] - lo] = 1
        both += held @ held.T
    both = np.triu(both, 1)  # owners stand in order within a name, so pairs were counted above the diagonal
    a, b = np.nonzero(both)
    near = both[a, b] >= similarity * (size[a] + size[b] - both[a, b]) - 1e-6
    return a[near], b[near]


def _few(keys: np.ndarray, m: int) -> np.ndarray | float:
    if not len(keys):
        return 0.0
    out = np.zeros(m * m, np.float32)
    np.add.at(out, keys, 1)
    return out.reshape(m, m)


def _links(sets: DataFrame, similarity: float, by_band: bool) -> DataFrame:
    """Compares the classes of each (root or band value) in pairs of blocks."""
    deal = F.when(F.col("size") <= BLOCK, F.lit(1)).otherwise(F.ceil(F.col("size") / BLOCK)).cast("int")
    dealt = sets.withColumn("blocks", deal).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = dealt.withColumn("other", other).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
    keys = ["root", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    yield from zip(*(c.to_pylist() for c in batch.slice(k, 256).columns))

        out = []
        for (root, lo, hi), group in groupby(rows(), key=lambda r: r[:3]):
            out += _compare([r[3:] for r in group], similarity, (lo, hi, root if by_band else None))
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["node", "links", "top"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["node", "links", "top"])

    return paired.select(*keys, "node", "copies", "names", "bands", "block").repartition(*keys).sortWithinPartitions(*keys, "node").mapInArrow(run, _LINKS)


def join(docs: DataFrame, similarity: float = SIMILARITY, n: int = WORDS, recall: float = RECALL, rows: int = ROWS, large: int = LARGE) -> DataFrame:
    """The Jaccard self-join of docs (doc_id, text) on sets of word n-grams, one row for each row of docs.

    class_id: the least doc_id of the documents joined by links of at least `similarity`, directly or
    through others; copy_id: the least doc_id with the same n-gram set; n_copies: rows with that set;
    n_links: other rows linked directly, copies included. Two different sets are linked if they share a band
    value and are as similar on the whole sets; `recall` is the chance that a pair at the threshold shares one.
    Texts without words (or null) link to nothing. Texts of fewer than n words are one n-gram. Null doc_ids
    count as rows, and name a class only where no doc_id does. Other columns are ignored; an empty table
    gives no rows. `large` only says how components are compared, not what is linked.
    """
    return _classified(docs, similarity, n, recall, rows, large).select(
        "doc_id",
        F.coalesce("class_id", "rep0", "doc_id").alias("class_id"),
        F.coalesce("rep0", "doc_id").alias("copy_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )


def _classified(docs: DataFrame, similarity: float = SIMILARITY, n: int = WORDS, recall: float = RECALL, rows: int = ROWS, large: int = LARGE) -> DataFrame:
    """doc_id, row, hi, lo of every row, with its class: rep0 and copies of its set; class_id, links and root
    where that is linked to others."""
    count = bands_for(similarity, recall, rows)
    found = stored(sketches(docs, count, rows, n), "sketches")
    classes = stored(
        found.where("hi is not null").groupBy("hi", F.col("lo").alias("node")).agg(F.min("doc_id").alias("rep0"), F.min("row").alias("rep_row"), F.count("*").alias("copies"), F.first("bands").alias("bands")),
        "classes",
    )
    band = _band_rows(classes)
    shared = stored(band.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most"), F.count("*").alias("size")).where("least < most").drop("most"), "bands")
    meeting = stored(band.join(shared, "band").select("node", "band", "least", "size"), "meetings")
    near = components(meeting.select(F.col("node").alias("a"), F.col("least").alias("b")))
    sizes = stored(near.groupBy("root").agg(F.count("*").alias("size")), "sizes")
    members = stored(classes.join(near.join(sizes, "root"), "node"), "members")
    sets = stored(_sets(docs, members, n), "sets")
    whole = _links(sets.where(F.col("size") <= large), similarity, False)
    large_sets = sets.where(F.col("size") > large).drop("root", "size").join(meeting.select("node", F.col("band").alias("root"), "size"), "node")
    links = stored(whole.unionByName(_links(large_sets, similarity, True)), "links")
    removed(shared, meeting, near, sizes, members, sets)
    top = components(links.select(F.col("node").alias("a"), F.col("top").alias("b")))
    per_class = links.groupBy("node").agg(F.sum("links").alias("links"))
    linked = stored(classes.select("hi", "node", "rep0", "copies").join(top, "node").join(per_class, "node"), "linked")
    removed(links, top)
    least = linked.groupBy("root").agg(F.min("rep0").alias("class_id"))
    named = stored(linked.join(least, "root").select("hi", "node", "class_id", "links", "root"), "named")
    removed(linked)
    judged = classes.select("hi", "node", "rep0", "copies").join(named, ["hi", "node"], "left").select("hi", F.col("node").alias("lo"), "rep0", "copies", "class_id", "links", "root")
    judged = stored(judged, "judged")  # so that the join with all rows has two plain sides, which Spark splits
    removed(classes, named)
    return found.select("doc_id", "row", "hi", "lo").join(judged, ["hi", "lo"], "left")


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """docs with one row of each class: that of the least doc_id, and of rows that share it the one whose hash
    of doc_id and text is least; without any doc_id, by that hash alone. Rows without words stay. Of rows with
    one doc_id and text one stays. All columns stay as they are, whatever their names."""
    judged = _classified(docs, **parameters)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    key = [F.coalesce("root", "lo").alias("k"), F.when(F.col("root").isNull(), F.col("hi")).alias("h")]
    kept = judged.where("hi is not null").select(*key, "doc_id", "row").groupBy("k", "h").agg(first).select("first.doc_id", "first.row")
    kept = stored(kept.unionByName(judged.where("hi is null").select("doc_id", "row")).distinct(), "kept")
    same = docs["doc_id"].eqNullSafe(kept["doc_id"]) & (F.xxhash64(docs["doc_id"], docs["text"]) == kept["row"])
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
