"""Language identification by language-bitmask n-gram filters.

Learning counts letter n-grams of every training document by language, all of them, as fixed-size tables
that tasks add up; n-grams frequent enough in a language (against the language where they are most
frequent) enter its Bloom filter. The filters are bit-sliced: slot j holds one bit for each language, so
AND-ing an n-gram's slots returns all languages that contain it at once. A document goes to the language
with the most hits after correction for that language's false-positive rate.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import crc_of_id

#: n-grams are named by a hash of so many bits; counts are kept for each name and language.
NAME_BITS = 20
SHARDS = 32
SLOT_BITS = 19
PROBES = 2
#: An n-gram is in a language if it is at least so frequent there as a share of its highest frequency, and was
#: seen so often.
SHARE = 0.4
MIN_COUNT = 2

_KINDS = ((2, 0x9E3779B1, 0x85EBCA77), (3, 0xC2B2AE3D, 0x27D4EB2F), (4, 0x165667B1, 0xD3A2646D))


@cache
def _letters() -> np.ndarray:
    """The code point of each letter; 0 for any other."""
    return np.array([c if chr(c).isalpha() else 0 for c in range(sys.maxunicode + 1)], np.uint32)


def names(text: str) -> np.ndarray:
    """Hashed names of the letter n-grams of a text, lower-cased; all that is no letter counts as a gap."""
    code = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    v = _letters()[code]
    if not v.any():
        return np.zeros(0, np.int64)
    out = []
    for n, first, step in _KINDS:
        h = v[: len(v) - n + 1] * np.uint32(first)
        gaps = (v[: len(v) - n + 1] == 0).astype(np.uint8)
        for k in range(1, n):
            part = v[k : len(v) - n + 1 + k]
            h = (h ^ (h >> np.uint32(15))) * np.uint32(step) + part * np.uint32(first)
            if k < n - 1:
                gaps = gaps + 2 * (part == 0)
        # a gap may begin or end an n-gram, not stand inside or at both ends of one
        whole = (gaps < 2) & ((gaps == 0) | (part != 0))
        h = (h ^ (h >> np.uint32(13))) * np.uint32(0x85EBCA6B)
        out.append((h >> np.uint32(32 - NAME_BITS))[whole])
    return np.concatenate(out).astype(np.int64)


def slots(name: np.ndarray) -> list[np.ndarray]:
    """The filter slots of n-gram names."""
    found = []
    for k in range(PROBES):
        h = (name.astype(np.uint32) + np.uint32(1 + 0x51ED * k)) * np.uint32(0x9E3779B1 if k % 2 else 0xC2B2AE35)
        h ^= h >> np.uint32(16)
        found.append(((h * np.uint32(0x7FEB352D)) >> np.uint32(32 - SLOT_BITS)).astype(np.int64))
    return found


@dataclass
class Filters:
    """langs: sorted. slots: uint64 array (slots, words of 64 languages). fill: share of bits set by language."""

    langs: list[str]
    bits: np.ndarray
    common: int

    def __post_init__(self):
        self.fill = np.array([float(((self.bits[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean()) for k in range(len(self.langs))])

    def hits(self, name: np.ndarray) -> np.ndarray:
        """How many of the n-grams each language's filter has, less those expected by chance."""
        found = [self.bits[s] for s in slots(name)]
        mask = found[0]
        for m in found[1:]:
            mask = mask & m
        if len(self.langs) <= 8:
            values = np.bincount(mask[:, 0].astype(np.int64), minlength=256)
            raw = np.array([values[(np.arange(len(values)) >> k) & 1 == 1].sum() for k in range(len(self.langs))], float)
        else:
            raw = np.array([((mask[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).sum() for k in range(len(self.langs))], float)
        chance = self.fill**PROBES
        return np.maximum(0.0, (raw - len(name) * chance) / np.maximum(1e-9, 1 - chance))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its share of all languages' hits, its hits as a share of the n-grams."""
        name = names(text) if text else np.zeros(0, np.int64)
        if not len(name) or not self.langs:
            return "und", 0.0, 0.0
        hits = self.hits(name)
        best = int(hits.argmax())
        if hits[best] <= 0:
            return self.langs[self.common], 0.0, 0.0
        return self.langs[best], float(hits[best] / hits.sum()), min(1.0, float(hits[best] / len(name)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    tables: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            name = names(text) if text else ()
            if len(name):
                if lang not in tables:
                    tables[lang] = np.zeros(1 << NAME_BITS, np.int64)
                if len(name) > 1 << 16:
                    tables[lang] += np.bincount(name, minlength=1 << NAME_BITS)
                else:
                    np.add.at(tables[lang], name, 1)
    salt = TaskContext.get().partitionId() % 32
    for lang, t in tables.items():
        yield _rows([(lang, k, salt, zlib.compress(part.tobytes(), 1)) for k, part in enumerate(np.split(t, SHARDS))])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["lang", "shard", "salt", "counts"])


_COUNTED = "lang string, shard int, salt int, counts binary"


def _added(t: pa.Table) -> pa.Table:
    total = np.zeros((1 << NAME_BITS) // SHARDS, np.int64)
    for x in t.column("counts").to_pylist():
        total += np.frombuffer(zlib.decompress(x), np.int64)
    return pa.Table.from_batches([_rows([(t.column("lang")[0].as_py(), t.column("shard")[0].as_py(), 0, zlib.compress(total.tobytes(), 1))])])


def learn(docs: DataFrame) -> Filters:
    """Filters from all rows of docs (text, lang) with neither null.

    Tasks count into tables of a fixed size; the tables, not rows, are shuffled, added up in two steps, and
    end on the driver as one table for each language and shard (at most 2**NAME_BITS counts a language).
    """
    counted = docs.where("text is not null and lang is not null").select("lang", "text").mapInArrow(_counts, _COUNTED)
    summed = counted.groupBy("lang", "shard", "salt").applyInArrow(_added, _COUNTED).groupBy("lang", "shard").applyInArrow(_added, _COUNTED)
    tables: dict[str, np.ndarray] = {}
    size = (1 << NAME_BITS) // SHARDS
    for row in summed.toLocalIterator():
        t = tables.setdefault(row.lang, np.zeros(1 << NAME_BITS, np.uint32))
        t[row.shard * size : (row.shard + 1) * size] = np.minimum(np.frombuffer(zlib.decompress(row.counts), np.int64), (1 << 32) - 1)
    langs = sorted(tables)
    bits = np.zeros((1 << SLOT_BITS, max(1, -(-len(langs) // 64))), np.uint64)
    totals = [float(tables[x].sum()) for x in langs]
    most = np.zeros(1 << NAME_BITS, np.float32)
    for x, total in zip(langs, totals):
        np.maximum(most, tables[x] / np.float32(total), out=most)
    for k, (x, total) in enumerate(zip(langs, totals)):
        name = np.flatnonzero((tables[x] >= MIN_COUNT) & (tables[x] / np.float32(total) >= SHARE * most))
        for s in slots(name):
            bits[np.unique(s), k // 64] |= np.uint64(1 << (k % 64))
    return Filters(langs, bits, int(np.argmax(totals)) if langs else 0)


PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, known_share double"


def identify(docs: DataFrame, filters: Filters) -> DataFrame:
    """The language of every row of docs (doc_id, text, held_out).

    `und` with score 0 for null texts and texts without a letter; the most frequent learned language with
    score 0 if no filter has any of the n-grams; `und` if no language was learned. Equal hits: the first
    language in order. Texts are read whole; null doc_ids and repeated rows are kept; other columns are
    ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast((filters.langs, filters.bits, filters.common))

    def run(batches):
        f = Filters(*shared.value)
        for batch in batches:
            ids, texts, held = (c.to_pylist() for c in batch.columns)
            found = [f.predict(t) for t in texts]
            columns = [ids, held, *zip(*found)] if found else [[]] * 5
            kinds = [pa.int64(), pa.bool_(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in PREDICTED.split(", ")])

    return docs.select("doc_id", "text", "held_out").mapInArrow(run, PREDICTED)


def split(docs: DataFrame) -> DataFrame:
    """Adds held_out: crc32(doc_id as text) mod 3 is 1. Those are not learned from."""
    return docs.withColumn("held_out", crc_of_id() % 3 == 1)


def detect(docs: DataFrame) -> DataFrame:
    """Learns from the rows of docs (doc_id, text, lang) that are not held out, then identifies all rows."""
    parted = split(docs.select("doc_id", "text", "lang"))
    return identify(parted, learn(parted.where(~F.col("held_out"))))


#: Texts with a smaller share of known n-grams are in none of the learned languages.
LEAST_KNOWN = 0.25


def accepted(docs: DataFrame, filters: Filters, least_known: float = LEAST_KNOWN) -> DataFrame:
    """The rows of docs (text and others) in one of the learned languages, unchanged: not `und`, and at least
    `least_known` of the text's n-grams are in the filter of the language found."""
    shared = docs.sparkSession.sparkContext.broadcast((filters.langs, filters.bits, filters.common))

    def run(batches):
        f = Filters(*shared.value)
        for batch in batches:
            found = [f.predict(t) for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([lang != "und" and known >= least_known for lang, _, known in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
