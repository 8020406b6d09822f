"""Substring dedup over bytes by bucket-pointer refinement.

Suffixes are put into initial buckets by the q-gram at their anchor (one sampled suffix for some 80 bytes;
every 200-byte string holds exactly one, so none is missed), which a shuffle brings together. Buckets of one
suffix, and of suffixes that go on alike over the anchor's whole segment, are done. The others are refined to
the suffixes at every byte: buckets by their first bytes, then sorted by pairs of bucket identifiers, their own
and that of the suffix at a later offset. A round's new identifiers are what the next round reads at twice the
offset, up to `window` bytes; a suffix alone in its bucket keeps its identifier and is not sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewright.llm import repeats
from tidewright.llm.common import mix64, utf8_slices

WINDOW = 200
GRAM = 32

_BYTE_NAMES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_units(texts: pa.Array) -> Iterator[np.ndarray]:
    yield from utf8_slices(texts)


def refined(raw: np.ndarray, left: np.ndarray, window: int) -> np.ndarray:
    """Bucket identifiers of suffixes by their first `window` bytes. left: how many bytes each suffix has to the
    end of its sequence; shorter ones are in no bucket (-1)."""
    depth = min(8, window)
    some = np.flatnonzero(left >= depth)
    # the first bytes as one number
    key = np.zeros(len(some), np.uint64)
    for k in range(depth):
        key = (key << np.uint64(8)) | raw[some + k]
    bucket = np.full(len(raw), -1, np.int64)
    found, where, count = np.unique(key, return_inverse=True, return_counts=True)
    bucket[some] = where
    open_, used = some[count[where] > 1], len(found)
    while depth < window:
        step = min(depth, window - depth)
        # the later offset has its identifier of this round, as it has `depth` bytes left
        open_ = open_[left[open_] >= depth + step]
        pair = bucket[open_] * np.int64(used) + bucket[open_ + step]
        found, where, count = np.unique(pair, return_inverse=True, return_counts=True)
        bucket[open_] = used + where
        used += len(found)
        open_ = open_[count[where] > 1]
        depth += step
    bucket[left < window] = -1
    return bucket


def sorted_out(buckets: list[tuple[np.ndarray, list[np.ndarray]]], window: int) -> list[np.ndarray]:
    """For each segment of each initial bucket, which of its windows stand in a bucket with others."""
    segments = [x for _, some in buckets for x in some]
    length = np.array([len(x) for x in segments])
    left = np.repeat(np.cumsum(length), length) - np.arange(int(length.sum()))
    bucket = refined(np.concatenate(segments), left, window)
    known = bucket >= 0
    count = np.bincount(bucket[known])
    hit = np.zeros(len(bucket), bool)
    hit[known] = count[bucket[known]] > 1
    ends = np.cumsum(length)
    return [hit[e - n : e - window + 1] for e, n in zip(ends.tolist(), length.tolist())]


def kind(window: int = WINDOW, gram: int | None = None) -> repeats.Kind:
    return repeats.Kind(byte_units, window, gram or min(GRAM, window), False, sorted_out, "u1", _BYTE_NAMES)


CLEANED = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


def remove_repeats(docs: DataFrame, window: int = WINDOW, most: int = repeats.MOST, with_text: bool = True) -> DataFrame:
    """Removes each byte covered by a `window`-byte string that also starts anywhere else, judged on the
    input; strings never cross documents.

    Returns a row for each row of docs: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 and, with_text, kept (the remaining bytes; they may cut characters). Null text: no bytes.
    Repeated rows repeat each other. Texts of any length are read whole; null doc_ids are kept; other
    columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part, out = batch.slice(lo, 1000), []
                for doc, raw, spans in zip(part.column(0).to_pylist(), utf8_slices(part.column(1)), part.column(2).to_pylist()):
                    kept, n_spans = raw, 0
                    if spans:
                        hit = repeats.covered(len(raw), window, spans)
                        kept = raw[~hit]
                        n_spans = int(np.count_nonzero(np.diff(hit.astype(np.int8), prepend=0) == 1))
                    left = kept.tobytes()
                    out.append((doc, len(raw), len(raw) - len(left), n_spans, hashlib.sha256(left).hexdigest(), left))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CLEANED.split(", ")])

    rows = repeats.keyed(docs)
    joined = rows.join(repeats.repeated(rows, kind(window), most), ["row", "doc"], "left").select("doc_id", "text", "spans")
    made = joined.mapInArrow(run, CLEANED)
    return made if with_text else made.drop("kept")
