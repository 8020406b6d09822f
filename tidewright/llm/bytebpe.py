"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

A block is some documents of one Arrow batch, cut by number and bytes. Its texts are exploded into pre-tokens with their positions, as
codes into the block's own list of distinct words. Words go, packed by hash bucket, through one shuffle that
brings equal words of all blocks together; each distinct word is encoded once; its ids go back, packed, to
every block that has it. A block is reassembled by position. So a shuffle holds a word once for each block,
not once for each occurrence, and a frequent word is no heavier than a rare one. Decoding looks ids up in
the table of token bytes, which has the vocabulary's fixed size.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.bpe import spread
from tidewright.llm.common import stretches

#: The white space of the vocabulary's splitting pattern (Unicode White_Space).
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Texts cut at once, documents in one row of positions, texts in a block and their bytes.
CUT, CHUNK = 400, 1000
TEXTS, BYTES = 10_000, 16 << 20
_ROW = "block long, kind int, part int, data binary, docs binary, counts binary"


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})


@cache
def token_bytes(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and bytes of each id's token."""
    ranks = read_ranks(path)
    length = np.zeros(max(ranks.values(), default=-1) + 1, np.int64)
    for token, k in ranks.items():
        length[k] = len(token)
    start = np.cumsum(length) - length
    data = np.zeros(int(length.sum()), np.uint8)
    for token, k in ranks.items():
        data[start[k] : start[k] + len(token)] = np.frombuffer(token, np.uint8)
    return start, length, data


class Cutter:
    """Pre-tokens of texts: the pattern's matches. Texts are first cut into runs (an optional blank and what
    is not white space, or white space), which no match crosses; the pattern is applied to distinct runs."""

    def __init__(self, pattern: str):
        import regex

        spaced = pattern.replace(r"[^\s", f"[^{SPACES}").replace(r"\s", f"[{SPACES}]").replace(r"\S", f"[^{SPACES}]")
        self.match = regex.compile(spaced).findall
        self.runs = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+").findall
        self.of: dict[str, list[str]] = {}

    def cut(self, runs: list[str]) -> list[list[str]]:
        if len(self.of) > 300_000:
            self.of = {}
        of = self.of
        out = []
        for r in runs:
            found = of.get(r)
            if found is None:
                found = self.match(r)
                if len(r) <= 40:
                    of[r] = found
            out.append(found)
        return out


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


class Block:
    """words: distinct pre-tokens, bucket after bucket; first: where each bucket begins; codes: the word at
    each position of the documents; counts: positions of each document."""

    def __init__(self, cutter: Cutter, texts: pa.Array, buckets: int):
        place: defaultdict[str, int] = defaultdict()
        place.default_factory = place.__len__
        of_run, runs_of = [], []
        for lo in range(0, len(texts), CUT):
            found = [cutter.runs(t) if t else [] for t in texts.slice(lo, CUT).to_pylist()]
            runs_of += [len(x) for x in found]
            of_run.append(np.fromiter(map(place.__getitem__, chain.from_iterable(found)), np.int64, sum(map(len, found))))
        runs = list(place)
        parts = cutter.cut(runs)
        code: defaultdict[str, int] = defaultdict()
        code.default_factory = code.__len__
        length = np.array([len(p) for p in parts], np.int64)
        inner = np.fromiter(map(code.__getitem__, chain.from_iterable(parts)), np.int64, int(length.sum()))
        words = [w.encode() for w in code]
        bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
        order = np.argsort(bucket, kind="stable")
        self.words = [words[k] for k in order.tolist()]
        self.first = np.searchsorted(bucket[order], np.arange(buckets + 1))
        to = np.empty(len(order), np.int64)
        to[order] = np.arange(len(order))
        at = np.concatenate(of_run) if of_run else np.zeros(0, np.int64)
        self.codes = to[spread((np.cumsum(length) - length)[at], length[at], inner)].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(length[at])])[np.cumsum(np.array(runs_of, np.int64))]
        self.counts = np.diff(ends, prepend=0)

    def name(self, ids: list) -> int:
        """A name of the block's content, the same whenever the block is built again."""
        h = xxhash.xxh3_64(self.codes.tobytes())
        h.update(b"\n".join(self.words))
        h.update(self.counts.tobytes() + repr(ids).encode())
        return h.intdigest() - (1 << 63)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["block", "kind", "part", "data", "docs", "counts"])


def _blocks(docs: DataFrame, pattern: str, buckets: int, positions: bool) -> DataFrame:
    """Rows of kind 1 with positions (ids and counts of documents, codes), else of kind 0 with words: one
    for each bucket of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter(pattern)
        for batch in batches:
            for lo, hi in stretches(batch.column(1), TEXTS, BYTES):
                yield from of(cutter, batch.slice(lo, hi - lo))

    def of(cutter: Cutter, part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = part.column(0).to_pylist()
        b = Block(cutter, part.column(1), buckets)
        name, rows = b.name(ids), []
        if positions:
            ends = np.concatenate([[0], np.cumsum(b.counts)])
            for k, lo in enumerate(range(0, len(ids), CHUNK)):
                hi = min(len(ids), lo + CHUNK)
                docs_of = pa.array(ids[lo:hi], pa.int64())
                known = np.array([x is not None for x in ids[lo:hi]], np.uint8).tobytes()
                data = _pack(b.codes[ends[lo] : ends[hi]].view(np.uint8).reshape(-1, 4).T.tobytes())
                yield _rows([(name, 1, k, data, known + docs_of.fill_null(0).to_numpy().tobytes(), b.counts[lo:hi].astype("<u4").tobytes())])
            return
        for k in range(buckets):
            some = b.words[b.first[k] : b.first[k + 1]]
            if some:
                sizes = np.array([len(w) for w in some], "<u4")
                rows.append((name, 0, k, _pack(b"".join(some)), None, _pack(sizes.tobytes())))
            if len(rows) >= 256:
                yield _rows(rows)
                rows = []
        if rows:
            yield _rows(rows)

    return docs.select("doc_id", "text").mapInArrow(run, _ROW)


def _encoded(words: DataFrame, path: str, pattern: str) -> DataFrame:
    """Rows of kind 0 with the ids of a bucket's words; every distinct word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path, pattern)._encode_single_piece

        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns))

        for bucket, group in groupby(rows(), key=lambda r: r[2]):
            known: dict[bytes, list[int]] = {}
            out = []
            for block, _, _, data, _, sizes in group:
                raw, ends = _unpack(data), np.cumsum(np.frombuffer(_unpack(sizes), "<u4")).tolist()
                found, at = [], 0
                for end in ends:
                    w = raw[at:end]
                    ids = known.get(w)
                    if ids is None:
                        ids = known[w] = encode(w)
                    found.append(ids)
                    at = end
                flat = np.fromiter(chain.from_iterable(found), "<u4")
                out.append((block, 0, bucket, _pack(flat.view(np.uint8).reshape(-1, 4).T.tobytes()), None, _pack(np.array([len(x) for x in found], "<u4").tobytes())))
                if len(out) >= 256:
                    yield _rows(out)
                    out = []
            if out:
                yield _rows(out)

    return words.repartition("part").sortWithinPartitions("part", "block").mapInArrow(run, _ROW)


def _planes(data: bytes) -> np.ndarray:
    """32-bit values that were stored byte plane by byte plane."""
    raw = np.frombuffer(_unpack(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").ravel()


def _assembled(blocks: DataFrame, each, kind: str) -> DataFrame:
    """each(doc_ids, counts, ids) for the documents of each row of positions; gives a record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for k in range(0, batch.num_rows, 64):
                    yield from zip(*(c.to_pylist() for c in batch.slice(k, 64).columns))

        for _, group in groupby(rows(), key=lambda r: r[0]):
            parts: dict[int, tuple] = {}
            length = None
            for _, kind_of, part, data, docs, counts in group:
                if kind_of == 0:
                    parts[part] = (_planes(data).astype(np.uint32), np.frombuffer(_unpack(counts), "<u4").astype(np.int64))
                    continue
                if length is None:
                    order = sorted(parts)
                    pool = np.concatenate([parts[k][0] for k in order]) if order else np.zeros(0, np.uint32)
                    length = np.concatenate([parts[k][1] for k in order]) if order else np.zeros(0, np.int64)
                    start = np.cumsum(length) - length
                    parts = {}
                codes = _planes(data)
                if len(codes) and int(codes.max()) >= len(length):
                    raise RuntimeError("a block of documents changed between two reads; store the documents before encoding them")
                n = np.frombuffer(counts, "<u4").astype(np.int64)
                m = length[codes]
                ids = spread(start[codes], m, pool)
                ends = np.concatenate([[0], np.cumsum(m)])[np.cumsum(n)]
                known, doc = np.frombuffer(docs[: len(n)], np.uint8), np.frombuffer(docs[len(n) :], np.int64)
                yield each(pa.array(doc, pa.int64(), mask=known == 0), np.diff(ends, prepend=0), ids)

    return blocks.repartition("block").sortWithinPartitions("block", "kind", "part").mapInArrow(run, kind)


def _all(docs: DataFrame, path: str | None, pattern: str | None, buckets: int | None):
    path, pattern = path or default_ranks(), pattern or default_pattern()
    if buckets is None:  # more with the input, as each holds its words in memory, but fewer for each block
        buckets = max(64, round(4 * docs.rdd.getNumPartitions() ** 0.75))
    words = _blocks(docs, pattern, buckets, positions=False)
    return path, _encoded(words, path, pattern).unionByName(_blocks(docs, pattern, buckets, positions=True))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, buckets: int | None = None) -> DataFrame:
    """doc_id and ids (array of int) of every row of docs (doc_id, text), as the vocabulary's library gives
    them without special tokens. Null text: no ids. Null doc_ids and repeated rows are kept, texts are read
    whole, other columns are ignored, an empty table gives no rows. docs is read twice and must give the
    same batches both times, as stored tables do; if it doesn't, the job fails."""
    _, blocks = _all(docs, path, pattern, buckets)

    def each(doc: pa.Array, n: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(ids.astype(np.int32)))
        return pa.RecordBatch.from_arrays([doc, lists], ["doc_id", "ids"])

    return _assembled(blocks, each, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and data (binary) of every row of encoded (doc_id, ids); null ids: null data."""
    path = path or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, length, data = token_bytes(path)
        for batch in batches:
            out = []
            for ids in batch.column(1):
                if ids.as_py() is None:
                    out.append(None)
                else:
                    k = np.array(ids.as_py(), np.int64)
                    out.append(spread(start[k], length[k], data).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "data"])

    return encoded.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>")).mapInArrow(run, "doc_id long, data binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None, buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (ids as little-endian unsigned 32-bit integers), decoded_sha256 (the
    ids' token bytes) of every row of docs. Cases as for encode; a null text is an empty one."""
    path, blocks = _all(docs, path, pattern, buckets)

    def each(doc: pa.Array, n: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        start, length, data = token_bytes(path)
        m = length[ids]
        text = spread(start[ids], m, data).tobytes()
        ends = np.cumsum(n)
        cut = np.concatenate([[0], np.cumsum(m)])[np.concatenate([[0], ends])].tolist()
        raw = memoryview(ids.astype("<u4").tobytes())
        sha = [hashlib.sha256(raw[4 * (e - k) : 4 * e]).hexdigest() for e, k in zip(ends.tolist(), n.tolist())]
        back = [hashlib.sha256(text[a:b]).hexdigest() for a, b in zip(cut, cut[1:])]
        return pa.RecordBatch.from_arrays([doc, pa.array(n.astype(np.int64)), pa.array(sha), pa.array(back)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _assembled(blocks, each, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
