"""Substring dedup over words by relative Lempel-Ziv factors.

The reference of a document is all documents with smaller doc_ids. It is indexed in hash-partitioned blocks:
the segments of words around one anchor (see repeats), wherever they occur, make a block, and each document
is parsed against every block that can hold one of its windows. A segment that an earlier document has too is
one factor. Any other segment is parsed greedily: at a window that the block's index knows from an earlier
document, the match is extended, symbol by symbol, as far as the reference goes on alike; that is a factor.
Parsing goes on at the factor's boundary, where the windows that reach over its end are looked up. Factors of
at least `window` words are the duplicate spans; what lies between them is literal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm import repeats
from tidewright.llm.common import NO_ID, names, words

WINDOW = 50
GRAM = 8


def word_units(texts: pa.Array) -> Iterator[np.ndarray]:
    for k in range(0, len(texts), 500):
        for text in texts.slice(k, 500).to_pylist():
            yield names.of(words(text))


def parse(units: np.ndarray, known: np.ndarray, reference: Callable[[int], Iterator[np.ndarray]], window: int) -> list[tuple[int, int]]:
    """The factors (start, length) of at least `window` units, from left to right. known: window starts whose
    names the index holds; reference(i): what the reference holds from where it has window i's name on."""
    factors, at, k = [], 0, 0
    while k < len(known):
        at = int(known[k])
        length = 0
        for other in reference(at):
            own = units[at : at + len(other)]
            differ = np.flatnonzero(own != other[: len(own)])
            length = int(differ[0]) if len(differ) else len(own)
            if length >= window:  # names may agree by chance; the next place with this name is tried then
                break
        if length >= window:
            factors.append((at, length))
            # windows that reach over the factor's end begin here
            k = int(np.searchsorted(known, at + length - window + 1))
        else:
            k += 1
    return factors


def factored(buckets: list[tuple[np.ndarray, list[np.ndarray]]], window: int) -> list[np.ndarray]:
    """For each segment of each block, which of its windows lie in factors of the block's earlier documents."""
    return [hit for docs, segments in buckets for hit in _block(docs, segments, window)]


def _block(docs: np.ndarray, segments: list[np.ndarray], window: int) -> Iterator[np.ndarray]:
    length = np.array([len(x) for x in segments])
    n = length - window + 1
    start = np.cumsum(length) - length
    flat = np.concatenate(segments)
    of = np.repeat(np.arange(len(segments)), n)
    before = np.cumsum(n) - n
    place = np.arange(int(n.sum())) - before[of] + start[of]
    name = repeats.window_names(flat, window)[place]
    order = np.lexsort((docs[of], name))
    first = np.flatnonzero(np.concatenate([[True], name[order][1:] != name[order][:-1]]))
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(order)))
    ends = np.append(first, len(order))
    # the index gives the earliest document of each window's name first
    known = docs[of[order[first[group]]]] < docs[of]
    for k, units in enumerate(segments):
        lo, hit = int(before[k]), np.zeros(int(n[k]), bool)

        def reference(i: int, lo: int = lo, k: int = k) -> Iterator[np.ndarray]:
            g = group[lo + i]
            for at in order[ends[g] : ends[g + 1]].tolist():
                if docs[of[at]] >= docs[k]:
                    return
                yield flat[place[at] : start[of[at]] + length[of[at]]]

        for at, size in parse(units, np.flatnonzero(known[lo : lo + int(n[k])]), reference, window):
            hit[at : at + size - window + 1] = True
        yield hit


def kind(window: int = WINDOW, gram: int | None = None) -> repeats.Kind:
    return repeats.Kind(word_units, window, gram or min(GRAM, window), True, factored)


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Duplicate spans in words, longest first to last: doc_id, start, length for each factor of a document
    (doc_id, text) that repeats an earlier document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(*(c.to_pylist() for c in batch.columns)):
                hit = repeats.covered(len(words(text)), window, spans)
                edge = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
                out += [(doc, a, b - a) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "length"])

    rows = repeats.keyed(docs)
    joined = rows.join(repeats.repeated(rows, kind(window)), ["row", "doc"]).select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, start long, length long")


CLEANED = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, most: int = repeats.MOST, with_text: bool = True) -> DataFrame:
    """Removes each word covered by a `window`-word sequence that also starts in a document with a smaller
    doc_id, judged on the input.

    Returns a row for each row of docs: doc_id, n_words, n_removed, kept_sha256 and, with_text, kept (the
    kept words joined by one space). Null and empty texts have no words. Rows with one doc_id are one
    document: they don't count as earlier than each other. Null doc_ids come after all others. Texts of
    any length are read whole; other columns are ignored; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                out = []
                for doc, text, spans in zip(*(c.to_pylist() for c in batch.slice(lo, 1000).columns)):
                    own = words(text)
                    kept = own
                    if spans:
                        hit = repeats.covered(len(own), window, spans).tolist()
                        kept = [w for w, h in zip(own, hit) if not h]
                    left = " ".join(kept)
                    out.append((doc, len(own), len(own) - len(kept), hashlib.sha256(left.encode("utf-8", "surrogatepass")).hexdigest(), left))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in CLEANED.split(", ")])

    rows = repeats.keyed(docs)
    joined = rows.join(repeats.repeated(rows, kind(window), most), ["row", "doc"], "left").select("doc_id", "text", "spans")
    made = joined.mapInArrow(run, CLEANED)
    return made if with_text else made.drop("kept")


def cleaned(docs: DataFrame, window: int = WINDOW, most: int = repeats.MOST) -> DataFrame:
    """docs with the words of repeated windows removed from text, and n_chars (if there) set to what is left.

    Rows stay, also those of which nothing is left (their text is then empty); a text without repeats stays
    as it is, in others the kept words are joined by one space. Columns named _row, _doc or _spans are not
    allowed in docs.
    """
    spans = repeats.repeated(repeats.keyed(docs), kind(window), most).toDF("_row", "_doc", "_spans")
    whole = docs.withColumns({"_row": F.xxhash64("doc_id", "text"), "_doc": F.coalesce(F.col("doc_id"), F.lit(NO_ID))})
    joined = whole.join(spans, ["_row", "_doc"], "left").select(*docs.columns, "_spans")
    names, at = list(docs.columns), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                texts, n = [], []
                spans = part.column(part.num_columns - 1)
                for k, text in enumerate(part.column(at).to_pylist()):
                    if spans[k].is_valid:
                        own = words(text)
                        hit = repeats.covered(len(own), window, spans[k].as_py()).tolist()
                        text = " ".join([w for w, h in zip(own, hit) if not h])
                        n.append(len(text))
                    else:
                        n.append(None)
                    texts.append(text)
                columns = [part.column(k) for k in range(part.num_columns - 1)]
                columns[at] = pa.array(texts, columns[at].type)
                if "n_chars" in names:
                    k = names.index("n_chars")
                    old = columns[k].to_pylist()
                    columns[k] = pa.array([o if x is None else x for o, x in zip(old, n)], columns[k].type)
                yield pa.RecordBatch.from_arrays(columns, names)

    return joined.mapInArrow(run, docs.schema)
