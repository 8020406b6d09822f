"""A quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]): the pairwise
interactions cost time linear in the features (the sum-of-squares identity). The machine is fitted in numpy
on a bounded sample of labelled rows; scoring is a narrow map over all documents.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import WORD, crc_of_id

WORD_BITS = 14
STATS = 16
SIZE = (1 << WORD_BITS) + STATS
RANK = 6
#: Labelled rows that the machine is fitted on, at most.
SAMPLE = 6000
THRESHOLD = 0.3


def statistics(text: str, words: list[str], counts: Counter, n_chars: int | None) -> list[float]:
    """Structure statistics of a text and its metadata."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n, m = max(1, len(raw)), max(1, len(words))
    h = np.bincount(raw, minlength=256)
    upper, lower, digits = int(h[65:91].sum()), int(h[97:123].sum()), int(h[48:58].sum())
    high, blank = int(h[128:].sum()), int(h[32] + h[9:14].sum())
    marks = len(raw) - upper - lower - digits - high - blank
    usual = int(h[44] + h[46])
    share = h[h > 0] / n
    lines = text.split("\n")
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    odd = sum(c for w, c in counts.items() if not (w[-1].isalnum() or w[-1] in ".,"))
    return [
        upper / max(1, upper + lower), digits / n, (marks - usual) / n, usual / n, high / n, blank / n,
        len(text) / m / 10, len(counts) / m, repeats / m, odd / m,
        sum(c for w, c in counts.items() if len(w) == 1) / m, counts.most_common(1)[0][1] / m if counts else 0.0,
        1 - len(set(lines)) / len(lines), -float((share * np.log2(share)).sum()) / 8,
        math.log1p(len(words)) / 10, math.log1p(n_chars if n_chars is not None and n_chars >= 0 else len(text)) / 12,
    ]


class Words:
    """Hashed places of words, kept up to a bound."""

    def __init__(self, most: int = 300_000):
        self.of: dict[str, int] = {}
        self.most = most

    def features(self, text: str | None, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of a text's features; a null text is an empty one."""
        text = text or ""
        words = WORD.findall(text)
        counts = Counter(words)
        if len(self.of) > self.most:
            self.of = {}
        of = self.of
        place = np.empty(len(counts) + STATS, np.int64)
        for k, w in enumerate(counts):
            at = of.get(w)
            if at is None:
                at = of[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) >> (32 - WORD_BITS)
            place[k] = at
        value = np.empty(len(place), np.float64)
        value[: len(counts)] = np.sqrt(np.fromiter(counts.values(), np.float64, len(counts)) / max(1, len(words)))
        place[len(counts) :] = np.arange(1 << WORD_BITS, SIZE)
        value[len(counts) :] = statistics(text, words, counts, n_chars)
        return place, value


@dataclass
class Machine:
    bias: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    sd: np.ndarray

    def standard(self, value: np.ndarray) -> np.ndarray:
        out = value.copy()
        out[-STATS:] = np.clip((value[-STATS:] - self.mean) / self.sd, -4, 4) / 4
        return out

    def score(self, place: np.ndarray, value: np.ndarray) -> float:
        x = self.standard(value)
        vx = self.v[place] * x[:, None]
        z = self.bias + self.w[place] @ x + 0.5 * float((vx.sum(axis=0) ** 2 - (vx * vx).sum(axis=0)).sum())
        return float(1 / (1 + math.exp(-min(30.0, max(-30.0, z)))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 12, rate: float = 0.05, decay: float = 1e-5, batch: int = 64, steps: int = 800, seed: int = 7) -> Machine:
    """Fits by Adagrad on the logistic loss, `epochs` times over the rows or about `steps` steps if that is
    more. Without rows of both labels the share of label 1 is the score."""
    rng = np.random.default_rng(seed)
    y = np.array([r[2] for r in rows], float)
    base = min(0.99, max(0.01, float(y.mean()))) if len(y) else 0.5
    stats = np.array([r[1][-STATS:] for r in rows]) if rows else np.zeros((1, STATS))
    m = Machine(math.log(base / (1 - base)), np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, RANK)), stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    if len(set(y.tolist())) < 2:
        m.v[:] = 0
        return m
    xs = [m.standard(r[1]) for r in rows]
    epochs = max(epochs, -(-steps * batch // len(rows)))
    gw, gv, gb = np.full(SIZE, 1e-2), np.full((SIZE, RANK), 1e-2), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            some = order[lo : lo + batch]
            n = np.array([len(xs[k]) for k in some])
            place = np.concatenate([rows[k][0] for k in some])
            x = np.concatenate([xs[k] for k in some])
            first = np.cumsum(n) - n
            vx = m.v[place] * x[:, None]
            total = np.add.reduceat(vx, first)
            z = m.bias + np.add.reduceat(m.w[place] * x, first) + 0.5 * (total**2 - np.add.reduceat(vx * vx, first)).sum(axis=1)
            d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[some]) / len(some)
            dx = np.repeat(d, n) * x
            used, at = np.unique(place, return_inverse=True)
            grad = np.bincount(at, dx) + decay * m.w[used]
            gw[used] += grad**2
            m.w[used] -= rate * grad / np.sqrt(gw[used])
            step = dx[:, None] * (np.repeat(total, n, axis=0) - vx)
            grad = np.stack([np.bincount(at, step[:, f]) for f in range(RANK)], axis=1) + decay * m.v[used]
            gv[used] += grad**2
            m.v[used] -= rate * grad / np.sqrt(gv[used])
            gb += float(d.sum()) ** 2
            m.bias -= rate * float(d.sum()) / math.sqrt(gb)
    return m


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> Machine:
    """Fits on at most `sample` labelled documents whose crc32(doc_id as text) mod 5 is not 0: those whose
    doc_id hashes lowest. A document with different labels counts as label 0. Only their features (hashed
    places and values, no text) come to the driver."""
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % 5 != 0))
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    joined = docs.select("doc_id", "text", chars.alias("n_chars")).join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text", "n_chars")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            ids, label, texts, n = (c.to_pylist() for c in batch.columns)
            found = [words.features(t, c) for t, c in zip(texts, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(label, pa.int32()), pa.array([p.astype("<i2").tobytes() for p, _ in found], pa.binary()), pa.array([v.astype("<f4").tobytes() for _, v in found], pa.binary())],
                ["doc_id", "label", "place", "value"],
            )

    made = joined.mapInArrow(run, "doc_id long, label int, place binary, value binary").orderBy(F.xxhash64("doc_id"), "doc_id", "place").limit(sample)
    rows = [(np.frombuffer(r.place, "<i2").astype(np.int64), np.frombuffer(r.value, "<f4").astype(float), r.label) for r in made.collect()]
    return fit(rows)


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def rate(docs: DataFrame, machine: Machine) -> DataFrame:
    """Scores every row of docs (doc_id, text and, if there, n_chars); null and empty texts too.

    held_out: crc32(doc_id as text) mod 5 is 0. predicted: 1 if score >= 0.3. Other columns are ignored;
    null doc_ids and repeated rows are kept; texts are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)
    chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")

    def run(batches):
        words, m = Words(), shared.value
        for batch in batches:
            ids, held, texts, n = (c.to_pylist() for c in batch.columns)
            scores = [m.score(*words.features(t, c)) for t, c in zip(texts, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(scores, pa.float64()), pa.array([int(s >= THRESHOLD) for s in scores], pa.int32())],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", (crc_of_id() % 5 == 0).alias("held_out"), "text", chars.alias("n_chars")).mapInArrow(run, SCORED)


def accepted(docs: DataFrame, machine: Machine) -> DataFrame:
    """The rows of docs (doc_id, text, n_chars and others) that the machine predicts as label 1, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches):
        words, m = Words(), shared.value
        for batch in batches:
            n = batch.column("n_chars").to_pylist() if "n_chars" in batch.schema.names else [None] * batch.num_rows
            keep = [m.score(*words.features(t, c)) >= THRESHOLD for t, c in zip(batch.column("text").to_pylist(), n)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fits on the labelled documents that are not held out, then scores all."""
    return rate(docs, train(docs, labels))
