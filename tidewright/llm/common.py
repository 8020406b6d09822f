"""What the corpus operators share: reading the tables, keys, cached work folders, Arrow helpers."""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of every operator that counts or compares words: runs other than ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
MASK64 = (1 << 64) - 1
#: doc_id that stands for null inside an operator: it sorts after every other.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names. Where none is set, a local session (as in tests) gets one of
    our own; on a cluster that is refused, as executors would write to their own disks."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = "/tmp/tidewright-checkpoints"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(at)
    return at


def stored(df: DataFrame, what: str, codec: str = "zstd") -> DataFrame:
    """df written once to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    at = f"{checkpoint_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(at)
    found = spark.read.schema(df.schema).parquet(at)
    found._stored_at = at
    return found


def removed(*tables: DataFrame) -> None:
    """Deletes what stored() wrote for these tables, which nothing reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def words(text: str | None) -> list[str]:
    """The runs of characters other than ASCII white space, unchanged."""
    return WORD.findall(text) if text else []


class WordNames(dict):
    """64-bit names of words. One for a worker process, shared by the operators; what a task adds goes when
    the task ends, and sooner where it grows past its bound."""

    most = 200_000
    longest = 64

    def __missing__(self, word: str) -> int:
        name = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        if len(word) <= self.longest:
            self[word] = name
        return name

    def of(self, some: list[str]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, some), np.uint64, len(some))


names = WordNames()


def forget() -> None:
    """Empties what this worker process keeps between batches."""
    names.clear()


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which the worker process keeps nothing: it may serve other operators next."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()

    return wrapped


def stretches(col: pa.Array, most_rows: int, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Rows [lo, hi) of an Arrow column of texts, at most so many and of so many bytes; a longer text is a
    stretch of its own."""
    if not len(col):
        return
    at = offsets(col).astype(np.int64)
    lo = 0
    while lo < len(col):
        hi = int(np.searchsorted(at, at[lo] + most_bytes, side="right")) - 1
        hi = min(len(col), lo + most_rows, max(lo + 1, hi))
        yield lo, hi
        lo = hi


def offsets(col: pa.Array) -> np.ndarray:
    """Where each value of a column of texts or bytes begins in its data, and where the last ends."""
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    return np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def utf8_slices(col: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text of an Arrow column as uint8 arrays without copies; null: empty."""
    if len(col) == 0:
        return
    off, data = offsets(col), col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    empty = np.zeros(0, np.uint8)
    valid = col.is_valid().to_numpy(zero_copy_only=False) if col.null_count else None
    for i in range(len(col)):
        yield raw[off[i] : off[i + 1]] if valid is None or valid[i] else empty


def crc_of_id(col: str = "doc_id"):
    """crc32 of doc_id as text; null ids hash as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))
