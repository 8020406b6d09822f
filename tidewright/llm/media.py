"""Media columns: texts as AVI files of lossless motion-JPEG frames, read back, cut into shots.

A payload is cut into frames of 24 x 24 eight-bit samples. Each frame is an intra frame: lossless JPEG
(ITU-T T.81 process 14, SOF3, predictor 1), so the samples read back are the payload. Frames of many
documents are coded and decoded together in numpy, sample position by sample position.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewright.llm.common import utf8_slices

SIDE = 24
FRAME = SIDE * SIDE
FPS = 25
#: Frames coded at once, and bytes of payload gathered before that.
SLICE = 4096
GATHER = 2 << 20

#: Fixed values of the format: the nine difference categories of 8-bit samples get codes of four bits.
_DHT = b"\xff\xc4" + struct.pack(">H", 2 + 17 + 9) + b"\x00" + bytes([0, 0, 0, 9] + [0] * 12) + bytes(range(9))
_SOF3 = b"\xff\xc3" + struct.pack(">HBHHBBBB", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0)
_SOS = b"\xff\xda" + struct.pack(">HBBBBBB", 8, 1, 1, 0x00, 1, 0, 0)
HEAD = b"\xff\xd8" + _DHT + _SOF3 + _SOS
TAIL = b"\xff\xd9"

CLIPS = "doc_id long, clip int, start_frame long, end_frame long, start_s double, end_s double, mean_diff double"


def payload_of(raw: bytes) -> bytes:
    """raw with bytes 255 appended up to a positive multiple of a frame."""
    return raw + b"\xff" * ((-len(raw)) % FRAME if raw else FRAME)


def _code_table() -> tuple[np.ndarray, np.ndarray]:
    """Code word and its length for each difference -255..255, at index difference + 255."""
    d = np.arange(-255, 256)
    size = np.array([int(abs(x)).bit_length() for x in d])
    extra = np.where(d < 0, d + (1 << size) - 1, d)
    return ((size << size) | extra).astype(np.int64), (size + 4).astype(np.int64)


def _peek_table(head: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Difference and bits used for each 12 bits that a sample may start with, from a frame's Huffman table."""
    at = head.index(b"\xff\xc4") + 5
    counts = list(head[at : at + 16])
    symbols = list(head[at + 16 : at + 16 + sum(counts)])
    diff, used = np.zeros(4096, np.int16), np.zeros(4096, np.int64)
    code = k = 0
    for bits, n in enumerate(counts, 1):
        for _ in range(n):
            size = symbols[k]
            for extra in range(1 << size):
                d = extra if size == 0 or extra >> (size - 1) else extra - (1 << size) + 1
                lo = ((code << size) | extra) << (12 - bits - size)
                diff[lo : lo + (1 << (12 - bits - size))] = d
                used[lo : lo + (1 << (12 - bits - size))] = bits + size
            code, k = code + 1, k + 1
        code <<= 1
    return diff, used


_WORDS, _BITS = _code_table()


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of frames: uint8 array of shape (n, FRAME)."""
    n = len(samples)
    x = samples.reshape(n, SIDE, SIDE).astype(np.int16)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    d = d.reshape(n, FRAME).astype(np.int64) + 255
    bits = _BITS[d]
    ends = np.cumsum(bits, axis=1)
    n_bytes = (ends[:, -1] + 7) >> 3
    first = np.concatenate([[0], np.cumsum(n_bytes)])
    at = (ends - bits + (first[:-1] * 8)[:, None]).ravel()
    bits = bits.ravel()
    # every code ends within the three bytes from the one it begins in; codes do not overlap, so sums are unions
    put = np.bincount(at >> 3, (_WORDS[d].ravel() << (24 - (at & 7) - bits)).astype(np.float64), minlength=first[-1]).astype(np.int64)
    pad = (n_bytes * 8 - ends[:, -1]).astype(np.int64)
    out = put >> 16
    out[1:] += (put[:-1] >> 8) & 255
    out[2:] += put[:-2] & 255
    out[first[1:] - 1] |= (1 << pad) - 1
    data = out.astype(np.uint8).tobytes()
    return [HEAD + data[a:b].replace(b"\xff", b"\xff\x00") + TAIL for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def decode_frames(files: list[bytes]) -> np.ndarray:
    """Samples of intra frames: uint8 array of shape (n, FRAME). All frames must share one header."""
    n = len(files)
    if n == 0:
        return np.zeros((0, FRAME), np.uint8)
    head = files[0][: len(HEAD)]
    if any(not f.startswith(head) or not f.endswith(TAIL) for f in files):
        raise ValueError("frames of different kinds in one file")
    height, width, predictor = *struct.unpack(">HH", head[head.index(b"\xff\xc3") + 5 :][:4]), head[-3]
    if (height, width, predictor) != (SIDE, SIDE, 1):
        raise ValueError("not a frame of this kind")
    diff_of, used_of = _peek_table(head)
    scans = [f[len(HEAD) : -2].replace(b"\xff\x00", b"\xff") for f in files]
    at = np.concatenate([[0], np.cumsum([len(s) for s in scans])])[:-1] * 8
    raw = np.frombuffer(b"".join(scans) + b"\xff\xff\xff", np.uint8).astype(np.int32)
    window = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
    d = np.empty((FRAME, n), np.int16)
    for k in range(FRAME):
        peek = (window[at >> 3] >> (12 - (at & 7))) & 4095
        d[k] = diff_of[peek]
        at += used_of[peek]
    x = d.T.reshape(n, SIDE, SIDE).astype(np.int32)
    x[:, 0, 0] += 128
    x[:, :, 0] = np.cumsum(x[:, :, 0], axis=1)
    return np.cumsum(x, axis=2).astype(np.uint8).reshape(n, FRAME)


def _chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + b"\0" * (len(data) & 1)


def write_avi(frames: list[bytes]) -> bytes:
    """A RIFF AVI file of motion-JPEG frames with its index."""
    n, most = len(frames), max(map(len, frames), default=0)
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, n, 0, 1, most, SIDE, SIDE, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIII4H", b"vids", b"MJPG", 0, 0, 0, 0, 1, FPS, 0, n, most, 0xFFFFFFFF, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", FRAME, 0, 0, 0, 0)
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    index, movi, at = [], [b"movi"], 4
    for f in frames:
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        movi.append(_chunk(b"00dc", f))
        at += len(movi[-1])
    return _chunk(b"RIFF", b"AVI " + hdrl + _chunk(b"LIST", b"".join(movi)) + _chunk(b"idx1", b"".join(index)))


def read_avi(data: bytes) -> list[bytes]:
    """The frames that the index of an AVI file lists."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    at, movi, index = 12, None, b""
    while at + 8 <= len(data):
        name, size = data[at : at + 4], struct.unpack_from("<I", data, at + 4)[0]
        if name == b"LIST" and data[at + 8 : at + 12] == b"movi":
            movi = at + 8
        elif name == b"idx1":
            index = data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    if movi is None:
        raise ValueError("no frames")
    return [data[movi + o + 8 : movi + o + 8 + size] for name, _, o, size in struct.iter_unpack("<4sIII", index) if name == b"00dc"]


def histograms(samples: np.ndarray) -> np.ndarray:
    """16-bin histograms of frames."""
    n = len(samples)
    cells = (samples >> 4).astype(np.int64) + (np.arange(n) * 16)[:, None]
    return np.bincount(cells.ravel(), minlength=16 * n).reshape(n, 16)


def shots(hist: np.ndarray, window: int = 12, times: float = 3.0, floor: float = 0.08) -> np.ndarray:
    """First frames of shots: a frame starts one where its histogram differs from the last by more than
    the mean plus `times` standard deviations of up to `window` differences before, and by `floor`."""
    if len(hist) < 2:
        return np.zeros(1, np.int64)
    diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2.0 * FRAME)
    one = np.concatenate([[0.0], np.cumsum(diff)])
    two = np.concatenate([[0.0], np.cumsum(diff * diff)])
    t = np.arange(len(diff))
    lo = np.maximum(0, t - window)
    n = np.maximum(1, t - lo)
    mean = (one[t] - one[lo]) / n
    sd = np.sqrt(np.maximum(0, (two[t] - two[lo]) / n - mean * mean))
    cut = (diff > np.maximum(floor, mean + times * sd)) & (t >= 2)
    return np.concatenate([[0], np.flatnonzero(cut) + 1])


def _store(payloads: list[bytes]) -> list[bytes]:
    """AVI files of payloads, coded together."""
    lens = [len(p) // FRAME for p in payloads]
    samples = np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, FRAME)
    coded = [f for at in range(0, len(samples), SLICE) for f in encode_frames(samples[at : at + SLICE])]
    ends = np.cumsum(lens)
    return [write_avi(coded[e - n : e]) for n, e in zip(lens, ends)]


def _load(files: list[bytes]) -> list[np.ndarray]:
    """Samples of each AVI file, decoded together."""
    frames = [read_avi(f) for f in files]
    flat = [f for fs in frames for f in fs]
    parts = [decode_frames(flat[at : at + SLICE]) for at in range(0, len(flat), SLICE)]
    samples = np.concatenate(parts) if parts else np.zeros((0, FRAME), np.uint8)
    return np.split(samples, np.cumsum([len(fs) for fs in frames])[:-1]) if files else []


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """doc_ids and UTF-8 texts, some GATHER bytes at once."""
    for batch in batches:
        ids, raws, size = [], [], 0
        for doc, raw in zip(batch.column(0).to_pylist(), utf8_slices(batch.column(1))):
            ids.append(doc)
            raws.append(raw.tobytes())
            size += len(raw) + FRAME
            if size >= GATHER:
                yield ids, raws
                ids, raws, size = [], [], 0
        if ids:
            yield ids, raws


def to_media(docs: DataFrame) -> DataFrame:
    """Texts (doc_id, text) as AVI files: doc_id, n_bytes, media binary. Null text: empty."""

    def run(batches):
        for ids, raws in _groups(batches):
            media = _store([payload_of(r) for r in raws])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(r) for r in raws], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def clips(media: DataFrame) -> DataFrame:
    """Timed clip rows of AVI files (doc_id, media): one row for each shot. Null media: none."""

    def run(batches):
        for batch in batches:
            out = []
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if data is None:
                    continue
                hist = histograms(_load([data])[0])
                starts = shots(hist).tolist()
                step = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2.0 * FRAME)
                for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(hist)])):
                    inner = step[a : b - 1]
                    out.append((doc, k, a, b, a / FPS, b / FPS, float(inner.mean()) if len(inner) else 0.0))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], [c.split()[0] for c in CLIPS.split(", ")])

    return media.select("doc_id", "media").mapInArrow(run, CLIPS)


DIGESTS = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_clips long"


def feature(samples: np.ndarray) -> tuple[str, int]:
    """Frames, shots, a checksum of where they start, and the mean histogram in hex."""
    hist = histograms(samples)
    starts = shots(hist)
    share = np.minimum(255, (hist.sum(axis=0) * 256) // max(1, int(hist.sum()))).astype(np.uint8)
    cuts = zlib.crc32(starts.astype("<u4").tobytes())
    return f"frames={len(hist)};clips={len(starts)};cuts={cuts:08x};hist={share.tobytes().hex()}", len(starts)


def media_digests(docs: DataFrame) -> DataFrame:
    """Stores every text as an AVI file, reads the file back and describes what was read.

    Returns a row for each row of `docs`. Null or empty text: a payload of one frame of bytes 255. Texts of
    any length are stored whole. Equal texts give equal values; null doc_ids are kept; other columns of
    `docs` are ignored; an empty table gives no rows.
    """

    def run(batches):
        for ids, raws in _groups(batches):
            media = _store([payload_of(r) for r in raws])
            out = []
            for doc, raw, file, samples in zip(ids, raws, media, _load(media)):
                back = samples.tobytes()
                text, n = feature(samples)
                out.append((doc, len(raw), len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-32:]), len(file), hashlib.sha256(file).hexdigest(), text, n))
            names, kinds = zip(*(c.split() for c in DIGESTS.split(", ")))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, k in zip(zip(*out), kinds)], list(names))

    return docs.select("doc_id", "text").mapInArrow(run, DIGESTS)
