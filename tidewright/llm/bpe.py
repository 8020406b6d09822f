"""Byte-pair encoding of many words at once in numpy, and a word encoder for a tokenizer file with word ends."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_NO_PAIR = np.int64(1 << 40)
_BATCH = 4096
_LONGEST = 48


class Merges:
    """Merge rules as sorted pair keys: rank and result of each pair of symbols."""

    def __init__(self, left: np.ndarray, right: np.ndarray, made: np.ndarray, n_symbols: int):
        self.n = np.int64(n_symbols)
        key = left.astype(np.int64) * self.n + right
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made.astype(np.int64)[order]

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or _NO_PAIR) and place in the rules of pairs; b < 0 is no symbol."""
        key = a * self.n + b
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where((self.key[at] == key) & (b >= 0), self.rank[at], _NO_PAIR), at

    def apply(self, symbols: np.ndarray) -> np.ndarray:
        """Merges rows of symbols (-1: none, at the end only) in place, lowest rank and leftmost first."""
        n, width = symbols.shape
        if width < 2 or n == 0:
            return symbols
        none = np.full((n, 1), -1, np.int64)
        rank, at = self.find(symbols, np.hstack([symbols[:, 1:], none]))
        column = np.arange(width)
        rows = np.arange(n)
        while True:
            j = rank.argmin(axis=1)
            live = rank[np.arange(len(rows)), j] < _NO_PAIR
            if not live.all():
                rows, j, rank, at = rows[live], j[live], rank[live], at[live]
            if not len(rows):
                return symbols
            mine = np.arange(len(rows))
            s = symbols[rows]
            made = self.made[at[mine, j]]
            take = np.minimum(column + (column > j[:, None]), width - 1)
            s = np.take_along_axis(s, take, 1)
            rank, at = np.take_along_axis(rank, take, 1), np.take_along_axis(at, take, 1)
            s[:, -1] = -1
            rank[:, -1] = _NO_PAIR
            s[mine, j] = made
            after = np.where(j + 1 < width, s[mine, np.minimum(j + 1, width - 1)], -1)
            rank[mine, j], at[mine, j] = self.find(made, after)
            before = j > 0
            k = j[before] - 1
            rank[mine[before], k], at[mine[before], k] = self.find(s[mine[before], k], made[before])
            symbols[rows] = s


class Pool:
    """Ids of known words, all in flat arrays: some 30 bytes a word and no Python object. Bounded in words and
    in their bytes: when it is full, the words that most batches asked for stay."""

    def __init__(self, most: int, most_bytes: int):
        self.most, self.most_bytes = most, most_bytes
        self.words = pa.array([], pa.string())
        self.start, self.length, self.asked = (np.zeros(0, np.int32) for _ in range(3))
        self.ids = np.zeros(0, np.uint32)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where each of these distinct words is; -1: not known."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy().copy()
        self.asked[at[at >= 0]] += 1
        return at

    def make_room(self) -> None:
        if len(self.words) > self.most or self.words.nbytes > self.most_bytes:
            some = np.flatnonzero(self.asked > 1)
            some = np.sort(some[np.argsort(-self.asked[some], kind="stable")[: self.most // 2]])
            size = np.cumsum(pc.binary_length(self.words).to_numpy()[some])
            some = some[: np.searchsorted(size, self.most_bytes // 2)]
            self.ids = spread(self.start[some], self.length[some], self.ids)
            self.words, self.length, self.asked = self.words.take(pa.array(some)), self.length[some], self.asked[some] // 2
            self.start = (np.cumsum(self.length) - self.length).astype(np.int32)

    def add(self, words: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.ids)
        self.words = pa.concat_arrays([self.words, words])
        self.start = np.concatenate([self.start, (first + np.cumsum(lengths) - lengths).astype(np.int32)])
        self.length = np.concatenate([self.length, lengths.astype(np.int32)])
        self.asked = np.concatenate([self.asked, np.ones(len(words), np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words, one after the other, and how many each has."""
        n = self.length[places].astype(np.int64)
        return spread(self.start[places], n, self.ids), n


def spread(start: np.ndarray, length: np.ndarray, data: np.ndarray) -> np.ndarray:
    """data[start:start+length] of each, one after the other."""
    total = int(length.sum())
    at = np.arange(total) + np.repeat(start - np.cumsum(length) + length, length)
    return data[at]


class WordEncoder:
    """Ids of whole texts by a tokenizer file that drops white space and marks word ends.

    Texts are cut at blanks, which no id spans, and each distinct run is encoded once. The file's special
    tokens are found first, as the library does, in the text as it is. Runs of printable ASCII are cut by the
    file's pattern here; others by the library's own normaliser and cutter. Known words stay with the worker
    process, up to some 40 MB.
    """

    _of: dict[str, WordEncoder] = {}

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        model = given["model"]
        #: None of them may hold a blank, or be found after normalising, to be found within runs.
        self.special = {x["content"]: x["id"] for x in given["added_tokens"]}
        if any(set(x["content"]) & set(" \n\t") or x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in given["added_tokens"]):
            raise ValueError(f"{path} has special tokens of a kind that is not supported")
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        ids, self.end = model["vocab"], model["end_of_word_suffix"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        table = [np.array(x, np.int64) for x in zip(*((ids[a], ids[b], ids[a + b]) for a, b in pairs))]
        self.merges = Merges(*table, n_symbols=max(ids.values()) + 1)
        self.ids = ids
        #: The file's pattern for the ASCII characters, lower-cased.
        self.cut = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
        self.runs, self.parts = Pool(most, 20 * most), Pool(most // 2, 8 * most)

    @classmethod
    def at(cls, path: str) -> WordEncoder:
        if path not in cls._of:
            cls._of[path] = cls(path)
        return cls._of[path]

    def _encode_parts(self, parts: list[str]) -> None:
        """Adds parts (words in the vocabulary's own characters, or special tokens) to the pool."""
        if named := [p for p in parts if p in self.special]:
            self.parts.add(pa.array(named, pa.string()), np.array([self.special[p] for p in named]), np.ones(len(named), np.int64))
            parts = [p for p in parts if p not in self.special]
        parts.sort(key=len)
        for lo in range(0, len(parts), _BATCH):
            some = parts[lo : lo + _BATCH]
            width = len(some[-1])
            if width <= _LONGEST:
                rows = np.full((len(some), width), -1, np.int64)
                for k, p in enumerate(some):
                    rows[k, : len(p)] = [self.ids[c] for c in p[:-1]] + [self.ids[p[-1] + self.end]]
                rows = self.merges.apply(rows)
                keep = rows >= 0
                ids, lengths = rows[keep], keep.sum(axis=1)
            else:
                found = [[t.id for t in self.tokenizer.model.tokenize(p)] for p in some]
                ids, lengths = np.array([i for f in found for i in f], np.uint32), np.array([len(f) for f in found], np.int64)
            self.parts.add(pa.array(some, pa.string()), ids, lengths)

    def _parts_of(self, runs: list[str]) -> list[list[str]]:
        """Each run's parts: special tokens, and what the file's normaliser and cutter make of the rest."""
        out: list[list[str]] = []
        other = []
        for k, r in enumerate(runs):
            if self.cut_special is not None and "<" in r and (found := self.cut_special.split(r))[1:]:
                out.append([p for j, x in enumerate(found) for p in ([x] if j % 2 else self._plain(x))])
            elif r.isascii() and r.isprintable():
                out.append(self.cut.findall(r.lower()))
            else:
                out.append([])
                other.append(k)
        # the library takes many runs at once, told apart by blanks; runs that hold white space go alone
        for lo in range(0, len(other), 20_000):
            some = [k for k in other[lo : lo + 20_000] if len(runs[k].split()) == 1]
            normal = self.tokenizer.normalizer.normalize_str(" ".join(runs[k] for k in some))
            ends = np.cumsum([len(x) + 1 for x in normal.split(" ")])
            if len(ends) != len(some):
                some = []
            else:
                found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
                of = np.searchsorted(ends, np.fromiter((at for _, (at, _) in found), np.int64, len(found)), side="right")
                for k, (p, _) in zip(of.tolist(), found):
                    out[some[k]].append(p)
            alone = set(some)
            for k in other[lo : lo + 20_000]:
                if k not in alone:
                    out[k] = self._plain(runs[k])
        return out

    def _plain(self, run: str) -> list[str]:
        if run.isascii() and run.isprintable():
            return self.cut.findall(run.lower())
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(run))]

    def _encode_runs(self, runs: pa.Array) -> None:
        parts_of = self._parts_of(runs.to_pylist())
        self.parts.make_room()
        coded = pa.array([p for ps in parts_of for p in ps], pa.string()).dictionary_encode()
        place = self.parts.places(coded.dictionary)
        if (place < 0).any():
            self._encode_parts(coded.dictionary.filter(pa.array(place < 0)).to_pylist())
            place = pc.index_in(coded.dictionary, value_set=self.parts.words).to_numpy()
        ids, n = self.parts.of(place[coded.indices.to_numpy()])
        of_run = np.repeat(np.arange(len(runs)), [len(ps) for ps in parts_of])
        self.runs.add(runs, ids, np.bincount(of_run, n, len(runs)).astype(np.int64))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an array of texts one after the other, and how many each text has. Null: none."""
        texts = pc.fill_null(texts, "")
        for c in "\n\t":
            texts = pc.replace_substring(texts, c, " ")
        runs = pc.split_pattern(texts, " ")
        coded = runs.flatten().dictionary_encode()
        self.runs.make_room()
        place = self.runs.places(coded.dictionary)
        new = place < 0
        if new.any():
            place[new] = len(self.runs.words) + np.arange(int(new.sum()))
            self._encode_runs(coded.dictionary.filter(pa.array(new)))
        ids, n = self.runs.of(place[coded.indices.to_numpy()])
        per_text = pc.list_value_length(runs).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(per_text)]
        return ids, np.diff(ends, prepend=0)
