"""The operators that give a row for each document, held against plain versions of what they promise."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewright.llm import bytebpe, fingerprints, lm, media, minhash, packing, substrings, suffixes
from tidewright.llm.common import words


def by_row(df, *columns):
    return sorted(((r.doc_id is None, r.doc_id), *(r[c] for c in columns)) for r in df.collect())


def plain(rows, f):
    return sorted(((d is None, d), *f(d, t or "")) for d, t in rows)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def near_rows(rows, similarity=0.8):
    """Links and components by comparing all pairs of rows."""
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links, root = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = root[i], root[j]
                root = [a if x == b else x for x in root]
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[root[k]] = min(d, least.get(root[k], d))
    return [(least.get(root[k], d), links[k]) for k, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("large", [4096, 1])
def test_near_copies_are_all_linked(docs, rows, large):
    got = by_row(minhash.join(docs, large=large), "class_id", "n_links")
    assert got == sorted(((d is None, d), *x) for (d, _), x in zip(rows, near_rows(rows)))


def test_bands_reach_the_recall():
    n = minhash.bands_for(0.8, 0.999, 5)
    assert 1 - (1 - 0.8**5) ** n >= 0.999 > 1 - (1 - 0.8**5) ** (n - 1)


def test_blocks_of_a_large_group_find_every_link(spark):
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join([*base[: k % 110], f"x{k}", *base[k % 110 + 1 :]])) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert by_row(minhash.join(df), "class_id", "n_links") == sorted(((False, d), *x) for (d, _), x in zip(rows, near_rows(rows)))


def test_links_do_not_depend_on_how_components_are_compared(spark, monkeypatch):
    import random

    rng = random.Random(6)
    base = [f"w{k}" for k in range(150)]
    near = lambda: " ".join(f"x{rng.randrange(10**9)}" if rng.random() < rng.choice((0.01, 0.03, 0.05)) else w for w in base)
    df = spark.createDataFrame([(k, near()) for k in range(300)], "doc_id long, text string")
    monkeypatch.setattr(minhash, "BLOCK", 64)
    for recall in (0.99999, 0.9):
        whole, by_band = (by_row(minhash.join(df, large=x, recall=recall), "class_id", "n_links") for x in (4096, 1))
        assert whole == by_band


def test_planted_near_copies_are_found(spark):
    """Pairs at a similarity of 0.8 to 0.9: nearly all are linked at the default bands, at least 0.9 at recall 0.9."""
    import random

    rng, rows = random.Random(8), []
    for k in range(400):
        base = [f"w{rng.randrange(10**9)}" for _ in range(200)]
        at = rng.randrange(20, 150)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join([*base[:at], *(f"y{rng.randrange(10**9)}" for _ in range(rng.randrange(2, 18))), *base[at + 17 :]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d for (d, _), (_, n) in zip(rows, near_rows_of_pairs(rows)) if n}
    for recall, least in ((0.99999, 0.999), (0.9, 0.9)):
        got = {r.doc_id for r in minhash.join(df, recall=recall).collect() if r.n_links}
        assert got <= want and len(got) >= least * len(want) > 0


def near_rows_of_pairs(rows):
    return [x for k in range(0, len(rows), 2) for x in near_rows(rows[k : k + 2])]


def test_one_row_of_each_class_stays(docs, rows):
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for c, _ in near_rows(rows)}
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(c) for c in want)


def test_rows_with_one_id_or_none_are_told_apart_by_their_texts(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
    rows = [(5, a), (5, b), (1, b + " more"), (None, c), (None, c + " x"), (None, a + " y"), (None, None), (7, None), (7, None), (8, "")]
    kept = minhash.one_of_each(spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, kept_id int"))
    found = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(d is None and t is not None for d, t in found) == 1  # one of c's two
    assert sorted((str(d), str(t)) for d, t in found if d is not None or t is None) == sorted((str(d), str(t)) for d, t in [(5, a), (1, b + " more"), (None, None), (7, None), (8, "")])


def test_bpe_round_trip(docs, rows):
    e = bytebpe._encoding(bytebpe.default_ranks(), bytebpe.default_pattern())
    want = plain(rows, lambda d, t: (len(x := e.encode_ordinary(t)), sha(np.array(x, "<u4").tobytes()), sha(t)))
    assert by_row(bytebpe.round_trip(docs, buckets=5), "n_tokens", "ids_sha256", "decoded_sha256") == want
    encoded = bytebpe.encode(docs)
    assert by_row(encoded, "ids") == plain(rows, lambda d, t: (e.encode_ordinary(t),))
    assert by_row(bytebpe.decode(encoded), "data") == plain(rows, lambda d, t: (bytearray(t.encode()),))


def test_pretokens_of_any_text():
    import random

    e, cut = bytebpe._encoding(bytebpe.default_ranks(), bytebpe.default_pattern()), bytebpe.Cutter(bytebpe.default_pattern())
    rng, letters = random.Random(2), " \n\t\r\x0b\x1c\x85\xa0 　ab'srtA1²٣é中!._́​\U0001f600\x00"
    for _ in range(3000):
        t = "".join(rng.choice(letters) for _ in range(rng.randrange(15)))
        assert [k for p in cut.cut(cut.runs(t)) for w in p for k in e._encode_single_piece(w.encode())] == e.encode_ordinary(t)


def earlier_repeats(rows, window):
    first = {}
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        w = words(t)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), (d is None, d))

    def kept(d, t):
        w = words(t)
        hit = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d is None, d):
                hit[i : i + window] = [True] * window
        left = " ".join(x for x, h in zip(w, hit) if not h)
        return len(w), sum(hit), sha(left), left

    return kept


@pytest.mark.parametrize("window,most", [(50, 20_000), (50, 1), (12, 3)])
def test_words_of_earlier_documents_go(docs, rows, window, most):
    got = by_row(substrings.remove_repeats(docs, window, most), "n_words", "n_removed", "kept_sha256", "kept")
    assert got == plain(rows, earlier_repeats(rows, window))


def test_cleaned_keeps_rows_and_columns(docs, rows):
    plain_docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    got = substrings.cleaned(plain_docs)
    assert got.schema == plain_docs.schema
    kept = earlier_repeats(rows, 50)
    want = sorted((str(d), t if not t or not kept(d, t)[1] else kept(d, t)[3]) for d, t in rows if t is not None)
    assert sorted((str(r.doc_id), r.text) for r in got.collect() if r.text is not None) == want


def test_factors_are_the_removed_runs(docs, rows):
    total = Counter()
    for r in substrings.factors(docs).collect():
        assert r.length >= 50
        total[r.doc_id] += r.length
    want = Counter()
    kept = earlier_repeats(rows, 50)
    for d, t in rows:
        if n := kept(d, t or "")[1]:
            want[d] += n
    assert total == want


@pytest.mark.parametrize("window,most", [(200, 20_000), (200, 1), (40, 2)])
def test_bytes_that_repeat_anywhere_go(docs, rows, window, most):
    times = Counter(b[i : i + window] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - window + 1))

    def kept(d, t):
        b = t.encode()
        edge = np.zeros(len(b) + 1, int)
        for i in range(len(b) - window + 1):
            if times[b[i : i + window]] > 1:
                edge[i] += 1
                edge[i + window] -= 1
        hit = np.cumsum(edge[:-1]) > 0
        left = np.frombuffer(b, np.uint8)[~hit].tobytes()
        return len(b), int(hit.sum()), int((np.diff(hit.astype(int), prepend=0) == 1).sum()), sha(left)

    got = by_row(suffixes.remove_repeats(docs, window, most), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == plain(rows, kept)


def test_window_names_tell_strings_apart():
    from tidewright.llm.repeats import window_names

    rng = np.random.default_rng(1)
    raw = rng.integers(0, 2, 600).astype(np.uint8)
    for window in (1, 3, 8, 13):
        names = window_names(suffixes._BYTE_NAMES[raw], window)
        strings = [raw[i : i + window].tobytes() for i in range(len(raw) - window + 1)]
        assert len(names) == len(strings) and len(set(names.tolist())) == len(set(strings)) == len(set(zip(names.tolist(), strings)))


@pytest.mark.parametrize("window", [1, 3, 8, 13, 40, 200])
def test_buckets_hold_equal_strings(window):
    rng = np.random.default_rng(window)
    some = [rng.integers(0, 2 + k % 3, n).astype(np.uint8) for k, n in enumerate([900, 200, 5, 431, 1, 200])]
    some += [some[0][100:600], np.tile(some[3][:7], 60), some[3][:220].copy()]
    raw, length = np.concatenate(some), np.array([len(x) for x in some])
    left = np.repeat(np.cumsum(length), length) - np.arange(len(raw))
    bucket = suffixes.refined(raw, left, window)
    strings = {i: raw[i : i + window].tobytes() for i in np.flatnonzero(left >= window).tolist()}
    assert (bucket[left < window] == -1).all() and all(bucket[i] >= 0 for i in strings)
    assert len({bucket[i] for i in strings}) == len(set(strings.values())) == len({(bucket[i], s) for i, s in strings.items()})


def test_factors_are_greedy_and_hold_what_they_match():
    rng = np.random.default_rng(4)
    old = [rng.integers(0, 1 << 60, n).astype(np.uint64) for n in (90, 70)]
    text = np.concatenate([old[0][5:40], rng.integers(0, 1 << 60, 8).astype(np.uint64), old[1][:30], old[0][60:]])
    docs, segments = np.array([3, 1, 7]), [*old, text]
    hits = substrings.factored([(docs, segments)], 12)
    assert not hits[0].any() and not hits[1].any()
    want = [any((text[i : i + 12] == o[j : j + 12]).all() for o in old for j in range(len(o) - 11)) for i in range(len(text) - 11)]
    assert hits[2].tolist() == want
    assert not any(h.any() for h in substrings.factored([(np.array([5, 5]), [old[0], old[0][:40]])], 12))  # one document
    longest = lambda at: iter([np.concatenate([text[at : at + 20], old[1][:3]])])
    assert substrings.parse(text, np.arange(len(text) - 11), longest, 12)[0] == (0, 20)
    # a name that agrees by chance makes no factor
    assert substrings.parse(text, np.array([0]), lambda at: iter([old[1]]), 12) == []


def test_media_reads_back_what_was_stored(docs, rows):
    def want(d, t):
        p = media.payload_of(t.encode())
        return len(t.encode()), len(p), sha(p), zlib.crc32(p[-32:])

    out = media.media_digests(docs)
    assert by_row(out, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32") == plain(rows, want)
    stored = {r.doc_id: r for r in media.to_media(docs).collect()}
    for r in out.collect():
        assert (r.media_bytes, r.media_sha256) == (len(stored[r.doc_id].media), sha(bytes(stored[r.doc_id].media)))
    frames = {d: len(media.read_avi(bytes(r.media))) for d, r in stored.items()}
    ends = defaultdict(int)
    for c in media.clips(media.to_media(docs).dropDuplicates(["doc_id"])).collect():
        assert c.start_s == c.start_frame / media.FPS and c.start_frame < c.end_frame
        ends[c.doc_id] += c.end_frame - c.start_frame
    assert ends == frames


def test_frames_of_any_bytes():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.integers(0, 256, (40, media.FRAME)), np.zeros((1, media.FRAME)), np.full((1, media.FRAME), 255), np.tile([0, 255], (1, media.FRAME // 2))]).astype(np.uint8)
    assert (media.decode_frames(media.encode_frames(x)) == x).all()


def test_shots_start_where_histograms_jump():
    x = np.full((60, media.FRAME), 40, np.uint8)
    x[25:40], x[40:] = 200, 90
    assert media.shots(media.histograms(x)).tolist() == [0, 25, 40]


def test_packing_holds_every_id_once(docs, rows):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    for length in (2048, 64):
        got = packing.best_fit(docs, length=length, open_bins=4).collect()
        want = []
        for d, text in rows:
            ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
            want += [(str(d), k, s, len(p), zlib.crc32(np.array(p, "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), length)) for p in [ids[s : s + length]]]
        assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
        bins = defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        for pieces in bins.values():
            at = 0
            for offset, n in sorted(pieces):
                assert offset == at
                at += n
            assert at <= length


def test_packing_is_tight(spark):
    rng = np.random.default_rng(5)
    sizes = np.minimum(2048, (rng.pareto(1.2, 6000) * 90 + 2).astype(int)).tolist()
    rows = [(k, 0, 0, n, k) for k, n in enumerate(sizes)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES).coalesce(1)).collect()
    least = -(-sum(sizes) // 2048)
    assert least <= len({r.sequence_id for r in got}) <= 1.03 * least + 4


def test_best_fit_takes_the_fullest_bin_that_fits():
    b = packing.BestFit(10, 2)
    assert b.put("a", 6) == [] and b.put("b", 5) == [] and b.put("c", 4) == [[("a", 0), ("c", 6)]]
    assert b.put("d", 9) == [] and b.put("e", 8) == [[("d", 0)]] and b.put("f", 10) == [[("f", 0)]]
    assert sorted(x for items in b.rest() for x, _ in items) == ["b", "e"]


def test_words_are_encoded_as_by_the_library():
    import pyarrow as pa
    from tokenizers import Tokenizer

    from tidewright.llm.bpe import WordEncoder

    t = Tokenizer.from_file(packing.default_tokenizer())
    some = ["a <|endoftext|> b<|startoftext|>c <|ENDOFTEXT|> é<|endoftext|><|endoftext|>́x", "naïve  ŒUVRE's İstanbul ΣΑΣ 'll'd x²½ don't 中文 ́a <|endoftext|> a\x00b\x85c　d", "", None, "a" * 100 + " " + "é" * 70, "  x\n\ny  "]
    ids, n = WordEncoder.at(packing.default_tokenizer()).encode(pa.array(some))
    at = np.cumsum(n)
    assert [ids[e - k : e].tolist() for e, k in zip(at, n)] == [t.encode(x or "", add_special_tokens=False).ids for x in some]


def test_fingerprints_and_edits(docs, rows):
    import pyspark.sql.functions as F

    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    got = {}
    for r in fingerprints.with_edits(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sorted(map(str, got)) == sorted({str(d) for d, _ in rows}) and sum(map(len, got.values())) == len(rows)
    for k, (d, t) in enumerate(ordered):
        t, u = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(t)
        e = t[: n - n // 2] + u[: n // 2]
        assert any(r.n_chars == n and r.edited_sha256 == sha(e) and r.fingerprint == fingerprints.as_text(fingerprints.sketch(fingerprints.phrases([t])[0])) for r in got[d])
    alone = {(r.doc_id, r.fingerprint) for r in fingerprints.fingerprint(docs).collect()}
    assert alone == {(r.doc_id, r.fingerprint) for rs in got.values() for r in rs}
    far = [r for rs in got.values() for r in rs if r.n_chars > 300]
    assert np.mean([r.near_edited for r in far]) > np.mean([r.near_next for r in far]) + 0.1
    assert fingerprints.with_edits(docs.where(F.col("doc_id") == 4)).count() == 1


def plain_phrases(text, level=fingerprints.LEVEL):
    """The same phrases symbol by symbol."""
    mask = (1 << 64) - 1
    seed = 0x9E3779B97F4A7C15

    def mix(h):
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & mask
        return h ^ (h >> 31)

    symbols = [mix(ord(c) + 1) for c in text]
    for _ in range(level if text else 0):
        runs = []
        for s in symbols:
            if runs and runs[-1][0] == s:
                runs[-1][1] += 1
            else:
                runs.append([s, 1])
        symbols = [mix((s + n * seed) & mask) if n > 1 else s for s, n in runs]
        label = symbols
        for _ in range(4):
            new = []
            for k, x in enumerate(label):
                differ = x ^ (label[k - 1] if k else x ^ 1)
                place = (differ & -differ).bit_length() - 1
                new.append(2 * place + (x >> place & 1))
            label = new
        begin = [k for k in range(len(symbols)) if k == 0 or (k + 1 < len(symbols) and label[k - 1] < label[k] > label[k + 1])]
        made = []
        for a, b in zip(begin, [*begin[1:], len(symbols)]):
            made.append(mix(sum(mix(symbols[k] ^ ((k - a) * seed & mask)) for k in range(a, b)) & mask))
        symbols = made
    return set(symbols)


def plain_sketch(text):
    mask = (1 << 64) - 1

    def mix(h):
        h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & mask
        h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & mask
        return h ^ (h >> 31)

    return sorted({mix(x) >> 32 for x in plain_phrases(text)})[: fingerprints.SIZE]


def plain_likeness(a, b):
    if not a or not b:
        return float(a == b)
    both = sorted({*a, *b})[: fingerprints.SIZE]
    return sum(x in a and x in b for x in both) / len(both)


def test_fingerprints_against_a_plain_version(spark, rows):
    some = [(d, t) for d, t in rows if d is None or d < 1001][:48]
    df = spark.createDataFrame([*some, (7, "two rows"), (7, "of one id"), (None, "no id")], "doc_id long, text string").repartition(3)
    by = {}
    for d, t in [(r.doc_id, r.text) for r in df.collect()]:
        by.setdefault(d, []).append(t)
    got = fingerprints.with_edits(df).collect()
    want = {fingerprints.as_text(np.array(plain_sketch(t or ""), np.uint32)) for ts in by.values() for t in ts}
    assert {r.fingerprint for r in got} == want and len(got) == df.count()
    ids = sorted((d for d in by if d is not None), reverse=True)
    for d, after in zip(ids, ids[1:]):
        if len(by[d]) > 1 or len(by[after]) > 1:
            continue
        t, u = by[d][0] or "", by[after][0] or ""
        e = t[: len(t) - len(t) // 2] + u[: len(t) // 2]
        a, b, c = plain_sketch(t), plain_sketch(e), plain_sketch(u)
        r = next(r for r in got if r.doc_id == d)
        assert (r.edited_fingerprint, r.edited_sha256) == (fingerprints.as_text(np.array(b, np.uint32)), sha(e))
        assert np.isclose(r.near_edited, plain_likeness(a, b)) and np.isclose(r.near_next, plain_likeness(a, c))


def test_rows_without_ids_are_dealt_over_many_stretches(spark):
    import pyspark.sql.functions as F

    df = spark.range(600).select(F.lit(None).cast("long").alias("doc_id"), F.concat_ws(" ", F.lit("text"), "id").alias("text")).repartition(4)
    places = {r.place for r in fingerprints.followed(df).where("not extra").select("place").distinct().collect()}
    assert len(places) > 8
    got = fingerprints.with_edits(df).collect()
    order = [r.text for r in df.orderBy(F.xxhash64("text")).collect()]
    follows = {t: u for t, u in zip(order, [*order[1:], order[0]])}
    assert sorted(r.edited_sha256 for r in got) == sorted(sha(t[: len(t) - len(t) // 2] + u[: len(t) // 2]) for t, u in follows.items())


def test_phrases_do_not_depend_on_the_offset():
    import random

    rng = random.Random(4)
    middle = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    a, b = fingerprints.phrases([middle, "".join(rng.choice("xyz ") for _ in range(777)) + middle])
    assert len(np.intersect1d(a, b)) >= 0.97 * len(a)


def test_scores_add_up(docs, rows):
    count, n_docs = Counter(), 0
    for d, t in rows:
        if zlib.crc32(str(d).encode() if d is not None else b"") % 7 != 2:
            count.update((t or "").encode().lower().split())
            n_docs += 1
    total, distinct = sum(count.values()) + n_docs, len(count) + 1

    def want(d, t):
        w = t.encode().lower().split()
        base = sum(np.log10((count[x] + 1) / (total + distinct + 1)) for x in w) + np.log10((n_docs + 1) / (total + distinct + 1))
        return zlib.crc32(str(d).encode() if d is not None else b"") % 7 == 2, len(w) + 1, sum(x in count for x in w) + 1, total, round(base, 6)

    got = lm.score(docs, buckets=3).collect()
    assert sorted(((r.doc_id is None, r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == plain(rows, want)
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_network_gives_probabilities_and_right_gradients():
    rng = np.random.default_rng(1)
    n = lm.n_symbols(bytebpe.default_ranks())
    count = np.zeros(n)
    count[rng.integers(0, n, 3000)] += 1
    windows = rng.integers(0, n, (6, lm.SPAN + 1))
    classes = lm.Classes.by_count(count, windows)
    assert np.allclose(np.bincount(classes.of, 10.0 ** classes.share.astype(float), lm.CLASSES)[np.unique(classes.of)], 1, atol=1e-4)
    net = lm.Network()
    net.begin(classes.mass)
    before, first = np.zeros(2, int), np.array([True, False])
    inputs, target = classes.place[windows[0, : 2 * lm.W]].reshape(2, lm.W), classes.of[windows[0, 1 : 2 * lm.W + 1]].reshape(2, lm.W)
    state = net.forward(inputs, before, first)[0].reshape(-1, lm.WIDTH)[:1]
    every = net.logs(np.repeat(state, lm.CLASSES, axis=0), np.arange(lm.CLASSES))
    assert abs(np.exp(every.astype(float)).sum() - 1) < 1e-3
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    _, grads = net.gradients(inputs, before, first, target)
    for name in ("q", "k", "v", "o", "w1", "w2", "out", "rel"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        old, loss = net.w[name][at], []
        for step in (1e-4, -1e-4):
            net.w[name][at] = old + step
            loss.append(net.gradients(inputs, before, first, target)[0])
        net.w[name][at] = old
        assert abs((loss[0] - loss[1]) / 2e-4 - grads[name][at]) < 2e-2 * abs(grads[name][at]) + 1e-5, name


def dense_log10(net, classes, symbols):
    """A text's symbols by plain attention over every pair of positions, one softmax over all classes."""
    w = {k: v.astype(float) for k, v in net.w.items()}
    n = len(symbols)
    x = w["e"][np.concatenate([[lm.HEAD - 1], classes.place[symbols[:-1]]])]
    i, j = np.arange(n)[:, None], np.arange(n)[None, :]
    near = (j <= i) & (j // lm.W >= i // lm.W - 1)
    s = (x @ w["q"]) @ (x @ w["k"]).T / np.sqrt(lm.WIDTH) + w["rel"][np.clip(i - j, 0, 2 * lm.W - 1)]
    a = np.where(near, np.exp(s), 0)
    h = (a / a.sum(axis=1, keepdims=True)) @ (x @ w["v"]) @ w["o"] + x
    g = np.maximum(h @ w["w1"] + w["b1"], 0) @ w["w2"] + h
    soft = lambda y: y - np.log(np.exp(y).sum(axis=-1, keepdims=True))
    within = soft(np.einsum("nd,gdc->ngc", g, w["in"]) + w["c"])
    whole = (soft(g @ w["out"] + w["b"])[:, :, None] + within).reshape(n, -1)
    return whole[np.arange(n), classes.of[symbols]] / np.log(10) + classes.share[symbols]


def test_scores_equal_plain_dense_attention():
    rng = np.random.default_rng(3)
    n = lm.n_symbols(bytebpe.default_ranks())
    classes = lm.Classes.by_count(np.ones(n), rng.integers(0, n, (4, lm.SPAN + 1)))
    net = lm.Network()
    net.w = {k: (v + rng.normal(0, 0.1, v.shape)).astype(np.float32) for k, v in net.w.items()}
    some = [rng.integers(0, n, k) for k in (1, 15, 0, 16, 17, 700, 5000)]
    lens = np.array([len(s) for s in some])
    together = np.split(net.log10_of(np.concatenate(some), lens, classes), np.cumsum(lens)[:-1])
    for s, t in zip(some, together):
        assert len(s) == len(t) and (not len(s) or np.allclose(dense_log10(net, classes, s), t, atol=1e-3))


@pytest.mark.parametrize("run", [minhash.join, minhash.one_of_each, bytebpe.round_trip, bytebpe.encode, substrings.remove_repeats, substrings.factors, suffixes.remove_repeats, media.media_digests, packing.best_fit, fingerprints.with_edits, lm.score])
def test_empty_tables_give_no_rows(none, run):
    assert run(none).count() == 0
