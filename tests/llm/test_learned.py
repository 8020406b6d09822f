"""Quality and language: held-out accuracy, what may be learned from, odd inputs."""

import random
import zlib

import numpy as np
import pytest

from tidewright.llm import langid, quality

SYLLABLES = {"aa": ["the", "ing", "an", "er", "on"], "bb": ["eau", "oi", "qu", "ez", "la"], "cc": ["sch", "un", "ge", "ich", "te"]}


def corpus(n=240):
    rng, rows, labels = random.Random(8), [], []
    for d in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        w = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(8, 120))]
        good = rng.random() < 0.7
        rows.append((d, " ".join(w if good else [x.upper() + "!!" for x in w]), lang if d % 17 else None, "s", 0))
        labels.append((d, int(good), 0))
    return rows, labels


ODD = [(9000, None, "aa", "s", 0), (9001, "", "aa", "s", None), (9002, "123 %% ...", "aa", "s", 3), (9003, "中文字字", "aa", "s", 4), (None, "theing an", None, None, None), (9004, "thean ing " * 20000, "aa", "s", 1)]


@pytest.fixture(scope="module")
def tables(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, *ODD, rows[0]], "doc_id long, text string, lang string, source string, n_chars long")
    return docs, spark.createDataFrame([*labels, (9000, None, None), (5, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"), rows, dict((a, b) for a, b, _ in labels)


def held(d, n, k):
    return zlib.crc32(str(d).encode() if d is not None else b"") % n == k


def test_language_of_held_out_documents(tables):
    docs, _, rows, _ = tables
    got = langid.detect(docs).collect()
    assert len(got) == docs.count() and all(r.held_out == held(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in got)
    lang = {d: x for d, _, x, _, _ in rows if x}
    tried = [r for r in got if r.held_out and r.doc_id in lang]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in tried]) >= 0.95
    odd = {r.doc_id: r for r in got if r.doc_id is None or r.doc_id >= 9000}
    assert [odd[k].lang_pred for k in (9000, 9001, 9002)] == ["und"] * 3 and odd[9003].lang_pred in SYLLABLES and odd[None].lang_pred == "aa"


def test_language_does_not_read_lang_of_held_out_rows(tables):
    from pyspark.sql import functions as F

    docs = tables[0]
    changed = docs.withColumn("lang", F.when(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("other"))
    key = lambda df: sorted((str(r.doc_id), r.lang_pred, r.score) for r in langid.detect(df).collect())
    assert key(docs) == key(changed)


def test_filters_return_all_languages_and_correct_for_chance():
    name = langid.names("theing eau")
    bits = np.zeros((1 << langid.SLOT_BITS, 2), np.uint64)
    langs = [f"l{k:02d}" for k in range(70)]
    for s in langid.slots(name):
        bits[s, 0] |= np.uint64(1 << 3)
        bits[s, 1] |= np.uint64(1 << 2)
    f = langid.Filters(langs, bits, 0)
    hits = f.hits(name)
    assert np.isclose(hits[[3, 66]], len(name)).all() and hits.sum() == hits[[3, 66]].sum()
    full = langid.Filters(["a"], np.ones((1 << langid.SLOT_BITS, 1), np.uint64), 0)
    assert full.hits(name)[0] == 0


def test_quality_of_held_out_documents(tables):
    docs, labels, _, good = tables
    got = quality.classify(docs, labels).collect()
    assert len(got) == docs.count() and all(r.held_out == held(r.doc_id, 5, 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    tried = [r for r in got if r.held_out and r.doc_id in good and r.doc_id != 5]
    assert np.mean([r.predicted == good[r.doc_id] for r in tried]) >= 0.95


def test_machine_matches_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    m = quality.Machine(0.1, rng.normal(size=quality.SIZE), rng.normal(size=(quality.SIZE, quality.RANK)) * 0.1, np.zeros(quality.STATS), np.ones(quality.STATS))
    place, value = quality.Words().features("some words and Some MORE words 12 !!", 9)
    x = m.standard(value)
    z = m.bias + m.w[place] @ x + sum(m.v[place[i]] @ m.v[place[j]] * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert np.isclose(m.score(place, value), 1 / (1 + np.exp(-z)))


def test_every_score_is_the_sum_over_pairs(tables):
    """The query's scores against the machine's definition, pair by pair, on words counted here."""
    from collections import Counter

    docs, labels, _, _ = tables
    m = quality.train(docs, labels)
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append((r.text or "", r.n_chars))
    got = quality.classify(docs, labels).collect()
    for r in got[:40] + [x for x in got if x.doc_id is None or x.doc_id >= 9000]:
        def plain(text, n):
            w = text.split()
            counts = Counter(w)
            x = np.zeros(quality.SIZE)
            for word, c in counts.items():
                x[zlib.crc32(word.encode()) >> 18] += (c / max(1, len(w))) ** 0.5
            stats = np.array(quality.statistics(text, w, counts, n))
            x[-quality.STATS :] = np.clip((stats - m.mean) / m.sd, -4, 4) / 4
            some = np.flatnonzero(x)
            # a word's own square is left out, also where two words share a place
            own = Counter()
            for word, c in counts.items():
                own[zlib.crc32(word.encode()) >> 18] += c / max(1, len(w))
            for k in range(quality.SIZE - quality.STATS, quality.SIZE):
                own[k] = x[k] ** 2
            z = m.bias + m.w @ x
            for i in some:
                z += sum(float(m.v[i] @ m.v[j]) * x[i] * x[j] for j in some if j < i)
                z += 0.5 * float(m.v[i] @ m.v[i]) * (x[i] ** 2 - own[i])
            return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

        if len(texts[r.doc_id][0][0]) < 3000:
            assert any(np.isclose(r.score, plain(*t), atol=1e-6) for t in texts[r.doc_id])


def test_languages_against_plain_counts(tables):
    """Filters against sets of n-grams kept whole: only false positives of the filters and names that meet differ."""
    from collections import Counter

    docs = tables[0]

    def grams(text):
        t = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        out = [t[i : i + n] for n in (2, 3, 4) for i in range(len(t) - n + 1)]
        return [g for g in out if " " not in g[1:-1] and not (g[0] == " " and g[-1] == " ")]

    counts, totals = {}, {}
    rows = docs.collect()
    for r in rows:
        if r.text is not None and r.lang is not None and not held(r.doc_id, 3, 1):
            counts.setdefault(r.lang, Counter()).update(grams(r.text))
    totals = {x: sum(c.values()) for x, c in counts.items()}
    every = {g for c in counts.values() for g in c}
    most = {g: max(c[g] / totals[x] for x, c in counts.items()) for g in every}
    known = {x: {g for g, n in c.items() if n >= langid.MIN_COUNT and n / totals[x] >= langid.SHARE * most[g]} for x, c in counts.items()}
    got, agree, n = {(r.doc_id, r.lang_pred): r for r in langid.detect(docs).collect()}, 0, 0
    for r in rows:
        g = grams(r.text)
        hits = {x: sum(y in k for y in g) for x, k in known.items()}
        if g and max(hits.values()) > 0:
            n += 1
            best = max(sorted(hits), key=hits.get)
            if (found := got.get((r.doc_id, best))) is not None:
                agree += abs(found.score - hits[best] / sum(hits.values())) < 0.1
    assert n > 200 and agree >= 0.97 * n


def test_stages_keep_rows_as_they_are(tables):
    docs, labels, rows, good = tables
    kept = quality.accepted(docs, quality.train(docs, labels))
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert np.mean([(d in ids) == bool(good[d]) for d, *_ in rows]) > 0.95
    left = langid.accepted(docs, langid.learn(docs))
    ids = {r.doc_id for r in left.collect()}
    assert left.schema == docs.schema and not ids & {9000, 9001, 9002, 9003} and all(d in ids for d, *_ in rows)


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert langid.detect(none).count() == 0 and quality.classify(none, labels).count() == 0
    one = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert langid.detect(one).first().lang_pred == "und" and 0 <= quality.classify(one, labels).first().score <= 1
