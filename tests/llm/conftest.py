import random

import pytest

KINDS = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, vocabulary=400):
    known = random.Random(9)
    names = ["".join(known.choice("abcdeorstn") for _ in range(2 + k % 6)) for k in range(vocabulary)]
    return " ".join(rng.choice(names) for _ in range(n))


def texts(seed=1):
    """Texts with exact and near copies, shared passages, repeats, odd white space and other scripts."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(5, 180)) for _ in range(25)]
    passage = words(rng, 70)
    out = list(base)
    out += [base[0], base[0], base[1] + " end", " ".join(base[2].split()[1:]), base[3].replace(" ", "  ")]
    out += [words(rng, 30) + " " + passage + " " + words(rng, 20), passage, passage + "\n" + words(rng, 5), words(rng, 9) + "\t" + passage]
    out += [words(rng, 60) * 2, "naïve 中文字   x y café " * 30, "a" * 900, "a b " * 300, "", "   \n\t", "x", "one two three", "don't 'S it's 12345 !!!"]
    out += [words(rng, 3000) + " " + passage]
    return out


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text) with a null text, a null id and a repeated row."""
    found = [(3 * k + 1, t) for k, t in enumerate(texts())]
    return [*found, (1000, None), (None, "one two three four five six"), found[0]]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows as a table with more columns, of names that operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], KINDS).repartition(3, "doc_id")
    return df.withColumns({c: F.lit("clash") for c in ("row", "doc", "node", "root", "a", "s", "block", "part", "score", "held_out", "class_id", "spans", "length")})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], KINDS)
