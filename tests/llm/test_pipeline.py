"""The pipeline's stages against plain versions of them, on the rows that each one gets."""

from collections import defaultdict

from tests.llm.conftest import KINDS
from tests.llm.test_text_operators import earlier_repeats, near_rows


def test_stages_and_run(spark, rows, tmp_path):
    import corpus_pipeline
    from tidewright.llm.common import words

    clean = [(d, t) for d, t in rows if d is not None and t and len(words(t)) > 20][:-1]
    data = [(d, t, "en", "s", len(t)) for d, t in clean] + [(5000 + k, " ".join(w.upper() + "!!" for w in t.split()), "en", "s", len(t)) for k, (d, t) in enumerate(clean)]
    labels = [(d, int(d < 5000), 0) for d, *_ in data]
    spark.createDataFrame(data, KINDS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "n-gram Jaccard join", "substring dedup", "best-fit packing"]
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/stage{k}")
        docs = spark.read.parquet(f"{tmp_path}/stage{k}")
        seen.append([(r.doc_id, r.text) for r in docs.collect()] if k < 4 else docs.collect())
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    good, spoken, single, cleaned, sequences = seen
    assert {d for d, _ in good} <= {d for d, *_ in data} and sum(d < 5000 for d, _ in good) > 0.9 * len(clean) > sum(d >= 5000 for d, _ in good)
    assert set(spoken) <= set(good) and len(spoken) >= 0.9 * len(good)
    assert sorted(d for d, _ in single) == sorted({c for c, _ in near_rows(spoken)})
    kept = earlier_repeats(single, 50)
    assert sorted(cleaned) == sorted((d, kept(d, t)[3] if kept(d, t)[1] else t) for d, t in single)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in sequences)
    filled = defaultdict(int)
    for r in sequences:
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048 and {r.doc_id for r in sequences} == {d for d, _ in single}


def test_stages_take_any_rows(spark, rows, tmp_path):
    """Null ids, texts and labels, empty and very short texts, repeated rows: every stage gives a subset of its
    rows (or changed texts), and the last packs each that is left."""
    import corpus_pipeline

    data = [(d, t, None if k % 5 == 0 else "en", None, None) for k, (d, t) in enumerate(rows)] * 2 + [(None, None, None, None, None), (None, "", "en", "s", -1)]
    labels = [(d, None if k % 4 == 0 else int(k % 3 > 0), 0) for k, (d, _) in enumerate(rows)] + [(None, 1, 0)]
    spark.createDataFrame(data, KINDS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = before = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, before, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/any{k}")
        docs = spark.read.parquet(f"{tmp_path}/any{k}")
        if k < 3:
            assert docs.exceptAll(before).isEmpty()
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and (k != 3 or docs.count() == before.count())
            before = docs
    assert sorted(str(r.doc_id) for r in docs.where("piece = 0").collect()) == sorted(str(r.doc_id) for r in before.collect())


def test_stages_take_empty_tables(spark, none, tmp_path):
    import corpus_pipeline

    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
