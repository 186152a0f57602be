"""The pipeline's stages against brute force on small documents."""

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.test_jaccard import brute
from tests.llm.test_shards_mixing_packing import sequences
from tests.llm.test_substrings_lines import brute_lines, sha


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    marked = [(r[0], f"{r[1]} vilemo" if k % 9 == 5 and r[1] else r[1], *r[2:]) for k, r in enumerate(rows)]
    spark.createDataFrame(marked, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int((r[1] or "").endswith("vilemo"))) for r in marked], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), marked


def test_stages(spark, folder):
    d, marked = folder
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{d}/documents.parquet")
    clean = stages["toxicity"](spark, docs, d)
    assert clean.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(left) == {r[0] for r in marked if not (r[1] or "").endswith("vilemo")}
    deduped = stages["line_dedup"](spark, clean, d)
    want = brute_lines([(k, v) for k, v in left.items()])
    texts = {r["doc_id"]: r["text"] for r in deduped.collect()}
    assert {k: sha(v) for k, v in texts.items()} == {k: v[2] for k, v in want.items()} and deduped.columns == docs.columns
    unique = stages["near_duplicates"](spark, deduped, d)
    assert {r["doc_id"] for r in unique.collect()} == {k for k, (_, c) in brute(list(texts.items())).items() if k == c}
    mixed = stages["mixing"](spark, unique, d)
    assert mixed.columns == docs.columns
    words = lambda df: sum(len((r["text"] or "").split()) for r in df.collect())
    assert words(mixed) == pytest.approx(words(unique), rel=0.05)
    packed = stages["packing"](spark, mixed, d).collect()
    used = sequences(packed, 1024)
    assert used <= np.ceil(sum(r["length"] for r in packed) / 1024) * 1.05 + 1
    assert corpus_pipeline.run(spark, d).count() == len(packed)


def test_equal_rows_have_their_own_copies(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (None, "c d", "x"), (None, "e f", "x"), (None, "g h", "x")], "doc_id long, text string, source string")
    copies = spark.createDataFrame([(1, "x", 2, 1), (1, "x", 2, 0), (None, "x", 2, 1), (None, "x", 2, 1), (None, "x", 2, 0)], "doc_id long, source string, size long, copies int")
    monkeypatch.setattr(corpus_pipeline.mixing, "mix_sources", lambda docs: copies)
    got = [tuple(r) for r in corpus_pipeline.mix(spark, docs, "").collect()]
    assert [r for r in got if r[0] == 1] == [(1, "a b", "x")] and len({r[1] for r in got}) == len(got) == 3


def odd_folder(spark, rows, path):
    """Repeated rows, rows without id, and extra columns with names that stages use."""
    from pyspark.sql import functions as F

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    odd = spark.createDataFrame([*rows, *rows[:6], (None, "no id here at all", "en", "a", 17), (None, "no id here at all", "en", "a", 17), (None, "nor here is one", "en", "a", 15)][:] if rows else [], schema)
    for c in ("n_lines", "tox_score", "_size", "_tox_score", "copies", "rank", "_own_tag", "component_id"):
        odd = odd.withColumn(c, F.lit("x"))
    odd.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, r[0] % 2) for r in rows[:0]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return spark.read.parquet(f"{path}/documents.parquet")


def test_odd_rows_pass_all_stages(spark, rows, tmp_path):
    docs = odd_folder(spark, rows, str(tmp_path))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stage_table(stage(spark, before, str(tmp_path)), f"odd-{name}")
        assert after.columns == docs.columns and after.schema.simpleString() == docs.schema.simpleString(), name
        ids = {r["doc_id"] for r in after.collect()}
        assert None in ids, name  # rows without id stay
        assert {r["tox_score"] for r in after.collect()} == {"x"}
        if name in ("toxicity", "line_dedup"):
            assert after.count() == docs.count()
        before = after
    packed = corpus_pipeline.pack(spark, before, str(tmp_path))
    assert packed.where("piece = 0").count() == before.count()


def test_an_empty_table_passes_all_stages(spark, tmp_path):
    odd_folder(spark, [], str(tmp_path))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
