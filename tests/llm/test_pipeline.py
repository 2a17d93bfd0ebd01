"""The pipeline stage by stage, and that every registered query gives its contract's columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from sunledger.llm.queries import QUERIES
from tests.oracle import SF_ROOT

SF = f"{SF_ROOT}/sf0.001"
COLUMNS = {
    "op1_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_language": "doc_id held_out lang_pred score",
    "op4_licenses": "doc_id n_sentences n_known licenses left_over",
    "op5_near_vectors": "vec_id n_links component_id kept",
    "op6_minhash": "doc_id class_id kept",
    "op7_quality": "doc_id held_out score predicted",
    "op8_top_k": "query_id rank vec_id score",
    "op9_bpe": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op10_token_ids": "doc_id start n_tokens ids_crc32",
    "op11_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op12_vector_codes": "vec_id code error label_error codebooks_sha256",
    "op13_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
}


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_columns(spark, name):
    df = queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(COLUMNS[name].split()) and df.count() > 0


def test_all_are_registered():
    assert set(QUERIES) == set(COLUMNS) and queries()["pipeline"] is corpus_pipeline.run


def test_stages_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
        out = out.cache()
        sizes.append(out.count())
        docs = out
    assert sizes[1] == sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[4] == sizes[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == sizes[4]


def test_stages_on_odd_and_empty_rows(spark, nasty, empty):
    for docs in (nasty.drop("id", "order"), empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns
            n = out.count()
            assert n <= docs.count()
        assert corpus_pipeline.packed(spark, docs, SF).count() >= docs.count()


def test_repeated_rows_leave_one(spark, nasty):
    left = [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, nasty, SF).select("doc_id").collect()]
    assert left.count(4) + left.count(5) == 1 and left.count(10) == 1 and left.count(6) + left.count(7) == 1
    assert left.count(0) == 1 and left.count(1) == 1 and left.count(2) == 1


def test_near_duplicates_do_not_depend_on_the_splits_of_a_job(spark, tmp_path):
    texts = [" ".join(f"w{i // 2 if i < 6 else i}x{j}" for j in range(40)) for i in range(10)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(8, "doc_id").write.parquet(f"{tmp_path}/docs")
    docs, key = spark.read.parquet(f"{tmp_path}/docs"), "spark.sql.files.minPartitionNum"
    try:
        spark.conf.set(key, "1")
        left = corpus_pipeline.near_duplicates(spark, docs, SF)
        spark.conf.set(key, "64")
        ids = [r["doc_id"] for r in left.collect()]
    finally:
        spark.conf.unset(key)
    assert len(ids) == 7 and {texts[i] for i in ids} == set(texts)


def test_cut_texts_stay_text(spark):
    body = "é" * 600
    docs = spark.createDataFrame([(1, "x" + body), (2, "y" + body), (3, None)], "doc_id int, text string").coalesce(1)
    rows = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    assert rows == {1: "x", 2: "y", 3: None}
    # These two characters end in the same byte, so the cut goes through them.
    tail = "".join(f"{i}," for i in range(300))
    docs = spark.createDataFrame([(1, "a\ufffdé" + tail), (2, "b©" + tail)], "doc_id int, text string").coalesce(1)
    rows = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    assert rows == {1: "a\ufffd", 2: "b"}


CLASHES = ("__row", "__rid", "__RID", "__spans", "__bytes", "__n_bytes", "__n_removed", "__text", "__language", "__score", "__quality")


@pytest.mark.parametrize("name", CLASHES)
def test_extra_columns_keep_their_values(spark, name):
    body = " ".join(f"shared{i}" for i in range(60))
    rows = [(k, f"{'lorem ipsum und der the of and to ' * 4} own{k} {body}", 7 * k) for k in range(4)]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, `{name}` bigint").withColumn("lang", F.lit("en")).withColumn("source", F.lit("s")).coalesce(1)
    for stage in (corpus_pipeline.near_duplicates, corpus_pipeline.repeated_passages):
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert all(r[name] == 7 * r["doc_id"] for r in out.collect())
    assert corpus_pipeline.language(spark, docs, SF).columns == docs.columns


def test_passages_of_51_words_are_caught(spark):
    passage = " ".join(f"pa{i}s" for i in range(51))
    assert 250 < len(passage) <= 310
    texts = [" ".join(f"d{k}w{i}" for i in range(80)) for k in range(3)]
    rows = [(k, f"{t} {passage} {t[::-1]}") for k, t in enumerate(texts)] + [(3, texts[0][:150]), (4, passage)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    left = {r["doc_id"]: r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, SF).collect()}
    assert all("pa20s" not in (left[k] or "") for k in (0, 1, 2, 4)) and left[3] == texts[0][:150]
    assert all(left[k].startswith(texts[k][:400]) for k in (0, 1, 2))
