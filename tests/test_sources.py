import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sunledger.functions.columns import MODELS
from sunledger.sources import documents, tables
from tests.helpers import frame, rows


def test_reads_stored_monthly_table_with_bom_and_empty_cells(spark, tmp_path):
    head = "month,half,actual_kWh," + ",".join(f"{m}_kWh" for m in MODELS)
    for site, actual in (("north", 100.5), ("south", 7.0)):
        (tmp_path / f"forecasts_{site}.csv").write_text(f"{head}\n2025-06-01,상반기,{actual},1.0,,3.0,0.0,0.0,6.0,7.0\n", encoding="utf-8-sig")
    df = tables.read_oof(spark, f"{tmp_path}/forecasts_*.csv", tables.oof_schema(), r"forecasts_(\w+)\.csv")
    got = df.orderBy("site").collect()
    assert [(r["site"], r["month"], r["actual_kWh"], r["전년동월_kWh"], r["선형회귀_kWh"]) for r in got] == [
        ("north", dt.date(2025, 6, 1), 100.5, None, 0.0), ("south", dt.date(2025, 6, 1), 7.0, None, 0.0)
    ]


def test_metric_file_starts_with_bom_and_keeps_order(spark, tmp_path):
    df = frame(spark, "comparison string, model string, n bigint, mae double", ("b", "x", 2, 0.5), ("a", "y", 1, 1.5))
    tables.write_metrics(df, f"{tmp_path}/m", ["comparison"], single_file=True)
    [part] = list((tmp_path / "m").glob("part-*.csv"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfcomparison,model,n,mae\n")
    assert part.read_text(encoding="utf-8-sig").splitlines()[1:] == ["a,y,1,1.5", "b,x,2,0.5"]


def test_manifest_with_dynamic_keys(spark, tmp_path):
    s = lambda n, w: {"n": n, "WAPE_pct": w, "MAE_kWh": 1.5, "RMSE_kWh": 2.5}
    pair = {"Ridge": {"n": 14, "GBHuber": s(14, 11.0), "Ridge": s(14, 17.0)}}
    doc = {
        "region": "r", "walk_forward_n": 14,
        "overall_단독표본": {"Ridge": s(14, 17.0), "GBHuber": s(14, 11.0)},
        "by_half_단독표본": {"상반기": {"Ridge": s(7, 23.0)}},
        "paired_vs_GBHuber_동일표본": pair,
        "paired_by_half_vs_GBHuber_동일표본": {"상반기": pair},
        "baselines_used_for_verdict": ["Ridge"],
    }
    (tmp_path / "m.json").write_text(json.dumps(doc, ensure_ascii=False, indent=1), encoding="utf-8")
    df = documents.read_manifest(spark, f"{tmp_path}/m.json", "GBHuber")
    assert df.groupBy("section").count().orderBy("section").collect() == [("own", 2), ("own_by_half", 1), ("paired", 2), ("paired_by_half", 2)]
    assert rows(df.where("section = 'paired' AND model = 'Ridge'")) == [("r", "paired", None, "Ridge", "Ridge", 14, 1.5, 2.5, 17.0)]


def test_document_order_is_fixed(spark):
    df = frame(
        spark, "site string, half string, model string, ordinal int, n bigint, mae double, rmse double, wape double",
        ("s", "b", "m2", 2, 1, 1.0, 1.0, 1.0), ("s", "a", "m1", 1, 1, 1.0, 1.0, 1.0), ("s", "b", "m1", 1, 1, 1.0, 1.0, 1.0),
    )
    doc = documents.metrics_document(df, "site", "half", ["b", "a"], "ordinal").collect()[0]["document"]
    parsed = json.loads(doc)
    assert list(parsed) == ["b", "a"] and list(parsed["b"]) == ["m1", "m2"]
    assert list(parsed["a"]["m1"]) == ["n", "MAE_kWh", "RMSE_kWh", "WAPE_pct"]


def test_provenance_flags_changed_and_absent_files(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"one")
    (tmp_path / "b.png").write_bytes(b"two")
    files = documents.file_hashes(spark, str(tmp_path))
    good = files.where("file = 'a.png'").collect()[0]["actual"]
    listed = frame(spark, "file string, sha256 string", ("a.png", good), ("b.png", good), ("c.png", good))
    out = documents.verify_provenance(files, listed)
    assert [(r["file"], r["ok"]) for r in out.orderBy("file").collect()] == [("a.png", True), ("b.png", False), ("c.png", False)]
    (tmp_path / "d.png").write_bytes(b"three")
    (tmp_path / "list.json").write_text(json.dumps([{"file": f, "source": "s", "sha256": good} for f in ("a.png", "b.png", "c.png")], indent=1))
    files = documents.file_hashes(spark, f"{tmp_path}/*.png")
    out = documents.verify_provenance(files, documents.read_provenance(spark, f"{tmp_path}/list.json"))
    assert [(r["file"], r["state"]) for r in out.orderBy("file").collect()] == [("a.png", "ok"), ("b.png", "changed"), ("c.png", "missing"), ("d.png", "unlisted")]


def test_schema_audit_names_missing_other_and_unexpected_columns(spark):
    actual = documents.schema_rows(spark, {"t": frame(spark, "a bigint, b string, c date", (1, "x", None))})
    expected = frame(spark, "table string, column string, expected_type string", ("t", "a", "bigint"), ("t", "b", "date"), ("t", "gone", "int"))
    out = documents.audit_schema(actual, expected)
    assert {r["column"]: r["state"] for r in out.collect()} == {"a": "ok", "b": "other_type", "c": "unexpected", "gone": "missing"}


def test_hash_tree_finds_the_bucket_that_differs(spark):
    base = spark.range(200).select("id", (F.col("id") % 4).alias("p"), F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("v"))
    leaves = lambda df: documents.content_leaves(df, F.col("p"), F.col("id"), 8)
    differing = lambda df: {(r["level"], r["part"], r["bucket"], r["state"]) for r in documents.compare_trees(leaves(df), leaves(base)).collect() if r["state"] != "ok"}
    assert differing(base.orderBy(F.desc("id"))) == set()
    one = base.withColumn("v", F.when(F.col("id") == 11, None).otherwise(F.col("v")))
    assert differing(one) == {("table", None, None, "changed"), ("part", "3", None, "changed"), ("bucket", "3", 3, "changed")}
    twice = base.union(base.where("id = 11")).union(base.where("id = 11"))  # cancels in the XOR
    assert ("bucket", "3", 3, "changed") in differing(twice)
    gone = differing(base.where("p <> 2"))
    assert ("part", "2", None, "missing") in gone and ("table", None, None, "changed") in gone
    null_part = base.union(base.where("id = 1").withColumn("p", F.lit(None).cast("bigint")))
    assert ("bucket", None, 1, "added") in differing(null_part) and ("part", None, None, "added") in differing(null_part)
    swapped = frame(spark, "id bigint, p bigint, v double", (None, 1, 2.0))
    assert leaves(swapped).exceptAll(leaves(frame(spark, "id bigint, p bigint, v double", (None, 1, None)))).count() == 1
    assert [(r["level"], r["n_differing"]) for r in documents.compare_trees(leaves(base.limit(0)), leaves(base.limit(0))).collect()] in ([], [("table", 0)])


def test_content_hash_ignores_order_but_not_values(spark):
    a = frame(spark, "x bigint, y string", (1, "a"), (2, None), (2, None))
    h = lambda df: tuple(documents.audit_content(df, ["x", "y"]).collect()[0])
    assert h(a) == h(a.orderBy(F.desc("x"))) and h(a) != h(a.distinct())
    assert h(a) != h(a.withColumn("y", F.coalesce("y", F.lit("b"))))


def test_audit_result(spark):
    schema = "table string, n_rows bigint, content_hash bigint, content_sum bigint"
    out = documents.audit_result(frame(spark, schema, ("t", 1, 2, 3), ("u", 1, 2, 3)), frame(spark, schema, ("t", 1, 2, 3), ("u", 1, 2, 4), ("v", 0, 0, 0)))
    assert [(r["table"], r["ok"]) for r in out.orderBy("table").collect()] == [("t", True), ("u", False), ("v", False)]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "v double")
    assert [r[0] for r in tables.nan_to_null(df).collect()] == [None, 1.0]


def test_markdown(spark):
    df = frame(spark, "site string, o int, m string, v double", ("s", 2, "b", None), ("s", 1, "a", 1.5))
    md = tables.markdown_tables(df, ["site"], {"model": F.col("m"), "MAE": F.col("v")}, ["o"]).collect()[0]["markdown"]
    assert md == "| model | MAE |\n|---|---|\n| a | 1.5 |\n| b |  |"


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_landing(spark, tmp_path, fmt):
    df = frame(spark, "id bigint, ts timestamp_ntz, raw string", (1, dt.datetime(2024, 5, 1, 0, 0, 0, 123456), "COMM"))
    tables.write_landing(df, f"{tmp_path}/x") if fmt == "csv" else df.write.parquet(f"{tmp_path}/x")
    assert tables.read_landing(spark, f"{tmp_path}/x", df.schema, fmt).collect() == df.collect()
