"""Queries that write result files from the tables and read them back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunledger.functions import columns as C
from sunledger.operators import metrics
from sunledger.plans.common import SCORE_SQL, scores
from sunledger.plans.registry import query
from sunledger.plans.score_queries import flagship, long, pairs
from sunledger.plans.views import OOF_BASELINES, OOF_MODELS, Tables
from sunledger.session import materialize, shared_dir, small_table
from sunledger.sources import documents, tables

SLICES = [C.WHOLE, C.FIRST_HALF, C.SECOND_HALF]


@query(
    "oof_files",
    "S1 U1",
    "SELECT site, month, half, actual_kwh, persistence, last_year, seasonal_mean, candidate FROM oof",
)
def _(t: Tables):
    path = shared_dir(t.spark, "oof")
    named = t.oof.select(
        "site", "month", "half", F.col("actual_kwh").alias("actual_kWh"), *[F.col(m).alias(f"{m}_kWh") for m in OOF_MODELS]
    )
    tables.write_oof(named, path)
    back = tables.read_oof(t.spark, f"{path}/*/*.csv", tables.oof_schema(OOF_MODELS), "site=([^/]+)/")
    return back.select(
        "site", "month", "half", F.col("actual_kWh").alias("actual_kwh"), *[F.col(f"{m}_kWh").alias(m) for m in OOF_MODELS]
    )


@query("metrics_file", "S2", f"SELECT comparison, model, site, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3")
def _(t: Tables):
    path = shared_dir(t.spark, "metrics")
    rows = scores(metrics.paired_metrics(pairs(t), ["site"])).select("comparison", "model", "site", "n", "mae", "rmse", "wape")
    tables.write_metrics(rows, path, ["site", "comparison", "model"])
    return t.spark.read.csv(path, header=True, schema=rows.schema)


def sliced(t: Tables) -> DataFrame:
    return scores(metrics.metrics_by_slice(long(t), ["site", "model", "ordinal"], "half", C.WHOLE))


SLICED_SQL = f"""SELECT site, half, model, {SCORE_SQL} FROM oof_long GROUP BY site, half, model
  UNION ALL SELECT site, '전체' AS half, model, {SCORE_SQL} FROM oof_long GROUP BY site, model"""


@query("metrics_document", "S3", SLICED_SQL)
def _(t: Tables):
    docs = documents.metrics_document(sliced(t), "site", "half", SLICES, "ordinal")
    return documents.flatten_document(docs, "site", "half")


@query(
    "manifest_rows",
    "S4",
    f"""WITH d AS (SELECT site, half, model, {SCORE_SQL} FROM oof_long GROUP BY 1, 2, 3 UNION ALL SELECT site, NULL, model, {SCORE_SQL} FROM oof_long GROUP BY 1, 2, 3),
        p AS (SELECT site, half, comparison, model, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3, 4 UNION ALL SELECT site, NULL, comparison, model, {SCORE_SQL} FROM oof_pairs GROUP BY 1, 2, 3, 4)
        SELECT site, CASE WHEN half IS NULL THEN 'own' ELSE 'own_by_half' END AS section, half, NULL AS baseline, model, n, mae, rmse, wape FROM d
        UNION ALL SELECT site, CASE WHEN half IS NULL THEN 'paired' ELSE 'paired_by_half' END, half, comparison, model, n, mae, rmse, wape FROM p""",
)
def _(t: Tables):
    paired = scores(flagship(t))
    duels = metrics.duel(paired, ["site", "half"], "candidate")
    verdicts = metrics.verdict(duels, ["site"], "half", C.WHOLE, OOF_BASELINES, [C.FIRST_HALF, C.SECOND_HALF])
    docs = documents.manifest_document(sliced(t), paired, verdicts, "site", C.WHOLE, "candidate")
    path = shared_dir(t.spark, "manifests")
    # One document per file line; a stored manifest with line breaks is read with multi_line.
    docs.select("document").write.text(path)
    return documents.read_manifest(t.spark, path, "candidate", multi_line=False)


@query(
    "landing_csv",
    "S5",
    """SELECT event_id, unit, ts, TRY_CAST(raw AS DOUBLE) AS value, CASE WHEN raw IS NULL THEN 'source_null' WHEN TRY_CAST(raw AS DOUBLE) IS NULL THEN 'comm_error' ELSE 'ok' END
       AS parse_status FROM readings_raw""",
)
def _(t: Tables):
    path = shared_dir(t.spark, "landing")
    rows = t.readings_raw.select("event_id", "unit", "ts", "raw")
    tables.write_landing(rows, path)
    back = tables.read_landing(t.spark, path, rows.schema, "csv")
    return back.select("event_id", "unit", "ts", C.parsed_value("raw").alias("value"), C.parse_status("raw").alias("parse_status"))


@query(
    "markdown_report",
    "S6",
    f"""WITH s AS (SELECT site, model, ordinal, {SCORE_SQL} FROM oof_long GROUP BY 1, 2, 3)
        SELECT site, '| model | n | MAE |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || model || ' | ' || n || ' | ' ||
          coalesce(format('{{:,}}', CAST(round(mae) AS BIGINT)), '') || ' |', chr(10) ORDER BY ordinal) AS markdown FROM s GROUP BY site""",
)
def _(t: Tables):
    s = scores(metrics.metrics(long(t), "pred", by=["site", "model", "ordinal"]))
    cols = {"model": F.col("model"), "n": F.col("n"), "MAE": F.format_number(F.round("mae", 0), 0)}
    return tables.markdown_tables(s, ["site"], cols, ["ordinal"])


@query(
    "provenance_check",
    "S7",
    """WITH r AS (SELECT 'report_' || y AS file, y || ' ' || count(*) || ' ' || CAST(sum(q) AS BIGINT) AS body, row_number() OVER (ORDER BY y) AS i
         FROM (SELECT year(l_shipdate) AS y, CAST(l_quantity AS BIGINT) AS q FROM lineitem) GROUP BY y),
       e AS (SELECT file, sha256(body || chr(10)) AS expected FROM r WHERE i <> 3),
       a AS (SELECT file, sha256(CASE WHEN i = 2 THEN body || ' again' ELSE body END || chr(10)) AS actual FROM r WHERE i <> 1)
       SELECT file, expected, actual, CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'unlisted' WHEN expected = actual THEN 'ok' ELSE 'changed' END AS state,
         coalesce(expected = actual, false) AS ok FROM e FULL JOIN a USING (file)""",
)
def _(t: Tables):
    # A report per year, and the list that was stored with the reports. Since then the first was lost, the second was
    # written again, and the third never was listed.
    sums = t.table("lineitem").groupBy(F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    reports = sums.select(
        F.concat(F.lit("report_"), "y").alias("file"),
        F.concat_ws(" ", "y", "n", "q").alias("body"),
        F.row_number().over(Window.orderBy("y")).alias("i"),  # a row per year
    )
    reports = materialize(reports, "reports")
    listed, found = shared_dir(t.spark, "provenance"), shared_dir(t.spark, "report-files")
    entry = F.struct("file", F.lit("lineitem").alias("source"), F.sha2(F.concat("body", F.lit("\n")), 256).alias("sha256"))
    reports.where("i <> 3").agg(F.to_json(F.array_sort(F.collect_list(entry)))).write.text(listed)
    body = F.when(F.col("i") == 2, F.concat("body", F.lit(" again"))).otherwise(F.col("body"))
    reports.where("i <> 1").select("file", body.alias("value")).repartition("file").write.partitionBy("file").text(found)
    files = documents.file_hashes(t.spark, found, r"file=([^/]+)/")
    return documents.verify_provenance(files, documents.read_provenance(t.spark, listed)).select("file", "expected", "actual", "state", "ok")


AUDITED = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
    "events": ["event_id", "user_id", "event_type", "props"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"],
}


def _audit_sql() -> str:
    parts = []
    for name, cols in AUDITED.items():
        text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in cols) + ")"
        parts.append(
            f"""SELECT '{name}' AS "table", CAST(count(*) AS BIGINT) AS n_rows, bit_xor(h) AS content_hash, CAST(sum(h % 1000003) AS BIGINT) AS content_sum
            FROM (SELECT ('0x' || substr(md5({text}), 1, 15))::BIGINT AS h FROM {name})"""
        )
    return " UNION ALL ".join(parts)


@query("table_audit", "S8", _audit_sql())
def _(t: Tables):
    parts = [documents.audit_content(t.table(n), cols).withColumn("table", F.lit(n)) for n, cols in AUDITED.items()]
    return reduce(DataFrame.unionByName, parts).select("table", "n_rows", "content_hash", "content_sum")


# Columns of an earlier delivery of three tables, before names, types and columns were changed.
EARLIER_SCHEMA = [
    *[("supplier", c, ty) for c, ty in [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "bigint"), ("s_phone_no", "string")]],
    *[("nation", c, ty) for c, ty in [("n_nationkey", "bigint"), ("n_name", "string"), ("n_regionkey", "string")]],
    *[("events", c, ty) for c, ty in [("event_id", "bigint"), ("ts", "date"), ("user_id", "bigint"), ("event_type", "string"), ("session", "string")]],
]
SCHEMA_TABLES = ["supplier", "nation", "events"]


def _schema_sql() -> str:
    stored = ", ".join(str(row) for row in EARLIER_SCHEMA)
    found = " UNION ALL ".join(f"SELECT '{n}' AS t, column_name AS c, column_type AS ty FROM (DESCRIBE {n})" for n in SCHEMA_TABLES)
    names = "CASE ty WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(ty) END"
    counts = " UNION ALL ".join(f"SELECT '{n}' AS t, CAST(count(*) AS BIGINT) AS n_rows FROM {n}" for n in SCHEMA_TABLES)
    return f"""WITH e AS (SELECT * FROM (VALUES {stored}) AS v(t, c, expected_type)), a AS (SELECT t, c, {names} AS actual_type FROM ({found})), n AS ({counts})
      SELECT t AS "table", c AS "column", expected_type, actual_type, CASE WHEN actual_type IS NULL THEN 'missing' WHEN expected_type IS NULL THEN 'unexpected'
        WHEN expected_type = actual_type THEN 'ok' ELSE 'other_type' END AS state, n_rows FROM e FULL JOIN a USING (t, c) JOIN n USING (t)"""


@query("schema_audit", "S8", _schema_sql())
def _(t: Tables):
    stored = materialize(small_table(t.spark, EARLIER_SCHEMA, "table string, column string, expected_type string"), "stored-schema")
    actual = documents.schema_rows(t.spark, {n: t.table(n) for n in SCHEMA_TABLES})
    counts = reduce(
        DataFrame.unionByName, [t.table(n).agg(F.count("*").alias("n_rows")).withColumn("table", F.lit(n)) for n in SCHEMA_TABLES]
    )
    out = documents.audit_schema(actual, stored).join(counts, "table")
    return out.select("table", "column", "expected_type", "actual_type", "state", "n_rows")


TREE_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_cents", "o_day", "o_orderpriority"]
EARLIER = """SELECT o_orderkey, o_custkey, o_orderstatus, o_cents + CASE WHEN o_orderkey % 1000 = 7 THEN 1 ELSE 0 END AS o_cents, o_day, o_orderpriority, y FROM now WHERE y <> 1995
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_cents, o_day, o_orderpriority, 1990 AS y FROM now WHERE y = 1996 AND o_orderkey % 10 = 3"""


def _leaf_sql(of: str) -> str:
    text = "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '\\N')" for c in TREE_TEXT) + ")"
    return f"""SELECT CAST(y AS VARCHAR) AS part, CAST(o_orderkey % 16 AS INTEGER) AS bucket, count(*) AS n, bit_xor(h) AS x, sum(h % 1000003) AS s
      FROM (SELECT *, ('0x' || substr(md5({text}), 1, 15))::BIGINT AS h FROM {of}) GROUP BY 1, 2"""


@query(
    "content_tree",
    "S8",
    f"""WITH now AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(round(o_totalprice * 100) AS BIGINT) AS o_cents, strftime(o_orderdate, '%Y-%m-%d') AS o_day, o_orderpriority, year(o_orderdate) AS y FROM orders),
      earlier AS ({EARLIER}), f AS ({_leaf_sql("now")}), e AS ({_leaf_sql("earlier")}),
      l AS (SELECT coalesce(f.part, e.part) AS part, coalesce(f.bucket, e.bucket) AS bucket, e.n AS en, f.n AS fn,
        CASE WHEN f.n IS NULL THEN 'missing' WHEN e.n IS NULL THEN 'added' WHEN f.n = e.n AND f.x = e.x AND f.s = e.s THEN 'ok' ELSE 'changed' END AS st
        FROM e FULL JOIN f ON e.part IS NOT DISTINCT FROM f.part AND e.bucket IS NOT DISTINCT FROM f.bucket),
      r AS (SELECT CASE grouping(part, bucket) WHEN 3 THEN 'table' WHEN 1 THEN 'part' ELSE 'bucket' END AS level, part, bucket,
        CASE WHEN min(st) = max(st) THEN max(st) ELSE 'changed' END AS state, CAST(count(*) FILTER (st <> 'ok') AS BIGINT) AS n_differing,
        CAST(coalesce(sum(en), 0) AS BIGINT) AS n_expected, CAST(coalesce(sum(fn), 0) AS BIGINT) AS n_found FROM l GROUP BY ROLLUP (part, bucket))
      SELECT * FROM r WHERE level <> 'bucket' OR state <> 'ok'""",
)
def _(t: Tables):
    o = t.table("orders")
    now = o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("o_cents"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_day"), "o_orderpriority", F.year("o_orderdate").alias("y"),
    )
    # The stored tree is that of an earlier state: other prices, a year that is gone now, and a year that was not there yet.
    cents = F.col("o_cents") + F.when(F.col("o_orderkey") % 1000 == 7, 1).otherwise(0)
    earlier = now.where("y <> 1995").withColumn("o_cents", cents).unionByName(
        now.where("y = 1996 AND o_orderkey % 10 = 3").withColumn("y", F.lit(1990))
    )

    def leaves(df: DataFrame) -> DataFrame:
        return documents.content_leaves(df, F.col("y"), F.col("o_orderkey"), 16, documents.text_hash(TREE_TEXT))

    return documents.compare_trees(leaves(now), materialize(leaves(earlier), "stored-tree"))
