"""Nested metric documents, evaluation manifests, provenance and table audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.session import small_table

# Field names of the stored metric documents.
SCORE_FIELDS = {"n": "n", "MAE_kWh": "mae", "RMSE_kWh": "rmse", "WAPE_pct": "wape"}
SCORE_TYPE = "struct<n: bigint, MAE_kWh: double, RMSE_kWh: double, WAPE_pct: double>"

# Section names of the stored manifests; ``{}`` takes the candidate's name.
OWN, OWN_HALF = "overall_단독표본", "by_half_단독표본"
PAIRED, PAIRED_HALF = "paired_vs_{}_동일표본", "paired_by_half_vs_{}_동일표본"


def _score_struct():
    return F.struct(*[F.col(c).alias(name) for name, c in SCORE_FIELDS.items()])


def _as_map(df: DataFrame, by: Sequence[str], key: str, order: str, value: str, name: str) -> DataFrame:
    """Fold (key, value) rows to one map per group, in the order of ``order``."""
    rows = F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k"), F.col(value).alias("v")))
    # Maps cannot be compared, so the order is stated on the order column alone.
    ranked = F.array_sort(rows, lambda a, b: F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0))
    entries = F.transform(ranked, lambda e: F.struct(e["k"], e["v"]))
    return df.groupBy(*by).agg(F.map_from_entries(entries).alias(name))


def metrics_document(scores: DataFrame, site: str, slice_col: str, slices: Sequence[str], model_order: str) -> DataFrame:
    """One JSON document per site: slice to model to metrics, in fixed order.

    ``slices`` x models bound the size of a document, whatever the number of sites.
    """
    rows = scores.withColumns(
        {"_v": _score_struct(), "_so": F.array_position(F.array(*[F.lit(s) for s in slices]), F.col(slice_col))}
    )
    models = _as_map(rows, [site, slice_col, "_so"], "model", model_order, "_v", "_m")
    doc = _as_map(models, [site], slice_col, "_so", "_m", "_d")
    return doc.select(site, F.to_json("_d").alias("document"))


def flatten_document(docs: DataFrame, site: str, slice_col: str) -> DataFrame:
    """Document back to flat rows."""
    parsed = docs.select(site, F.from_json("document", f"map<string, map<string, {SCORE_TYPE}>>").alias("d"))
    rows = parsed.select(site, F.explode("d").alias(slice_col, "m")).select(site, slice_col, F.explode("m").alias("model", "s"))
    return rows.select(site, slice_col, "model", *[F.col(f"s.{n}").alias(c) for n, c in SCORE_FIELDS.items()])


def manifest_document(own: DataFrame, paired: DataFrame, verdicts: DataFrame, site: str, whole: str, candidate: str) -> DataFrame:
    """Evaluation manifest per site: own and paired scores, overall and by half, and the verdict flags."""
    own = own.withColumn("_v", _score_struct())
    paired = paired.withColumn("_v", _score_struct())
    o = _as_map(own.where(F.col("half") == whole), [site], "model", "model", "_v", OWN)
    oh = _as_map(_as_map(own.where(F.col("half") != whole), [site, "half"], "model", "model", "_v", "_m"), [site], "half", "half", "_m", OWN_HALF)
    p = _as_map(paired.where(F.col("half") == whole), [site, "comparison"], "model", "model", "_v", "_m")
    p = _as_map(p, [site], "comparison", "comparison", "_m", PAIRED.format(candidate))
    ph = _as_map(paired.where(F.col("half") != whole), [site, "half", "comparison"], "model", "model", "_v", "_m")
    ph = _as_map(ph, [site, "half"], "comparison", "comparison", "_m", "_h")
    ph = _as_map(ph, [site], "half", "half", "_h", PAIRED_HALF.format(candidate))
    rows = o.join(oh, site).join(p, site).join(ph, site).join(verdicts, site)
    body = [F.col(site).alias("region"), *[F.col(f"`{c}`") for c in rows.columns if c != site]]
    return rows.select(site, F.to_json(F.struct(*body)).alias("document"))


def read_manifest(spark: SparkSession, path: str, candidate: str, multi_line: bool = True) -> DataFrame:
    """Read manifests and flatten them to (site, section, half, baseline, model, n, mae, rmse, wape).

    Baseline names are keys of the document, so they are read as maps. Paired sections may carry a plain
    count next to the score objects; it is skipped.
    """
    text, deep = "map<string, string>", "map<string, map<string, string>>"
    p, ph = PAIRED.format(candidate), PAIRED_HALF.format(candidate)
    schema = (
        f"region string, `{OWN}` {text}, `{OWN_HALF}` {deep}, `{p}` {deep}, `{ph}` map<string, {deep}>"
    )
    doc = spark.read.schema(schema).json(path, multiLine=multi_line)
    none = F.lit(None).cast("string")
    own = doc.select("region", F.lit("own").alias("section"), none.alias("half"), none.alias("baseline"), F.explode(OWN).alias("model", "s"))
    half = doc.select("region", F.explode(OWN_HALF).alias("half", "m")).select(
        "region", F.lit("own_by_half").alias("section"), "half", none.alias("baseline"), F.explode("m").alias("model", "s")
    )
    paired = doc.select("region", F.explode(p).alias("baseline", "m")).select(
        "region", F.lit("paired").alias("section"), none.alias("half"), "baseline", F.explode("m").alias("model", "s")
    )
    both = (
        doc.select("region", F.explode(ph).alias("half", "h"))
        .select("region", "half", F.explode("h").alias("baseline", "m"))
        .select("region", F.lit("paired_by_half").alias("section"), "half", "baseline", F.explode("m").alias("model", "s"))
    )
    rows = own.unionByName(half).unionByName(paired).unionByName(both).where(F.col("model") != "n")
    parsed = rows.withColumn("s", F.from_json("s", SCORE_TYPE))
    return parsed.select(
        F.col("region").alias("site"), "section", "half", "baseline", "model", *[F.col(f"s.{n}").alias(c) for n, c in SCORE_FIELDS.items()]
    )


def file_hashes(spark: SparkSession, path: str, name_pattern: str = r"([^/]+)$") -> DataFrame:
    """SHA-256 per file. Meant for report files and figures; a file is read as one binary value."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.url_decode(F.regexp_extract("path", name_pattern, 1)).alias("file"), F.sha2("content", 256).alias("actual")
    )


def read_provenance(spark: SparkSession, path: str) -> DataFrame:
    """A stored list of files: one JSON array of (file, source, sha256)."""
    return spark.read.schema("file string, source string, sha256 string").json(path, multiLine=True)


def verify_provenance(files: DataFrame, provenance: DataFrame) -> DataFrame:
    """(file, expected, actual, ok, state) for every file that is listed or found.

    ``state`` is ``ok``, ``changed``, ``missing`` (listed, not found) or ``unlisted`` (found, not listed); only the first is ok.
    """
    listed = provenance.select("file", F.col("sha256").alias("expected"))
    out = listed.join(files, "file", "full_outer")
    return out.withColumn("state", _compared(F.col("expected"), F.col("actual"), "unlisted")).withColumn("ok", F.col("state") == "ok")


def _compared(expected: Column, found: Column, extra: str) -> Column:
    return F.when(found.isNull(), "missing").when(expected.isNull(), extra).when(expected == found, "ok").otherwise("changed")


def schema_rows(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Schemas of the tables as rows."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    return small_table(spark, rows, "table string, column string, actual_type string")


def audit_schema(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected and found columns side by side."""
    out = expected.join(actual, ["table", "column"], "full_outer")
    state = (
        F.when(F.col("actual_type").isNull(), "missing")
        .when(F.col("expected_type").isNull(), "unexpected")
        .when(F.col("expected_type") == F.col("actual_type"), "ok")
        .otherwise("other_type")
    )
    return out.withColumn("state", state)


def text_hash(columns: Sequence[str]) -> Column:
    """A row's hash by the text of its columns, as other engines can repeat it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def audit_content(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and a hash that does not depend on row order; one pass, folded before the shuffle."""
    number = text_hash(columns)
    return df.agg(F.count("*").alias("n_rows"), F.bit_xor(number).alias("content_hash"), F.sum(F.pmod(number, F.lit(1_000_003))).alias("content_sum"))


def audit_result(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Pass covers count and hash only; it says nothing about time leakage or promotion."""
    names = ["n_rows", "content_hash", "content_sum"]
    e = expected.select("table", *[F.col(n).alias(f"expected_{n}") for n in names])
    same = F.lit(True)
    for n in names:
        same = same & (F.col(n) == F.col(f"expected_{n}"))
    return e.join(found, "table", "left").withColumn("ok", F.coalesce(same, F.lit(False)))


LEAF = ["part", "bucket"]
LEAF_FACTS = ["n_rows", "content_hash", "content_sum"]


def exact_row_hash(df: DataFrame) -> Column:
    """Hash over all columns of a row. NULL flags go in as well, as ``xxhash64`` passes over a NULL."""
    return F.xxhash64(*[F.col(f"`{c}`").isNull() for c in df.columns], *[F.col(f"`{c}`") for c in df.columns])


def content_leaves(df: DataFrame, part: Column, key: Column, buckets: int, row_hash: Column | None = None) -> DataFrame:
    """The leaves of a table's hash tree: rows, XOR and sum of row hashes for each (partition, bucket of the key).

    The order of rows does not matter; repeated rows cancel in the XOR but not in the count and the sum. One pass, folded
    before the shuffle, so a partition with most of the rows is no hot key. A NULL partition or key has a leaf of its own.
    """
    number = exact_row_hash(df) if row_hash is None else row_hash
    leaves = df.select(part.cast("string").alias("part"), F.pmod(key, F.lit(buckets)).cast("int").alias("bucket"), number.alias("_h"))
    return leaves.groupBy(*LEAF).agg(
        F.count("*").alias("n_rows"), F.bit_xor("_h").alias("content_hash"), F.sum(F.pmod("_h", F.lit(1_000_003))).alias("content_sum")
    )


def compare_trees(found: DataFrame, stored: DataFrame) -> DataFrame:
    """Where a table differs from its stored hash tree: one row for the table, each partition and each differing bucket.

    Levels are ``table``, ``part`` and ``bucket``. ``state`` is ``ok``, ``changed``, ``missing`` (stored only) or ``added`` (found only); a node
    whose leaves are all missing (added) is missing (added). ``n_differing`` counts leaves that are not ok, ``n_expected`` and ``n_found`` are rows.
    """
    facts = F.struct(*[F.col(c) for c in LEAF_FACTS])
    s = stored.select(*LEAF, facts.alias("expected")).alias("s")
    f = found.select(*LEAF, facts.alias("found")).alias("f")
    same_leaf = F.col("s.part").eqNullSafe(F.col("f.part")) & F.col("s.bucket").eqNullSafe(F.col("f.bucket"))
    leaves = s.join(f, same_leaf, "full_outer").select(
        F.coalesce("s.part", "f.part").alias("part"), F.coalesce("s.bucket", "f.bucket").alias("bucket"), "expected", "found"
    )
    leaves = leaves.withColumn("_state", _compared(F.col("expected"), F.col("found"), "added"))
    rolled = leaves.rollup("part", "bucket").agg(
        F.grouping_id().alias("_level"),
        F.when(F.min("_state") == F.max("_state"), F.max("_state")).otherwise("changed").alias("state"),
        F.count_if(F.col("_state") != "ok").alias("n_differing"),
        F.coalesce(F.sum("expected.n_rows"), F.lit(0)).alias("n_expected"),
        F.coalesce(F.sum("found.n_rows"), F.lit(0)).alias("n_found"),
    )
    level = F.when(F.col("_level") == 3, "table").when(F.col("_level") == 1, "part").otherwise("bucket")
    out = rolled.select(level.alias("level"), "part", "bucket", "state", "n_differing", "n_expected", "n_found")
    return out.where("level <> 'bucket' OR state <> 'ok'")
