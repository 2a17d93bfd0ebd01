"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import bpe, codes, langid, licenses, minhash, packing, periodic, quality, repeats, rules, tokenfile, vectors
from sunledger.llm.common import table
from sunledger.session import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("piece_ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), size=400)
    return cut.select("doc_id", F.col("__n_bytes").alias("n_bytes"), F.col("__n_removed").alias("n_removed"), F.col("__n_spans").alias("n_spans"), F.sha2("__kept", 256).alias("kept_sha256"))


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs, ~langid.held_out(F.col("doc_id")))
    scored = langid.predict(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.array_join(F.transform("matches", lambda m: F.concat(m["licence"], F.lit(":"), m["times"].cast("string"))), " ")
    return found.select("doc_id", "n_sentences", "n_known", names.alias("licenses"), "left_over")


SQL["op4_licenses"] = licenses.scan_sql()


@query
def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.98)


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("id"), "text")
    found = minhash.classes(rows, threshold=0.8)
    return found.select(F.col("id").alias("doc_id"), "class_id", F.coalesce(F.col("id") == F.col("class_id"), F.lit(True)).alias("kept"))


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), ~quality.held_out(F.col("doc_id")))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op10_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenfile.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenfile.read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def looped(text: Column, doc_id: Column) -> Column:
    """The text, of which in a tenth of the rows (by crc32 of the id) all words from some place on are replaced by repeats of the first few of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("bigint")

    def loop(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint")
        bound = rules.let(F.struct(a.alias("a"), p.alias("p")), lambda x: F.transform(w, lambda v, i: F.when(i < x["a"], v).otherwise(F.get(w, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))))
        return F.when(n > 0, F.array_join(bound, " ")).otherwise(F.lit(""))

    words = F.filter(F.split(text, rules.BLANKS), lambda x: x != "")
    return F.when((h % 10 == 0) & text.isNotNull(), rules.let(words, loop)).otherwise(text)


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.find_runs(docs, least=24, repeats=3)
    # The greatest exact exponent: a / b > c / d where a * d > c * b.
    key = lambda x, y: (x["length"] * y["period"], y["length"] * x["period"])

    def order(x: Column, y: Column) -> Column:
        left, right = key(x, y)
        before = (left > right) | ((left == right) & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"]))))
        return F.when(before, F.lit(-1)).otherwise(F.lit(1))

    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.get(F.when(F.size("runs") > 1, F.array_sort("runs", order)).otherwise(F.col("runs")), F.lit(0))
    found = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed")
    exponent = F.expr("(1000 * best.length) div best.period")
    return found.select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", exponent.alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# Every pair of equal words of a document within reach is a row; stretches of such rows are islands.
SQL["op11_periodic_runs"] = r"""WITH crc AS (SELECT list_transform(range(256), lambda v: list_reduce([v] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
  d0 AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ 	-
]+'), lambda x: x <> '') AS w,
    xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295) AS h FROM documents, crc),
  d1 AS (SELECT *, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a, 1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p FROM d0),
  d AS MATERIALIZED (SELECT r, doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN list_transform(range(len(w)), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) ELSE w END AS w FROM d1),
  x AS MATERIALIZED (SELECT r, unnest(range(len(w))) AS i, unnest(w) AS x, len(w) AS n FROM d),
  m AS (SELECT u.r, v.i - u.i AS p, u.i FROM x u JOIN x v ON v.r = u.r AND v.x = u.x AND v.i > u.i AND v.i - u.i <= u.n // 3),
  s AS (SELECT r, p, min(i) AS start, count(*) + p AS length FROM (SELECT r, p, i, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM m) GROUP BY r, p, island HAVING count(*) + p >= greatest(24, 3 * p)),
  q AS MATERIALIZED (SELECT r, start, length, min(p) AS period FROM s GROUP BY ALL),
  k AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS c FROM x WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.r = x.r AND x.i >= q.start + q.period AND x.i < q.start + q.length) GROUP BY r),
  l AS (SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM q GROUP BY r),
  b AS (SELECT DISTINCT ON (q.r) q.* FROM q WHERE NOT EXISTS (SELECT 1 FROM q o WHERE o.r = q.r AND o.length * q.period > q.length * o.period) ORDER BY q.r, start, period)
  SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start, CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
    CAST(1000 * length // period AS BIGINT) AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
  FROM d LEFT JOIN l USING (r) LEFT JOIN b USING (r) LEFT JOIN k USING (r)"""


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    fitted = codes.fit(rows, factor=4096.0, parts=8, entries=16, rounds=6)
    # Read again by the sums and by the rows, so it is written once.
    coded = materialize(fitted.encode(rows).withColumn("codebooks_sha256", fitted.digests(F.col("embedding"))).drop("embedding"), "vector-codes")
    by_label = coded.groupBy(F.col("label").alias("of_label")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


SQL["op12_vector_codes"] = codes.compressed_sql()


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = rules.rate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    named = [F.col(f"rated.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return rated.select("doc_id", *named, (F.size("rated.base_broken") > 0).alias("base_failed"), F.col("rated.kept").alias("kept"))


SQL["op13_quality_rules"] = rules.rate_sql()
