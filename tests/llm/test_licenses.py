"""Licence rules on texts, and the registered query against its SQL."""

from sunledger.llm import licenses
from sunledger.llm.queries import QUERIES, SQL
from tests.oracle import SF_ROOT, canonical, connect


def found(spark, *texts):
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).orderBy("doc_id").collect()
    return [[(m["licence"], m["times"]) for m in r["matches"]] for r in rows], rows


def wrapped(*names):
    return "\n\n".join(licenses.SENTENCES[n].replace(" the ", "\nthe ") for n in names)


def test_every_rule_matches_its_own_sentences(spark):
    texts = [" \n".join(licenses.SENTENCES[n] for n in names.split()) for _, names in licenses.RULES]
    got, rows = found(spark, *texts)
    for (licence, names), matches, row in zip(licenses.RULES, got, rows):
        assert matches == [(licence, 1)], (names, matches)
        assert row["left_over"] == 0


def test_order_of_sentences_and_rules(spark):
    mit = ["mit-grant", "mit-notice", "mit-as-is", "mit-liability"]
    got, rows = found(
        spark,
        "MIT License\n\nCopyright (c) 2020 A\n\n" + wrapped(*mit),
        wrapped(*mit) + "\nfoo. " + wrapped("mit-notice", "mit-grant"),  # the wrong order is no rule
        wrapped(*mit, *mit) + "\n" + "Released under the MIT License.",
        wrapped("bsd-grant") + "\n1. " + wrapped("bsd-source") + "\n2. " + wrapped("bsd-binary") + "\n3. " + wrapped("bsd-names"),
        "no stop before\nlicensed under the APACHE license, version 2.0.\nand on",
        "This speaks of the MIT License in passing.",
        None,
        "",
        " . . ! \n\n",
    )
    assert got[:6] == [[("MIT", 1)], [("MIT", 1)], [("MIT", 2), ("MIT", 1)], [("BSD-3-Clause", 1)], [("Apache-2.0", 1)], []]
    assert rows[1]["left_over"] == 2 and got[6:] == [[], [], []] and [r["n_sentences"] for r in rows[6:]] == [0, 0, 0]


def test_odd_rows(nasty, empty):
    assert licenses.scan(nasty).count() == nasty.count() and licenses.scan(empty).count() == 0
    assert "Python" not in licenses.scan(nasty)._jdf.queryExecution().toString()


def test_query_equals_sql(spark):
    sf = f"{SF_ROOT}/sf0.01"
    got = canonical(QUERIES["op4_licenses"](spark, sf).toArrow())
    assert got == canonical(connect(sf).sql(SQL["op4_licenses"]).to_arrow_table())
