"""Properties of the plans: what is read, shuffled and broadcast."""

import re
from types import SimpleNamespace

import pytest

from sunledger.operators import models
from sunledger.plans import CATALOG, runner
from sunledger.plans.model_queries import learner_rows
from sunledger.plans.views import Tables
from sunledger.session import CHECKPOINT_KEY, shared_dir
from tests.oracle import SF_ROOT

SF = f"{SF_ROOT}/sf0.01"
# These run jobs of their own while they are built; their result plan says little.
EAGER = {n for n in CATALOG if n.startswith("stream_")} | {
    "boosted_tree_candidate", "huber_candidate", "provenance_check", "manifest_rows", "oof_files", "metrics_file", "landing_csv",
}
PYTHON_ALLOWED = {"ridge_oof_two_features"}


def plan(spark, name):
    return runner(name)(spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(CATALOG) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    p = plan(spark, name)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", p)
    assert name in PYTHON_ALLOWED or not re.search("Python|ArrowEval|InPandas", p)


def test_scan_reads_only_needed_columns(spark):
    p = plan(spark, "metrics_by_slice")
    schema = re.search(r"ReadSchema: struct<([^>]*l_suppkey[^>]*)>", p).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_suppkey", "l_extendedprice", "l_shipdate"}


def test_filter_reaches_the_files(spark):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in plan(spark, "observation_delays")


def test_rank_limits_run_before_the_shuffle(spark):
    for name in ("last_12_attempts", "masked_reconstruction"):
        assert re.search("WindowGroupLimit.*Partial", plan(spark, name))


def test_ordered_scans_are_spread_by_bucket(spark):
    for name in ("linear_fill", "meter_increments", "as_known_at_issue", "forecast_revisions"):
        assert re.search(r"Exchange hashpartitioning\([^)]*_bucket#\d+L?, \d+\), REPARTITION_BY_COL", plan(spark, name))


def test_no_machine_local_folder_on_a_cluster():
    def session(master, conf):
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))

    assert shared_dir(session("yarn", {CHECKPOINT_KEY: "hdfs://shared/chk/"}), "x").startswith("hdfs://shared/chk/sunledger/x-")
    with pytest.raises(ValueError):
        shared_dir(session("yarn", {}), "x")
    first, second = (shared_dir(session("local[2]", {}), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_learner_input_is_computed_once(spark):
    """However many folds and passes a learner makes."""
    computed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            computed.add(batch.num_rows)
            yield batch

    rows = spark.range(48).selectExpr("id % 2 AS x", "add_months(DATE '2020-01-01', CAST(id DIV 2 AS INT)) AS month", "CAST(id AS DOUBLE) AS a", "2.0 * id AS y")
    rows = rows.selectExpr("IF(x = 0, 'p', 'q') AS site", "month", "a", "y")
    rows = rows.mapInArrow(count, rows.schema)
    out = models.walk_forward_learner(rows, "month", ["site"], ["a"], "y", ["2020-07-01", "2021-01-01"], models.huber_line("y"))
    assert out.count() == 36 and computed.value == 48


def test_learner_rows_read_the_sold_rows_once(spark):
    p = learner_rows(Tables(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert p.count("lineitem.parquet") == 1


def test_boosted_trees_read_the_written_rows_only(spark):
    files = runner("boosted_tree_candidate")(spark, SF).inputFiles()
    assert files and all("/learner-rows-" in f for f in files)
