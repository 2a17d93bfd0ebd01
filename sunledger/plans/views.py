"""The given tables and the forecast-shaped inputs Spark derives from them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions.columns import as_ntz, epoch_seconds, half_label, shift_seconds, slot_start
from sunledger.functions.stats import stable_mean
from sunledger.operators import baselines, grid
from sunledger.session import prepare, small_table

OOF_MODELS = ["persistence", "last_year", "seasonal_mean", "candidate"]
OOF_BASELINES = OOF_MODELS[:3]

# Ranges with known defects.
DEFECTS = [
    ("click", "2024-01-05 00:00:00", "2024-01-07 12:00:00"),
    ("view", "2024-01-10 06:00:00", "2024-01-10 18:00:00"),
    ("error", "2024-01-20 00:00:00", "2024-01-25 00:00:00"),
]

# The feeds each model needs.
REQUIRED = [
    ("ultra_short", "click"),
    ("ultra_short", "view"),
    ("short_24h", "click"),
    ("short_24h", "purchase"),
    ("short_48h", "signup"),
    ("short_48h", "error"),
]


def minutes_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


class Tables:
    """Named DataFrames for one data folder. Everything is lazy; nothing is collected."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = prepare(spark)
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def sold(self) -> DataFrame:
        """lineitem with the site name. Sizes decide the join kind: no side is forced to broadcast."""
        place = (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("nation_site"), F.col("r_name").alias("site"))
        )
        return self.table("lineitem").join(place, F.col("l_suppkey") == F.col("s_suppkey"))

    @cached_property
    def site_day(self) -> DataFrame:
        return self.sold.groupBy("site", F.col("l_shipdate").cast("date").alias("day")).agg(
            F.round(F.sum("l_extendedprice"), 2).alias("actual_kwh")
        )

    @cached_property
    def site_month(self) -> DataFrame:
        return self.site_day.groupBy("site", F.trunc("day", "month").alias("month")).agg(
            F.round(F.sum("actual_kwh"), 2).alias("actual_kwh"), F.count("*").alias("n_days")
        )

    @cached_property
    def unit_month(self) -> DataFrame:
        place = self.table("supplier").select("s_suppkey", F.col("s_nationkey").cast("bigint").alias("site"))
        return (
            self.table("lineitem")
            .groupBy(
                F.col("l_suppkey").alias("unit"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("month")
            )
            .agg(F.round(F.sum("l_extendedprice"), 2).alias("kwh"))
            .join(place, F.col("unit") == F.col("s_suppkey"))
            .select("unit", "site", "month", "kwh")
        )

    @cached_property
    def oof_with_days(self) -> DataFrame:
        """One row per (site, month) with baseline columns, a blended candidate and the number of days with rows."""
        wide = baselines.monthly_baselines(self.site_month, ["site"], "month", "actual_kwh")
        return wide.select(
            "site",
            "month",
            half_label("month").alias("half"),
            "actual_kwh",
            "persistence",
            "last_year",
            F.round("seasonal_mean", 6).alias("seasonal_mean"),
            F.round(0.7 * F.round("seasonal_mean", 6) + 0.3 * F.col("persistence"), 6).alias("candidate"),
            "n_days",
        )

    @cached_property
    def oof(self) -> DataFrame:
        """One row per (site, month) with baseline columns and a blended candidate."""
        return self.oof_with_days.drop("n_days")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def readings_raw(self) -> DataFrame:
        k = minutes_k()
        return self.events.select(
            "event_id",
            "ts",
            F.col("event_type").alias("unit"),
            (F.col("user_id") % 4).alias("site"),
            k.alias("k"),
            F.when(k >= 95, "COMM_ERR").when(k == 94, F.lit(None)).otherwise(F.col("value").cast("string")).alias("raw"),
        )

    @cached_property
    def readings(self) -> DataFrame:
        valid = self.events.withColumn("k", minutes_k()).where("k < 94")
        return valid.groupBy(F.col("event_type").alias("unit"), slot_start("ts", 15).alias("slot")).agg(
            stable_mean("value").alias("kw"),
            F.count("*").alias("n_obs"),
            F.max(shift_seconds("ts", F.col("k") * 60)).alias("received_at"),
        )

    @cached_property
    def grid(self) -> DataFrame:
        return grid.reindex(self.readings, ["unit"], "slot", 15)

    @cached_property
    def gaps(self) -> DataFrame:
        return grid.with_neighbours(self.grid, ["unit"], "slot", "kw", 15, received="received_at")

    @cached_property
    def obs(self) -> DataFrame:
        k = minutes_k()
        return self.events.where("event_type = 'view'").select(
            "event_id",
            (F.col("user_id") % 4).alias("station"),
            F.col("ts").alias("obs_ts"),
            k.cast("double").alias("cloud_pct"),
            F.when(F.col("event_id") % 97 == 0, k.cast("double")).otherwise(k / F.lit(10.0)).alias("cloud_tenths"),
            F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("temp"),
            F.when(F.col("event_id") % 11 != 0, F.col("value") / 2).alias("humidity"),
            shift_seconds("ts", k * 60).alias("received_at"),
        )

    @cached_property
    def issues(self) -> DataFrame:
        """Every full hour of each station's span."""
        hour = F.lit(3600)
        s = epoch_seconds("obs_ts")
        floor = s - F.pmod(s, hour)
        return (
            self.obs.groupBy("station")
            .agg(F.min(floor).alias("a"), F.max(floor).alias("b"))
            .select("station", F.explode(F.sequence("a", "b", hour.cast("bigint"))).alias("h"))
            .select("station", as_ntz(F.col("h")).alias("issue_ts"))
        )

    @cached_property
    def fc(self) -> DataFrame:
        k = minutes_k()
        issue = slot_start("ts", 60)
        return self.events.select(
            "event_id",
            (F.col("user_id") % 4).alias("site"),
            F.col("event_type").alias("model"),
            issue.alias("issue_ts"),
            k.alias("lead_h"),
            shift_seconds(issue, k * 3600).alias("target_ts"),
            F.col("ts").alias("received_at"),
            F.col("value").alias("pred"),
        )

    @cached_property
    def site_hour(self) -> DataFrame:
        return self.events.groupBy((F.col("user_id") % 4).alias("site"), slot_start("ts", 60).alias("hour")).agg(
            stable_mean("value").alias("actual_kw"), F.count("*").alias("n_obs")
        )

    @cached_property
    def capacity(self) -> DataFrame:
        total = F.abs("s_acctbal") + 100
        return self.table("supplier").select(
            F.col("s_suppkey").alias("unit"),
            F.col("s_nationkey").cast("bigint").alias("site"),
            F.explode(
                F.array(
                    F.struct(F.lit("inverter_sum").alias("role"), total.alias("kw")),
                    F.struct(F.lit("plant_api").alias("role"), F.round(0.95 * total, 6).alias("kw")),
                )
            ).alias("c"),
        ).select("unit", "site", "c.role", "c.kw")

    @cached_property
    def defects(self) -> DataFrame:
        rows = small_table(self.spark, DEFECTS, "unit string, a string, b string")
        return rows.select(
            "unit", F.col("a").cast("timestamp_ntz").alias("from_ts"), F.col("b").cast("timestamp_ntz").alias("to_ts")
        )

    @cached_property
    def runs(self) -> DataFrame:
        status = (
            F.when(F.col("event_type") == "purchase", "success")
            .when(F.col("event_type") == "error", "error")
            .when(F.col("event_type") == "signup", "warming_up")
            .otherwise("waiting")
        )
        return self.events.select(
            "event_id",
            (F.col("user_id") % 4).alias("job"),
            "ts",
            slot_start("ts", 15).alias("slot"),
            status.alias("status"),
            minutes_k().alias("k"),
            F.col("event_type").alias("feed"),
            "value",
        )

    @cached_property
    def first(self) -> Column:
        """Midnight of the first day of the logs; with ``end`` the clock of the queries over registers. One row of two aggregates, read as a scalar."""
        return self.events.agg(F.date_trunc("day", F.min("ts")).cast("timestamp_ntz")).scalar()

    @cached_property
    def end(self) -> Column:
        """Midnight after the last day of the logs."""
        return shift_seconds(self.events.agg(F.date_trunc("day", F.max("ts")).cast("timestamp_ntz")).scalar(), 86400)

    @cached_property
    def dated_jobs(self) -> DataFrame:
        """A register of jobs by effective dates: some begin late, some pause, and one entry has no row of ``tagged_runs`` at all."""
        jobs = self.table("nation").where("n_nationkey < 6").select(F.col("n_nationkey").cast("bigint").alias("job"), "n_regionkey")
        begin = shift_seconds(self.first, (F.col("n_regionkey") - 2) * 5 * 86400)
        rows = jobs.select("job", begin.alias("from_ts"))
        rows = rows.withColumn("to_ts", F.when(F.col("job") % 3 == 2, shift_seconds("from_ts", 12 * 86400)))
        again = jobs.where("job % 3 = 2").select("job", shift_seconds(self.first, 20 * 86400).alias("from_ts"), F.lit(None).cast("timestamp_ntz").alias("to_ts"))
        return rows.unionByName(again)

    @cached_property
    def tagged_runs(self) -> DataFrame:
        """Runs whose jobs go beyond the register."""
        return self.runs.drop("job").join(self.events.select("event_id", (F.col("user_id") % 8).alias("job")), "event_id")

    @cached_property
    def job_register(self) -> DataFrame:
        """Jobs with the dates from and to which they should run; some never do, and some run on after their end."""
        begin = shift_seconds(F.lit("2023-12-20 00:00:00").cast("timestamp_ntz"), F.col("n_regionkey") * 5 * 86400)
        rows = self.table("nation").where("n_nationkey < 6").select(F.col("n_nationkey").cast("bigint").alias("job"), begin.alias("from_ts"))
        return rows.withColumn("to_ts", F.when(F.col("job") % 3 == 2, shift_seconds("from_ts", F.lit(21 * 86400))))

    @cached_property
    def required(self) -> DataFrame:
        return small_table(self.spark, REQUIRED, "model string, feed string")

    @cached_property
    def features(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("row_key"),
            F.col("l_linenumber").alias("row_no"),
            F.col("l_shipdate").cast("date").alias("day"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("discount"),
            F.col("l_tax").alias("tax"),
        )
