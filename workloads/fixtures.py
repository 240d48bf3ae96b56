"""Spark views over the driver's tables that the queries start from."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.dates import month_window
from tidemark.operators.merge import join_features
from tidemark.operators.scoring import score_buckets
from tidemark.options import Options, SpineColumns
from tidemark.plans.split import fit_split
from tidemark.sources.staging import fresh_path, stage

SPINE = SpineColumns(ident="ident", date="month")
KEYS = SPINE.keys
# For the queries whose feature is a window.
START, END = month_window("1995-01-01", "%Y-%m-%d", months=78)
OPTIONS = Options(spine=SPINE, min_prior=0.35)

NUMERIC = ["n_orders", "total_price", "max_price", "sum_qty", "sum_price", "avg_discount", "c_acctbal", "c_nationkey"]
TEXT = ["top_status", "returnflag", "segment", "nation_name", "region_name"]
DIRTY = ["messy", "constant_txt", "all_null", "mostly_null", "quasi_const", "flag_yn", "flag_01", "two_level"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_schema(spark) -> str:
    """A schema of its own in the shared folder."""
    path = fresh_path(spark, "schema")
    name = "tidemark_" + path[-12:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def month_of(column: str):
    return F.trunc(F.col(column).cast("date"), "MM")


def spine_of(orders: DataFrame) -> DataFrame:
    urgent = (F.col("o_orderpriority") == "1-URGENT").cast("int")
    return orders.groupBy(F.col("o_custkey").alias("ident"), month_of("o_orderdate").alias("month")).agg(
        F.max(urgent).alias("target")
    )


def spine_cm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and month with an order; target: an urgent one."""
    return spine_of(table(spark, sf_dir, "orders"))


def spine_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spine of all months."""
    return spine_cm(spark, sf_dir)


def months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enough to find the validation months, without building the spine."""
    return table(spark, sf_dir, "orders").select(month_of("o_orderdate").alias("month"))


def spine_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users by day, for periods other than months; target: a purchase that day."""
    bought = (F.col("event_type") == "purchase").cast("int")
    return table(spark, sf_dir, "events").groupBy(
        F.col("user_id").alias("ident"), F.col("ts").cast("date").alias("month")
    ).agg(F.max(bought).alias("target"))


def feat_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("ident"), month_of("o_orderdate").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        F.max("o_totalprice").alias("max_price"),
        # Status of the last order. A number packs key and letter: maxima of
        # numbers hash-aggregate, those of text would sort all rows first.
        F.char(F.max(F.col("o_orderkey") * 256 + F.ascii("o_orderstatus")) % 256).alias("top_status"),
    )


def feat_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("ident"))
    return (
        table(spark, sf_dir, "lineitem")
        .join(owners, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("ident", month_of("l_shipdate").alias("month"))
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_discount"),
            F.char(F.max(F.ascii("l_returnflag"))).alias("returnflag"),
        )
    )


def feat_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("ident"),
            "c_acctbal",
            "c_nationkey",
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation_name"),
            F.col("r_name").alias("region_name"),
        )
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features plus the kinds of column that cleaning is for."""
    k = F.col("ident")
    messy = (
        F.when(k % 3 == 0, F.concat(F.lit("  "), F.lower("segment"), F.lit(" ")))
        .when(k % 3 == 1, F.col("segment"))
        .otherwise(F.concat(F.col("segment"), F.lit(" / b2b")))
    )
    return feat_customer(spark, sf_dir).select(
        "*",
        messy.alias("messy"),
        F.lit("FIXED").alias("constant_txt"),
        F.lit(None).cast("double").alias("all_null"),
        F.when(k % 40 == 0, F.col("c_acctbal")).alias("mostly_null"),
        F.when(k % 40 == 1, "B").otherwise("A").alias("quasi_const"),
        F.when(k % 3 == 0, "y ").otherwise("N").alias("flag_yn"),
        (k % 2).cast("int").alias("flag_01"),
        F.when(k % 5 == 0, 7).otherwise(3).alias("two_level"),
    )


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spine with all raw features."""
    joined = join_features(spine_window(spark, sf_dir), feat_orders(spark, sf_dir), KEYS)
    joined = join_features(joined, feat_lineitem(spark, sf_dir), KEYS)
    return join_features(joined, dirty(spark, sf_dir), ["ident"])


def split_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dataset(spark, sf_dir)
    return fit_split(months(spark, sf_dir), Options(spine=SPINE)).assign(rows)


def scored_cm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A proxy probability that needs no model: heavy ties, and exact 0 and 1."""
    prices = feat_orders(spark, sf_dir).select("ident", "month", "total_price")
    p = F.least(F.greatest(F.floor(F.col("total_price") / 10000) / 100, F.lit(0.0)), F.lit(1.0))
    rows = join_features(spine_window(spark, sf_dir), prices, KEYS)
    scored = rows.select("ident", "month", "target", F.array(1 - p, p).alias("probability"), p.alias("p"))
    plan = fit_split(months(spark, sf_dir), Options(spine=SPINE, n_months_val=3))
    return plan.assign(scored).withColumn("prediction", (F.col("p") >= 0.5).cast("double"))


def with_deciles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_buckets(scored_cm(spark, sf_dir), "p", ["month", "ident"], ["ind_split"])


def score_history(spark: SparkSession, sf_dir: str, late: bool = False) -> DataFrame:
    """Scores of two runs, of all months and of the last one; with ``late`` a third,
    of the month before."""
    rows = scored_cm(spark, sf_dir).select("ident", "month", "p", "prediction")
    last = months(spark, sf_dir).select(F.max("month")).scalar()
    runs = [("20010801_000000", F.lit(True)), ("20010901_000000", F.col("month") == last)]
    if late:
        runs.append(("20011001_000000", F.col("month") == F.add_months(last, -1)))
    frames = [rows.where(condition).withColumn("exec_time", F.lit(stamp)) for stamp, condition in runs]
    history = frames[0]
    for frame in frames[1:]:
        history = history.unionByName(frame)
    return stage(history, "history")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison."""
    return df.select(
        *[
            F.round(f.name, places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )
