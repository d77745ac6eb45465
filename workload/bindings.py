"""Driver tables read as raw customers, subscriptions and plans.

The formulas are fixed in FIXTURES.md; the comparison SQL states them a second time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenureline.functions.dates import reopened_end
from tenureline.plans.marts import RawTables

# Status code by order key modulo 11.
STATUS_CODES = """
    CASE o_orderkey % 11
        WHEN 0 THEN ' Active '
        WHEN 1 THEN 'ACTIVE'
        WHEN 2 THEN 'active'
        WHEN 3 THEN 'pending'
        WHEN 4 THEN 'Pending '
        WHEN 5 THEN 'canceled'
        WHEN 6 THEN 'CANCELLED'
        WHEN 7 THEN 'trial'
        WHEN 9 THEN 'active'
        WHEN 10 THEN 'cancelled'
    END
"""

# The plan price list.
PLANS_SQL = """
    SELECT * FROM VALUES
        ('p1', 'Basic', {basic_price}),
        ('p2', 'Pro', 50),
        ('p3', 'Enterprise', 200)
    AS plans(plan_id, plan_name, monthly_cost)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _subscriptions(orders: DataFrame, customer: str) -> DataFrame:
    dated = orders.withColumn("start", F.to_date("o_orderdate"))
    return dated.selectExpr(
        "'sub_' || o_orderkey AS subscription_id",
        f"{customer} AS customer_id",
        "'p' || (o_orderkey % 4 + 1) AS plan_id",
        f"{STATUS_CODES} AS status_code",
        "start AS subscription_start_date",
        """CASE WHEN o_orderkey % 13 = 0 THEN NULL
                WHEN o_orderkey % 23 = 0 THEN date_sub(start, 5)
                ELSE date_add(start, CAST(o_orderkey * 7919 % 500 AS INT))
           END AS subscription_end_date""",
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _subscriptions(table(spark, sf_dir, "orders"), "o_custkey")


def skewed_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same subscriptions, a third of them belonging to customer 1."""
    owner = "CASE WHEN o_orderkey % 3 = 0 THEN 1L ELSE o_custkey END"
    return _subscriptions(table(spark, sf_dir, "orders"), owner)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id",
        "'  ' || c_name || ' ' AS customer_name",
        """CASE WHEN c_custkey % 97 <> 0 THEN ' ' || upper(c_name) || '@Example.COM ' END
           AS customer_email""",
        "format_string('2000-01-%02d 10:30:00', c_custkey % 28 + 1) AS signup_at",
        """'{"seg": "' || c_mktsegment || '"}' AS metadata_super""",
        """CASE c_nationkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN ' EU ' WHEN 2 THEN 'US'
                ELSE ' None ' END AS region_raw""",
        """CASE WHEN c_custkey % 5 = 0 THEN 'None' ELSE ' ' || c_mktsegment END
           AS marketing_source_raw""",
    )


def raw_plans(spark: SparkSession, basic_price: int = 20) -> DataFrame:
    return spark.sql(PLANS_SQL.format(basic_price=int(basic_price)))


def part_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a large plan list."""
    return table(spark, sf_dir, "part").selectExpr(
        "'p' || p_partkey AS plan_id", "p_name AS plan_name", "p_size AS monthly_cost"
    )


def supplier_plans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a plan list; an account balance may be below zero."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "'s' || s_suppkey AS plan_id", "s_name AS plan_name", "s_acctbal AS monthly_cost"
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> RawTables:
    return RawTables(
        raw_customers(spark, sf_dir), raw_subscriptions(spark, sf_dir), raw_plans(spark)
    )


def as_timeline(cleaned: DataFrame) -> DataFrame:
    """Cleaned, still overlapping subscriptions in the shape of a timeline."""
    return cleaned.select(
        "customer_id",
        "resolved_subscription_id",
        "resolved_plan_id",
        "resolved_status",
        F.col("start_date").alias("resolved_start_date"),
        reopened_end(F.col("end_date")).alias("resolved_end_date"),
        "monthly_cost",
        "is_billable",
    )


def late_starters_open(timeline: DataFrame) -> DataFrame:
    """The timeline with every end before 1998, and later starters open: they open after it."""
    last = F.lit("1997-12-31").cast("date")
    closed = F.least(F.coalesce("resolved_end_date", last), last)
    return timeline.withColumn(
        "resolved_end_date", F.when(F.col("resolved_start_date") <= last, closed)
    )
