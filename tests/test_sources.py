from __future__ import annotations

from pathlib import Path
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError

from conftest import SMALL, plan_of, rows_of
from tenureline.operators.revenue import lifetime_value, mrr_monthly_of_resolved
from tenureline.plans import marts
from tenureline.sources import extracts, publish, schemas
from tenureline.sources.publish import publish_table, publish_view, scratch_dir, stage
from workload import bindings


def test_extract_with_crlf_and_no_final_newline(spark, tmp_path):
    path = tmp_path / "plans.csv"
    path.write_bytes(b"plan_id,plan_name,monthly_cost\r\np1,Basic,20\r\np2,\"Pro, \"\"big\"\"\",50")
    df = extracts.read_extract(spark, str(path), schemas.RAW_PLANS)
    assert rows_of(df) == [("p1", "Basic", 20), ("p2", 'Pro, "big"', 50)]


def test_empty_field_is_null_and_blanks_are_kept(spark, tmp_path):
    path = tmp_path / "plans.csv"
    path.write_text("plan_id,plan_name,monthly_cost\n p1 ,,\n")
    df = extracts.read_extract(spark, str(path), schemas.RAW_PLANS)
    assert rows_of(df) == [(" p1 ", None, None)]


@pytest.mark.parametrize(
    "text",
    [
        "plan_id,plan_name,monthly_cost\np1,Basic,dear\n",
        "plan,name,cost\np1,Basic,20\n",
    ],
)
def test_bad_value_or_header_fails(spark, tmp_path, text):
    path = tmp_path / "plans.csv"
    path.write_text(text)
    with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
        extracts.read_extract(spark, str(path), schemas.RAW_PLANS).collect()


def test_decimal_prices_load(spark, tmp_path):
    path = tmp_path / "plans.csv"
    path.write_text("plan_id,plan_name,monthly_cost\nbasic,Basic,31.00\npro,Pro,62\nx,X,19.99\n")
    prices = extracts.read_extract(spark, str(path), schemas.RAW_PLANS).select("monthly_cost")
    assert [str(row[0]) for row in prices.collect()] == ["31.00", "62.00", "19.99"]


def test_malformed_rows_fail_although_their_columns_are_not_read(spark, tmp_path):
    path = tmp_path / "plans.csv"
    path.write_text("plan_id,plan_name,monthly_cost\np1,Basic,dear\np2\n")
    df = extracts.read_extract(spark, str(path), schemas.RAW_PLANS)
    for read in (df.select("plan_id").collect, df.count):
        with pytest.raises(Py4JJavaError, match="FAILED_READ_FILE"):
            read()


def test_line_breaks_in_fields_need_the_option(spark, tmp_path):
    lines = spark.createDataFrame([("p1", 'two\nlines, "quoted"', 5)], "plan_id string, plan_name string, monthly_cost int")
    path = extracts.write_extract(lines, str(tmp_path / "plans"))
    back = extracts.read_extract(spark, path, schemas.RAW_PLANS, multiLine=True)
    assert rows_of(back) == [("p1", 'two\nlines, "quoted"', 5)]


def test_extract_round_trip(spark, tmp_path):
    customers = bindings.raw_customers(spark, SMALL)
    path = extracts.write_extract(customers, str(tmp_path / "customers"))
    assert rows_of(extracts.read_extract(spark, path, schemas.RAW_CUSTOMERS)) == rows_of(customers)


def test_scratch_folder_follows_the_session(spark):
    chosen = spark.sparkContext.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if chosen or configured:
        assert scratch_dir(spark) == (chosen or configured).rstrip("/")


def test_stage_reads_from_files(spark):
    staged = stage(spark.range(10), "numbers")
    assert staged.count() == 10 and "FileScan parquet" in plan_of(staged)


def test_staged_folders_end_with_their_scratch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(publish, "scratch_dir", lambda spark: str(tmp_path))
    raw = bindings.raw_tables(spark, SMALL)
    with publish.scratch(spark):
        marts.timeline_of(raw.subscriptions, raw.plans).count()
    assert list((tmp_path / "tenureline").iterdir()) == []
    with publish.scratch(spark) as folder:
        fact = publish.publish_table(
            marts.monthly_revenue(raw.subscriptions, raw.plans), str(tmp_path), "marts", "mrr"
        )
        assert len(list(Path(folder).iterdir())) == 1
    assert list((tmp_path / "tenureline").iterdir()) == [] and fact.count() > 0


def test_view_is_named_after_its_layer(spark):
    publish_view(spark.range(3), "intermediate", "numbers")
    assert spark.table("intermediate__numbers").count() == 3


def test_table_is_rebuilt_in_full(spark, tmp_path):
    root = str(tmp_path)
    publish_table(spark.range(5), root, "marts", "numbers")
    again = publish_table(spark.range(2), root, "marts", "numbers")
    assert again.count() == 2


def test_a_failed_rebuild_leaves_the_table(spark, tmp_path):
    numbers, failing = spark.range(5).withColumnRenamed("id", "n"), "IF(id = 70, raise_error('lost'), id) AS n"
    broken = spark.range(0, 100, 1, 8).selectExpr(failing)
    for layers in ({}, {"bucket_by": "n", "buckets": 2, "database": "failing"}):
        root = f"{tmp_path}/{len(layers)}"
        publish_table(numbers, root, "marts", "numbers", **layers)
        with pytest.raises(Exception, match="lost"):
            publish_table(broken, root, "marts", "numbers", **layers)
        assert spark.read.parquet(f"{root}/marts/numbers").count() == 5
        assert not layers or spark.table("failing.numbers").count() == 5
        assert [x.name for x in Path(f"{root}/marts").iterdir()] == ["numbers"]
        again = publish_table(numbers.limit(3), root, "marts", "numbers", **layers)
        assert again.count() == 3 and [x.name for x in Path(f"{root}/marts").iterdir()] == ["numbers"]


def test_roots_may_hold_quotes_and_databases_keep_pipelines_apart(spark, tmp_path):
    numbers = spark.range(5).withColumnRenamed("id", "n")
    layers = {"bucket_by": "n", "buckets": 2}
    one = publish_table(numbers, f"{tmp_path}/it's", "lay", "t", database="one_lay", **layers)
    two = publish_table(numbers.limit(2), f"{tmp_path}/two", "lay", "t", database="two_lay", **layers)
    assert (one.count(), two.count(), spark.table("one_lay.t").count()) == (5, 2, 5)


def test_bucketed_marts_need_no_further_shuffle(spark, tmp_path):
    raw = bindings.raw_tables(spark, SMALL)
    built = marts.build_marts(raw, str(tmp_path), buckets=4)
    assert "hashpartitioning" not in plan_of(built.timeline.groupBy("customer_id").count())
    assert "hashpartitioning" not in plan_of(built.summary)
    fact = mrr_monthly_of_resolved(built.timeline, clustered=True)
    assert "hashpartitioning" not in plan_of(fact)
    assert "hashpartitioning" not in plan_of(lifetime_value(built.fact))
    assert rows_of(built.timeline) == rows_of(marts.timeline_of(raw.subscriptions, raw.plans))
    again = marts.build_marts(raw, str(tmp_path), buckets=4)
    assert again.dimension.count() == raw.customers.count()


def test_a_cluster_must_name_its_shared_folder():
    def session(chosen=None, **settings):
        context = SimpleNamespace(getCheckpointDir=lambda: chosen)
        return SimpleNamespace(conf=settings, sparkContext=context)

    shared = {"spark.checkpoint.dir": "hdfs:///shared/", "spark.master": "yarn"}
    assert scratch_dir(session(**shared)) == "hdfs:///shared"
    assert scratch_dir(session("hdfs:///set/later", **shared)) == "hdfs:///set/later"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(session(**{"spark.master": "yarn"}))
