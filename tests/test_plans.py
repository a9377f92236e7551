"""What the plans must and must not contain."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from anticipa import operators as op
from anticipa import plans, sources
from anticipa.sources import Table
from anticipa.sources import order_feeds as feeds
from helpers import final_plan, rows

ROOT = Path(__file__).parents[1]
FOLDER = "/root/testdata/sf0.001"
QUERIES = entry._own_queries()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def change(**settings):
        for key, value in settings.items():
            key = "spark.sql." + key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_pairwise_join_and_no_python(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    plan = final_plan(QUERIES[name](spark, FOLDER))
    assert not re.search(r"Cartesian|NestedLoop|EvalPython|InPandas|ExistingRDD|Window", plan)
    scans = re.findall(r"FileScan parquet.*?/(\w+)\.parquet", plan)
    assert scans.count("lineitem") <= 1
    if "lineitem" in scans and name not in ("invoice_preview",):
        assert "l_comment" not in plan


@pytest.mark.parametrize(
    "name", ["rate_indicators_all", "credit_days_all", "billed_by_term_all", "contract_unbucketed", "contract_rejects"]
)
def test_portfolio_figures_shuffle_only_aggregates(spark, name):
    plan = final_plan(QUERIES[name](spark, FOLDER))
    assert "Join" not in plan
    below = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in below and "partial_" in below


@pytest.mark.parametrize("name", ["rate_indicators", "annex_indicators", "credit_days", "billed_by_term", "clients_by_term"])
def test_combined_frames_share_the_facts(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    assert "ReusedExchange" in final_plan(QUERIES[name](spark, FOLDER))


@pytest.mark.parametrize("name", ["billed_by_term_by_client", "clients_by_term_by_client", "billed_by_term", "clients_by_term"])
def test_charts_shuffle_items_once(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    plan = final_plan(QUERIES[name](spark, FOLDER))
    assert re.search(r"hashpartitioning\(cliente_id#\d+L?, \d+\)", plan) and not re.search(r"hashpartitioning\(cliente_id#\d+L?, dias", plan)


def test_scan_reads_only_what_is_asked(spark):
    plan = final_plan(QUERIES["credit_days_all"](spark, FOLDER))
    assert "ReadSchema: struct<l_quantity:double,l_discount:double>" in plan


def test_only_the_named_item_fields_are_read(spark, tmp_path):
    path = str(tmp_path / "feed")
    feeds.annex_feed(spark, FOLDER).write.parquet(path)
    feed = sources.annex_feed(spark, Table(path))
    plan = final_plan(op.clients_by_term_all(op.annex_items(feed, "dias_pago")))
    assert "ReadSchema: struct<cliente_id:bigint,jsonb_agg:array<struct<dias_pago:int>>>" in plan
    plan = final_plan(op.billed_by_term_all(op.annex_items(feed, "comision", "dias_pago")))
    assert "ReadSchema: struct<jsonb_agg:array<struct<cant_comision:decimal(18,4),dias_pago:int>>>" in plan


def test_jobs_read_only_the_item_fields_of_their_figure(spark, tmp_path):
    path = str(tmp_path / "feed")
    feeds.annex_feed(spark, FOLDER).write.parquet(path)
    inputs = {"annex_feed": sources.annex_feed(spark, Table(path)), "clients": feeds.clients(spark, FOLDER)}
    for job, fields in (("clients_by_term", "dias_pago:int"), ("billed_by_term", "cant_comision:decimal(18,4),dias_pago:int")):
        plan = final_plan(plans.compute(job, inputs, feeds.AS_OF))
        assert f"ReadSchema: struct<cliente_id:bigint,jsonb_agg:array<struct<{fields}>>>" in plan
    plan = final_plan(plans.compute("billed_by_term_all", inputs, feeds.AS_OF))
    assert "ReadSchema: struct<jsonb_agg:array<struct<cant_comision:decimal(18,4),dias_pago:int>>>" in plan


def test_an_item_without_a_date_is_billed(spark, tmp_path):
    (tmp_path / "feed.json").write_text(
        '{"anexo_id":1,"cliente_id":7,"jsonb_agg":[{"cant_comision":1.0,"dias_pago":5,"fecha_registro":"2024-01-01"},{"cant_comision":2.0,"dias_pago":5},'
        '{"cant_comision":4.0},{"dias_pago":5}]}\n{"anexo_id":2,"cliente_id":7,"jsonb_agg":"none"}\n'
    )
    clients = spark.createDataFrame([(7, "x")], "cliente_id long, nombre_fiscal string")
    inputs = {"annex_feed": sources.annex_feed(spark, Table(str(tmp_path / "feed.json"), "json")), "clients": clients}
    billed = plans.compute("billed_by_term", inputs, feeds.AS_OF).where("dias = '0-30'")
    assert [float(r.total_facturado) for r in billed.collect()] == [3.0, 3.0]
    counted = plans.compute("clients_by_term", inputs, feeds.AS_OF).where("dias = '0-30'")
    assert [r.no_clientes for r in counted.collect()] == [1, 1]
    left = plans.rejects("billed_by_term", inputs)
    assert rows(left["annex_items"].select("reason")) == [("missing comision",), ("missing dias_pago",)]
    assert [(r.cliente_id, r.reason) for r in left["annex_feed"].collect()] == [(7, "unreadable")]


def test_no_driver_side_work_in_the_package():
    banned = r"\.collect\(|toPandas|\.rdd\b|localCheckpoint|udf|crossJoin|toLocalIterator|\.cache\(|\.persist\("
    for file in (f for f in (ROOT / "anticipa").rglob("*.py") if f.parent.name != "llm"):  # Python is at home there
        text = file.read_text()
        assert not re.search(banned, text), file
        assert "broadcast(" not in text, file


def test_day_partition_is_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    state = feeds.credit_days_state(spark, FOLDER).withColumn("snapshot_date", F.to_date("created_at"))
    state.write.partitionBy("snapshot_date").parquet(path)
    plan = final_plan(op.todays_rows(spark.read.parquet(path), feeds.AS_OF))
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date.*snapshot_date.* = 2001-08-01", plan)


def hot(spark, tmp_path, share_of_rows=0.4):
    """The tables with one order owning a large share of all lines, and one client of all orders."""
    folder = tmp_path / "hot"
    for table in ("orders", "lineitem", "customer", "supplier"):
        df = spark.read.parquet(f"/root/testdata/sf0.01/{table}.parquet")
        if table == "lineitem":
            df = df.withColumn("l_orderkey", F.when(F.rand(1) < share_of_rows, 1).otherwise(F.col("l_orderkey")))
        if table == "orders":
            df = df.withColumn("o_custkey", F.when(F.rand(2) < share_of_rows, 3).otherwise(F.col("o_custkey")))
        df.repartition(8).write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


def test_hot_order_and_hot_client(spark, conf, tmp_path):
    folder = hot(spark, tmp_path)
    names = ["rate_indicators", "billed_by_term", "clients_by_term", "credit_days", "pareto_client_commission", "annex_indicators"]
    want = {n: rows(QUERIES[n](spark, folder)) for n in names}
    conf(
        autoBroadcastJoinThreshold="-1",
        files__maxPartitionBytes="100KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    for name in names:
        df = QUERIES[name](spark, folder)
        assert rows(df) == want[name]
        # The hot order's lines are split over several tasks.
        assert ("skew=true" in final_plan(df)) == (name != "annex_indicators")


def test_much_copied_dashboard_key(spark, conf):
    """Copies of a key meet its computed row in slices of bounded size."""
    conf(autoBroadcastJoinThreshold="-1")
    today = spark.range(30000).select(
        "id", F.when(F.col("id") < 20000, "CLIENTE-1").otherwise(F.concat(F.lit("CLIENTE-"), "id")).alias("id_analisis")
    )
    computed = spark.createDataFrame(
        [("CLIENTE-1", "a", 1.0), ("CLIENTE-2", "b", 2.0)], "id_analisis string, cliente string, v double"
    )
    for slices in (1, 32, 4096):
        plan = op.plan_merge(computed, today, ["id_analisis"], slices=slices)
        assert {r.action: r["count"] for r in plan.groupBy("action").count().collect()} == {
            "update": 1, "insert": 1, "delete": 19999, "keep": 10000,
        }
        assert plan.select("id").distinct().count() == 30001
        text = final_plan(plan)
        assert "Window" not in text and re.search(r"hashpartitioning\(id_analisis#\d+, _slice#\d+", text)


@pytest.mark.parametrize("keys", [("id_analisis",), ("id_analisis", "dias")])
def test_merge_reads_the_day_once_and_forces_no_broadcast(spark, conf, tmp_path, keys):
    conf(autoBroadcastJoinThreshold="-1")
    n = F.col("id") % 700
    today = spark.range(5000).select(
        "id", F.when(n < 600, n.cast("string")).alias("id_analisis"), F.lit("x").alias("dias"), F.col("id").alias("v"),
    )
    today.repartition(3).write.parquet(f"{tmp_path}/today")
    computed = spark.range(500, 900).select(F.col("id").cast("string").alias("id_analisis"), F.lit("x").alias("dias"), (-n).alias("v"))
    computed.write.parquet(f"{tmp_path}/computed")
    today, computed = spark.read.parquet(f"{tmp_path}/today"), spark.read.parquet(f"{tmp_path}/computed")
    plan = op.plan_merge(computed, today, keys)
    text = final_plan(plan)
    assert text.count("FileScan") == 2 and text.count("ReusedExchange") == 1  # the day's and the computed rows
    assert "Broadcast" not in text and "Window" not in text
    counts = {r.action: r["count"] for r in plan.groupBy("action").count().collect()}
    present = [(i, i % 700) for i in range(5000)]
    again = [i for i, k in present if 500 <= k < 600]
    assert counts == {"insert": 300, "update": 100, "delete": len(again) - 100, "keep": 5000 - len(again)}
