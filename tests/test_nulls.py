"""Rows with nulls are kept, rejected or left out of a mean, and never lost."""

import random
from collections import Counter
from uuid import uuid4

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anticipa import operators as op
from anticipa import sources
from anticipa.sources import Table
from anticipa.operators import sync
from anticipa.operators.snapshot import Dashboard
from datetime import date, datetime
from helpers import rows

USERS = "id string, email string, status string, license_plates string"
TARGET = "id long, id_user_sb string, email string, status string, license_plates string"


def test_unreadable_target_rows_stay(spark):
    source = spark.createDataFrame([("b", None, None, None), ("c", "c@x", "on", None)], USERS)
    target = spark.createDataFrame([(None, "b", "kept", None, None), (4, None, "whose", None, None), (5, "gone", "g", None, None)], TARGET)
    plan = op.plan_sync(source, target)
    assert Counter(r["action"] for r in plan.collect()) == {"keep": 2, "delete": 1, "insert": 1}
    after = {(r["id_user_sb"], r["email"]) for r in op.synced(plan, target).collect()}
    assert after == {("b", "kept"), (None, "whose"), ("c", "c@x")}


def json_target(spark, tmp_path, *lines):
    (tmp_path / "target.json").write_text("\n".join(lines))
    return sources.users_target(spark, Table(str(tmp_path / "target.json"), "json"))


def test_a_user_with_an_unreadable_row_id_is_not_inserted_again(spark, tmp_path):
    lines = ['{"id":"bad-id","id_user_sb":"b","email":"old"}', "no json at all", '{"id":3,"id_user_sb":"c","email":"c"}', '{"id":4,"id_user_sb":"b2"}', '{"id":{},"id_user_sb":"b2"}']
    target = json_target(spark, tmp_path, *lines)
    source = spark.createDataFrame([("b", "b@x", None, None), ("b2", "b2@x", None, None), ("d", "d@x", None, None)], USERS)
    assert rows(op.plan_sync(source, target).select("id", "target_id", "action")) == sorted(
        [("b", None, "keep"), ("b2", 4, "update"), ("b2", None, "keep"), ("c", 3, "delete"), ("d", None, "insert")], key=repr
    )
    assert rows(op.rejected_users(source, target)) == [("b", 1, "unreadable target row")]
    with pytest.raises((PySparkException, Py4JJavaError), match="dead letters"):
        op.apply_sync(source, target, str(tmp_path / "none"))
    done = op.apply_sync(source, target, str(tmp_path / "new"), str(tmp_path / "letters"))
    assert done == {"insert": 1, "update": 1, "delete": 1, "keep": 2}
    after = spark.read.parquet(str(tmp_path / "new"))
    assert rows(after.select("id_user_sb", "email")) == sorted([("b", "old"), ("b2", "b2@x"), ("b2", None), ("d", "d@x")], key=repr)
    assert rows(op.synced(op.plan_sync(source, target), target)) == rows(after)
    letters = spark.read.json(str(tmp_path / "letters"))
    assert rows(letters.select("reason", "text")) == sorted(
        [("unreadable row id", lines[0]), ("unreadable", lines[1]), ("unreadable row id", lines[4])], key=repr
    )
    # The kept row has no row id in the new table either: still nobody is inserted twice.
    assert op.plan_sync(source, after).where("action = 'insert'").count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_no_user_twice_and_no_text_lost(spark, tmp_path, seed):
    """Random JSON lines, good, broken and unreadable, against the sync said plainly."""
    draw = random.Random(seed)
    users = [f"u{i}" for i in range(12)]
    lines, held, readable, bad = [], Counter(), Counter(), 0
    for i in range(30):
        user, kind = draw.choice(users), draw.randrange(4)
        lines.append(['{"id":%d,"id_user_sb":"%s"}' % (i, user), '{"id":"x%d","id_user_sb":"%s"}' % (i, user), "{broken %d" % i, '{"id":%d}' % i][kind])
        bad += kind in (1, 2)
        held[user] += kind < 2
        readable[user] += kind == 0
    source = [(u, "e", None, None) for u in users if draw.random() < 0.7]
    target = json_target(spark, tmp_path, *lines)
    op.apply_sync(spark.createDataFrame(source, USERS), target, str(tmp_path / "new"), str(tmp_path / "letters"))
    after = Counter(r["id_user_sb"] for r in spark.read.parquet(str(tmp_path / "new")).collect() if r["id_user_sb"])
    names = {u for u, *_ in source}
    for user in users:
        unreadable = held[user] - readable[user]
        alone = user in names and (readable[user] > 0 or not held[user])
        assert after[user] == unreadable + alone
    assert spark.read.json(str(tmp_path / "letters")).count() == bad


def test_planning_a_sync_starts_no_job_and_reads_each_side_once(spark, tmp_path):
    spark.range(50).selectExpr("CAST(id % 40 AS STRING) id", "'e' email", "'s' status", "'p' license_plates").write.parquet(f"{tmp_path}/s")
    spark.range(50).selectExpr("id", "CAST(id % 30 AS STRING) id_user_sb", "'e' email", "'s' status", "'p' license_plates").write.parquet(f"{tmp_path}/t")
    source, target = sources.users(spark, Table(f"{tmp_path}/s")), sources.users_target(spark, Table(f"{tmp_path}/t"))
    group = f"plan-{uuid4()}"
    spark.sparkContext.setJobGroup(group, group)
    plans = op.plan_sync(source, target), sync._after(sync._matched(source, target))
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for plan in plans:
            plan.collect()
            text = plan._jdf.queryExecution().executedPlan().toString()
            scans, skipped = [], None  # of final plans only; those made first stand below, as far to the right
            for line in text.splitlines():
                at = len(line) - len(line.lstrip(" :+-*"))
                if "== Initial Plan ==" in line:
                    skipped = at if skipped is None else min(at, skipped)
                elif skipped is not None and at < skipped:
                    skipped = None
                scans += [line] if skipped is None and "FileScan" in line else []
            assert [sum(f"{tmp_path}/{side}]" in x for x in scans) for side in "st"] == [1, 1], text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_source_rows_without_id_are_rejects_and_block_deletes(spark):
    source = spark.createDataFrame([(None, "a@x", None, None), ("c", "c@x", "on", None)], USERS)
    target = spark.createDataFrame([(1, "a", "old", None, None), (2, "c", "c@old", None, None)], TARGET)
    assert rows(op.rejected_users(source)) == [(None, 1, "missing id")]
    plan = op.plan_sync(source, target)
    assert {(r["id"], r["action"]) for r in plan.collect()} == {("a", "keep"), ("c", "update")}
    assert {(r["id_user_sb"], r["email"]) for r in op.synced(plan, target).collect()} == {("a", "old"), ("c", "c@x")}


@pytest.mark.parametrize("seed", range(3))
def test_every_target_row_is_updated_kept_or_deleted(spark, seed):
    some = lambda k, n: F.when(F.rand(seed * 10 + k) < 0.2, None).otherwise((F.rand(seed * 10 + k + 1) * n).cast("long").cast("string"))
    nothing = [F.lit(None).cast("string").alias(c) for c in ("status", "license_plates")]
    source = spark.range(30).select(some(1, 20).alias("id"), some(3, 9).alias("email"), *nothing).cache()
    target = spark.range(60).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"), some(5, 25).alias("id_user_sb"), F.lit("e").alias("email"), *nothing
    ).cache()
    actions = Counter(r["action"] for r in op.plan_sync(source, target).collect())
    assert actions["update"] + actions["keep"] + actions["delete"] == target.count()
    after = op.synced(op.plan_sync(source, target), target)
    assert after.count() == target.count() - actions["delete"] + actions["insert"]


def test_dashboard_rows_with_a_null_key_stay(spark):
    board = Dashboard("d", ("id_analisis",), ("dias_promedio",))
    at = datetime(2024, 3, 5, 1)
    today = spark.createDataFrame(
        [(1, "TODOS", "Todos", 3.0, at), (2, None, "lost", 4.0, at)],
        "id long, id_analisis string, cliente string, dias_promedio double, created_at timestamp_ntz",
    )
    computed = spark.createDataFrame([("TODOS", "Todos", 9.0)], "id_analisis string, cliente string, dias_promedio double")
    actions = {(r["id"], r["action"]) for r in op.plan_merge(computed, today, ["id_analisis"]).collect()}
    assert actions == {(1, "update"), (2, "keep")}
    day = op.merged_day(computed, today, board, date(2024, 3, 5))
    assert {(r["id"], r["id_analisis"], r["dias_promedio"]) for r in day.collect()} == {(1, "TODOS", 9.0), (2, None, 4.0)}


def test_mean_rate_without_null_rates(spark):
    invoices = spark.createDataFrame([(1, "a", 4), (2, "a", None)], "factura_id long, cliente_id string, tasa_descuento long")
    row = op.rate_indicators_all(invoices.withColumn("tasa_descuento", F.col("tasa_descuento").cast("decimal(6,3)"))).first()
    assert float(row["media"]) == 4.0
