"""Writing state: day snapshots, the table sync, and refreshes on arrival."""

from datetime import date, datetime
from decimal import Decimal
from uuid import uuid4

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from anticipa import operators as op
from anticipa import schemas
from anticipa.plans import DASHBOARDS, JOBS, compute, refresh, refresh_all
from anticipa.sources import Table
from anticipa.sources import order_feeds as feeds
from anticipa.streaming import refresh_on_arrival
from helpers import final_plan, rows

FOLDER = "/root/testdata/sf0.001"
D1, D2 = date(2024, 3, 5), date(2024, 3, 6)
DAYS = DASHBOARDS["indicadores_dias_credito_dashboard"]


def days(spark, *data):
    return spark.createDataFrame(list(data), "id_analisis string, cliente string, dias_promedio double")


def state(spark, *data):
    return spark.createDataFrame(
        list(data), "id long, id_analisis string, cliente string, dias_promedio double, created_at timestamp_ntz"
    )


def read(spark, path):
    return rows(spark.read.parquet(path).select("snapshot_date", "id_analisis", "cliente", "dias_promedio", "created_at"))


def test_snapshots_over_two_days(spark, tmp_path):
    path = str(tmp_path / "t")
    midnight = [datetime(2024, 3, 5), datetime(2024, 3, 6)]
    assert op.apply_merge(spark, days(spark, ("A", "a", 1.0), ("B", "b", 2.0)), DAYS, path, D1) == {
        "insert": 2, "update": 0, "delete": 0, "keep": 0,
    }
    ids = rows(spark.read.parquet(path).select("id_analisis", "id"))

    # The same again changes nothing; a renamed client keeps the old label, a vanished key stays.
    again = op.apply_merge(spark, days(spark, ("A", "other", 5.0), ("C", "c", 3.0)), DAYS, path, D1)
    assert again == {"insert": 1, "update": 1, "delete": 0, "keep": 1}
    first_day = [
        (D1, "A", "a", 5.0, midnight[0]),
        (D1, "B", "b", 2.0, midnight[0]),
        (D1, "C", "c", 3.0, midnight[0]),
    ]
    assert read(spark, path) == first_day
    assert rows(spark.read.parquet(path).where("id_analisis < 'C'").select("id_analisis", "id")) == ids

    assert op.apply_merge(spark, days(spark, ("A", "a", 9.0)), DAYS, path, D2)["insert"] == 1
    assert read(spark, path) == first_day + [(D2, "A", "a", 9.0, midnight[1])]


def test_refresh_twice_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    computed = days(spark, *[(f"CLIENTE-{i}", f"n{i}", float(i)) for i in range(50)])
    op.apply_merge(spark, computed, DAYS, path, D1)
    before = rows(spark.read.parquet(path))
    assert op.apply_merge(spark, computed, DAYS, path, D1) == {"insert": 0, "update": 50, "delete": 0, "keep": 0}
    assert rows(spark.read.parquet(path)) == before


def test_nothing_computed(spark, tmp_path):
    path = str(tmp_path / "t")
    nothing = {"insert": 0, "update": 0, "delete": 0, "keep": 0}
    assert op.apply_merge(spark, days(spark), DAYS, path, D1) == nothing
    op.apply_merge(spark, days(spark, ("A", "a", 1.0)), DAYS, path, D1)
    before = read(spark, path)
    for empty in (days(spark), days(spark, ("B", "b", 2.0)).where("1 = 0"), days(spark, ("B", "b", 2.0)).where("cliente = 'x'")):
        assert op.apply_merge(spark, empty, DAYS, path, D1) == {**nothing, "keep": 1}
    assert op.apply_merge(spark, days(spark), DAYS, path, D2) == nothing
    assert read(spark, path) == before


def test_copies_collapse_or_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    noon = datetime(2024, 3, 5, 12)
    old = state(
        spark,
        *[(i, "A", "a", float(i), noon) for i in range(7, 300)],
        *[(i, "Z", "z", float(i), noon) for i in range(1000, 1003)],
        (1, "A", "a", 0.0, datetime(2024, 3, 4, 12)),
    )
    old.withColumn("snapshot_date", F.to_date("created_at")).write.partitionBy("snapshot_date").parquet(path)
    assert op.apply_merge(spark, days(spark, ("A", "new", 4.5)), DAYS, path, D1) == {
        "insert": 0, "update": 1, "delete": 292, "keep": 3,
    }
    got = rows(spark.read.parquet(path).where(F.col("snapshot_date") == D1).select("id", "id_analisis", "dias_promedio", "created_at"))
    assert got == [(1000, "Z", 1000.0, noon), (1001, "Z", 1001.0, noon), (1002, "Z", 1002.0, noon), (7, "A", 4.5, noon)]
    assert spark.read.parquet(path).where(F.col("snapshot_date") < D1).count() == 1


def test_a_failed_refresh_leaves_the_table_as_it_was(spark, tmp_path):
    path = str(tmp_path / "t")
    op.apply_merge(spark, days(spark, ("A", "a", 1.0)), DAYS, path, D1)
    before = rows(spark.read.parquet(path))
    broken = days(spark, ("A", "a", 2.0), ("B", "b", 3.0)).where(
        F.when(F.col("id_analisis") == "A", True).otherwise(F.raise_error(F.lit("lost")).cast("boolean"))
    )
    with pytest.raises(PySparkException, match="lost"):
        op.apply_merge(spark, broken, DAYS, path, D1)
    assert rows(spark.read.parquet(path)) == before
    assert op.apply_merge(spark, days(spark, ("A", "a", 2.0)), DAYS, path, D1)["update"] == 1


def test_pareto_keeps_every_rate_and_name(spark, tmp_path):
    dashboard = DASHBOARDS["parreto_clientes_comision"]
    path = str(tmp_path / "t")
    schema = "id_analisis string, cliente string, tasa_cliente int, importe decimal(28,4)"
    computed = spark.createDataFrame(
        [("CLIENTE-1", "x", 1, Decimal(5)), ("CLIENTE-1", "x", 2, Decimal(6)), ("CLIENTE-1", "y", 2, Decimal(7))], schema
    )
    for _ in range(2):
        op.apply_merge(spark, computed, dashboard, path, D1)
    assert rows(spark.read.parquet(path).select(*computed.columns)) == rows(computed)


def test_a_renamed_client_does_not_count_twice(spark, tmp_path):
    dashboard = DASHBOARDS["parreto_clientes_comision"]
    path = str(tmp_path / "t")
    schema = "id_analisis string, cliente string, tasa_cliente int, importe decimal(28,4)"
    before = [("CLIENTE-1", "Old", 1, Decimal(5)), ("CLIENTE-1", "Old", 2, Decimal(6)), ("CLIENTE-2", "Z", 1, Decimal(7))]
    after = [("CLIENTE-1", "New", 1, Decimal(5)), ("CLIENTE-1", "New", 2, Decimal(6))]
    op.apply_merge(spark, spark.createDataFrame(before, schema), dashboard, path, D1)
    done = op.apply_merge(spark, spark.createDataFrame(after, schema), dashboard, path, D1)
    assert done == {"insert": 2, "update": 0, "delete": 2, "keep": 1}
    assert rows(spark.read.parquet(path).select(*schema.replace(",", " ").split()[0:6:2], "importe")) == sorted(after + before[2:])


@pytest.fixture(scope="module")
def inputs(spark):
    return {
        t: getattr(feeds, t)(spark, FOLDER) for t in ("invoices", "annexes", "annex_feed", "clients")
    }


@pytest.mark.parametrize("name", JOBS)
def test_every_job_refreshes_its_dashboard(spark, tmp_path, inputs, name):
    dashboard = DASHBOARDS[JOBS[name].dashboard]
    computed = compute(name, inputs, feeds.AS_OF, strict=True)
    count = computed.count()
    done = refresh(spark, name, inputs, str(tmp_path), feeds.AS_OF)
    assert done == {"insert": count, "update": 0, "delete": 0, "keep": 0} and count > 0
    stored = spark.read.parquet(f"{tmp_path}/{dashboard.name}")
    assert set(stored.columns) == {*dashboard.columns, "snapshot_date"}
    columns = [c for c in computed.columns if c in stored.columns]
    assert rows(stored.select(columns)) == rows(computed.select(columns))


def test_portfolio_and_client_refreshes_share_a_table(spark, tmp_path, inputs):
    refresh(spark, "credit_days_all", inputs, str(tmp_path), feeds.AS_OF)
    done = refresh(spark, "credit_days_by_client", inputs, str(tmp_path), feeds.AS_OF)
    assert done["keep"] == 1 and done["update"] == 0
    done = refresh(spark, "credit_days", inputs, str(tmp_path), feeds.AS_OF)
    assert done["keep"] == done["insert"] == done["delete"] == 0 and done["update"] > 1


def test_number_of_spark_jobs_does_not_grow_with_clients(spark, tmp_path):
    counts = []
    for scale in ("sf0.001", "sf0.01"):
        tables = {t: getattr(feeds, t)(spark, f"/root/testdata/{scale}") for t in ("invoices", "clients")}
        group = f"refresh-{scale}-{uuid4()}"
        spark.sparkContext.setJobGroup(group, group)
        refresh(spark, "rate_indicators_by_client", tables, f"{tmp_path}/{scale}", feeds.AS_OF)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
    assert counts[0] == counts[1] > 0


COMBINED = [n for n in JOBS if not n.endswith(("_all", "_by_client"))]


def test_refresh_all_equals_the_single_refreshes(spark, tmp_path, inputs):
    """Also where fields are missing, which leaves an invoice out of some figures only."""
    whole = inputs["invoices"]
    gaps = {
        "tasa_descuento": F.col("tasa_descuento") != 4,
        "dias_pago": F.col("dias_pago") < 70,
        "cant_comision": F.col("cant_comision") > 500,
        "nombre_fiscal": ~F.col("nombre_fiscal").endswith("8"),
        "cliente_id": F.col("factura_id") != 1,
    }
    holes = whole.select(*[F.when(gaps[c], F.col(c)).alias(c) if c in gaps else c for c in whole.columns])
    for name, invoices in (("whole", whole), ("holes", holes)):
        tables = {**inputs, "invoices": invoices}
        single, together = f"{tmp_path}/{name}/single", f"{tmp_path}/{name}/together"
        done = {JOBS[j].dashboard: refresh(spark, j, tables, single, feeds.AS_OF) for j in COMBINED}
        assert refresh_all(spark, tables, together, feeds.AS_OF) == done and set(done) == set(DASHBOARDS)
        for dashboard in DASHBOARDS:
            columns = spark.read.parquet(f"{single}/{dashboard}").columns
            assert rows(spark.read.parquet(f"{together}/{dashboard}").select(columns)) == rows(
                spark.read.parquet(f"{single}/{dashboard}").select(columns)
            )


USERS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.USERS)
TARGET = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.USERS_TARGET)


def test_sync(spark, tmp_path):
    source = spark.createDataFrame(
        [("new", "n@x", "on", None), ("both", "b@x", None, "P"), ("twice", "1@x", "a", "b"), ("twice", "2@x", "c", "d"),
         ("lost", "1@x", "a", "b"), ("lost", "1@x", "a", "b")],
        USERS,
    )
    target = spark.createDataFrame(
        [(1, "both", "old", "old", "old"), (2, "both", "old", "old", "old"), (3, "gone", "g", "g", "g"), (4, "gone", "g", "g", "g"),
         (5, "twice", "t", "t", "t"), (6, "twice", "u", "u", "u")],
        TARGET,
    )
    assert rows(op.plan_sync(source, target)) == sorted(
        [
            ("new", None, "insert", "n@x", "on", None),
            ("both", 1, "update", "b@x", None, "P"),
            ("both", 2, "delete", None, None, None),
            ("gone", 3, "delete", None, None, None),
            ("gone", 4, "delete", None, None, None),
            ("twice", 5, "keep", None, None, None),
            ("twice", 6, "delete", None, None, None),
        ],
        key=repr,
    )
    assert rows(op.rejected_users(source)) == [("lost", 2, "repeated id"), ("twice", 2, "repeated id")]
    path = str(tmp_path / "users")
    op.apply_sync(source, target, path)
    got = spark.read.parquet(path)
    assert rows(got.drop("id")) == sorted(
        [("new", "n@x", "on", None), ("both", "b@x", None, "P"), ("twice", "t", "t", "t")], key=repr
    )
    # A second sync of the synced table only updates.
    assert {r.action for r in op.plan_sync(source, got).collect()} == {"update", "keep"}


def test_sync_of_much_copied_ids(spark):
    """A third of each side under one id: no window, no collected group, copies told apart by row id."""
    source = spark.range(9000).select(
        F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("m").alias("email"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast("string").alias("license_plates"),
    )
    target = spark.range(9000).select(
        "id",
        F.when(F.col("id") < 3000, "hot2").otherwise(F.col("id").cast("string")).alias("id_user_sb"),
        *[F.lit("old").alias(c) for c in ("email", "status", "license_plates")],
    )
    actions = op.plan_sync(source, target)
    assert {r.action: r["count"] for r in actions.groupBy("action").count().collect()} == {"update": 6000, "delete": 3000}
    assert "Window" not in final_plan(actions)
    assert op.synced(actions, target).where("email <> 'm'").count() == 0


def test_sync_into_an_empty_target(spark):
    source = spark.createDataFrame([("a", "a@x", None, None)], USERS)
    assert rows(op.plan_sync(source, spark.createDataFrame([], TARGET))) == [("a", None, "insert", "a@x", None, None)]


def test_refresh_on_arrival(spark, tmp_path):
    """Arrived rows change the figure: the inputs are read anew for each batch."""
    arrivals, out, name = str(tmp_path / "arrivals"), str(tmp_path / "out"), f"annexes-{uuid4()}"
    annexes = spark.range(3).select(
        F.col("id").alias("anexo_id"), F.lit(1).cast("long").alias("cliente_id"), F.lit("s").alias("estatus"),
        F.lit(4).alias("estatus_id"), F.lit("2001-08-01T00:00:00Z").alias("created_at"),
    )
    done = []

    def run(found):
        done.append(refresh(spark, "annex_indicators_all", found, out, feeds.AS_OF))

    def trigger():
        stream = spark.readStream.schema(schemas.ANNEXES).parquet(arrivals)
        tables = {"annexes": Table(arrivals)}
        refresh_on_arrival(stream, tables, run, name, once=True).awaitTermination()
        return [r.pagados for r in spark.read.parquet(f"{out}/indicadores_anexos_dashboard").collect()]

    annexes.write.parquet(arrivals)
    assert trigger() == [3] and trigger() == [3]
    assert [d["insert"] for d in done] == [1]
    annexes.limit(2).write.mode("append").parquet(arrivals)
    assert trigger() == [5]
    assert [d["update"] for d in done] == [0, 1]
