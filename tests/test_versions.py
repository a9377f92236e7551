"""Versioned dashboards: the day is switched in one step, or not at all."""

import json
import threading
from datetime import date

import pytest

from anticipa import operators as op
from anticipa.operators import versions
from anticipa.plans import DASHBOARDS, refresh, refresh_all
from anticipa.sources import order_feeds as feeds
from helpers import rows

DAYS = DASHBOARDS["indicadores_dias_credito_dashboard"]
TYPES = {"id_analisis": "string", "dias_promedio": "double"}
D1, D2 = date(2024, 3, 5), date(2024, 3, 6)


def days(spark, *data):
    return spark.createDataFrame(list(data), "id_analisis string, cliente string, dias_promedio double")


def merge(spark, path, day, *data):
    return op.apply_merge_versioned(spark, days(spark, *data), DAYS, path, day)


def table(spark, path, version=None):
    return rows(op.read_version(spark, DAYS, path, TYPES, version).select("snapshot_date", "id_analisis", "dias_promedio"))


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert table(spark, path) == []
    assert merge(spark, path, D1, ("A", "a", 1.0), ("B", "b", 2.0)) == {"insert": 2, "update": 0, "delete": 0, "keep": 0}
    assert merge(spark, path, D2, ("A", "a", 9.0))["insert"] == 1
    assert merge(spark, path, D1, ("A", "x", 5.0)) == {"insert": 0, "update": 1, "delete": 0, "keep": 1}
    assert table(spark, path) == [(D1, "A", 5.0), (D1, "B", 2.0), (D2, "A", 9.0)]
    assert table(spark, path, 1) == [(D1, "A", 1.0), (D1, "B", 2.0)]
    with pytest.raises(ValueError, match="no version 9"):
        table(spark, path, 9)
    assert set(op.read_version(spark, DAYS, path, TYPES).columns) == {*DAYS.columns, "snapshot_date"}


@pytest.mark.parametrize("where", ["before the write", "between write and switch"])
def test_a_crash_leaves_the_version_before(spark, tmp_path, monkeypatch, where):
    path = str(tmp_path / "t")
    merge(spark, path, D1, ("A", "a", 1.0))

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(versions, "put_new" if "switch" in where else "merge_counts", dies)
        with pytest.raises(KeyboardInterrupt):
            merge(spark, path, D1, ("A", "a", 2.0), ("B", "b", 3.0))
    assert table(spark, path) == [(D1, "A", 1.0)] and op.current(spark, path)[0] == 1
    assert merge(spark, path, D1, ("A", "a", 4.0))["update"] == 1
    assert table(spark, path) == [(D1, "A", 4.0)]


def interrupted_by(monkeypatch, other):
    """Run `other` when the next refresh has written its rows and is about to switch."""
    put = versions.put_new

    def late(*args):
        monkeypatch.setattr(versions, "put_new", put)
        other()
        return put(*args)

    monkeypatch.setattr(versions, "put_new", late)


def test_the_second_refresh_of_a_day_fails_and_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    merge(spark, path, D1, ("A", "a", 1.0))
    interrupted_by(monkeypatch, lambda: merge(spark, path, D1, ("A", "a", 2.0), ("B", "b", 2.0)))
    with pytest.raises(op.ConcurrentRefresh, match="2024-03-05"):
        merge(spark, path, D1, ("A", "a", 3.0), ("C", "c", 3.0))
    assert table(spark, path) == [(D1, "A", 2.0), (D1, "B", 2.0)]
    assert merge(spark, path, D1, ("A", "a", 3.0), ("C", "c", 3.0)) == {"insert": 1, "update": 1, "delete": 0, "keep": 1}


def test_refreshes_of_two_days_both_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    interrupted_by(monkeypatch, lambda: merge(spark, path, D2, ("A", "a", 2.0)))
    merge(spark, path, D1, ("A", "a", 1.0))
    assert table(spark, path) == [(D1, "A", 1.0), (D2, "A", 2.0)] and op.current(spark, path)[0] == 2


def test_only_one_of_many_writers_puts_a_version(spark, tmp_path):
    (tmp_path / "log").mkdir()
    won, barrier = [], threading.Barrier(8)

    def put(i):
        barrier.wait()
        if versions.put_new(spark, f"{tmp_path}/log/1.json", json.dumps(i)):
            won.append(i)

    writers = [threading.Thread(target=put, args=(i,)) for i in range(8)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert len(won) == 1 and json.loads((tmp_path / "log/1.json").read_text()) == won[0]
    assert [f.name for f in (tmp_path / "log").iterdir() if not f.name.endswith(".crc")] == ["1.json"]


def test_what_no_version_names_can_be_dropped(spark, tmp_path):
    path = str(tmp_path / "t")
    for value in (1.0, 2.0, 3.0):
        merge(spark, path, D1, ("A", "a", value))
    assert op.drop_unnamed(spark, path, keep=1) == 0  # too young
    assert op.drop_unnamed(spark, path, keep=1, older_than_hours=-1) == 2
    assert table(spark, path) == [(D1, "A", 3.0)] and merge(spark, path, D1, ("A", "a", 4.0))["update"] == 1


def test_versioned_refreshes_equal_plain_ones(spark, tmp_path):
    inputs = {t: getattr(feeds, t)(spark, "/root/testdata/sf0.001") for t in ("invoices", "annexes", "annex_feed", "clients")}
    plain = refresh_all(spark, inputs, f"{tmp_path}/plain", feeds.AS_OF)
    assert refresh_all(spark, inputs, f"{tmp_path}/versions", feeds.AS_OF, versioned=True) == plain
    again = refresh(spark, "credit_days", inputs, f"{tmp_path}/versions", feeds.AS_OF, versioned=True)
    assert again["update"] == plain[DAYS.name]["insert"]
    columns = [*DAYS.columns, "snapshot_date"]
    got = op.read_version(spark, DAYS, f"{tmp_path}/versions/{DAYS.name}", TYPES)
    assert rows(got.select(columns)) == rows(spark.read.parquet(f"{tmp_path}/plain/{DAYS.name}").select(columns))
