"""Merge, sync and charts against plain Python over random small tables."""

from collections import Counter, defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from anticipa import operators as op
from anticipa import schemas
from helpers import rows

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
KEYS = st.sampled_from("ABCDE")
TARGET = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.USERS_TARGET)
USERS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.USERS)


@few
@given(
    st.dictionaries(st.tuples(KEYS, st.integers(0, 2)), st.integers(0, 9), max_size=8),
    st.lists(st.tuples(KEYS, st.integers(0, 2)), max_size=30),
    st.sampled_from([1, 2, 8]),
)
def test_merge(spark, computed, present, slices):
    today = [(i, *key) for i, key in enumerate(present)]
    ids = defaultdict(list)
    for i, *key in today:
        ids[tuple(key)].append(i)
    want = [(None, *k, v, "insert") for k, v in computed.items() if k not in ids]
    for key, found in ids.items():
        if key in computed:
            want += [(i, *key, computed[key], "update" if i == min(found) else "delete") for i in found]
        else:
            want += [(i, *key, None, "keep") for i in found]
    got = op.plan_merge(
        spark.createDataFrame([(*k, v) for k, v in computed.items()], "id_analisis string, dias int, v int"),
        spark.createDataFrame(today, "id long, id_analisis string, dias int"),
        ["id_analisis", "dias"],
        slices=slices,
    )
    assert rows(got) == sorted(want, key=repr)


@few
@given(
    st.lists(st.tuples(KEYS, st.sampled_from([None, "x", "y"])), max_size=8),
    st.lists(KEYS, max_size=12),
)
def test_sync(spark, users, present):
    source = [(k, mail, mail, None) for k, mail in users]
    target = [(i, k, f"old{i}", None, "p") for i, k in enumerate(present)]
    times, mails = Counter(k for k, _ in users), dict(users)
    usable = {k for k in times if times[k] == 1 and mails[k] is not None}
    first = {k: present.index(k) for k in set(present)}
    state = [(k, mails[k], mails[k], None) for k in usable]
    state += [(k, f"old{i}", None, "p") for k, i in first.items() if k in times and k not in usable]
    frames = spark.createDataFrame(source, USERS), spark.createDataFrame(target, TARGET)
    actions = op.plan_sync(*frames)
    assert rows(op.synced(actions, frames[1]).drop("id")) == sorted(state, key=repr)
    touched = Counter(r.target_id for r in actions.collect() if r.target_id is not None)
    assert touched == Counter(range(len(present)))
    assert {r.id for r in op.rejected_users(frames[0]).collect()} == set(times) - usable


def bucket(days):
    limits = [("0-30", 0, 30), ("31-45", 30, 45), ("46-89", 45, 89), ("90", 89, 90), (">90", 90, 10**9)]
    return next((label for label, low, high in limits if low < days <= high), None)


@few
@given(
    st.lists(st.tuples(st.integers(1, 4), st.integers(-2, 95), st.integers(0, 10**6)), max_size=25),
    st.sets(st.integers(1, 5), max_size=4),
)
def test_charts(spark, items, known):
    facts = spark.createDataFrame(
        [(1, c, Decimal(m).scaleb(-4), d, "") for c, d, m in items],
        "anexo_id long, cliente_id long, comision decimal(18,4), dias_pago int, created_at string",
    )
    people = spark.createDataFrame([(c, str(c)) for c in known], "cliente_id long, nombre_fiscal string")
    labels = ["0-30", "31-45", "46-89", "90", ">90"]
    keys = {("TODOS", "Todos"): {c for c, *_ in items}} | {(f"CLIENTE-{c}", str(c)): {c} for c in known}
    billed, counted = [], []
    for key, members in keys.items():
        for label in labels:
            mine = [(c, m) for c, d, m in items if c in members and bucket(d) == label]
            billed.append((*key, label, Decimal(sum(m for _, m in mine)).scaleb(-4).quantize(Decimal("1.0000"))))
            counted.append((*key, label, len({c for c, _ in mine})))
    assert rows(op.billed_by_term(facts, people)) == sorted(billed, key=repr)
    assert rows(op.clients_by_term(facts, people)) == sorted(counted, key=repr)
