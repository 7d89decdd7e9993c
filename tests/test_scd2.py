from datetime import date

import pytest
from pyspark.sql import functions as F

from aerolith.operators import scd2

SCHEMA = "id string, name string, area string, lat double, note string"
D1, D2, D3 = date(2026, 1, 1), date(2026, 2, 1), date(2026, 3, 1)
TRACKED = ["name", "area", "lat"]


def snap(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(
        (r.id, r.key, r.name, r.area, r.lat, r.note, r.effective_date, r.expiry_date, r.is_current)
        for r in df.collect()
    )


def base(spark):
    s1 = snap(spark, [("a", "A", "X", 1.0, "n1"), ("b", "B", "Y", 2.0, "n1"), ("c", "C", None, 3.0, "n1")])
    return scd2.first_load(s1, "id", "key", D1)


def check_invariants(dim):
    rows = dim.collect()
    cur = {}
    for r in rows:
        if r.is_current:
            assert r.id not in cur, "two current versions"
            cur[r.id] = r
    by_id = {}
    for r in rows:
        by_id.setdefault(r.id, []).append((r.effective_date, r.expiry_date))
    for spans in by_id.values():
        spans.sort()
        for (s0, e0), (s1, _e1) in zip(spans, spans[1:]):
            assert e0 <= s1, "overlapping versions"
        for s, e in spans:
            assert s < e, "empty version"
    keys = [r.key for r in rows]
    assert len(keys) == len(set(keys)), "duplicate surrogate keys"


def test_first_load(spark):
    dim = base(spark)
    assert [(r[0], r[1]) for r in rows_of(dim)] == [("a", 1), ("b", 2), ("c", 3)]
    assert all(r.is_current and r.expiry_date == date(9999, 12, 31) for r in dim.collect())


def test_four_cases(spark):
    dim = base(spark)
    s2 = snap(spark, [
        ("a", "A", "X", 1.0, "n2"),       # no tracked change (untracked note differs)
        ("b", "B2", "Y", 2.0, "n1"),      # changed -> close + insert
        ("d", "D", "Z", 4.0, "n1"),       # new key -> insert
    ])                                     # c absent -> left as is
    out = scd2.merge(dim, s2, "id", TRACKED, "key", D2)
    check_invariants(out)
    r = rows_of(out)
    assert ("a", 1, "A", "X", 1.0, "n1", D1, date(9999, 12, 31), True) in r
    assert ("b", 2, "B", "Y", 2.0, "n1", D1, D2, False) in r
    assert ("c", 3, "C", None, 3.0, "n1", D1, date(9999, 12, 31), True) in r
    new = {x[0]: x for x in r if x[6] == D2}
    assert new["b"][1] == 4 and new["b"][2] == "B2" and new["b"][8]
    assert new["d"][1] == 5 and new["d"][8]
    assert len(r) == 5


def test_rerun_is_idempotent(spark):
    dim = base(spark)
    s2 = snap(spark, [("a", "A", "X", 1.5, "n1"), ("b", "B", "Y", 2.0, "n1")])
    once = scd2.merge(dim, s2, "id", TRACKED, "key", D2)
    twice = scd2.merge(once, s2, "id", TRACKED, "key", D2)
    assert rows_of(once) == rows_of(twice)


def test_two_changes_in_sequence_and_null_transitions(spark):
    dim = base(spark)
    s2 = snap(spark, [("a", "A", None, 1.0, "n"), ("c", "C", "W", 3.0, "n")])  # value->null, null->value
    s3 = snap(spark, [("a", "A", "V", 1.0, "n"), ("c", "C", "W", 3.0, "n")])
    out = scd2.merge(scd2.merge(dim, s2, "id", TRACKED, "key", D2), s3, "id", TRACKED, "key", D3)
    check_invariants(out)
    a = [x for x in rows_of(out) if x[0] == "a"]
    assert [(x[3], x[6], x[7], x[8]) for x in a] == [
        ("X", D1, D2, False), (None, D2, D3, False), ("V", D3, date(9999, 12, 31), True)
    ]
    c = [x for x in rows_of(out) if x[0] == "c"]
    assert len(c) == 2 and c[-1][3] == "W"


def test_same_day_change_updates_in_place(spark):
    dim = base(spark)
    s2 = snap(spark, [("a", "A9", "X", 1.0, "n")])
    out = scd2.merge(dim, s2, "id", TRACKED, "key", D1)
    check_invariants(out)
    a = [x for x in rows_of(out) if x[0] == "a"]
    assert len(a) == 1 and a[0][2] == "A9" and a[0][1] == 1 and a[0][8]


def test_type1_and_close_missing(spark):
    dim = base(spark)
    s2 = snap(spark, [("a", "A", "X", 1.0, "fresh")])
    out = scd2.merge(dim, s2, "id", TRACKED, "key", D2, type1=["note"], close_missing=True)
    check_invariants(out)
    r = {x[0]: x for x in rows_of(out)}
    assert r["a"][5] == "fresh" and r["a"][8]
    assert r["b"][7] == D2 and not r["b"][8]


def test_reappearing_key_and_empty_current(spark):
    dim = base(spark)
    closed = scd2.merge(dim, snap(spark, [("a", "A", "X", 1.0, "n")]), "id", TRACKED, "key", D2, close_missing=True)
    back = scd2.merge(closed, snap(spark, [("b", "B", "Y", 2.0, "n")]), "id", TRACKED, "key", D3)
    check_invariants(back)
    b = [x for x in rows_of(back) if x[0] == "b"]
    assert [x[8] for x in b] == [False, True]
    empty = dim.filter(F.lit(False))
    fresh = scd2.merge(empty, snap(spark, [("z", "Z", "Q", 0.0, "n")]), "id", TRACKED, "key", D2)
    assert [(x[0], x[1]) for x in rows_of(fresh)] == [("z", 1)]


def test_asof_lookup(spark):
    dim = scd2.merge(base(spark), snap(spark, [("b", "B2", "Y", 2.0, "n")]), "id", TRACKED, "key", D2)
    facts = spark.createDataFrame(
        [("b", date(2025, 6, 1)), ("b", date(2026, 1, 15)), ("b", date(2026, 2, 1)), ("b", date(2026, 5, 1)),
         ("zz", date(2026, 5, 1))],
        "id string, d date",
    )
    got = sorted((r.id, r.d, r.key) for r in scd2.asof_lookup(facts, dim, "id", "id", "d", ["key"]).collect())
    assert got == [
        ("b", date(2025, 6, 1), 2),   # before the first load: first version (open to the left)
        ("b", date(2026, 1, 15), 2),
        ("b", date(2026, 2, 1), 4),   # change day belongs to the new version
        ("b", date(2026, 5, 1), 4),
        ("zz", date(2026, 5, 1), None),
    ]
    strict = scd2.asof_lookup(facts, dim, "id", "id", "d", ["key"], open_first=False)
    assert strict.filter((F.col("d") == date(2025, 6, 1)) & F.col("key").isNull()).count() == 1


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_merge_keys_unique_under_partitioning(spark, parts):
    rows = [(f"id{i:03d}", f"N{i}", "X", float(i), "n") for i in range(200)]
    dim = scd2.first_load(snap(spark, rows).repartition(parts), "id", "key", D1)
    s2 = snap(spark, [(f"id{i:03d}", f"N{i}{'x' if i % 3 == 0 else ''}", "X", float(i), "n") for i in range(250)])
    out = scd2.merge(dim, s2.repartition(parts), "id", TRACKED, "key", D2)
    check_invariants(out)
    assert out.count() == 200 + 67 + 50


def test_merge_guards(spark):
    cols = "k int, a string"
    v1 = scd2.first_load(spark.createDataFrame([(None, "x"), (1, "x")], cols), "k", "sk", "2024-01-01")
    again = scd2.merge(v1, spark.createDataFrame([(None, "x"), (1, "y")], cols), "k", ["a"], "sk", "2024-02-01")
    rows = sorted((r.k or 0, r.a, r.is_current) for r in again.collect())
    assert rows == [(0, "x", True), (1, "x", False), (1, "y", True)]  # the NULL key stays
    with pytest.raises(Exception, match="two incoming rows of key 1"):
        scd2.merge(v1, spark.createDataFrame([(1, "y"), (1, "z")], cols), "k", ["a"], "sk", "2024-02-01").collect()
    with pytest.raises(Exception, match="dated before the current version of key 1"):
        scd2.merge(v1, spark.createDataFrame([(1, "y")], cols), "k", ["a"], "sk", "2023-02-01").collect()
