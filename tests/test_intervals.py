import random

import pytest

from tests.conftest import rows
from uptide.functions.categories import category_lists
from uptide.operators import intervals


@pytest.mark.parametrize("share", [0.001, 0.0, 1.0])
def test_interval_join_equals_all_pairs(spark, monkeypatch, share):
    monkeypatch.setattr(intervals, "HOT_SHARE", share)
    rnd = random.Random(9)
    points = [(rnd.choice(["a", "a", "a", "b", "c", None]), rnd.choice([None, rnd.randrange(-300, 900)]), i) for i in range(400)] + [("a", 5, 1000)] * 3
    spans = [(rnd.choice(["a", "a", "b", "d", None]), s, s + rnd.choice([0, 1, 2, 7, 30, 31, 64, 500, -4]), j) for j, s in enumerate(rnd.randrange(-300, 900) for _ in range(150))]
    spans += [("a", None, 4, 500), ("b", 4, None, 501)]
    p = spark.createDataFrame(points, "k string, t long, i long").repartition(4)
    w = spark.createDataFrame(spans, "k string, s long, e long, j long")
    want = sorted((k, t, i, s, e, j) for k, t, i in points if k and t is not None for k2, s, e, j in spans if k2 == k and s is not None and e is not None and s <= t < e)
    found = intervals.interval_join(p, w, key="k", at="t", start="s", end="e")
    assert found.columns == ["k", "t", "i", "s", "e", "j"] and sorted(map(tuple, found.collect())) == want
    totals = intervals.interval_totals(p, w, ["i"], key="k", at="t", start="s", end="e", name="j")
    assert {r["j"]: (r["points"], r["i"]) for r in totals.select("j", "points", totals["i"]).collect()} == {
        j: (sum(x[5] == j for x in want), sum(x[2] for x in want if x[5] == j) if any(x[5] == j for x in want) else None) for _, _, _, j in spans
    }


def test_interval_totals_do_not_meet_the_pairs(spark, monkeypatch):
    """A point for each whole number and windows over nearly all of them: 400 million pairs, none of which is built."""
    n = 20_000
    monkeypatch.setattr(intervals, "interval_join", None)
    p = spark.range(n).selectExpr("'hot' as k", "id as t", "if(id % 2 = 0, id, null) as v", "cast(id as decimal(12, 2)) as d")
    w = spark.range(n).selectExpr("'hot' as k", "id % 10 - 5 as s", f"{n} - id % 7 as e", "id as j")
    w = w.unionAll(spark.createDataFrame([("hot", 3, 4, -1), ("hot", 9, 9, -2), ("hot", None, 9, -3), ("cold", 0, 9, -4), (None, 0, 9, -5), ("hot", 4, 8, -6), ("hot", 10, 12, -6)], "k string, s long, e long, j long"))
    found = intervals.interval_totals(p, w, ["v", "d"], key="k", at="t", start="s", end="e", name="j")
    assert [f.dataType.simpleString() for f in found.schema.fields[-2:]] == ["bigint", "decimal(22,2)"]
    got = found.selectExpr("j", "points", "v", "cast(d as long) d").collect()
    assert len(got) == n + 7
    for j, points, v, d in got:
        if j >= 0:
            lo, hi = max(0, j % 10 - 5), n - j % 7
            assert (points, v, d) == (hi - lo, sum(range(lo + lo % 2, hi, 2)), (lo + hi - 1) * (hi - lo) // 2)
    # One odd point has no known value; a name given twice has the totals of both its windows.
    assert sorted(tuple(r) for r in got if r["j"] == -1) == [(-1, 1, None, 3)]
    assert sorted(tuple(r) for r in got if r["j"] == -6) == [(-6, 6, 4 + 6 + 10, 4 + 5 + 6 + 7 + 10 + 11)] * 2
    assert sorted(tuple(r) for r in got if -6 < r["j"] < -1) == [(j, 0, None, None) for j in (-5, -4, -3, -2)]


def test_interval_totals_of_fractions_and_of_nothing(spark):
    p = spark.createDataFrame([("a", 1, 1e300), ("a", 5, 0.1), ("a", 6, None)], "k string, t long, v double")
    w = spark.createDataFrame([("a", 5, 7, 1), ("a", 0, 2, 2), ("a", 6, 7, 3)], "k string, s long, e long, j long")
    named = {"key": "k", "at": "t", "start": "s", "end": "e", "name": "j"}
    assert rows(intervals.interval_totals(p, w, ["v"], **named), "j", "points", "v") == [(1, 2, 0.1), (2, 1, 1e300), (3, 1, None)]
    p = spark.createDataFrame([], "k string, t long, v long")
    assert rows(intervals.interval_totals(p, w, ["v"], **named), "j", "points", "v") == [(1, 0, None), (2, 0, None), (3, 0, None)]


def test_interval_join_of_nothing(spark):
    p, w = spark.createDataFrame([], "k string, t long"), spark.createDataFrame([], "k string, s long, e long")
    assert intervals.interval_join(p, w, key="k", at="t", start="s", end="e").collect() == []


def test_category_lists_are_exact_within_the_bound(spark):
    df = spark.range(20_000).selectExpr(
        "cast(id % 50 as string) fifty", "cast(id % 51 as string) more", "cast(id as string) each", "if(id % 3 = 0, null, 'x y') one", "cast(null as string) none", "id % 4 as number",
        "if(id < 19000, 'common', cast(id as string)) tail",
    )
    found = category_lists(df.repartition(5), df.columns, 50)
    assert found == {"fifty": sorted(str(i) for i in range(50)), "more": None, "each": None, "one": ["x y"], "none": [], "number": list("0123"), "tail": None}
    assert rows(df.limit(0)) == [] and category_lists(df.limit(0), ["one"], 50) == {"one": []}
