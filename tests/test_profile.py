import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from uptide.functions.quantiles import exact_quantiles
from uptide.operators import profile
from uptide.plans.catalog import QUERIES


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    x = rng.normal(10, 3, 400).round(3)
    return pd.DataFrame({"x": x, "y": (2 * x + rng.normal(0, 1, 400)).round(3), "k": 5.0, "z": np.where(x > 11, np.nan, x)})


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in frame.columns]).repartition(4)


def test_describe(df, frame):
    found = {r["column"]: r for r in profile.describe(df).collect()}
    for c in frame.columns:
        s, r = frame[c], found[c]
        assert r.mean == pytest.approx(s.mean()) and r["std"] == pytest.approx(s.std())
        assert [r.min, r.q1, r.median, r.q3, r.max] == pytest.approx([s.min(), *s.quantile([0.25, 0.5, 0.75]), s.max()])
        assert (r.nulls, r["count"]) == (s.isna().sum(), s.count())


def test_correlations(df, frame):
    expected = frame.corr()
    found = {(r.feature_x, r.feature_y): r["corr"] for r in profile.correlation_matrix(df).collect()}
    assert len(found) == 16
    for (a, b), v in found.items():
        if "k" in (a, b):
            assert v is None  # constant
        else:
            assert v == pytest.approx(expected.loc[a, b])
    assert [r.feature for r in profile.target_correlations(df, "y", top=2).collect()] == sorted(
        ["x", "z"], key=lambda c: -abs(expected.loc[c, "y"])
    )
    pairs = {(r.feature_x, r.feature_y): r["corr"] for r in profile.feature_pairs(df, ["x", "y", "z"]).collect()}
    assert pairs == {p: pytest.approx(expected.loc[p]) for p in (("x", "y"), ("x", "z"), ("y", "z"))}


def test_outliers_and_box(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [*range(1, 20), 1000, -500]], "v double, one double")
    found = {r["column"]: r for r in profile.iqr_outliers(df).collect()}
    assert (found["v"].outliers, found["v"].flagged, found["one"].outliers) == (2, 1, 0)
    box = {r["column"]: r for r in profile.boxplot(df, ["v"]).collect()}["v"]
    assert (box.whisker_low, box.median, box.whisker_high, box.outliers, box.n) == (1.0, 10.0, 19.0, 2, 21)


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    found = [(r.bin, r.n) for r in profile.histogram(df, "v", bins=5).orderBy("bin").collect()]
    assert found == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 3)]
    flat = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    assert sum(r.n for r in profile.histogram(flat, "v", bins=5).collect()) == 2


def test_quartile_bands_match_qcut(spark, frame):
    data = frame[["x", "y"]].round(0)
    bands = pd.qcut(data["x"], 4, labels=list(profile.QUARTILE_LABELS))
    found = {r.band: r.n for r in profile.boxplot_by_quartile(spark.createDataFrame(data), "y", "x").collect()}
    assert found == {k: v for k, v in bands.value_counts().to_dict().items() if v}


def test_trend(df, frame):
    slope, intercept = np.polyfit(frame.x, frame.y, 1)
    r = profile.linear_trend(df, "x", "y").first()
    assert (r.slope, r.intercept, r.n) == (pytest.approx(slope), pytest.approx(intercept), 400)
    assert profile.linear_trend(df, "k", "y").first().slope is None


def test_thirds(spark):
    df = spark.createDataFrame([(v,) for v in [*range(100), None]], "d int")
    found = {r.urgencia: (r.n, round(r.proporcao, 4)) for r in profile.urgency_thirds(df, "d").collect()}
    assert found == {"Curto": (33, 0.3267), "Médio": (33, 0.3267), "Longo": (34, 0.3366), "Indefinido": (1, 0.0099)}


def test_sorted_curve(spark):
    df = spark.createDataFrame([(v,) for v in [5, -3, 5, 5, 100, None]], "d int")
    assert rows(profile.sorted_curve(df, "d", 10).select("d", "first_index", "last_index", F.round("cume_dist", 2))) == sorted(
        [(-3, 0, 0, 0.2), (5, 1, 3, 0.8), (100, 4, 4, 1.0)], key=lambda r: tuple((v is None, str(v)) for v in r)
    )


def test_balance_and_insights(spark):
    df = spark.createDataFrame([("a", float(i), float(i * 2)) for i in range(9)] + [("b", 9.0, 18.0)], "c string, x double, y double")
    assert rows(profile.category_balance(df, ["c"])) == [("c", "a", 9, 0.9, 1)]
    kinds = {(r.kind, r.column) for r in profile.insights(df, ["x"], ["c"], "y").collect()}
    assert {("registros", "*"), ("correlacao_forte", "x"), ("desbalanceada", "c=a"), ("target_media", "y")} <= kinds


def test_many_columns_with_gaps_in_one_pass(spark):
    rnd = np.random.default_rng(3)
    k = 60
    table = rnd.normal(1e6, 1.0, (400, k)) + rnd.normal(0, 1, (400, 1))
    table[rnd.random((400, k)) < 0.2] = np.nan
    frame = pd.DataFrame(table, columns=[f"c{i}" for i in range(k)])
    frame["c5"] = frame["c5"].where(frame["c5"].isna(), 0.1)
    frame["c6"] = np.nan
    data = [tuple(None if np.isnan(v) else float(v) for v in r) for r in frame.to_numpy()]
    df = spark.createDataFrame(data, ", ".join(f"c{i} double" for i in range(k))).repartition(6)
    found = profile.feature_pairs(df, df.columns)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("MapInArrow") == 1 and text.count("regr_") == 0
    got = {(r.feature_x, r.feature_y): r["corr"] for r in found.collect()}
    expected = frame.corr()
    assert len(got) == k * (k - 1) // 2
    for (a, b), v in got.items():
        if {a, b} & {"c5", "c6"}:
            assert v is None
        else:
            assert v == pytest.approx(expected.loc[a, b], abs=1e-8)


def test_no_number_gives_no_number(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, float("nan"), 3.0), (3.0, 1.0, 2.0)], "a double, b double, c double")
    got = {(r.feature_x, r.feature_y): r["corr"] for r in profile.feature_pairs(df, ["a", "b", "c"]).collect()}
    assert math.isnan(got["a", "b"]) and math.isnan(got["b", "c"]) and got["a", "c"] == pytest.approx(0.5)
    assert [r["corr"] for r in profile.feature_pairs(df.limit(0), ["a", "b"]).collect()] == [None]


def test_quantiles_within_groups(spark):
    rnd = random.Random(8)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([None, rnd.randrange(30) / 4, rnd.gauss(0, 1)]), rnd.random()) for _ in range(3000)] + [("only", None, 1.0)]
    df = spark.createDataFrame(data, "g string, v double, w double").repartition(5)
    got = {(r.g, r["column"], r.probability): r["value"] for r in exact_quantiles(df, ["v", "w"], [0.1, 0.5, 0.99], by=["g"], accuracy=50).collect()}
    assert len(got) == 21
    for (g, c, p), value in got.items():
        values = [r[1 if c == "v" else 2] for r in data if r[0] == g and r[1 if c == "v" else 2] is not None]
        assert value == pytest.approx(float(np.quantile(values, p)))
    box = {r.band: r for r in profile.boxplot_by_quartile(df, "v", "w").collect()}
    assert sum(r.n for r in box.values()) == sum(r[1] is not None for r in data)


def test_quantile_plans_stay_small(spark, sf):
    for name in ("boxplot_by_quartile", "entity_statistics", "iqr_outliers", "describe_numeric"):
        text = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert text.count("FileScan") < 20
