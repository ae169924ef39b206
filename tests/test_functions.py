import datetime
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from tests.conftest import rows
from uptide.functions import scalar as s
from uptide.functions.prefix import running_totals
from uptide.functions.quantiles import exact_quantiles


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_urgency_boundaries(spark):
    days = [None, -1, 0, 29, 30, 89, 90]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    found = [r[0] for r in df.select(s.urgency(F.col("d"))).collect()]
    assert found == ["DESCONHECIDO", "ATRASADO", "URGENTE", "URGENTE", "ATENÇÃO", "ATENÇÃO", "OK"]


def test_forecast_band_has_inclusive_upper_bounds(spark):
    df = spark.createDataFrame([(d,) for d in (0, 30, 31, 90, 91, None)], "d int")
    found = [r[0] for r in df.select(s.forecast_band(F.col("d"))).collect()]
    assert found == ["URGENTE", "URGENTE", "ATENÇÃO", "ATENÇÃO", "OK", None]


def test_recommendation(spark):
    df = spark.createDataFrame([(d,) for d in (-31, -30, 30, 31)], "d int")
    assert [r[0] for r in df.select(s.recommendation(F.col("d"))).collect()] == [
        "Antecipar", "Conforme", "Conforme", "Pode adiar",
    ]


def test_fit_and_quality_bands(spark):
    r = one(spark, s.fit_band(F.lit(0.9)), s.fit_band(F.lit(0.7)), s.fit_band(F.lit(0.69)),
            s.quality_label(F.lit(1.49)), s.quality_label(F.lit(1.5)))
    assert tuple(r) == ("Excelente", "Bom", "Moderado/baixo", s.QUALITY_OK, s.QUALITY_BAD)


def test_clamp_keeps_null(spark):
    r = one(spark, s.clamp(F.lit(None).cast("double"), 0.6, 1.2), s.clamp(F.lit(5.0), 0.6, 1.2), s.clamp(F.lit(0.1), 0.6, 1.2))
    assert tuple(r) == (None, 1.2, 0.6)


def test_brazilian_formats(spark):
    r = one(
        spark, s.format_int(F.lit(1234567)), s.format_int(F.lit(None).cast("int")), s.format_pct(F.lit(1234.5)),
        s.format_pct(F.lit(None).cast("double")), s.format_day(F.lit(datetime.date(2024, 2, 3))),
        s.format_month(F.lit(datetime.date(2024, 2, 3))), s.month_key(F.lit(datetime.date(2024, 2, 3))),
    )
    assert tuple(r) == ("1.234.567", "—", "1.234,50 %", "—", "03/02/2024", "Fev/2024", "2024-02")


def test_dates_are_read_day_first(spark):
    df = spark.createDataFrame(
        [("05/03/2024 00:00:00",), ("25/03/2024 10:20:30",), ("2024-03-05",), ("x",), (None,)], "t string"
    )
    parsed = [r[0] for r in df.select(s.parse_timestamp(F.col("t"), ("dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd"))).collect()]
    assert parsed == [
        datetime.datetime(2024, 3, 5), datetime.datetime(2024, 3, 25, 10, 20, 30), datetime.datetime(2024, 3, 5), None, None,
    ]


def test_safe_double(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), (None,)], "t string")
    assert [r[0] for r in df.select(s.safe_double(F.col("t"))).collect()] == [1.5, None, None, None]


def test_clean_name():
    assert s.clean_name("Consumo de massa (Kg/100pçs).x-y") == "Consumo_de_massa_Kg_100pçsx_y"


def test_event_label(spark):
    df = spark.createDataFrame(
        [("ULTIMA_SUBSTITUICAO", None), ("PREVENTIVA", "3"), ("PREVENTIVA", ""), ("OUTRA", None)], "t string, n string"
    )
    assert [r[0] for r in df.select(s.event_label(F.col("t"), F.col("n"))).collect()] == [
        "Última troca", "Preventiva (#3)", "Preventiva (#?)", "OUTRA",
    ]


def test_report_version(spark):
    df = spark.createDataFrame([("Report_R12",), ("Report_R7b",), ("notes",)], "n string")
    assert [r[0] for r in df.select(s.report_version(F.col("n"))).collect()] == [12, 7, None]


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1231, 3000])
def test_quantiles_equal_numpy(spark, size):
    rng = random.Random(size)
    data = [(round(rng.gauss(0, 100), 3), rng.choice([None, 1.0, 2.0, 2.0, 7.5])) for _ in range(size)]
    df = spark.createDataFrame(data, "x double, y double")
    probabilities = [0.0, 0.25, 0.33, 0.5, 0.66, 0.75, 1.0]
    found = {(r[0], r[1]): r[2] for r in exact_quantiles(df, ["x", "y"], probabilities).collect()}
    for i, c in enumerate("xy"):
        values = [r[i] for r in data if r[i] is not None]
        for p in probabilities:
            if values:
                assert found[c, p] == pytest.approx(float(np.quantile(values, p)), abs=1e-9)
            else:
                assert (c, p) not in found


def test_quantiles_with_brackets(spark):
    """Coarse ranks force the bracket path; skewed copies and outliers must not move the answer."""
    rng = random.Random(5)
    data = [7.0] * 2000 + [rng.expovariate(0.01) for _ in range(3500)] + [1e12, -1e12]
    rng.shuffle(data)
    df = spark.createDataFrame([(v,) for v in data], "x double").repartition(6)
    found = {r[1]: r[2] for r in exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], accuracy=200).collect()}
    for p in found:
        assert found[p] == pytest.approx(float(np.quantile(data, p)), abs=1e-9)


def test_running_totals_over_blocks(spark):
    rng = random.Random(1)
    data = [(rng.choice("aab"), rng.randrange(40), i, rng.choice([None, 1, 2, 5])) for i in range(400)]
    df = spark.createDataFrame(data, "k string, t int, i int, v long").repartition(5)
    found = running_totals(df, keys=["k"], order=["t", "i"], block=F.floor(F.col("t") / 7), totals={"total": "v"})
    sums: dict = {}
    expected = []
    for k, t, i, v in sorted(data, key=lambda r: (r[1], r[2])):
        sums[k] = sums.get(k, 0) + (v or 0)
        expected.append((k, t, i, v, None if v is None else sums[k]))
    assert rows(found) == sorted(expected, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_quantiles_of_sparse_columns(spark):
    """A few values among many NULLs, and brackets no wider than a rank."""
    rng = random.Random(8)
    sparse = {c: rng.sample(range(50_000), n) for c, n in (("one", 1), ("two", 2), ("few", 102), ("some", 199))}
    df = spark.range(50_000).select("id", *[F.when(F.col("id").isin(v), F.col("id") * 1.5).alias(c) for c, v in sparse.items()])
    found = {(r[0], r[1]): r[2] for r in exact_quantiles(df, list(sparse), [0.25, 0.5, 0.9]).collect()}
    for c, v in sparse.items():
        for p in (0.25, 0.5, 0.9):
            assert found[c, p] == pytest.approx(float(np.quantile([1.5 * x for x in v], p)), abs=1e-9)


def test_weighted_quantiles(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, 1.0, 2.5, 7.0, 100.0]), rng.randrange(5)) for _ in range(60)]
    found = exact_quantiles(spark.createDataFrame(data, "x double, n long"), ["x"], [0.1, 0.5, 0.75], weight="n")
    values = [x for x, n in data for _ in range(n) if x is not None]
    for r in found.collect():
        assert r[2] == pytest.approx(float(np.quantile(values, r[1])))


def test_running_totals_of_null_keys_and_blocks(spark):
    data = [(None, 1, 5), (None, 2, 7), ("a", None, 1), ("a", 1, 2), ("a", 2, 4)]
    df = spark.createDataFrame(data, "k string, t int, v long")
    found = running_totals(df, keys=["k"], order=["t"], block=F.col("t"), totals={"total": "v"})
    assert {(r["k"], r["t"]): r["total"] for r in found.collect()} == {(None, 1): None, (None, 2): None, ("a", None): 1, ("a", 1): 3, ("a", 2): 7}


@pytest.mark.parametrize("kind", ["date", "int", "decimal(9,2)", "string", "timestamp"])
def test_running_totals_meet_their_blocks_in_one_exchange(spark, kind):
    """Rows and block sums are dealt once by key and block, to partitions that stay apart; NULL blocks come first."""
    given = [(k, t, v) for k in ("a", "b", None) for t, v in ((None, 5), (None, 7), (1, 1), (1, None), (2, 4))]
    block = {"date": "date_add(date'1969-12-30', t)", "string": "cast(t as string)", "timestamp": "timestamp_seconds(t)"}.get(kind, f"cast(t - 1 as {kind})")
    df = spark.createDataFrame(given, "k string, t int, v long").withColumn("i", F.monotonically_increasing_id())
    found = running_totals(df, keys=["k"], order=["t", "i"], block=F.expr(block), totals={"total": "v"})
    assert found.columns == [*df.columns, "total"]
    want = [(k, t, v, total) for k in ("a", "b", None) for (t, v), total in zip(((None, 5), (None, 7), (1, 1), (1, None), (2, 4)), (5, 12, 13, None, 17) if k else [None] * 5)]
    assert sorted(map(str, found.select("k", "t", "v", "total").collect())) == sorted(str(Row(k=k, t=t, v=v, total=x)) for k, t, v, x in want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.count("Exchange") == 4, plan
