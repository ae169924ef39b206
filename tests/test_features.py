import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from uptide.operators import features, stats

D, T = datetime.date, datetime.datetime
FACT = "entity string, prod_ts timestamp, order_id long, qty_produced long"


@pytest.fixture(scope="module")
def dim(spark):
    return spark.createDataFrame(
        [
            ("E1", D(2024, 3, 1), D(2024, 1, 1), 60, 20.3, 20.0, 19.9, 19.0),
            ("E2", D(2024, 3, 1), None, None, 19.0, 18.0, 19.0, None),
            ("E3", None, None, -5, None, None, None, None),
        ],
        "entity string, last_replacement date, previous_replacement date, interval_days int, componente_a_max double, "
        "componente_a_min double, componente_b_max double, componente_b_min double",
    )


def test_target(spark, dim):
    fact = spark.createDataFrame(
        [
            ("E1", T(2024, 2, 20), 1, 1),  # before the last replacement
            ("E1", T(2024, 3, 1), 2, 1),  # on it
            ("E1", T(2024, 3, 2), 3, 1),  # after: last + 60
            ("E1", T(2024, 5, 1), 4, 1),  # 61 days later: dropped
            ("E2", T(2024, 3, 2), 5, 1),  # interval defaults to 365
            ("E9", T(2024, 5, 31), 6, 1),  # unmapped
            ("E9", T(2024, 6, 2), 7, 1),  # unmapped, past the default date: dropped
            ("E1", None, 8, 1),
        ],
        FACT,
    )
    found = features.maintenance_target(fact, dim)
    assert rows(found, "order_id", "target") == [(1, 10), (2, 0), (3, 59), (5, 364), (6, 1)]


def test_cumulative_with_ties(spark):
    fact = spark.createDataFrame(
        [("E1", T(2024, 1, 1), 2, 10), ("E1", T(2024, 1, 1), 1, 5), ("E1", T(2024, 1, 2), 3, 1), ("E2", T(2024, 1, 1), 4, None)],
        FACT,
    )
    found = features.cumulative_features(fact, ["qty_produced"], tiebreak=["order_id"])
    assert rows(found, "order_id", "qty_produced_acumulado") == [(1, 5), (2, 15), (3, 16), (4, None)]


def test_wear_by_hand(spark, dim):
    fact = spark.createDataFrame(
        [("E1", T(2024, 1, 1), 1, 100), ("E2", T(2024, 1, 1), 2, 0), ("E3", T(2024, 1, 1), 3, 10), ("E9", T(2024, 1, 1), 4, 10)],
        FACT,
    )
    found = {r.order_id: r for r in features.measurement_features(fact, dim, quantity="qty_produced").collect()}
    one = found[1]
    assert one.desgaste_componente_a == pytest.approx(0.3) and one.desgaste_componente_b == pytest.approx(1.0)
    assert one.taxa_desgaste_componente_a == pytest.approx(0.3 / 60)
    assert one.indice_desgaste == pytest.approx(0.6 * 50 + 0.4 * 50)
    assert one.desgaste_por_1000_pecas == pytest.approx(1.3 / 100 * 1000)
    two = found[2]  # A below nominal is negative and not floored; B lacks a bound, filled by the median
    assert two.indice_desgaste == pytest.approx(-1.0 / 0.6 * 100 * 0.6)
    assert (two.desgaste_por_1000_pecas, two.intervalo_manutencao, two.desgaste_componente_b) == (0.0, 365, pytest.approx(1.0))
    three = found[3]
    assert (three.taxa_desgaste_componente_a, three.indice_desgaste) == (0.0, 0.0)
    assert three.componente_a_max == pytest.approx((20.3 + 19.0) / 2)  # median over records
    assert found[4].intervalo_manutencao == 365


def test_measurements_all_missing_become_zero(spark, dim):
    fact = spark.createDataFrame([("E3", T(2024, 1, 1), 3, 10)], FACT)
    row = features.measurement_features(fact, dim, quantity="qty_produced").first()
    assert (row.componente_a_max, row.desgaste_componente_b) == (0.0, 0.0)


def test_one_hot_limit_and_inverse(spark):
    df = spark.createDataFrame([(i, f"EQ-{i % 3}" if i < 9 else None, f"v{i % 51}", f"w{i % 50}") for i in range(60)], "i int, e string, many string, fits string")
    coded = features.one_hot(df, ["e", "many", "fits"], prefixes={"e": "Equipamento"})
    assert "many" in coded.columns and "fits" not in coded.columns
    assert [c for c in coded.columns if c.startswith("Equipamento_")] == ["Equipamento_EQ_0", "Equipamento_EQ_1", "Equipamento_EQ_2"]
    back = coded.select("i", features.entity_from_one_hot(coded).alias("e"))
    assert rows(back.filter("i in (4, 40)")) == [(4, "EQ-1"), (40, "Outro")]
    assert df.select(features.entity_from_one_hot(df)).first()[0] == "Desconhecido"


def test_preventive_features(spark):
    daily = spark.createDataFrame([("E1", D(2024, 1, 1), 1), ("E1", D(2024, 1, 5), 2), ("E2", D(2024, 1, 5), 3)], "entity string, day date, q int")
    prev = spark.createDataFrame([("E1", D(2024, 1, 2)), ("E1", D(2024, 1, 2)), ("E1", D(2024, 1, 5)), ("E2", None)], "entity string, event_date date")
    found = features.preventive_features(daily, prev)
    assert rows(found, "q", "preventivas_ate_data", "dias_desde_ultima_preventiva") == [(1, 0, None), (2, 3, 0), (3, 0, None)]


def test_day_grain_and_date_features(spark, dim):
    fact = spark.createDataFrame([("E1", T(2024, 3, 4, 8), 1, 10), ("E1", T(2024, 3, 4, 9), 2, 20), ("E1", T(2024, 1, 10), 3, 1)], FACT)
    daily = features.entity_day_grain(fact, sums=["qty_produced"], maxima=["order_id"])
    assert rows(daily) == [("E1", D(2024, 1, 10), 1, 3), ("E1", D(2024, 3, 4), 30, 2)]
    dated = features.date_features(daily, dim, ts="day")
    assert rows(dated, "order_id", "dia_da_semana", "mes", "dias_desde_inicio_serie", "dias_desde_ultima_manutencao") == [
        (2, 0, 3, 54, 3), (3, 2, 1, 0, 9),
    ]


def test_defaults_fill_fields_and_entities(spark):
    found = spark.createDataFrame([("E1", D(2024, 1, 1), None)], "entity string, last_replacement date, interval_days int")
    default = spark.createDataFrame([("E1", D(2020, 1, 1), 7), ("E2", D(2020, 2, 2), 9)], "entity string, last_replacement date, interval_days int")
    full = features.with_defaults(found, default, "entity", ["last_replacement", "interval_days"])
    assert rows(full) == [("E1", D(2024, 1, 1), 7), ("E2", D(2020, 2, 2), 9)]


def test_entity_statistics_zero_production(spark):
    fact = spark.createDataFrame([("E1", 0, 3), ("E1", 0, 1), ("E2", 200, 3), (None, 5, 5)], "entity string, qty_produced long, qty_scrapped long")
    dim = spark.createDataFrame(
        [("E1", 10, D(2024, 1, 1), None, "n", None, None, None, None)],
        "entity string, interval_days int, last_replacement date, previous_replacement date, notes string, componente_a_max double, "
        "componente_a_min double, componente_b_max double, componente_b_min double",
    )
    found = stats.entity_statistics(fact, dim)
    assert rows(found, "equipamento", "total_produzido", "total_registros", "total_refugado", "taxa_refugo_pct", "intervalo_manutencao_dias") == [
        ("E1", 0, 2, 4, None, 10), ("E2", 200, 1, 3, 1.5, None),
    ]


def test_a_busy_entity_is_spread(spark):
    """One entity with nearly all rows: the totals hold and no task of the wide step sees them all."""
    n = 20_000
    fact = spark.range(n).select(
        F.when(F.col("id") % 100 == 0, F.concat(F.lit("E"), F.col("id") % 7)).otherwise("HOT").alias("entity"),
        F.expr("timestamp'2024-01-01' + make_interval(0,0,0, cast(id % 300 as int))").alias("prod_ts"),
        F.col("id").alias("order_id"),
        F.lit(1).cast("bigint").alias("qty_produced"),
    )
    found = features.cumulative_features(fact, ["qty_produced"], tiebreak=["order_id"])
    hot = found.filter("entity = 'HOT'")
    top = hot.agg(F.max("qty_produced_acumulado"), F.count_distinct("qty_produced_acumulado"), F.count(F.lit(1))).first()
    assert tuple(top) == (n - n // 100,) * 3
    sizes = [r[0] for r in hot.groupBy(F.spark_partition_id().alias("p")).count().select("count").collect()]
    assert max(sizes) < 0.6 * sum(sizes)


def test_days_of_running_totals_are_grouped_where_they_are(spark):
    """Records lie by entity and day after their running totals: the day grain must not shuffle them again."""
    fact = spark.createDataFrame(
        [
            ("E1", T(2024, 1, 1), 2, 10), ("E1", T(2024, 1, 1), 1, 5), ("E1", T(2024, 1, 2), 3, 1), ("E2", T(2024, 1, 1), 4, None),
            ("E2", None, 5, 3), ("E2", T(1970, 1, 1), 6, 4), (None, T(2024, 1, 1), 7, 2), (None, None, 8, 1), ("E1", T(2024, 1, 2), 3, 1),
        ],
        FACT,
    )
    grain = {"sums": ["qty_produced"], "means": ["order_id"], "maxima": ["qty_produced_acumulado"]}
    kept = features.cumulative_features(fact, ["qty_produced"], tiebreak=["order_id"], keep_place=True)
    daily = features.entity_day_grain(kept, **grain)
    exchanges = [df._jdf.queryExecution().executedPlan().toString().count("Exchange ") for df in (kept, daily)]
    assert exchanges[0] == exchanges[1] > 0
    plain = features.entity_day_grain(features.cumulative_features(fact, ["qty_produced"], tiebreak=["order_id"]), **grain)
    assert daily.schema == plain.schema and rows(daily) == rows(plain)
    assert ("E2", None, 3, 5.0, 3) in rows(daily) and ("E2", D(1970, 1, 1), 4, 6.0, 7) in rows(daily)
