import datetime

from tests.conftest import rows
from uptide.operators import clean


def test_key_duplicates_keep_the_first_in_order(spark):
    df = spark.createDataFrame(
        [(1, "b", 10), (1, "a", 99), (None, "z", 1), (None, "y", 2), (2, "c", 5)], "k int, source string, v int"
    )
    kept = clean.drop_key_duplicates(df, ["k", "absent"], ["source"])
    assert rows(kept) == [(1, "a", 99), (2, "c", 5), (None, "y", 2)]


def test_exact_duplicates_and_report(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert rows(clean.drop_exact_duplicates(df)) == [(1, None), (2, "x")]
    assert tuple(clean.duplicate_report(df).first()) == (3, 2, 1)
    assert tuple(clean.duplicate_report(df.limit(0)).first()) == (0, 0, 0)


def test_imputation(spark):
    df = spark.createDataFrame(
        [(1.0, "b", None, None), (None, "a", None, None), (4.0, None, None, None), (2.0, "b", None, None), (3.0, "a", None, None)],
        "n double, t string, empty string, void double",
    )
    filled = clean.impute_nulls(df, numeric=["n"], text=["t", "empty"])
    assert sorted(r.n for r in filled.collect()) == [1.0, 2.0, 2.5, 3.0, 4.0]
    assert sorted(r.t for r in filled.collect()) == ["a", "a", "a", "b", "b"]  # tie -> smallest
    assert {r.empty for r in filled.collect()} == {"Desconhecido"}
    assert {r.void for r in clean.impute_nulls(df, numeric=["void"]).collect()} == {None}
    assert {r.void for r in clean.impute_nulls(df, numeric=["void"], empty_numeric=0.0).collect()} == {0.0}


def test_period_filter_ends_at_midnight(spark):
    times = [datetime.datetime(2024, 1, 1), datetime.datetime(2024, 1, 31), datetime.datetime(2024, 1, 31, 8)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp")
    assert clean.within_period(df, "ts", "2024-01-01", "2024-01-31").count() == 2
    assert clean.within_period(df, "ts").count() == 3


def test_convert_date_columns_only_touches_text(spark):
    df = spark.createDataFrame([("31/12/2024", 5, "x")], "Data_prod string, data_n int, other string")
    r = clean.convert_date_columns(df, ["dd/MM/yyyy"]).first()
    assert tuple(r) == (datetime.datetime(2024, 12, 31), 5, "x")


def test_standardize_and_combine(spark):
    df = spark.createDataFrame([("1", "P1")], ["Qtd. Produzida", "Nome. Produto"])
    std = clean.standardize(
        df,
        {"q": ("Qtd. Produzida",), "compound": ("Composto", "Nome. Produto"), "mass": ("Massa",), "other": ("o",)},
        {"q": "bigint", "compound": "string", "mass": "double", "other": "string"},
        {"mass": 0.0},
    )
    assert std.collect()[0].asDict() == {"q": 1, "compound": "P1", "mass": 0.0, "other": None}
    both = clean.combine_sources(std, spark.createDataFrame([(7,)], "q bigint"))
    assert rows(both.select("q", "mass")) == [(1, 0.0), (7, None)]


def test_first_present(spark):
    df = spark.createDataFrame([(1, 2)], ["Cod Recurso", "Qtd_Produzida"])
    assert clean.first_present(df, ["Equipamento", "Cod Recurso"]) == "Cod Recurso"
    assert clean.first_present(df, ["produzida"], contains=True) == "Qtd_Produzida"
    assert clean.first_present(df, ["nothing"]) is None


def test_entity_prefix_trims_after_the_test(spark):
    df = spark.createDataFrame([("EQ-1 ",), (" EQ-2",), ("Equipamento",), (None,)], "e string")
    assert rows(clean.with_entity_prefix(df, "e", "EQ-")) == [("EQ-1",)]


def test_append_new_rows(spark):
    old = spark.createDataFrame([("a", 1), ("b", None)], "e string, v int")
    new = spark.createDataFrame([("a", 1), ("b", None), ("b", 2), ("b", 2)], "e string, v int")
    assert rows(clean.append_new_rows(old, new)) == [("a", 1), ("b", 2), ("b", None)]
    assert rows(clean.only_new_rows(old, new)) == [("b", 2)]
    assert rows(clean.append_counts(old, new, "e")) == [("a", 1, 1, 1, 0), ("b", 1, 3, 2, 1)]


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["Fator Un.", "a/b-c"])
    assert clean.clean_column_names(df).columns == ["Fator_Un", "a_b_c"]
