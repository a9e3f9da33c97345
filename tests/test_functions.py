import datetime as dt

from pyspark.sql import functions as F

from relkit.functions import scalar as fx


def one(spark, expr, schema="x string", value=(None,)):
    return spark.createDataFrame([value], schema).select(expr.alias("r")).first()["r"]


def test_dow_and_day_name(spark):
    sunday = (dt.date(2024, 1, 7),)
    assert one(spark, fx.pg_dow("x"), "x date", sunday) == 0
    assert one(spark, fx.pg_day_name("x"), "x date", sunday) == "Sunday   "
    assert len(one(spark, fx.pg_day_name("x"), "x date", (dt.date(2024, 1, 10),))) == 9


def test_us_date_literal_and_intervals(spark):
    assert one(spark, fx.us_date("12/31/1996")) == dt.date(1996, 12, 31)
    assert one(spark, F.date_sub(F.col("x"), 280), "x date", (dt.date(2024, 1, 7),)) == dt.date(2023, 4, 2)
    assert one(spark, fx.days_between(F.lit("2024-03-01"), F.lit("2024-02-01"))) == 29


def test_char_positions_empty_null_and_case(spark):
    assert one(spark, fx.char_positions("x", "e"), value=("",)) == []
    assert one(spark, fx.char_positions("x", "e"), value=(None,)) == []
    assert one(spark, fx.char_positions("x", "e"), value=("Beer eEe",)) == [2, 3, 6, 7, 8]


def test_concat_propagates_null(spark):
    assert one(spark, fx.pg_concat(F.lit("a"), F.col("x"))) is None
    assert one(spark, fx.pg_concat(F.lit("a"), F.col("x")), value=("b",)) == "ab"


def test_mean_of_present(spark):
    schema = "a double, b double, c double"
    assert one(spark, fx.mean_of_present(["a", "b", "c"]), schema, (None, None, None)) is None
    assert one(spark, fx.mean_of_present(["a", "b", "c"]), schema, (1.0, None, 3.0)) == 2.0


def test_pct_change_zero_and_null_denominator(spark):
    schema = "a double, b double"
    assert one(spark, fx.pct_change("a", "b"), schema, (0.0, 5.0)) is None
    assert one(spark, fx.pct_change("a", "b"), schema, (None, 5.0)) is None
    assert one(spark, fx.pct_change("a", "b"), schema, (4.0, 5.0)) == 25.0


def test_rounding_half_up(spark):
    assert one(spark, fx.round_money(fx.money(F.lit(900.15)) * fx.dec("1.10"))) == 990.17
    assert one(spark, fx.round_half_up(F.lit(1.125), 2)) == 1.13   # exactly representable half
    assert one(spark, fx.round_half_up(F.lit(-0.5), 0)) == -1.0
    assert one(spark, fx.round_half_up(F.lit(-0.125), 2)) == -0.13
    assert one(spark, fx.round_half_up(F.lit(1.005), 2)) == 1.01


def test_band_keeps_or_labels_null(spark):
    b = fx.band("x", [(18.5, "Under"), (25.0, "Normal")], "Over")
    assert one(spark, b, "x double", (None,)) is None
    b2 = fx.band("x", [(18.5, "Under")], "Over", null_label="Unknown")
    assert one(spark, b2, "x double", (None,)) == "Unknown"
    assert one(spark, b2, "x double", (18.5,)) == "Over"


def test_yes_no_and_code_label(spark):
    assert one(spark, fx.yes_no("x"), "x int", (1,)) == "Yes"
    assert one(spark, fx.yes_no("x"), "x int", (None,)) == "Unknown"
    assert one(spark, fx.code_label("x", {0: "Non-GDM", 1: "GDM"}, "Unknown"), "x int", (0,)) == "Non-GDM"


def test_stock_value_sql_function_matches_set_form(spark):
    import __spark_entry__ as entry
    from conftest import SF_SMALL
    from relkit.functions.routines import register_stock_value
    from relkit.sources.tables import read_table
    read_table(spark, SF_SMALL, "part").createOrReplaceTempView("t_part")
    fn = register_stock_value(spark, "t_part")
    expected = {r["category"]: r["stock_value"] for r in entry.queries()["fn_stock_value"](spark, SF_SMALL).collect()}
    for cat, value in expected.items():
        got = spark.sql(f"SELECT {fn}('{cat}') AS v").first()["v"]
        assert got == value
