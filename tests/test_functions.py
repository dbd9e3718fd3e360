"""Edge rows for every cleaning rule: NULL, '', padding, case, bad dates."""

import datetime as dt

from pyspark.sql import functions as F

from crosschecks import parse_yyyymmdd_text
from refinery.functions import codes, dates, values


def one_col(spark, rows, ddl):
    return spark.createDataFrame([(r,) for r in rows], ddl)


def results(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_marital_status_codes(spark):
    df = one_col(spark, ["S", " s ", "m", "M ", None, "", "x", "Single"], "c string")
    assert results(df, codes.normalize_marital_status("c")) == \
        ["Single", "Single", "Married", "Married", "n/a", "n/a", "n/a", "n/a"]


def test_gender_crm_and_erp(spark):
    df = one_col(spark, ["F", " m ", "female", "MALE", None, ""], "c string")
    assert results(df, codes.normalize_gender_crm("c")) == ["Female", "Male", "n/a", "n/a", "n/a", "n/a"]
    assert results(df, codes.normalize_gender_erp("c")) == ["Female", "Male", "Female", "Male", "n/a", "n/a"]


def test_product_line(spark):
    df = one_col(spark, ["M ", "r", " S", "T", "Q", None], "c string")
    assert results(df, codes.normalize_product_line("c")) == \
        ["Mountain", "Road", "Other Sales", "Touring", "n/a", "n/a"]


def test_country_is_case_sensitive_and_keeps_unknown(spark):
    df = one_col(spark, ["DE", "de", "US", "USA ", "", None, "France"], "c string")
    assert results(df, codes.normalize_country("c")) == \
        ["Germany", "de", "United States", "United States", "n/a", "n/a", "France"]


def test_yes_no_flag_is_three_valued(spark):
    df = one_col(spark, ["Yes", "yes ", "NO", "?", None], "c string")
    assert results(df, codes.flag_to_boolean("c")) == [True, True, False, None, None]
    flags = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert results(flags, codes.boolean_to_flag("b")) == ["Yes", "No", None]


def test_merge_gender_precedence(spark):
    df = spark.createDataFrame([("Male", "Female"), ("n/a", "Female"), ("n/a", None), (None, "Male")],
                               "p string, s string")
    assert results(df, codes.merge_gender("p", "s")) == ["Male", "Female", "n/a", "Male"]


def test_parse_yyyymmdd(spark):
    df = one_col(spark, [20240131, 0, 5489, 20101340, None, 20240230, -2010101, 20240229, 19000229], "c int")
    assert results(df, dates.parse_yyyymmdd("c")) == \
        [dt.date(2024, 1, 31), None, None, None, None, None, None, dt.date(2024, 2, 29), None]


def test_parse_yyyymmdd_text_input(spark):
    df = one_col(spark, ["20240131", "2024013 ", "abc", "00000000", "20240131 ", None], "c string")
    assert results(df, dates.parse_yyyymmdd("c")) == [dt.date(2024, 1, 31), None, None, None, None, None]


def test_parse_yyyymmdd_agrees_with_pattern_parse(spark):
    df = spark.range(0, 200000).select(((F.col("id") * 7919) % 90000000 + 10000000).cast("int").alias("x"))
    diff = df.filter(~dates.parse_yyyymmdd("x").eqNullSafe(parse_yyyymmdd_text("x")))
    assert diff.count() == 0


def test_parse_mdy_and_cast_date(spark):
    df = one_col(spark, ["5/3/2001", "12/31/1999", "13/1/2000", None], "c string")
    assert results(df, dates.parse_mdy_date("c")) == [dt.date(2001, 5, 3), dt.date(1999, 12, 31), None, None]
    iso = one_col(spark, ["2011-07-01", "2011-07-01?", None], "c string")
    assert results(iso, dates.cast_date("c")) == [dt.date(2011, 7, 1), None, None]


def test_null_future_dates(spark):
    df = one_col(spark, [dt.date(2999, 1, 1), dt.date(2024, 1, 1), dt.date(1970, 5, 5), None], "d date")
    assert results(df, dates.null_future_dates("d", "2024-01-01")) == \
        [None, dt.date(2024, 1, 1), dt.date(1970, 5, 5), None]


def test_repair_price(spark):
    df = spark.createDataFrame(
        [(10, 100, 5), (None, 100, 4), (0, 90, 3), (-5, -100, 2), (None, 100, 0), (None, 100, None)],
        "price int, sales int, qty int")
    assert results(df, values.repair_price("price", "sales", "qty")) == [10.0, 25.0, 30.0, -50.0, None, None]


def test_cast_decimal_rounds_half_up_and_overflow_is_null(spark):
    df = one_col(spark, [256.275, 1.005, 1e12, None], "c double")
    got = results(df, values.cast_decimal("c"))
    assert [None if g is None else str(g) for g in got] == ["256.28", "1.01", None, None]


def test_product_key_split(spark):
    df = one_col(spark, ["CO-RF-FR-R92B-58", "AC-HE-HL-U509", "AB"], "k string")
    assert results(df, values.category_id_from_key("k")) == ["CO_RF", "AC_HE", "AB"]
    assert results(df, values.product_number_from_key("k")) == ["FR-R92B-58", "HL-U509", ""]


def test_id_cleanup(spark):
    df = one_col(spark, ["NASAW00001", "AW00002", "nasAW3", None], "c string")
    assert results(df, values.strip_id_prefix("c")) == ["AW00001", "AW00002", "nasAW3", None]
    hy = one_col(spark, ["AW-000-1", "AW2", None], "c string")
    assert results(hy, values.strip_hyphens("c")) == ["AW0001", "AW2", None]


def test_coalesce_default_keeps_type(spark):
    df = one_col(spark, [None, 7], "c int")
    out = df.select(values.coalesce_default("c", 0).alias("x"))
    assert out.schema["x"].dataType.simpleString() == "int"
    assert [r.x for r in out.collect()] == [0, 7]


def test_trim_removes_blanks_only(spark):
    from refinery.operators.frames import trim_all_strings
    df = spark.createDataFrame([("  a ", "\tb\n", 1)], "x string, y string, n int")
    row = trim_all_strings(df).collect()[0]
    assert row.x == "a" and row.y == "\tb\n" and row.n == 1


def test_no_python_udf_in_cleaning_plans(spark):
    df = one_col(spark, ["x"], "c string").select(
        codes.normalize_country("c"), dates.parse_yyyymmdd(F.lit(20200101)), values.strip_hyphens("c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
