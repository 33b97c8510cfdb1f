"""Golden cells: literal input, expected value."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from contentlake.functions import dates, numbers, text


def evaluate(spark, cells, expr):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    return [r["x"] for r in df.selectExpr("i", f"{expr} AS x").orderBy("i").collect()]


def check(spark, cases, expr):
    got = evaluate(spark, list(cases), expr)
    wrong = {c: (g, w) for (c, w), g in zip(cases.items(), got) if g != w}
    assert not wrong


def test_whitespace_is_what_unicode_calls_space():
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_strip(spark):
    check(spark, {" \xa0　a\xa0b\t\n": "a\xa0b", "": "", "x": "x", None: None}, text.strip("c"))


def test_mixed_dates(spark):
    d = datetime
    day = d(2024, 1, 5)
    moment = d(2024, 1, 5, 7, 8, 9)
    cases = {c: day for c in ("2024-01-05", "2024/1/5", "2024.01.05", "05/01/2024", "5-1-2024", "5.1.2024")}
    cases |= {" 2024-01-05 ": day, "\xa02024-01-05\n": day, "13/01/24": d(2024, 1, 13)}
    cases |= {"2024/01/05 7:08:09": moment, "2024-01-05 07:08:09": moment}
    cases |= {"01/02/68": d(2068, 2, 1), "01/02/69": d(1969, 2, 1)}
    cases |= {"45292": d(2024, 1, 1), "100": d(1900, 4, 9), "73415": d(2100, 12, 31), "002": d(1900, 1, 1), "2024": d(1905, 7, 16)}
    nothing = (
        "2024-01-05 7:08:09", "12", "202401", "999999", "73416", "001", "31/02/2024", "abc",
        "05/01/2024 07:08:09", "2024-01-05 07:08", "", "-", "nan", "None", "NaT", None,
        "1899-12-31", "2101-01-01", "2024-01",
    )
    cases |= {c: None for c in nothing}
    check(spark, cases, dates.parse_mixed_dates("c"))


def test_numbers(spark):
    value = {
        "1.234": "1234", "Rp 1.234,50": "1234.5", "5,": "5", ",5": "0.5", "-5": "5", "": "0",
        "-": "0", "nan": "0", "n/a": "0", "######": "0", "Rp": "0", ".": "0", "1,2,3": "0",
        "12%": "12", "12a": "12", "rp 5": "5", None: "0",
    }
    check(spark, {c: Decimal(v) for c, v in value.items()}, numbers.clean_number("c"))
    check(spark, value, numbers.plain_number(numbers.clean_number("c")))
    corrupt = {"######", "Rp", ".", "1,2,3", "12%", "12a", "rp 5"}
    check(spark, {c: c in corrupt for c in value}, numbers.is_numeric_corrupt("c"))


def test_percents(spark):
    cases = {"12.3%": 0.123, "12": 0.12, "0,00%": None, "######": None, "-": None, "12d": None}
    got = evaluate(spark, list(cases), numbers.percent_to_fraction("c"))
    assert [None if g is None else round(g, 9) for g in got] == list(cases.values())
    assert evaluate(spark, ["0,50%"], numbers.percent_to_fraction("c", True)) == [0.005]
    check(
        spark,
        {"12.3%": False, "0,00%": False, "######": False, "-": False, "IDR": True, None: False},
        numbers.is_percent_corrupt("c"),
    )


def test_blank_and_non_empty(spark):
    blank = {"": True, "-": True, " NaN ": True, "none": True, "nat": True, "n/a": False, "0": False, None: True}
    full = {"": False, "-": False, " NaN ": False, "none": False, "nat": True, "n/a": False, "0": True, None: False}
    check(spark, blank, text.is_blank("c"))
    check(spark, full, text.is_non_empty("c"))
    check(spark, {"": False, " \t": False, "x": True, None: True}, text.has_id("c"))


def test_round_half_even(spark):
    cases = {"0.5": 0, "1.5": 2, "2.5": 2, None: 0}
    check(spark, cases, numbers.round_half_even(f"CAST(c AS {numbers.MONEY})"))


def test_names():
    assert text.snake_case("Nilai barang dagangan bruto (Video) (Rp)") == "nilai_barang_dagangan_bruto_video_rp"
    assert text.snake_case("GPM (Rp)") == "gpm_rp"
    assert text.snake_case("No. Video") == "no_video"
    assert text.snake_case(" A-B/C% ") == "abc"
    assert text.snake_case("a  b") == "a__b"


def test_usual_cells_read_as_the_general_patterns_do(spark):
    """The short patterns stand in front of the general ones and must agree with them."""
    cells = ["1.234", "Rp 1.234,56", "-5", "5,", ",5", "1,2,3", "Rp", "#12", "\xa07", "9" * 40, "7\n", "", None]
    general = f"CASE WHEN c RLIKE r'{numbers.NUMERIC_CELL}' THEN 1 ELSE 0 END"
    fits = evaluate(spark, cells, f"c RLIKE r'{numbers._USUAL_NUMBER}'")
    assert all(g == 1 for f, g in zip(fits, evaluate(spark, cells, general)) if f)
    assert fits[:5] == [True, True, True, False, False]
    check(
        spark,
        {"1.234": Decimal(1234), "Rp 1.234,56": Decimal("1234.56"), "-5": Decimal(5), "5,": Decimal(5), "7\n": Decimal(7)},
        numbers.clean_number("c"),
    )
    check(spark, {"12.5%": 0.125, "s3": 0.03, "4\\": 0.04, "1,5%": None, "": None}, numbers.percent_to_fraction("c"))
    texts = {"0": "0", "0.000000001": "0.000000001", "-0.001": "-0.001", "120": "120", "-7.5": "-7.5", "0.123": "0.123"}
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        check(spark, texts, numbers.plain_number(f"CAST(c AS {numbers.MONEY})"))
    spark.conf.set("spark.sql.ansi.enabled", "true")
    day = datetime(2024, 3, 9)
    check(
        spark,
        {"2024.3/09": day, "09/3-2024": day, "2024/3/9 7:08:09": datetime(2024, 3, 9, 7, 8, 9), "2024-3-9 7:08:09": None,
         "2101-01-01": None, "2024-02-31": None, "": None},
        dates.parse_mixed_dates("c"),
    )
