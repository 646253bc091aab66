"""Column expressions on literal rows with literal answers."""

from __future__ import annotations

import pytest

from shelfcast.functions import numeric, text


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expr).collect()]


def test_clip_keeps_null(spark):
    assert values(spark, [(-1.0,), (25.0,), (7.0,), (None,)], "x DOUBLE", numeric.clip("x", 0, 20)) == [0, 20, 7, None]


def test_clip_is_idempotent(spark):
    once = numeric.clip("x", 0, 20)
    rows = [(float(i - 30),) for i in range(80)]
    assert values(spark, rows, "x DOUBLE", once) == values(spark, rows, "x DOUBLE", numeric.clip(once, 0, 20))


def test_trend_walk_stops_at_missing_and_skips_zero(spark):
    rows = [(None, 0.5, 0.5), (0.0, 0.5, 0.1), (0.0, None, 0.1), (0.2, 0.5, 0.1), (0.0, 0.0, 0.0)]
    got = values(spark, rows, "d1 DOUBLE, d2 DOUBLE, d3 DOUBLE", numeric.select_trend(["d1", "d2", "d3"]))
    assert got == [0.0, 0.5, 0.0, 0.2, 0.0]


def test_relative_delta_of_zero_base_is_null(spark):
    assert values(spark, [(5.0, 0.0), (6.0, 4.0)], "v DOUBLE, b DOUBLE", numeric.relative_delta("v", "b")) == [None, 0.5]


def test_february_always_has_28_days(spark):
    months = [(1,), (13,), (12 * 3 + 1,), (0,), (11,)]
    assert values(spark, months, "m INT", numeric.days_in_month("m")) == [28, 28, 28, 31, 31]


def test_parse_date(spark):
    assert str(values(spark, [("02.01.2013",)], "d STRING", numeric.parse_date("d"))[0]) == "2013-01-02"


@pytest.mark.parametrize(
    "name, name2, name3",
    [
        ("Game [PC, диск] x", "pc диск ", "0"),
        ("Game (Extra disc)", "0", "extra disc "),
        ("Plain", "0", "0"),
        ("Игра [Xbox 360, русская] (rus)", "xbox 360 русская rus", "rus "),
        ("Ёлка [ёж]", " ж", "0"),
        ("a [0", "0", "0"),
        ("a [7", "", "0"),
    ],
)
def test_name_parts(spark, name, name2, name3):
    df = spark.createDataFrame([(name,)], "n STRING")
    assert tuple(df.select(text.bracket_part("n"), text.parenthesis_part("n")).first()) == (name2, name3)


@pytest.mark.parametrize(
    "name2, kind",
    [
        ("xbox 360 русская", "xbox360"),
        ("xbox one русская", "xboxone"),
        ("xbox360 x", "xbox360"),
        ("x360 a", "xbox360"),
        ("pс", "pc"),
        ("pc cd", "pc"),
        ("рs3", "ps3"),
        ("ps3", "ps3"),
        ("", "mac"),
        (" a", "mac"),
        ("0", "0"),
        ("xboxes a", "xboxes"),
        ("xbox", "xbox"),
    ],
)
def test_item_type(spark, name2, kind):
    assert values(spark, [(name2,)], "n STRING", text.item_type("n")) == [kind]


def test_subtype(spark):
    rows = [("A - B",), ("A - Blu-Ray",), ("Whole name ",), ("A - B - C",)]
    assert values(spark, rows, "n STRING", text.subtype("n")) == ["B", "Blu", "Whole name", "B"]


def test_tokens(spark):
    rows = [("Казань ТЦ x",), ("Один",)]
    assert values(spark, rows, "n STRING", text.token("n", 1)) == ["Казань", "Один"]
    assert values(spark, rows, "n STRING", text.token("n", 2)) == ["ТЦ", None]
    assert values(spark, rows, "n STRING", text.first_word("n")) == ["Казань", None]


def test_greedy_prefix(spark):
    rows = [("Игры - PC - доп",), ("Билеты",)]
    assert values(spark, rows, "n STRING", text.greedy_prefix("n")) == ["Игры - PC", None]


def test_multi_match_joins_in_fixed_order(spark):
    rows = [("Игры PSP PS2",), ("Книги",)]
    assert values(spark, rows, "n STRING", text.multi_match("n", ["PS2", "PSP"])) == ["PS2PSP", "None"]


def test_normalise_name(spark):
    rows = [("Супер-Игра! II [PC] (x)",), (" (x)",)]
    assert values(spark, rows, "n STRING", text.normalise_name("n")) == ["супер игра ii", ""]


def test_contains_flag(spark):
    assert values(spark, [("a (Цифра)",), ("a",)], "n STRING", text.contains_flag("n", "(Цифра)")) == [True, False]
