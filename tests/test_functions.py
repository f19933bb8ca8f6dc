import datetime

import pytest
from pyspark.sql import functions as F

from wirespark.functions import cards, dates, text


def values(spark, rows, expression, ddl="x string"):
    """Expression over one column, in row order."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, {ddl}")
    return [r[1] for r in df.select("i", expression).orderBy("i").collect()]


def test_tag_text_keeps_missing_and_empty_apart(spark):
    rows = [
        "a<PAGE_TITLE>One</PAGE_TITLE>b<PAGE_TITLE>Two</PAGE_TITLE>",
        "<PAGE_TITLE>line\nbreak</PAGE_TITLE>",
        "<PAGE_TITLE></PAGE_TITLE>",
        "<pageTitle>other tag</pageTitle>",
        "<PAGE_TITLE>not closed",
        "",
        None,
    ]
    found = values(spark, rows, text.tag_text(F.col("x")))
    assert found == ["One", "line\nbreak", "", None, None, None, None]


def test_tag_text_or_empty_ignores_case_and_stops_at_line_ends(spark):
    rows = ["<PAGETITLE>A</pagetitle>", "<pageTitle>a\nb</pageTitle>", "<PAGE_TITLE>x</PAGE_TITLE>", None]
    assert values(spark, rows, text.tag_text_or_empty(F.col("x"))) == ["A", "", "", ""]


def test_list_items_trims_then_drops_blanks(spark):
    rows = [None, "", "A;", "A; ;B;", " A ;B"]
    assert values(spark, rows, text.list_items(F.col("x"))) == [
        [],
        [],
        ["A"],
        ["A", "B"],
        ["A", "B"],
    ]


def test_first_item_and_clean_name(spark):
    assert values(spark, ["A;B", ";B", "A", None], text.first_item(F.col("x"))) == [
        "A",
        "",
        "A",
        None,
    ]
    assert values(spark, ["Al B,12", "Al, B", "x"], text.clean_name(F.col("x"))) == [
        "Al B",
        "Al, B",
        "x",
    ]


def test_normalize_text(spark):
    rows = ["  Hello,   World!_x ", "ÉTÉ\tno break", "...", None]
    assert values(spark, rows, text.normalize_text(F.col("x"))) == [
        "hello world _x",
        "été no break",
        "",
        "",
    ]


def test_s_stem(spark):
    rows = ["stories", "eies", "aies", "houses", "shoes", "trees", "cats", "bus", "class", "a"]
    assert values(spark, rows, text.s_stem(F.col("x"))) == [
        "story",
        "eies",
        "aies",
        "house",
        "shoes",
        "trees",
        "cat",
        "bus",
        "class",
        "a",
    ]


def test_bad_dates_are_null(spark):
    rows = ["20240105", "20240199", "x", None]
    assert values(spark, rows, dates.int_date(F.col("x"))) == [
        datetime.date(2024, 1, 5),
        None,
        None,
        None,
    ]


def test_text_date_label(spark):
    rows = ["20240105", "2024-12-31", "", None, "soon", "20240199"]
    assert values(spark, rows, dates.text_date_label(F.col("x"))) == [
        "Jan 5, 2024",
        "Dec 31, 2024",
        "Unknown date",
        "Unknown date",
        "Invalid Date",
        "Invalid Date",
    ]


@pytest.mark.parametrize(
    "given, rounded",
    [
        ("2024-01-01 10:07", "2024-01-01 10:00"),
        ("2024-01-01 10:08", "2024-01-01 10:15"),
        ("2024-01-01 10:52", "2024-01-01 10:45"),
        ("2024-01-01 23:53", "2024-01-02 00:00"),
        ("2024-01-03 00:00", None),
        ("2024-02-30 10:00", None),
        ("yesterday", None),
    ],
)
def test_round_quarter_hour(spark, given, rounded):
    from wirespark.sources.manifest import parse_minute, quarter_hour_range

    as_of = F.lit("2024-01-03 00:00:00").cast("timestamp_ntz")
    start, end = quarter_hour_range(parse_minute(F.col("x")), as_of)
    row = spark.createDataFrame([(given,)], "x string").select(start, end).first()
    if rounded is None:
        assert row[0] is None and row[1] is None
    else:
        assert f"{row[0]:%Y-%m-%d %H:%M}" == rounded
        assert row[1] - row[0] == datetime.timedelta(hours=3)


def test_elapsed_label(spark):
    assert values(spark, [0.0, 59.9, 3661.5, 90061.0], dates.elapsed_label(F.col("x")), "x double") == [
        "0 hours, 0 minutes, 0 seconds",
        "0 hours, 0 minutes, 59 seconds",
        "1 hours, 1 minutes, 1 seconds",
        "25 hours, 1 minutes, 1 seconds",
    ]


def test_theme_category(spark):
    rows = ["military", "TAX_HEALTHCARE", "ECON", "E", "ZZZ", "", None]
    assert values(spark, rows, cards.theme_category(F.col("x"))) == [
        "MILITARY",
        "HEALTH",
        "ECONOMY",
        "GENERAL_GOVERNMENT",
        None,
        None,
        None,
    ]


def test_card_text(spark):
    ddl = "i int, title string, a1 string, a2 string, theme string, n int, tone double"
    rows = [
        (0, "Real", "A", "B", "T_X", 2, 1.0),
        (1, "News Event", "A", "A", "T_X", 1, -1.0),
        (2, None, None, "B", None, 0, 0.0),
        (3, "", "", None, "", None, None),
    ]
    c = F.col
    df = spark.createDataFrame(rows, ddl).orderBy("i")
    found = df.select(
        cards.display_title(c("title"), c("a1"), c("a2"), c("theme")),
        cards.excerpt(c("a1"), c("a2"), c("theme"), c("n"), c("tone")),
        cards.tone_label(c("tone")),
    ).collect()
    assert [tuple(r) for r in found] == [
        (
            "Real",
            "Event involving A and B. Related to t_x. Mentioned 2 times. Overall tone: positive.",
            "positive",
        ),
        (
            "A - (T_X)",
            "Event involving A and A. Related to t_x. Overall tone: negative.",
            "negative",
        ),
        ("B", "Overall tone: neutral.", "neutral"),
        ("News Event", cards.DEFAULT_EXCERPT, None),
    ]


def test_card_links_and_labels(spark):
    ddl = "i int, source string, doc string, image string, theme string, c double"
    rows = [
        (0, "http://a", "http://b", "http://i", "MILITARY", -1234.56),
        (1, "", "b.com/x", "i.jpg", "sports news", 0.0),
        (2, None, None, None, None, None),
    ]
    c = F.col
    df = spark.createDataFrame(rows, ddl).orderBy("i")
    found = df.select(
        cards.article_url(c("source"), c("doc")),
        cards.image_url(c("image"), c("theme")),
        cards.confidence_label(c("c")),
        cards.source_label(c("source")),
    ).collect()
    assert [tuple(r) for r in found] == [
        ("http://a", "http://i", "1234.6%", "http://a"),
        ("https://b.com/x", cards.PICTURE_URL.format(n=1263348), "0.0%", "Unknown"),
        (None, cards.PICTURE_URL.format(n=4265906), None, "Unknown"),
    ]
