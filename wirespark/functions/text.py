"""Text expressions: tag capture, list splitting, normalising, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_text(column: Column, tag: str = "PAGE_TITLE") -> Column:
    """Text of the first ``<tag>…</tag>``, newlines included; NULL if there is none.

    The whole element is matched once and its known-length tags cut off, which
    keeps an empty element ('') apart from a missing one (NULL).
    """
    return _inside(F.regexp_substr(column, F.lit(f"(?s)<{tag}>.*?</{tag}>")), tag)


def tag_text_or_empty(column: Column, tag: str = "pageTitle") -> Column:
    """Text of the first one-line ``<tag>…</tag>`` in any case; '' if there is none."""
    element = F.regexp_substr(column, F.lit(f"(?id)<{tag}>.*?</{tag}>"))
    return F.coalesce(_inside(element, tag), F.lit(""))


def _inside(element: Column, tag: str) -> Column:
    return F.substr(element, F.lit(len(tag) + 3), F.length(element) - F.lit(2 * len(tag) + 5))


def first_item(column: Column, separator: str = ";") -> Column:
    """Text before the first separator."""
    return F.split_part(column, F.lit(separator), F.lit(1))


def list_items(column: Column, separator: str = ";") -> Column:
    """Items of a delimited list, trimmed, blank ones dropped; NULL gives []."""
    parts = F.split(F.coalesce(column, F.lit("")), separator)
    return F.filter(F.transform(parts, lambda item: F.trim(item)), lambda item: item != "")


def clean_name(column: Column) -> Column:
    """A name item without its ``,offset`` suffix."""
    return F.regexp_replace(column, r",\d+$", "")


def normalize_text(column: Column) -> Column:
    """Lower-case words separated by single spaces; NULL gives ''."""
    words = F.regexp_replace(F.coalesce(column, F.lit("")), r"[^\p{L}\p{N}_]+", " ")
    return F.lower(F.trim(words))


def joined_text(*columns: Column) -> Column:
    """Columns separated by single spaces, NULL as ''."""
    return F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])


def search_tokens(column: Column, stop_words: list[str]) -> Column:
    """Search terms of a text: letter/digit runs, lower case, no stop words, stemmed."""
    words = F.split(F.lower(F.coalesce(column, F.lit(""))), r"[^\p{L}\p{N}]+")
    kept = F.filter(words, lambda w: (w != "") & ~w.isin(stop_words))
    return F.transform(kept, s_stem)


def s_stem(word: Column) -> Column:
    """S-stemmer (Harman 1991): plural endings, first applicable rule only."""
    return (
        F.when(
            F.endswith(word, F.lit("ies")),
            F.when(
                F.endswith(word, F.lit("eies")) | F.endswith(word, F.lit("aies")), word
            ).otherwise(F.concat(_without_last(word, 3), F.lit("y"))),
        )
        .when(
            F.endswith(word, F.lit("es")),
            F.when(
                F.endswith(word, F.lit("aes"))
                | F.endswith(word, F.lit("ees"))
                | F.endswith(word, F.lit("oes")),
                word,
            ).otherwise(_without_last(word, 1)),
        )
        .when(
            F.endswith(word, F.lit("s")),
            F.when(
                F.endswith(word, F.lit("us")) | F.endswith(word, F.lit("ss")), word
            ).otherwise(_without_last(word, 1)),
        )
        .otherwise(word)
    )


def _without_last(word: Column, n: int) -> Column:
    return F.substr(word, F.lit(1), F.length(word) - F.lit(n))


def contains_ignoring_case(column: Column, text: str) -> Column:
    """Literal substring test without regard to case; NULL does not match."""
    return F.coalesce(F.contains(F.lower(column), F.lit(text.lower())), F.lit(False))
