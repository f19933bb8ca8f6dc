"""Display columns of an article. NULL stands for an absent field throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Theme keys in match order.
THEME_KEYS = [
    "GENERAL_GOVERNMENT",
    "MILITARY",
    "SCIENCE_TECHNOLOGY",
    "EDUCATION",
    "HEALTH",
    "ECONOMY",
    "ENVIRONMENT",
    "SPORTS",
    "CRIME",
    "POLITICS",
]

# Stand-in picture number per theme key, in match order.
THEME_PICTURES = {
    "GENERAL_GOVERNMENT": 8386440,
    "MILITARY": 1263348,
    "SCIENCE_TECHNOLOGY": 586063,
    "EDUCATION": 4265906,
    "HEALTH": 8386440,
    "ECONOMY": 6801874,
    "ENVIRONMENT": 9800029,
    "SPORTS": 1263348,
}
DEFAULT_PICTURE = 4265906
PICTURE_URL = (
    "https://images.pexels.com/photos/{n}/pexels-photo-{n}.jpeg?auto=compress&cs=tinysrgb&w=800"
)
# Titles that count as missing.
PLACEHOLDER_TITLES = ["News Event", "Breaking News Event"]
DEFAULT_EXCERPT = "Click to read more details about this news event."


def _present(column: Column) -> Column:
    return F.coalesce(column != "", F.lit(False))


def _first_related(theme: Column, values: dict[str, str]) -> Column:
    """Value of the first key that contains the theme or is contained in it."""
    upper = F.upper(theme)
    pairs = F.array(
        *[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in values.items()]
    )
    related = F.filter(
        pairs, lambda pair: F.contains(upper, pair["key"]) | F.contains(pair["key"], upper)
    )
    return F.when(_present(theme), F.get(related, 0)["value"])


def theme_category(theme: Column) -> Column:
    """Category of a theme: the key itself, else the first related key, else NULL."""
    related = _first_related(theme, {key: key for key in THEME_KEYS})
    return F.when(F.upper(theme).isin(THEME_KEYS), F.upper(theme)).otherwise(related)


def theme_label(theme: Column) -> Column:
    return F.translate(theme, "_", " ")


def display_title(title: Column, actor1: Column, actor2: Column, theme: Column) -> Column:
    """The title, or one made of actors and theme where it is missing or a placeholder."""
    parts = F.concat_ws(
        " - ",
        F.when(_present(actor1), actor1),
        F.when(_present(actor2) & ~actor2.eqNullSafe(actor1), actor2),
        F.when(_present(theme), F.concat(F.lit("("), theme, F.lit(")"))),
    )
    return (
        F.when(_present(title) & ~title.isin(PLACEHOLDER_TITLES), title)
        .when(parts != "", parts)
        .otherwise(F.lit("News Event"))
    )


def tone_label(tone: Column) -> Column:
    return (
        F.when(tone > 0, F.lit("positive"))
        .when(tone < 0, F.lit("negative"))
        .when(tone.isNotNull(), F.lit("neutral"))
    )


def excerpt(
    actor1: Column, actor2: Column, theme: Column, mentions: Column, tone: Column
) -> Column:
    """Up to four sentences about actors, theme, mentions and tone."""
    sentences = F.concat_ws(
        ". ",
        F.when(
            _present(actor1) & _present(actor2),
            F.concat(F.lit("Event involving "), actor1, F.lit(" and "), actor2),
        ).when(_present(actor1), F.concat(F.lit("Event involving "), actor1)),
        F.when(_present(theme), F.concat(F.lit("Related to "), F.lower(theme))),
        F.when(
            mentions > 1,
            F.concat(F.lit("Mentioned "), mentions.cast("string"), F.lit(" times")),
        ),
        F.concat(F.lit("Overall tone: "), tone_label(tone)),
    )
    return F.when(sentences != "", F.concat(sentences, F.lit("."))).otherwise(
        F.lit(DEFAULT_EXCERPT)
    )


def article_url(source_url: Column, document_url: Column) -> Column:
    """First non-empty address, with a protocol."""
    url = F.when(_present(source_url), source_url).when(_present(document_url), document_url)
    return F.when(F.startswith(url, F.lit("http")), url).otherwise(
        F.concat(F.lit("https://"), url)
    )


def image_url(image: Column, theme: Column) -> Column:
    """Own picture, else one for the theme, else the default."""
    pictures = {key: PICTURE_URL.format(n=n) for key, n in THEME_PICTURES.items()}
    default = F.lit(PICTURE_URL.format(n=DEFAULT_PICTURE))
    stand_in = F.coalesce(_first_related(theme, pictures), default)
    return F.when(F.startswith(image, F.lit("http")), image).otherwise(stand_in)


def confidence_label(confidence: Column) -> Column:
    """Magnitude with one decimal and a percent sign."""
    return F.when(confidence.isNotNull(), F.format_string("%.1f%%", F.abs(confidence)))


def source_label(source: Column, default: str = "Unknown") -> Column:
    return F.when(_present(source), source).otherwise(F.lit(default))
