"""Table schemas and the raw positions they are read from."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Width of a raw record and (raw position, column, type) per feed.
RAW_WIDTH = {"export": 61, "mentions": 16, "gkg": 27}

FEED_COLUMNS: dict[str, list[tuple[int, str, str]]] = {
    "export": [
        (0, "globaleventid", "string"),
        (1, "sqldate", "int"),
        (6, "actor1name", "string"),
        (16, "actor2name", "string"),
        (26, "eventcode", "string"),
        (27, "eventbasecode", "string"),
        (28, "eventrootcode", "string"),
        (29, "quadclass", "int"),
        (30, "goldsteinscale", "double"),
        (33, "nummentions", "int"),
        (34, "avgtone", "double"),
        (40, "actor1geo_lat", "double"),
        (41, "actor1geo_long", "double"),
        (48, "actor2geo_lat", "double"),
        (49, "actor2geo_long", "double"),
        (56, "actiongeo_lat", "double"),
        (57, "actiongeo_long", "double"),
        (59, "dateadded", "bigint"),
        (60, "sourceurl", "string"),
    ],
    "mentions": [
        (0, "globaleventid", "string"),
        (2, "mentiontimedate", "bigint"),
        (4, "mentionssource", "string"),
        (5, "mentionidentifier", "string"),
        (11, "confidence", "double"),
    ],
    "gkg": [
        (0, "gkgrecordid", "string"),
        (1, "date", "string"),
        (3, "sourcecommonname", "string"),
        (4, "documentidentifier", "string"),
        (7, "themes", "string"),
        (11, "persons", "string"),
        (13, "organizations", "string"),
        (18, "sharingimage", "string"),
        (19, "relatedimages", "string"),
        (23, "allnames", "string"),
        (26, "extras", "string"),
    ],
}

# Child table -> (list column of gkg it comes from, item column).
CHILD_TABLES = {
    "gkg_themes": ("themes", "theme"),
    "gkg_persons": ("persons", "person"),
    "gkg_organizations": ("organizations", "organization"),
    "gkg_names": ("allnames", "name"),
}

# Base table -> feed it is read from.
BASE_TABLES = {"events": "export", "mentions": "mentions", "gkg": "gkg"}


def raw_schema(feed: str) -> T.StructType:
    """All raw positions as strings: no inference pass, leading zeros kept."""
    return T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(RAW_WIDTH[feed])])


def table_schema(table: str) -> T.StructType:
    """Typed schema of a base or child table."""
    if table in CHILD_TABLES:
        return T.StructType.fromDDL(f"gkgrecordid string, {CHILD_TABLES[table][1]} string")
    columns = FEED_COLUMNS[BASE_TABLES[table]]
    return T.StructType.fromDDL(", ".join(f"`{name}` {dtype}" for _, name, dtype in columns))


TABLE_NAMES = [*BASE_TABLES, *CHILD_TABLES]


@dataclass(frozen=True)
class NewsTables:
    """The seven relations the queries run on."""

    events: DataFrame
    mentions: DataFrame
    gkg: DataFrame
    gkg_themes: DataFrame
    gkg_persons: DataFrame
    gkg_organizations: DataFrame
    gkg_names: DataFrame

    def named(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in TABLE_NAMES}
