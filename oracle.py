"""Reference results as plain SQL over the star-schema test tables.

Each query is written in its textbook form (join everything, then rank and
deduplicate), so agreement with the Spark plans also checks their rewrites.
"""

from __future__ import annotations

import glob
import os
import zipfile

import pyspark


def stop_words() -> list[str]:
    """Spark's default English stop words, from the MLlib jar."""
    jars = os.path.join(os.environ.get("SPARK_HOME", os.path.dirname(pyspark.__file__)), "jars")
    with zipfile.ZipFile(glob.glob(f"{jars}/spark-mllib_*.jar")[0]) as jar:
        text = jar.read("org/apache/spark/ml/feature/stopwords/english.txt").decode()
    return text.split()


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


EV = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS globaleventid,
    CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS sqldate,
    CASE WHEN user_id % 5 <> 0 THEN 'ACTOR_' || (user_id % 40) END AS actor1name,
    CASE WHEN event_id % 3 <> 0 THEN 'ACTOR_' || (event_id % 40) END AS actor2name,
    CASE event_type WHEN 'click' THEN '010' WHEN 'error' THEN '042' WHEN 'purchase' THEN '061'
      WHEN 'signup' THEN '111' ELSE '190' END AS eventcode,
    CAST(1 + event_id % 4 AS INTEGER) AS quadclass,
    CAST(event_id % 21 AS DOUBLE) - 10 AS goldsteinscale,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS nummentions,
    CASE WHEN event_id % 17 <> 0 THEN value - 100 END AS avgtone,
    CAST(event_id % 181 AS DOUBLE) - 90 AS lat,
    CAST(event_id % 361 AS DOUBLE) - 180 AS long,
    CAST(strftime(ts, '%Y%m%d%H%M%S') AS BIGINT) AS dateadded,
    CAST(strptime(strftime(ts, '%Y%m%d'), '%Y%m%d') AS DATE) AS event_date,
    url AS sourceurl
  FROM events JOIN pages ON page_id = event_id % (SELECT count(*) FROM pages))"""

MN = """mn AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS globaleventid,
    CAST(strftime(l_shipdate, '%Y%m%d%H%M%S') AS BIGINT) AS mentiontimedate,
    'src' || (l_suppkey % 20) AS mentionssource,
    'http://m.example.com/' || l_partkey || '/' || l_linenumber AS mentionidentifier,
    CASE WHEN l_linenumber <> 7 THEN l_quantity * 2 END AS confidence
  FROM lineitem)"""

GK = """gk AS (
  SELECT '20240101000000-' || page_id AS gkgrecordid,
    '20240101' || lpad(CAST(page_id % 24 AS VARCHAR), 2, '0') || '0000' AS date,
    CASE WHEN page_id % 11 <> 0 THEN d.source END AS sourcecommonname,
    url AS documentidentifier,
    CASE WHEN page_id % 13 <> 0 THEN a.p_type || '_' || replace(a.p_brand, '#', '_') || ';'
      || b.p_type || '_' || replace(b.p_brand, '#', '_') || ';' END AS themes,
    CASE WHEN page_id % 7 = 0 THEN ''
      ELSE 'person ' || (page_id % 17) || '; ;person ' || (page_id % 23) END AS persons,
    'org ' || (page_id % 29) || ';org ' || (page_id % 5) || ';' AS organizations,
    'Name ' || (page_id % 31) || ',' || page_id || ';' || a.p_name || ',7' AS allnames,
    CASE WHEN page_id % 4 <> 0 THEN 'http://img.example.com/' || page_id || '.jpg' END
      AS sharingimage,
    CASE WHEN page_id % 19 = 0 THEN '<X>none</X>' ELSE '<PAGE_TITLE>'
      || regexp_extract(html, '<title>(.*?)</title>', 1) || '</PAGE_TITLE>' END AS extras
  FROM pages
  LEFT JOIN documents d ON d.doc_id = page_id % (SELECT count(*) FROM documents)
  LEFT JOIN part a ON a.p_partkey = page_id % (SELECT count(*) FROM part)
  LEFT JOIN part b ON b.p_partkey = (page_id * 7 + 3) % (SELECT count(*) FROM part))"""

GR = """gr AS (
  SELECT *, row_number() OVER () AS rid, split_part(themes, ';', 1) AS first_theme,
    CASE WHEN regexp_matches(extras, '(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>')
      THEN regexp_extract(extras, '(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>', 1) END AS page_title
  FROM gk)"""


def _child(name: str, column: str, item: str) -> str:
    return f"""{name} AS (
  SELECT gkgrecordid, trim(x) AS {item}
  FROM (SELECT gkgrecordid, unnest(string_split(coalesce({column}, ''), ';')) AS x FROM gk)
  WHERE trim(x) <> '')"""


GT = _child("gt", "themes", "theme")
GP = _child("gp", "persons", "person")
GO = _child("go_", "organizations", "organization")
GN = _child("gn", "allnames", "name")

JOINED = """ev JOIN gr ON sourceurl = documentidentifier JOIN mn USING (globaleventid)"""

ARTICLE = """globaleventid AS id, actor1name AS actor1_name, actor2name AS actor2_name, event_date,
  nummentions AS num_mentions, avgtone AS avg_tone, confidence, sourceurl AS source_url,
  sourcecommonname AS source, first_theme AS theme, sharingimage AS image, page_title AS title"""

RECORD_ORDER = "gkgrecordid, sourcecommonname, first_theme, sharingimage, page_title"

TOP = f"""ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY avgtone, eventcode, coalesce(actor1name, actor2name)
    ORDER BY nummentions DESC NULLS FIRST, abs(confidence) DESC NULLS FIRST,
      avgtone DESC NULLS FIRST, globaleventid, confidence DESC, {RECORD_ORDER}) AS rn
  FROM {JOINED}
  WHERE nummentions > 0 AND avgtone IS NOT NULL AND confidence IS NOT NULL
    AND sharingimage IS NOT NULL),
unique_urls AS (
  SELECT *, row_number() OVER (PARTITION BY sourceurl
    ORDER BY nummentions DESC NULLS FIRST, abs(confidence) DESC NULLS FIRST,
      avgtone DESC NULLS FIRST, globaleventid, confidence DESC, {RECORD_ORDER}) AS un
  FROM ranked WHERE rn = 1),
top AS (
  SELECT {ARTICLE} FROM unique_urls WHERE un = 1
  ORDER BY nummentions DESC, avgtone DESC, abs(confidence) DESC, globaleventid LIMIT 5000)"""

FEATURED = """featured AS (
  SELECT globaleventid AS id, actor1name AS actor1_name, actor2name AS actor2_name, dateadded,
    event_date, eventcode, nummentions, avgtone, sourceurl AS url, documentidentifier, confidence,
    sourcecommonname, first_theme, sharingimage AS image,
    coalesce(page_title, 'News Article') AS title
  FROM {joined}
  WHERE nummentions > 0 AND avgtone IS NOT NULL AND sharingimage IS NOT NULL
  ORDER BY (nummentions / 3.0) * avgtone DESC, globaleventid, confidence DESC NULLS LAST,
    {records} LIMIT {limit})"""

ALL_ARTICLES = f"""best_mention AS (
  SELECT globaleventid, confidence FROM (
    SELECT *, row_number() OVER (PARTITION BY globaleventid
      ORDER BY abs(confidence) DESC NULLS LAST, confidence DESC NULLS LAST) AS mr FROM mn)
  WHERE mr = 1),
first_record AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY documentidentifier
    ORDER BY {RECORD_ORDER}) AS dr FROM gr) WHERE dr = 1),
articles AS (
  SELECT {ARTICLE}, dateadded FROM ev
  LEFT JOIN best_mention USING (globaleventid)
  LEFT JOIN first_record ON sourceurl = documentidentifier)"""

ARTICLE_FIELDS = """id, actor1_name, actor2_name, event_date, num_mentions, avg_tone, confidence,
  source_url, source, theme, image, title"""

NORMALIZED = "lower(trim(regexp_replace(coalesce({c}, ''), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')))"

STEM = """CASE
  WHEN w LIKE '%ies' THEN CASE WHEN w LIKE '%eies' OR w LIKE '%aies' THEN w
    ELSE left(w, length(w) - 3) || 'y' END
  WHEN w LIKE '%es' THEN CASE WHEN w LIKE '%aes' OR w LIKE '%ees' OR w LIKE '%oes' THEN w
    ELSE left(w, length(w) - 1) END
  WHEN w LIKE '%s' THEN CASE WHEN w LIKE '%us' OR w LIKE '%ss' THEN w
    ELSE left(w, length(w) - 1) END
  ELSE w END"""

RECORD_TEXT = """coalesce(themes, '') || ' ' || coalesce(persons, '') || ' '
  || coalesce(organizations, '') || ' ' || coalesce(allnames, '') || ' '
  || coalesce(page_title, 'News Article')"""


def _tokens(name: str, source: str, key: str, text: str) -> str:
    """Search terms of a text column, one row per token."""
    return f"""{name} AS (
  SELECT {key}, {STEM} AS term FROM (
    SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS w
    FROM {source})
  WHERE w <> '' AND NOT list_contains({_sql_list(stop_words())}, w))"""


def _tfidf_terms(name: str, source: str, key: str, text: str) -> str:
    """1- and 2-gram counts of a text column."""
    return f"""{name}_words AS (
  SELECT {key}, list_filter(string_split({NORMALIZED.format(c=text)}, ' '),
    lambda w: length(w) >= 2 AND NOT list_contains({_sql_list(stop_words())}, w)) AS ws
  FROM {source}),
{name}_grams AS (
  SELECT {key}, unnest(list_concat(ws, list_transform(range(1, len(ws)),
    lambda i: ws[i] || ' ' || ws[i + 1]))) AS term
  FROM {name}_words),
{name} AS (SELECT {key}, term, count(*) AS tf FROM {name}_grams GROUP BY ALL)"""


def _vocabulary(source: str, terms: str) -> str:
    return f"""vocab AS (
  SELECT term, df, cf, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM (
    SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM {terms} GROUP BY term),
    (SELECT count(*) AS n FROM {source})
  WHERE df >= 2 AND df <= 0.8 * n ORDER BY cf DESC, term LIMIT 1000)"""


def _nearest(source: str, terms: str, key: str, query: str, k: int) -> str:
    return f"""asked AS (SELECT 1 AS qid, '{query}' AS q),
{_tfidf_terms("qt", "asked", "qid", "q")},
qv AS (SELECT term, tf * idf AS x FROM qt JOIN vocab USING (term)),
sums AS (
  SELECT t.{key}, sum(tf * idf * coalesce(qv.x, 0)) AS dot, sqrt(sum((tf * idf) ^ 2)) AS norm
  FROM {terms} t JOIN vocab USING (term) LEFT JOIN qv USING (term) GROUP BY t.{key}),
found AS (
  SELECT s.{key}, round(coalesce(dot / (norm * (SELECT sqrt(sum(x * x)) FROM qv)), 0), 6)
    AS similarity
  FROM {source} s LEFT JOIN sums ON sums.{key} = s.{key}
  ORDER BY similarity DESC, s.{key} LIMIT {k})"""


CORPUS = """corpus AS (
  SELECT DISTINCT globaleventid, sqldate AS date, actor1name, actor2name, nummentions,
    gkgrecordid, sourcecommonname, sharingimage AS image, extras, coalesce(theme, '') AS theme,
    coalesce(person, '') AS person, coalesce(organization, '') AS organization,
    coalesce(name, '') AS name, confidence
  FROM ev LEFT JOIN gr ON {on}
  LEFT JOIN gt USING (gkgrecordid) LEFT JOIN gp USING (gkgrecordid)
  LEFT JOIN go_ USING (gkgrecordid) LEFT JOIN gn USING (gkgrecordid)
  LEFT JOIN mn USING (globaleventid)
  ORDER BY date DESC NULLS FIRST, globaleventid, gkgrecordid, sourcecommonname, image, extras,
    theme, person, organization, name, confidence LIMIT 10000)"""



def _items(column: str) -> str:
    return f"""array_to_string(list_sort(list_distinct(list_filter(list_transform(
      string_split(coalesce({column}, ''), ';'), lambda x: trim(x)), lambda x: x <> ''))), ' ')"""


#: One search document per event and article record.
SEARCH_ROWS = f"""records AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY documentidentifier, gkgrecordid
    ORDER BY sourcecommonname, sharingimage, extras, themes, persons, organizations, allnames)
    AS delivery FROM gk) WHERE delivery = 1),
strongest AS (
  SELECT globaleventid, CASE WHEN max(confidence) >= -min(confidence) THEN max(confidence)
    ELSE min(confidence) END AS confidence FROM mn GROUP BY globaleventid),
rows AS (
  SELECT *, concat_ws(' ', title, {_items("themes")}, {_items("persons")},
    {_items("organizations")}, {_items("allnames")}, actor1name, actor2name) AS combined_text
  FROM (
    SELECT {{'e': globaleventid, 'r': gkgrecordid}} AS row_id, globaleventid, sqldate AS date,
      actor1name, actor2name, nummentions, confidence, sourcecommonname, sharingimage AS image,
      coalesce(split_part(themes, ';', 1), '') AS theme, themes, persons, organizations, allnames,
      CASE WHEN regexp_matches(extras, '(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>')
        THEN regexp_extract(extras, '(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>', 1) END AS title
    FROM ev LEFT JOIN records ON sourceurl = documentidentifier
    LEFT JOIN strongest USING (globaleventid)))"""

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
PICTURES = {
    "GENERAL_GOVERNMENT": 8386440,
    "MILITARY": 1263348,
    "SCIENCE_TECHNOLOGY": 586063,
    "EDUCATION": 4265906,
    "HEALTH": 8386440,
    "ECONOMY": 6801874,
    "ENVIRONMENT": 9800029,
    "SPORTS": 1263348,
}


def _related(values: dict[str, str], default: str) -> str:
    cases = " ".join(
        f"WHEN contains(upper(theme), '{k}') OR contains('{k}', upper(theme)) THEN '{v}'"
        for k, v in values.items()
    )
    return f"CASE WHEN coalesce(theme, '') = '' THEN {default} {cases} ELSE {default} END"


def _picture(n: int) -> str:
    return (
        f"https://images.pexels.com/photos/{n}/pexels-photo-{n}.jpeg"
        "?auto=compress&cs=tinysrgb&w=800"
    )


CARDS = f"""
SELECT id,
  CASE WHEN event_date IS NULL THEN 'Unknown date'
    ELSE strftime(event_date, '%b %-d, %Y') END AS date_label,
  {_related({k: k for k in THEME_KEYS}, "NULL")} AS category,
  CASE WHEN coalesce(title, '') NOT IN ('', 'News Event', 'Breaking News Event') THEN title
    WHEN made <> '' THEN made ELSE 'News Event' END AS display_title,
  CASE WHEN parts <> '' THEN parts || '.'
    ELSE 'Click to read more details about this news event.' END AS excerpt,
  tone,
  CASE WHEN source_url LIKE 'http%' THEN source_url ELSE 'https://' || source_url END AS link,
  CASE WHEN image LIKE 'http%' THEN image
    ELSE {_related({k: _picture(n) for k, n in PICTURES.items()}, f"'{_picture(4265906)}'")}
    END AS picture,
  CASE WHEN confidence IS NOT NULL THEN printf('%.1f%%', abs(confidence)) END AS confidence_label,
  replace(theme, '_', ' ') AS theme_label,
  coalesce(nullif(source, ''), 'Unknown') AS source_label
FROM (
  SELECT *,
    concat_ws(' - ', actor1_name, CASE WHEN actor2_name IS DISTINCT FROM actor1_name
      THEN actor2_name END, '(' || nullif(theme, '') || ')') AS made,
    concat_ws('. ',
      CASE WHEN actor1_name IS NOT NULL AND actor2_name IS NOT NULL
        THEN 'Event involving ' || actor1_name || ' and ' || actor2_name
        WHEN actor1_name IS NOT NULL THEN 'Event involving ' || actor1_name END,
      'Related to ' || lower(nullif(theme, '')),
      CASE WHEN num_mentions > 1 THEN 'Mentioned ' || num_mentions || ' times' END,
      'Overall tone: ' || tone) AS parts
  FROM (SELECT *, CASE WHEN avg_tone > 0 THEN 'positive' WHEN avg_tone < 0 THEN 'negative'
    WHEN avg_tone = 0 THEN 'neutral' END AS tone FROM articles))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _detail(on: str) -> str:
    return (
        _with(EV, MN, GK, GR, GT, GP, GO)
        + f"""SELECT globaleventid AS id, sqldate AS date, actor1name AS actor1_name,
  actor2name AS actor2_name, nummentions AS num_mentions, goldsteinscale AS goldstein_scale,
  avgtone AS avg_tone, sourcecommonname AS source, sharingimage AS image,
  documentidentifier AS document_url, coalesce(page_title, 'News Article') AS title,
  string_agg(DISTINCT theme, ', ' ORDER BY theme) AS themes,
  string_agg(DISTINCT person, ', ' ORDER BY person) AS persons,
  string_agg(DISTINCT organization, ', ' ORDER BY organization) AS organizations,
  avg(confidence) AS avg_confidence
FROM ev LEFT JOIN gr ON {on}
LEFT JOIN gt USING (gkgrecordid) LEFT JOIN gp USING (gkgrecordid)
LEFT JOIN go_ USING (gkgrecordid) LEFT JOIN mn USING (globaleventid)
GROUP BY globaleventid, sqldate, actor1name, actor2name, nummentions, goldsteinscale, avgtone,
  sourcecommonname, sharingimage, documentidentifier, page_title, extras"""
    )


def oracle_sql(p) -> dict[str, str]:
    """SQL per query key; ``p`` holds the query parameters of the entry module."""
    news = _with(EV, MN, GK, GR, TOP)
    articles = _with(EV, MN, GK, GR, ALL_ARTICLES)
    featured = FEATURED.format(joined=JOINED, records=RECORD_ORDER, limit=p.FEATURED)
    geo = ", ".join(
        f"{axis} AS {place}_{axis}"
        for place in ("actor1geo", "actor2geo", "actiongeo")
        for axis in ("lat", "long")
    )
    explodes = {
        f"explode_{name}": _with(GK, cte) + f"SELECT gkgrecordid, {item} FROM {alias}"
        for name, cte, alias, item in (
            ("themes", GT, "gt", "theme"),
            ("persons", GP, "gp", "person"),
            ("organizations", GO, "go_", "organization"),
        )
    }
    document_index = _tokens("tok", "documents", "doc_id", "coalesce(text, '')")
    document_terms = _tfidf_terms("dt", "documents", "doc_id", "text")
    document_vocab = _vocabulary("documents", "dt")
    corpus = {
        link: _with(EV, MN, GK, GR, GT, GP, GO, GN, CORPUS.format(on=on))
        for link, on in (
            ("url", "sourceurl = documentidentifier"),
            ("id", "globaleventid = gkgrecordid"),
        )
    }
    table_counts = (
        _with(EV, MN, GK, GT)
        + """SELECT 'events_count' AS metric, count(*) AS value FROM ev
UNION ALL SELECT 'mentions_count', count(*) FROM mn
UNION ALL SELECT 'gkg_count', count(*) FROM gk
UNION ALL SELECT 'themes_count', count(*) FROM gt
UNION ALL SELECT 'common_event_gkg_ids', count(*) FROM ev JOIN gk ON globaleventid = gkgrecordid
UNION ALL SELECT 'common_event_mention_ids', count(*) FROM ev JOIN mn USING (globaleventid)"""
    )
    all_events = (
        _with(EV)
        + f"""SELECT globaleventid, sqldate, actor1name, actor2name, eventcode,
  eventcode AS eventbasecode, left(eventcode, 2) AS eventrootcode, quadclass, goldsteinscale,
  nummentions, avgtone, {geo}, dateadded, sourceurl FROM ev"""
    )
    tfidf_results = (
        _with(
            EV,
            MN,
            GK,
            GR,
            SEARCH_ROWS,
            _tfidf_terms("ct", "rows", "row_id", "combined_text"),
            _vocabulary("rows", "ct"),
            _nearest("rows", "ct", "row_id", p.NEWS_QUERY, 10),
        )
        + """
SELECT globaleventid AS id, coalesce(nullif(title, ''), 'No title available') AS title, date,
  theme, actor1name AS actor1_name, actor2name AS actor2_name, nummentions AS num_mentions,
  confidence, sourcecommonname AS source, image, similarity AS similarity_score
FROM rows JOIN found USING (row_id)"""
    )

    fts_search = (
        _with(EV, MN, GK, GR, _tokens("tok", "gr", "rid", RECORD_TEXT))
        + f"""SELECT {ARTICLE}, rank FROM (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY nummentions DESC NULLS FIRST,
      rank DESC, globaleventid, confidence DESC NULLS LAST, {RECORD_ORDER}) AS rn
    FROM {JOINED} JOIN (
      SELECT rid, round(count(*) * CAST(0.1 AS DOUBLE), 6) AS rank FROM tok
      WHERE term IN ({", ".join(f"'{t}'" for t in p.NEWS_TERMS)}) GROUP BY rid)
      USING (rid))
  WHERE rn = 1 ORDER BY rank DESC, globaleventid, page_title LIMIT 35)"""
    )

    def themed(condition: str) -> str:
        return (
            _with(EV, MN, GK, GR, GT)
            + f"""SELECT {ARTICLE} FROM (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY page_title ORDER BY nummentions DESC NULLS FIRST,
      globaleventid, confidence DESC NULLS LAST, {RECORD_ORDER}) AS rn
    FROM {JOINED} JOIN gt USING (gkgrecordid) WHERE {condition})
  WHERE rn = 1
  ORDER BY nummentions DESC NULLS FIRST, globaleventid, page_title LIMIT 50)"""
        )

    search_terms = ", ".join(f"'{t}'" for t in p.SEARCH_TERMS)
    quarter = "make_timestamp(CAST(floor((epoch(ts) + 450) / 900) * 900000000 AS BIGINT))"
    statements = {
        "page_titles": """SELECT page_id,
  CASE WHEN regexp_matches(html, '(?s)<title>(.*?)</title>')
    THEN regexp_extract(html, '(?s)<title>(.*?)</title>', 1) END AS title,
  CASE WHEN regexp_matches(html, '(?i)<h1>(.*?)</h1>')
    THEN regexp_extract(html, '(?i)<h1>(.*?)</h1>', 1) ELSE '' END AS heading
FROM pages""",
        "normalize_text": f"""SELECT doc_id, {NORMALIZED.format(c="text")} AS normalized
FROM documents""",
        **explodes,
        "explode_names": _with(GK, GN)
        + "SELECT gkgrecordid, name, regexp_replace(name, ',\\d+$', '') AS clean_name FROM gn",
        "article_cards": articles + CARDS,
        "top_news": news + f"SELECT {ARTICLE_FIELDS} FROM top",
        "top_news_total": news + "SELECT count(*) AS total FROM top",
        "featured_news": _with(EV, MN, GK, GR, featured) + "SELECT * FROM featured",
        "top_minus_featured": _with(EV, MN, GK, GR, TOP, featured)
        + f"""SELECT {ARTICLE_FIELDS} FROM top
WHERE id NOT IN (SELECT id FROM featured)""",
        "theme_filter": themed(f"theme ILIKE '%{p.THEME}%'"),
        "theme_filter_literal": themed(f"contains(lower(theme), '{p.LITERAL_THEME}')"),
        "contains_search": articles
        + f"""SELECT {ARTICLE_FIELDS} FROM articles
WHERE contains(lower(title), '{p.CONTAINS}') OR contains(lower(actor1_name), '{p.CONTAINS}')
  OR contains(lower(actor2_name), '{p.CONTAINS}') OR contains(lower(theme), '{p.CONTAINS}')""",
        "source_filter": articles
        + f"""SELECT {ARTICLE_FIELDS} FROM articles
WHERE contains(lower(source), '{p.SOURCE.lower()}')""",
        "recent_news": articles
        + f"""SELECT {ARTICLE_FIELDS} FROM articles
ORDER BY dateadded DESC, id LIMIT 500""",
        "latest_news": articles
        + f"""SELECT {ARTICLE_FIELDS} FROM articles
WHERE dateadded BETWEEN
  CAST(strftime(TIMESTAMP '{p.AS_OF}' - INTERVAL 24 HOUR, '%Y%m%d%H%M%S') AS BIGINT)
  AND CAST(strftime(TIMESTAMP '{p.AS_OF}', '%Y%m%d%H%M%S') AS BIGINT)
ORDER BY dateadded DESC, id LIMIT 20""",
        "facet_themes": _with(GK, GT)
        + """SELECT theme, count(*) AS count FROM gt WHERE theme IS NOT NULL AND theme <> ''
GROUP BY theme ORDER BY count DESC, theme LIMIT 100""",
        "theme_menu": _with(GK, GT)
        + """SELECT theme, count(*) AS count, replace(theme, '_', ' ') AS label FROM gt
GROUP BY theme ORDER BY count DESC, theme LIMIT 20""",
        "facet_sources": _with(GK)
        + """SELECT sourcecommonname AS source, count(*) AS count FROM gk
WHERE sourcecommonname IS NOT NULL AND sourcecommonname <> ''
GROUP BY sourcecommonname ORDER BY count DESC, source LIMIT 20""",
        "stats": _with(EV, MN, GK, GT)
        + f"""SELECT 'total_events' AS metric, count(*) AS value FROM ev
UNION ALL SELECT 'total_mentions', count(*) FROM mn
UNION ALL SELECT 'total_gkg', count(*) FROM gk
UNION ALL SELECT 'total_themes', count(DISTINCT theme) FROM gt
UNION ALL SELECT 'recent_events', count(*) FROM ev
  WHERE sqldate >= CAST(strftime(DATE '{p.AS_OF[:10]}' - INTERVAL 7 DAY, '%Y%m%d') AS INTEGER)""",
        "table_profile": table_counts,
        "etl_profile": table_counts,
        "sample_events": _with(EV)
        + """SELECT globaleventid, sqldate, actor1name, nummentions FROM ev
ORDER BY globaleventid, sqldate, actor1name, nummentions LIMIT 10""",
        "sample_mentions": _with(MN)
        + """SELECT globaleventid, mentionssource, confidence FROM mn
ORDER BY globaleventid, mentionssource, confidence LIMIT 5""",
        "sample_gkg": _with(GK)
        + """SELECT gkgrecordid, sourcecommonname, sharingimage FROM gk
ORDER BY gkgrecordid, sourcecommonname, sharingimage LIMIT 5""",
        "id_overlap": _with(EV, MN)
        + "SELECT count(*) AS count FROM ev JOIN mn USING (globaleventid)",
        "news_detail": _detail("sourceurl = documentidentifier"),
        "news_detail_one": f"""SELECT * FROM ({_detail("sourceurl = documentidentifier")})
WHERE id = '{p.NEWS_ID}'""",
        "news_detail_by_record_id": _detail("globaleventid = gkgrecordid"),
        "orphan_mentions": _with(EV, MN)
        + """SELECT * FROM mn WHERE globaleventid IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM ev WHERE ev.globaleventid = mn.globaleventid)""",
        "duplicate_keys": _with(MN)
        + """SELECT globaleventid, count(*) AS count FROM mn GROUP BY globaleventid
HAVING count(*) > 1""",
        "search_table": _with(GK, GR, _tokens("tok", "gr", "rid", RECORD_TEXT))
        + """SELECT gkgrecordid, CAST(strptime(left(date, 8), '%Y%m%d') AS DATE) AS date,
  sourcecommonname, documentidentifier, themes, persons, organizations, sharingimage,
  CAST(NULL AS VARCHAR) AS relatedimages, allnames, extras,
  coalesce(page_title, 'News Article') AS page_title, coalesce(n, 0) AS tokens
FROM gr LEFT JOIN (SELECT rid, count(*) AS n FROM tok GROUP BY rid) USING (rid)""",
        "search_docs": _with(GK, GR, _tokens("tok", "gr", "rid, gkgrecordid", RECORD_TEXT))
        + """SELECT gkgrecordid, term, count(*) AS tf FROM tok
GROUP BY rid, gkgrecordid, term""",
        "fts_index": _with(document_index)
        + "SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL",
        "fts_rank": _with(document_index)
        + f"""SELECT doc_id, round(count(*) * CAST(0.1 AS DOUBLE), 6) AS rank FROM tok
WHERE term IN ({search_terms}) GROUP BY doc_id""",
        "fts_search": fts_search,
        "fts_search_saved": fts_search,
        "tfidf_vocab": _with(document_terms, document_vocab)
        + "SELECT term, df, cf, round(idf, 6) AS idf FROM vocab",
        "tfidf_weights": _with(document_terms, document_vocab)
        + """SELECT doc_id, term, round(tf * idf / sqrt(sum((tf * idf) ^ 2)
  OVER (PARTITION BY doc_id)), 6) AS weight FROM dt JOIN vocab USING (term)""",
        "tfidf_search": _with(
            document_terms, document_vocab, _nearest("documents", "dt", "doc_id", p.WORDS, 10)
        )
        + "SELECT doc_id, similarity FROM found",
        "search_corpus": corpus["url"] + "SELECT * FROM corpus",
        "search_corpus_by_record_id": corpus["id"] + "SELECT * FROM corpus",
        "search_tfidf": tfidf_results,
        "search_tfidf_saved": tfidf_results,
        "knn_cosine": """WITH target AS (
  SELECT list(m ORDER BY i) AS v FROM (
    SELECT i, avg(CAST(embedding[i] AS DOUBLE)) AS m
    FROM embeddings, range(1, 65) r(i) GROUP BY i))
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 6) AS similarity
FROM embeddings, target ORDER BY similarity DESC, vec_id LIMIT 20""",
        "knn_cells_exact": """WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query, vec_id, similarity FROM (
  SELECT q.vec_id AS query, x.vec_id, round(list_cosine_similarity(q.v, x.v), 6) AS similarity,
    row_number() OVER (PARTITION BY q.vec_id
      ORDER BY round(list_cosine_similarity(q.v, x.v), 6) DESC, x.vec_id) AS place
  FROM usable q, usable x WHERE q.vec_id % 100 = 0)
WHERE place <= 20""",
        "interval_manifest": """WITH span AS (
  SELECT time_bucket(INTERVAL 15 MINUTE, min(ts)) AS low,
    time_bucket(INTERVAL 15 MINUTE, max(ts)) AS high FROM events),
steps AS (SELECT strftime(unnest(generate_series(low, high, INTERVAL 15 MINUTE)),
  '%Y%m%d%H%M%S') AS interval FROM span)
SELECT interval, feed, 'http://feed.example.com/v2/' || interval || '.' || ending AS url,
  'landing/' || feed || '/' || interval || '.' || ending AS path
FROM steps, (VALUES ('export', 'export.CSV.zip'), ('mentions', 'mentions.CSV.zip'),
  ('gkg', 'gkg.csv.zip')) f(feed, ending)""",
        "round_quarter_hour": f"""SELECT event_id,
  CASE WHEN {quarter} < TIMESTAMP '{p.AS_OF}' THEN {quarter} END AS start_at,
  CASE WHEN {quarter} < TIMESTAMP '{p.AS_OF}' THEN {quarter} + INTERVAL 3 HOUR END AS end_at
FROM events""",
        "format_elapsed": """SELECT event_id, (s // 3600) || ' hours, ' || ((s % 3600) // 60)
  || ' minutes, ' || (s % 60) || ' seconds' AS elapsed
FROM (SELECT event_id, CAST(floor(value * 100) AS BIGINT) AS s FROM events)""",
        "feed_events": all_events,
        "stream_ingest": all_events,
        "feed_mentions": _with(MN) + "SELECT * FROM mn",
        "feed_gkg": _with(GK)
        + """SELECT gkgrecordid, date, sourcecommonname, documentidentifier, themes,
  nullif(persons, '') AS persons, organizations,
  sharingimage, CAST(NULL AS VARCHAR) AS relatedimages, allnames, extras FROM gk""",
    }
    for name in ("theme_filter", "contains_search", "source_filter"):
        statements[f"{name}_saved"] = statements[name]
    statements["top_news_maintained"] = statements["top_news"]
    statements["search_tfidf_segments"] = statements["search_tfidf"]
    statements["fts_search_segments"] = statements["fts_search"]
    statements["news_detail_lookup"] = statements["news_detail_one"]
    statements["etl_increments"] = statements["etl_profile"]
    return statements
