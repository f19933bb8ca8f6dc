import dataclasses
import datetime
import tempfile
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wirespark import session
from wirespark.plans import etl, news, search, stats
from wirespark.schemas import RAW_WIDTH, TABLE_NAMES
from wirespark.sinks import writers
from wirespark.sources import archives, derived, feeds, manifest, tables
from wirespark.streaming.ingest import ingest, without_repeats


def folder() -> Path:
    return Path(tempfile.mkdtemp(prefix="run-"))


def record(feed: str, **at: str) -> str:
    fields = [""] * RAW_WIDTH[feed]
    for position, value in at.items():
        fields[int(position[1:])] = value
    return "\t".join(fields)


def export(event_id: str, added: str = "20240105001500", **at: str) -> str:
    given = {"p0": event_id, "p1": "20240105", "p26": "010", "p33": "4", "p34": "-1.5"}
    return record("export", **{**given, "p59": added, "p60": "http://u/1", **at})


def gkg(record_id: str, **at: str) -> str:
    given = {"p0": record_id, "p1": "20240105001500", "p3": "src", "p4": "http://u/1"}
    return record("gkg", **{**given, **at})


def land(base: Path) -> Path:
    for feed in RAW_WIDTH:
        (base / feed).mkdir()
    (base / "export" / "20240105001500.export.CSV").write_text(
        export("1") + "\n" + export("2", p1="20240199", p6='"Ann ""A"" B"', p34="x") + "\n"
    )
    (base / "export" / "20240105003000.export.csv").write_text(export("3") + "\n")
    (base / "export" / "20240105004500.export.csv").write_text("")
    (base / "export" / "notes.txt").write_text("not a feed")
    (base / "mentions" / "20240105001500.mentions.CSV").write_text(
        record("mentions", p0="1", p2="20240105001500", p4="s", p5="m", p11="50") + "\n"
    )
    (base / "gkg" / "20240105001500.gkg.csv").write_text(
        gkg("r1", p7="A;B; ;A;", p23="Al B,12;C,3", p26='"<PAGE_TITLE>two\nlines</PAGE_TITLE>"')
        + "\n"
        + gkg("r2", p11="p;")
        + "\n"
    )
    return base


def test_feed_of():
    assert feeds.feed_of("/x/20240105001500.export.CSV") == "export"
    assert feeds.feed_of("20240105001500.gkg.csv") == "gkg"
    with pytest.raises(ValueError):
        feeds.feed_of("other.csv")


def test_read_feed_types_and_quotes(spark):
    base = land(folder())
    rows = {r.globaleventid: r for r in feeds.read_feed(spark, f"{base}/export").collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].eventcode == "010"
    assert rows["1"].dateadded == 20240105001500
    assert rows["1"].avgtone == -1.5
    assert rows["2"].actor1name == 'Ann "A" B'
    assert rows["2"].avgtone is None
    assert rows["2"].sqldate == 20240199
    title = feeds.read_feed(spark, f"{base}/gkg").filter("gkgrecordid = 'r1'").first().extras
    assert title == "<PAGE_TITLE>two\nlines</PAGE_TITLE>"


def test_rejected_records_are_named(spark):
    base = land(folder())
    bad = base / "export" / "20240105010000.export.csv"
    bad.write_text("9\t20240105\n" + export("4") + "\n")
    rejected = feeds.rejected(spark, f"{base}/export", "export")
    assert [tuple(r) for r in rejected.collect()] == [(bad.name, "9", "9\t20240105")]
    rows = feeds.read_feed(spark, f"{base}/export").select("globaleventid", "sourceurl")
    assert ("9", None) in [tuple(r) for r in rows.collect()]
    assert rows.count() == 5


def test_unknown_feed(spark):
    with pytest.raises(ValueError):
        feeds.read_raw(spark, "x", "other")
    with pytest.raises(ValueError):
        archives.read_archives(spark, "x", "other")


def test_archives_give_the_same_rows_as_files(spark):
    base = land(folder())
    zipped = folder()
    for feed in RAW_WIDTH:
        (zipped / feed).mkdir()
        for file in (base / feed).glob("*.[cC][sS][vV]"):
            with zipfile.ZipFile(zipped / feed / f"{file.name}.zip", "w") as archive:
                archive.write(file, file.name)
    for feed in RAW_WIDTH:
        plain = feeds.read_feed(spark, f"{base}/{feed}", feed)
        opened = feeds.typed(archives.read_archives(spark, f"{zipped}/{feed}", feed), feed)
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, opened.collect()))
    files = archives.landed_summary(archives.landed_files(spark, str(zipped)))
    counts = {(r.folder, r.type): r.files for r in files.collect()}
    assert counts == {("export", "ZIP"): 3, ("mentions", "ZIP"): 1, ("gkg", "ZIP"): 1}
    t = etl.landed_tables(spark, str(zipped), zipped=True)
    assert t.events.count() == 3


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_transform(spark, fmt):
    base, out = land(folder()), folder()
    t = etl.transform(spark, str(base), str(out), fmt=fmt, by_day=fmt == "parquet")
    counts = {name: df.count() for name, df in t.named().items()}
    assert counts == {
        "events": 3,
        "mentions": 1,
        "gkg": 2,
        "gkg_themes": 3,
        "gkg_persons": 1,
        "gkg_organizations": 0,
        "gkg_names": 2,
    }
    assert [r.eventcode for r in t.events.collect()] == ["010"] * 3
    repeat = base / "export" / "20240105011500.export.CSV"
    repeat.write_text(export("3", "20240105011500") + "\n" + export("", "20240105011500") + "\n")
    assert sorted(r.theme for r in t.gkg_themes.collect()) == ["A", "A", "B"]
    again = etl.transform(spark, str(base), str(out), fmt=fmt, by_day=fmt == "parquet")
    assert sorted((r.globaleventid, r.dateadded) for r in again.events.collect()) == [
        ("1", 20240105001500),
        ("2", 20240105001500),
        ("3", 20240105001500),
    ]


def test_search_tables(spark):
    base, out = land(folder()), folder()
    t = etl.transform(spark, str(base), str(out))
    etl.build_search_tables(t, str(out))
    docs = spark.read.parquet(f"{out}/search_docs")
    assert len(docs.columns) == 13
    row = docs.filter("gkgrecordid = 'r1'").first()
    assert row.date == datetime.date(2024, 1, 5)
    assert row.page_title == "two\nlines"
    assert {tuple(x) for x in row.search_terms} >= {("line", 1), ("two", 1), ("b", 2)}
    index = spark.read.parquet(f"{out}/search_terms")
    assert index.filter("gkgrecordid = 'r2' AND term = 'p'").count() == 1


def test_catalog_tables(spark):
    base = land(folder())
    name = "news_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder()}'")
    try:
        writers.create_tables(spark, name)
        writers.create_tables(spark, name)
        landed = etl.landed_tables(spark, str(base))
        writers.replace_rows(landed, name)
        writers.replace_rows(landed, name)
        t = tables.catalog_tables(spark, name)
        assert [t.named()[n].count() for n in TABLE_NAMES] == [3, 1, 2, 3, 1, 0, 2]
        found = tables.run_sql(
            spark,
            "SELECT count(*) AS n FROM {events} WHERE nummentions > :least",
            t,
            {"least": 3},
        )
        assert found.first().n == 3
        assert stats.facet_themes(t).first().theme == "A"
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_bucketed_events_are_joined_in_place(spark):
    base = land(folder())
    name = "bucket_db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{folder()}'")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        writers.create_tables(spark, name, event_buckets=8)
        writers.replace_rows(etl.landed_tables(spark, str(base)), name)
        t = tables.catalog_tables(spark, name)
        means = t.mentions.groupBy("globaleventid").agg(F.max("confidence").alias("c"))
        joined = t.events.join(means, "globaleventid")
        assert joined.count() == 1
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan
        assert plan.count("Exchange hashpartitioning(globaleventid") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql(f"DROP DATABASE {name} CASCADE")


def test_jdbc_options_and_order():
    options = writers.jdbc_options("jdbc:x", "events", {"user": "u"}, refresh=True, connections=4)
    assert options == {
        "url": "jdbc:x",
        "dbtable": "events",
        "batchsize": "10000",
        "numPartitions": "4",
        "user": "u",
        "truncate": "true",
        "cascadeTruncate": "true",
    }
    appended = writers.jdbc_options("jdbc:x", "events", {}, refresh=False, connections=4)
    assert "truncate" not in appended
    assert writers.load_order()[:3] == ["events", "mentions", "gkg"]


def test_manifest(spark):
    texts = spark.createDataFrame([("2024-01-31 23:45", "2024-02-01 00:15")], "a string, b string")
    ranges = texts.select(*[manifest.parse_minute(F.col(c)).alias(c) for c in texts.columns])
    steps = manifest.intervals(ranges, "a", "b")
    files = manifest.feed_manifest(steps, "http://h/v2", "data")
    rows = files.orderBy("interval", "feed").collect()
    assert len(rows) == 9
    assert tuple(rows[0]) == (
        "20240131234500",
        "export",
        "http://h/v2/20240131234500.export.CSV.zip",
        "data/export/20240131234500.export.CSV.zip",
    )
    assert {r.interval for r in rows} == {"20240131234500", "20240201000000", "20240201001500"}


def test_stream_ingest_resumes_and_drops_repeats(spark):
    base = folder()
    drops, out, checkpoint = base / "drops", base / "out", base / "checkpoint"
    drops.mkdir()
    (drops / "20240105001500.export.CSV").write_text(export("1") + "\n" + export("2") + "\n")
    (drops / "20240105003000.export.CSV").write_text(
        export("2", "20240105003000") + "\n" + export("3", "20240105003000") + "\n"
    )

    def run():
        query = ingest(spark, str(drops), str(out), str(checkpoint), files_per_batch=1)
        assert query.awaitTermination(120)
        return sorted(r.globaleventid for r in spark.read.parquet(str(out)).collect())

    assert run() == ["1", "2", "3"]
    assert run() == ["1", "2", "3"]
    (drops / "20240105004500.export.CSV").write_text(
        export("3", "20240105004500") + "\n" + export("4", "20240105004500") + "\n"
    )
    assert run() == ["1", "2", "3", "4"]


def test_stream_ingest_keeps_late_first_deliveries(spark):
    base = folder()
    drops, out, checkpoint = base / "drops", base / "out", base / "checkpoint"
    drops.mkdir()

    def run(name, *rows):
        (drops / name).write_text("".join(row + "\n" for row in rows))
        query = ingest(spark, str(drops), str(out), str(checkpoint))
        assert query.awaitTermination(120)
        stored = spark.read.parquet(str(out)).select("globaleventid", "dateadded").collect()
        return sorted((r.globaleventid, r.dateadded) for r in stored)

    noon = 20240105120000
    first = run("a.export.CSV", export("1", str(noon)), export("2", str(noon)))
    assert first == [("1", noon), ("2", noon)]
    # A late new id, a late repeat, a repeat with another stamp.
    second = run(
        "b.export.CSV",
        export("3", "20240101090000"),
        export("1", "20240101090000"),
        export("2", str(noon + 1500)),
    )
    assert second == [*first, ("3", 20240101090000)]
    third = run("c.export.CSV", export("4", "unreadable"), export("4", "unreadable"))
    assert third == [*second, ("4", None)]


def test_repeats_and_rows_without_id(spark):
    rows = spark.createDataFrame([("1",), ("1",), (None,), (None,)], "globaleventid string")
    fresh = without_repeats(rows, None, "export")
    assert sorted(map(repr, fresh.collect())) == sorted(map(repr, rows.collect()))[1:]
    stored = spark.createDataFrame([("1",)], "globaleventid string")
    assert without_repeats(rows, stored, "export").count() == 2


def test_saved_search_reads_its_terms_only(spark):
    base, out = land(folder()), str(folder() / "index")
    t = etl.landed_tables(spark, str(base))
    build = search.refresh_if_stale(t, out, datetime.datetime(2024, 1, 5, 12))
    known = [r.term for r in spark.read.parquet(f"{build}/vocabulary").limit(2).collect()]
    found = search.best_saved(spark, build, [(term, 0.7) for term in known], 1)
    plan = found._jdf.queryExecution().toString()
    assert "In(term, [" in plan
    # The few rows here are one block; the range around it is then an equality.
    assert "EqualTo(block," in plan or "GreaterThanOrEqual(block," in plan
    plan = search.search_saved(spark, build, "two lines", 5)._jdf.queryExecution().toString()
    assert "combined_text" not in plan


def test_searches_scan_each_table_once(spark):
    clean, out = str(folder()), str(folder())
    t = etl.transform(spark, str(land(folder())), clean)
    etl.build_search_tables(t, out)

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")

    assert scans(news.filter_news(t, "tax")) == 4
    assert scans(search.search_news(t, "lines")) == 3
    saved = search.search_saved_news(t, out, "two lines")
    assert scans(saved) == 4
    assert "In(term, [" in saved._jdf.queryExecution().toString()
    direct = search.search_news(t, "two lines")
    assert sorted(map(repr, saved.collect())) == sorted(map(repr, direct.collect()))


def test_search_is_not_crowded_out_by_one_event(spark):
    """An event with 20,000 mentions leaves room for the others."""
    base = land(folder())
    t = etl.landed_tables(spark, str(base))
    some = t.events.orderBy("globaleventid").first()["globaleventid"]
    many = spark.range(20_000).select(
        F.lit(some).alias("globaleventid"),
        F.lit(0).cast("bigint").alias("mentiontimedate"),
        F.lit("s").alias("mentionssource"),
        F.col("id").cast("string").alias("mentionidentifier"),
        F.col("id").cast("double").alias("confidence"),
    )
    crowded = dataclasses.replace(t, mentions=t.mentions.unionByName(many))
    found = [r.id for r in search.search_tfidf(crowded, "two lines", 50).collect()]
    assert set(found) == {r.globaleventid for r in t.events.select("globaleventid").collect()}


@pytest.mark.parametrize("max_features", [1000, None])
def test_index_build_gives_up_its_steps(spark, monkeypatch, max_features):
    """What a build writes on the way is gone at its end, but for the index."""
    out, steps = folder(), []

    def noted(spark, name, new_folder=session.new_folder):
        steps.append(new_folder(spark, name))
        return steps[-1]

    monkeypatch.setattr(session, "new_folder", noted)
    t = etl.landed_tables(spark, str(land(folder())))
    noon = datetime.datetime(2024, 1, 5, 12)
    build = search.refresh_if_stale(t, str(out / "index"), noon, max_features=max_features)
    assert len(steps) == (3 if max_features else 1)
    assert [spark.read.parquet(path).count() for path in steps] == [0] * len(steps)
    assert spark.read.parquet(f"{build}/rows").count() == 6


def test_pages_take_no_exchange(spark):
    tables_at = str(folder())
    for name in ("pages", "documents", "part"):
        empty = spark.createDataFrame([], derived.TABLE_SCHEMAS[name])
        empty.write.parquet(f"{tables_at}/{name}.parquet")
    gkg = derived.derived_gkg(spark, tables_at).select("extras")
    plan = gkg._jdf.queryExecution().analyzed().toString()
    joins = [n for n, line in enumerate(plan.splitlines()) if "Join " in line]
    assert "html" not in "".join(plan.splitlines()[: joins[-1]])


def test_index_refresh(spark):
    base, out = land(folder()), folder()
    t = etl.landed_tables(spark, str(base))
    path = str(out / "index")
    noon = datetime.datetime(2024, 1, 5, 12)
    first = search.refresh_if_stale(t, path, noon)
    assert search.refresh_if_stale(t, path, noon + datetime.timedelta(minutes=60)) == first
    later = search.refresh_if_stale(t, path, noon + datetime.timedelta(minutes=61))
    assert later != first
    saved = search.search_saved(spark, later, "two lines", 5)
    direct = search.search_tfidf(t, "two lines", 5)
    assert sorted(map(repr, saved.collect())) == sorted(map(repr, direct.collect()))
    assert saved.count() == 5
