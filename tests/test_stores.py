"""Tables that grow batch by batch: right after every batch, and read in part only."""

import dataclasses
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from test_indexes import metric
from test_news import make_rows
from test_sources import export, folder, gkg, land
from wirespark.operators import tfidf
from wirespark.plans import (
    detail,
    etl,
    increments,
    lookup,
    news,
    ranking,
    search,
    segments,
    sketches,
    stats,
)
from wirespark.schemas import NewsTables, table_schema
from wirespark.session import new_folder
from wirespark.sources import feeds
from wirespark.stores import keyed_log
from wirespark.stores.keyed_log import KeyedLog
from wirespark.stores.snapshots import Snapshots
from wirespark.streaming.ingest import ids_of, ingest


def relations(spark, rows) -> NewsTables:
    return NewsTables(
        **{name: spark.createDataFrame(rows[name], table_schema(name)) for name in rows}
    )


def same(a, b) -> bool:
    return sorted(map(repr, map(tuple, a.collect()))) == sorted(map(repr, map(tuple, b.collect())))


def test_folders_hold_every_batch_once(monkeypatch):
    monkeypatch.setattr(keyed_log, "TIER", 3)
    for batch in range(100):
        held = []
        for name in keyed_log.folders(batch):
            level, last = (int(part.split("=")[1]) for part in name.split("/"))
            held += range(last - 3**level + 1, last + 1)
        assert sorted(held) == list(range(batch))


def test_keyed_log(spark, monkeypatch):
    monkeypatch.setattr(keyed_log, "TIER", 2)
    schema = spark.createDataFrame([], "k string, v bigint").schema
    merge = lambda df: df.groupBy("k").agg(F.max("v").alias("v"))
    log = KeyedLog(spark, new_folder(spark, "log"), "k", schema, merge, buckets=4)
    rng = random.Random(1)
    best = {}
    assert log.before(0).count() == 0
    for batch in range(5):
        rows = [(f"k{rng.randrange(40):02}", rng.randrange(1000)) for _ in range(12)] + [(None, 1)]
        df = spark.createDataFrame(rows, schema)
        log.add(df, batch)
        log.add(df, batch)  # run again after a failure
        for k, v in rows[:-1]:
            best[k] = max(best.get(k, -1), v)
        assert {r.k: r.v for r in merge(log.before(batch + 1)).collect()} == best
        asked = [f"k{rng.randrange(60):02}" for _ in range(4)]
        keys = spark.createDataFrame([(k,) for k in [*asked, None]], "k string")
        found = {r.k: r.v for r in merge(log.among(keys, batch + 1)).collect()}
        assert {k: found[k] for k in asked if k in found} == {k: best[k] for k in asked if k in best}
    none = spark.createDataFrame([(None,)], "k string")
    assert log.among(none, 5).count() == 0


def test_keyed_log_reads_the_batch_share(spark):
    schema = spark.createDataFrame([], "k string").schema
    log = KeyedLog(spark, new_folder(spark, "log"), "k", schema, buckets=64)
    for batch in range(3):
        ids = spark.range(batch * 2000, batch * 2000 + 2000)
        log.add(ids.select(F.format_string("%06d", "id").alias("k")), batch)
    everything = log.before(3)
    assert metric(everything, "numOutputRows") == 6000
    few = spark.createDataFrame([("000007",), ("000011",)], "k string")
    found = log.among(few, 3)
    assert {r.k for r in found.collect()} == {"000007", "000011"}
    assert metric(found, "numFiles") <= 2 * 3 < metric(everything, "numFiles")
    assert metric(found, "numOutputRows") < 200
    # Ids beyond all stored ones leave nothing to read.
    new = spark.createDataFrame([("900000",)], "k string")
    assert metric(log.among(new, 3), "numOutputRows") == 0


def test_keyed_log_returns_what_it_stored(spark):
    schema = spark.createDataFrame([], "k string, v bigint").schema
    log = KeyedLog(spark, new_folder(spark, "log"), "k", schema, buckets=4)
    rows = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], schema)
    for batch in range(2):
        assert [tuple(r) for r in log.add(rows, batch).collect()] == [("a", 1)] * 2
    # Many keys: the range of keys filters, whatever their approximate number is.
    many = spark.range(1000).select(F.format_string("%04d", "id").alias("k"), "id")
    log.add(many.withColumnRenamed("id", "v"), 2)
    asked = many.filter("id BETWEEN 100 AND 699").select("k")
    found = {r.k for r in log.among(asked, 3).collect()}
    assert found == {f"{i:04}" for i in range(100, 700)}


def test_ingest_over_many_batches(spark, monkeypatch):
    """Many batches, merged tiers, repeats of any age."""
    monkeypatch.setattr(keyed_log, "TIER", 2)
    base = folder()
    drops, out, checkpoint = base / "drops", base / "out", base / "checkpoint"
    drops.mkdir()
    rng = random.Random(2)
    given = []
    for n in range(4):
        ids = [str(rng.randrange(30)) for _ in range(8)]
        (drops / f"{n}.export.CSV").write_text("".join(export(i) + "\n" for i in ids))
        given += ids
        query = ingest(spark, str(drops), str(out), str(checkpoint))
        assert query.awaitTermination(120)
        stored = [r.globaleventid for r in spark.read.parquet(str(out)).collect()]
        assert sorted(stored) == sorted(set(given))
    ids = spark.read.parquet(f"{ids_of(str(out))}/level=2")
    assert ids.select("globaleventid").distinct().count() == ids.count()


def drops_of(t: NewsTables, n: int) -> list[NewsTables]:
    """All rows of the base tables, dealt into drops by a hash of the row."""

    def dealt(df, i):
        return df.filter(F.pmod(F.xxhash64(*df.columns), F.lit(n)) == i)

    return [
        dataclasses.replace(
            t, events=dealt(t.events, i), mentions=dealt(t.mentions, i), gkg=dealt(t.gkg, i)
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1])
def test_ranking_after_every_drop(spark, seed):
    t = relations(spark, make_rows(seed))
    drops = drops_of(t, 3)
    kept = ranking.Ranking(spark, new_folder(spark, "ranking"), buckets=2)
    for number, drop in enumerate(drops):
        kept.update(number, drop.events, drop.mentions, drop.gkg)
        if number == 1:  # run again after a failure
            kept.update(number, drop.events, drop.mentions, drop.gkg)
        if number != 1:
            so_far = dataclasses.replace(
                t,
                **{
                    name: drops[0].named()[name].sparkSession.createDataFrame(
                        [r for d in drops[: number + 1] for r in d.named()[name].collect()],
                        table_schema(name),
                    )
                    for name in ("events", "mentions", "gkg")
                },
            )
            assert same(kept.top_news(number + 1, so_far.gkg), news.top_news(so_far))


def test_ranking_follows_a_winner_to_another_url(spark):
    """A story's best event is overtaken from another URL, and the first URL gets its next one."""
    t = relations(spark, make_rows(1))

    def event(i, actor, mentions, url):
        names = table_schema("events").names
        row = dict.fromkeys(names)
        row |= dict(globaleventid=i, actor1name=actor, eventcode="1", nummentions=mentions)
        row |= dict(avgtone=1.0, sourceurl=url, sqldate=20240105, dateadded=1)
        return tuple(row[n] for n in names)

    def mention(i, confidence):
        return (i, 20240105000000, "s", "m", confidence)

    def record(url):
        row = dict.fromkeys(table_schema("gkg").names) | dict(
            gkgrecordid=f"r{url}", documentidentifier=url, sharingimage="http://i"
        )
        return tuple(row.values())

    rows = [
        ([event("1", "A", 5, "u"), event("2", "B", 3, "u")], [mention("1", 9.0), mention("2", 9.0)], [record("u")]),
        ([event("3", "A", 8, "v")], [mention("3", -4.0)], []),
        ([], [], [record("v")]),  # now event 3 has a picture and takes story A
        ([], [mention("2", 60.0)], []),
    ]
    kept = ranking.Ranking(spark, new_folder(spark, "ranking"), buckets=2)
    gathered = {"events": [], "mentions": [], "gkg": []}
    tops = []
    for number, drop in enumerate(rows):
        frames = {}
        for name, values in zip(gathered, drop, strict=True):
            gathered[name] += values
            frames[name] = spark.createDataFrame(values, table_schema(name))
        kept.update(number, **frames)
        whole = {n: spark.createDataFrame(v, table_schema(n)) for n, v in gathered.items()}
        top = kept.top_news(number + 1, whole["gkg"])
        assert same(top, news.top_news(dataclasses.replace(t, **whole)))
        tops.append(sorted(r.id for r in top.collect()))
    assert tops == [["1"], ["1"], ["2", "3"], ["2", "3"]]


def test_segments_after_every_drop(spark):
    """Three increments: new events of old URLs, first records of known events, replaced ones."""
    t = relations(spark, make_rows(3))
    drops = drops_of(t, 3)
    index = segments.SegmentedIndex(spark, new_folder(spark, "segments"), buckets=2)
    gathered = {"events": [], "mentions": [], "gkg": []}
    for number, drop in enumerate(drops):
        frames = {}
        for name, rows in gathered.items():
            new = drop.named()[name].collect()
            rows += new
            frames[name] = spark.createDataFrame(new, table_schema(name))
        index.refresh(number, **frames)
        whole = {n: spark.createDataFrame(v, table_schema(n)) for n, v in gathered.items()}
        so_far = dataclasses.replace(t, **whole)
        if number == 0:
            continue
        for query, limit in (("t1 story name", 10), ("absent", 3)):
            found = index.search(number + 1, query, limit)
            assert same(found, search.search_tfidf(so_far, query, limit))
    # Full text: the last delivery of a record counts, so ids are made unique here.
    once = t.gkg.dropDuplicates(["gkgrecordid"])
    texts = segments.SegmentedIndex(spark, new_folder(spark, "segments"), buckets=2)
    older = once.withColumn("extras", F.lit("<PAGE_TITLE>t9 older</PAGE_TITLE>"))
    for number, rows in enumerate((older, once)):
        texts._add_texts(number, rows)
    found = texts.search_news(2, dataclasses.replace(t, gkg=once), "story older p1")
    assert same(found, search.search_news(dataclasses.replace(t, gkg=once), "story older p1"))


@pytest.mark.parametrize("max_features", [1000, 20_000])
def test_segments_post_a_term_once_a_url(spark, max_features):
    """Documents of a URL share its posting; counts of terms are those of all documents."""
    t = relations(spark, make_rows(3))
    index = segments.SegmentedIndex(
        spark, new_folder(spark, "segments"), max_features=max_features, buckets=2
    )
    index.refresh(0, t.events, t.mentions, t.gkg)
    posted = index.postings.before(1).select("term", "link").collect()
    assert len(posted) == len(set(posted))
    documents = index.documents.before(1).collect()
    assert len(documents) > len({d["link"] for d in documents})
    rows = search.corpus_documents(t.events, t.gkg)
    listed = tfidf.term_documents(rows, "document", F.col("combined_text"))
    terms = [x for d in listed.collect() for x in d["terms"]]
    counts = {term: (0, 0) for term, _ in terms}
    for term, tf in terms:
        counts[term] = (counts[term][0] + 1, counts[term][1] + tf)
    kept = {r["term"]: (r["df"], r["cf"]) for r in index.statistics.before(1).collect()}
    assert kept.pop(segments.DOCUMENTS) == (len(documents), 0)
    assert kept == counts and {r["term"] for r in posted} == set(counts)
    found = index.search(1, "t1 story name", 10)
    assert same(found, search.search_tfidf(t, "t1 story name", 10, max_features=max_features))


def test_mentions_that_change_nothing_rank_nothing(spark):
    t = relations(spark, make_rows(1))
    none = {"events": t.events.limit(0), "gkg": t.gkg.limit(0)}
    ids = t.mentions.select("globaleventid").distinct()
    columns = [c for c in t.mentions.columns if c != "globaleventid"]
    empty = [F.lit(None).cast(t.mentions.schema[c].dataType).alias(c) for c in columns]
    strong = ids.select("globaleventid", *empty).select(*t.mentions.columns)
    kept = ranking.Ranking(spark, new_folder(spark, "ranking"), buckets=4)
    kept.update(0, t.events, t.mentions, t.gkg)
    given = t.mentions
    # Weaker, a new strongest, weaker again, as strong but positive.
    for drop, (confidence, changes) in enumerate([(0.0, 0), (-500.0, 1), (499.0, 0), (500.0, 1)], 1):
        said = strong.withColumn("confidence", F.lit(confidence))
        if not drop - 1:
            said = said.join(t.mentions.filter("confidence IS NOT NULL"), "globaleventid", "left_semi")
        given = given.unionByName(said)
        kept.update(drop, mentions=said, **none)
        for log in (kept.bounds, kept.stories, kept.urls):
            rows = spark.read.schema(log.schema).parquet(f"{log.path}/level=0/last={drop}")
            assert (rows.count() > 0) == changes
        assert same(
            kept.top_news(drop + 1, t.gkg), news.top_news(dataclasses.replace(t, mentions=given))
        )


def test_drops_are_dealt_once(spark):
    """Each row is derived once, however many drops there are, and goes to the drop of its hash."""
    t = relations(spark, make_rows(1))
    met = spark.sparkContext.accumulator(0)

    def derived(batches):
        for batch in batches:
            met.add(batch.num_rows)
            yield batch

    records = t.gkg.mapInArrow(derived, t.gkg.schema)
    dealt = __spark_entry__._in_drops(
        dataclasses.replace(t, gkg=records), mentions=["globaleventid", "confidence"]
    )
    for drop, wanted in zip(dealt, drops_of(t, __spark_entry__.DROPS), strict=True):
        assert same(drop["events"], wanted.events) and same(drop["gkg"], wanted.gkg)
        assert same(drop["mentions"], wanted.mentions.select("globaleventid", "confidence"))
    assert met.value == t.gkg.count()


def test_snapshots(spark):
    path = new_folder(spark, "tables")
    kept = Snapshots(spark, path)
    assert kept.last() == -1 and kept.parts(-1) == {}
    files = spark.createDataFrame([("f", "a"), ("f", "b")], "name string, path string")
    for version, names in enumerate((["x", "y"], ["x"])):
        for name in names:
            spark.range(version, version + 1).write.parquet(kept.part(name, version))
        kept.commit(version, names, files.filter(F.col("path") == "ab"[version]))
    assert [r.path for r in kept.not_taken(files).collect()] == []
    assert kept.last() == 1 and len(kept.parts(1)["x"]) == 2 and len(kept.parts(1)["y"]) == 1
    assert sorted(r.id for r in kept.read("x", "id bigint").collect()) == [0, 1]
    assert [r.id for r in kept.read("x", "id bigint", 0).collect()] == [0]
    # A part that no manifest names is not seen, and a version cannot be skipped.
    spark.range(9).write.parquet(kept.part("x", 2))
    assert kept.read("x", "id bigint").count() == 2
    with pytest.raises(ValueError):
        kept.commit(3, ["x"], files)


def test_transform_of_new_files(spark):
    base, out = land(folder()), str(folder() / "clean")
    assert increments.transform_new(spark, str(base), out) == 0
    whole = etl.transform(spark, str(base), str(folder() / "whole"))
    first = increments.read_version(spark, out)
    for name, df in whole.named().items():
        assert same(first.named()[name], df), name
    assert increments.transform_new(spark, str(base), out) == 0  # nothing new, nothing written
    (base / "export" / "20240105010000.export.CSV").write_text(
        export("2", "20240105010000") + "\n" + export("8") + "\n" + export("8") + "\n"
    )
    (base / "gkg" / "20240105010000.gkg.csv").write_text(gkg("r9", p7="Q;") + "\n")
    assert increments.transform_new(spark, str(base), out) == 1
    part = spark.read.parquet(Snapshots(spark, out).part("events", 1))
    assert [r.globaleventid for r in part.collect()] == ["8"]  # 2 was there before
    now = increments.read_version(spark, out)
    assert {r.globaleventid for r in now.events.collect()} == {"1", "2", "3", "8"}
    assert now.gkg_themes.filter("theme = 'Q'").count() == 1
    whole = etl.transform(spark, str(base), str(folder() / "whole"))
    for name, df in whole.named().items():
        assert same(now.named()[name], df), name
    assert same(stats.table_profile(now), stats.table_profile(whole))
    assert increments.read_version(spark, out, 0).events.count() == 3
    assert increments.compact(spark, out, many=2) == 2
    assert all(len(p) == 1 for p in Snapshots(spark, out).parts(2).values())
    (base / "export" / "20240105011500.export.CSV").write_text(export("8") + "\n" + export("9") + "\n")
    assert increments.transform_new(spark, str(base), out) == 3
    ids = sorted(r.globaleventid for r in increments.read_version(spark, out).events.collect())
    assert ids == ["1", "2", "3", "8", "9"]


def test_sketches_by_day(spark):
    """Sketches of days and drops merge to the counts of all, within the stated error."""
    ids = spark.range(60_000)
    names = table_schema("events").names
    event = {"globaleventid": F.col("id").cast("string"), "sqldate": (F.col("id") % 7 + 20240101).cast("int")}
    columns = {f.name: F.lit(None).cast(f.dataType) for f in table_schema("events").fields} | event
    events = ids.select(*[columns[n].alias(n) for n in names])
    mention = {
        "globaleventid": (F.col("id") % 45_000 + 30_000).cast("string"),
        "mentiontimedate": F.lit(20240103000000).cast("bigint"),
    }
    columns = {f.name: F.lit(None).cast(f.dataType) for f in table_schema("mentions").fields} | mention
    mentions = ids.select(*[c.alias(n) for n, c in columns.items()])
    record = {
        "gkgrecordid": F.col("id").cast("string"),
        "date": F.when(F.col("id") % 9 > 0, F.concat((F.col("id") % 5 + 20240101).cast("string"), F.lit("000000"))),
        "themes": F.concat(F.lit("T"), F.col("id") % 20_000, F.lit(";U;")),
    }
    columns = {f.name: F.lit(None).cast(f.dataType) for f in table_schema("gkg").fields} | record
    records = ids.select(*[c.alias(n) for n, c in columns.items()])
    t = relations(spark, make_rows(1))
    t = dataclasses.replace(t, events=events, mentions=mentions, gkg=records)
    path = new_folder(spark, "sketches")
    for drop in drops_of(t, 3):
        sketches.write_sketches(drop, path)
    found = {r.name: r for r in sketches.distinct_counts(spark, path).collect()}
    exact = {"themes": (120_000, 20_001), "events": (60_000,) * 2, "mentioned": (60_000, 45_000), "records": (60_000,) * 2}
    for name, (rows, distinct) in exact.items():
        assert found[name].rows == rows
        assert abs(found[name].distinct - distinct) <= found[name].error < distinct * 0.03
    days = {r.name: r for r in sketches.distinct_counts(spark, path, (20240102, 20240103)).collect()}
    wanted = events.filter("sqldate BETWEEN 20240102 AND 20240103").count()
    assert abs(days["events"].distinct - wanted) <= days["events"].error
    shared = sketches.overlap(spark, path).first()
    assert abs(shared.distinct - 30_000) <= shared.error
    approximate = stats.stats(
        dataclasses.replace(t, gkg_themes=etl.child_table(records, "gkg_themes")), "2024-01-06", approximate=True
    )
    themes = {r.metric: r.value for r in approximate.collect()}["total_themes"]
    assert abs(themes - 20_001) <= 20_001 * 0.15  # three standard errors of Spark's default


@pytest.mark.parametrize("link", ["url", "id"])
def test_lookup_equals_detail(spark, link):
    t = relations(spark, make_rows(2))
    path = new_folder(spark, "lookup")
    lookup.write_lookup(t, path)
    for news_id in ("1", "2", "17", "absent"):
        found = lookup.detail_of(spark, path, news_id, link=link)
        assert same(found, detail.news_detail(t, news_id, link=link))
    for wrong in ({"news_id": ""}, {"news_id": "1", "link": "x"}):
        with pytest.raises(ValueError):
            lookup.detail_of(spark, path, **wrong)


def test_lookup_skips_row_groups(spark):
    t = relations(spark, make_rows(2))
    many = spark.range(40_000).select(
        F.format_string("r%07d", "id").alias("gkgrecordid"), F.sha2(F.col("id").cast("string"), 256).alias("theme")
    )
    t = dataclasses.replace(t, gkg_themes=t.gkg_themes.unionByName(many))
    path = new_folder(spark, "lookup")
    lookup.write_lookup(t, path, {"parquet.block.size": "65536"})
    themes = lookup.tables_of(spark, path, "1").gkg_themes
    assert metric(themes, "numOutputRows") < 40_000 / 4


def test_feed_reader_of_parts(spark):
    base = land(folder())
    assert increments.landed(spark, str(base)).count() == 4  # an empty file has nothing to take
    assert feeds.read_feed(spark, f"{base}/export").count() == 3
