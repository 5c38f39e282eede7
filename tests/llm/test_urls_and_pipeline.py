"""URL lists against a brute-force as-of evaluation; the pipeline's stages on a small table."""

import datetime as dt
import random
from urllib.parse import urlsplit

import corpus_pipeline
from conftest import SF_SMALL
from helpers import documents, odd_documents
from pyspark.sql import functions as F

from tidemark.llm.url_lists import filter_urls, intervals

DAY = dt.date(2024, 1, 1)
CAPTURES, ENTRIES = "id long, url string, fetched_on date, kind string", "kind string, pattern string, action string, effective_on date"


def brute(captures, entries):
    rank = {"remove": 0, "block": 1, "allow": 2}
    out = []
    for i, url, on, _ in captures:
        best = None
        if url and on:
            u = urlsplit(url.lower())
            host, path = (u.hostname or "").rstrip("."), u.path or "/"
            for kind, pattern in {(e[0], e[1]) for e in entries if None not in e and e[0] in ("domain", "host", "prefix")}:
                dated = [(e[3], rank[e[2]]) for e in entries if None not in e and e[:2] == (kind, pattern)
                         and e[2] in rank and e[3] <= on]
                p = pattern.lower()
                hit = (host == p if kind == "host" else host == p or host.endswith("." + p) if kind == "domain"
                       else host + path == p or (p.endswith("/") and (host + path).startswith(p)))
                if host and hit and dated and max(dated)[1]:
                    best = max(best or (), (("domain", "host", "prefix").index(kind), len(p), p, max(dated)[1]))
        out.append((i, url, bool(best) and best[3] == 1, best[2] if best else None))
    return out


def test_as_of_join_equals_brute_force(spark):
    rng = random.Random(7)
    hosts = ["a.b.com", "b.com", "x.a.b.com", "c.org", "localhost"]
    paths = ["", "/", "/p", "/p/q", "/p/q/", "/P/x?z=1#f", "/r#t"]
    patterns = {"host": hosts, "domain": hosts + ["com"], "prefix": [h + p for h in hosts for p in ("/", "/p/", "/p", "/p/q/")]}
    entries = []
    for _ in range(120):
        kind = rng.choice(list(patterns))
        entries.append((kind, rng.choice(patterns[kind]), rng.choice(["block", "allow", "remove", "block"]),
                        DAY + dt.timedelta(rng.randint(0, 40))))
    entries += [(None, "b.com", "block", DAY), ("host", None, "block", DAY), ("host", "c.org", "block", None),
                ("other", "c.org", "block", DAY), ("host", "c.org", "odd", DAY)]
    captures = [(i, rng.choice(["http", "HTTPS"]) + "://" + rng.choice(["", "u@", "www."]) + rng.choice(hosts).upper()
                 + rng.choice(["", ":80", "."]) + rng.choice(paths), DAY + dt.timedelta(rng.randint(0, 45)), "k")
                for i in range(300)]
    captures += [(1, None, DAY, "k"), (2, "", DAY, "k"), (3, "no url", DAY, "k"), (4, "http://b.com/", None, "k"),
                 (None, "http://b.com/", DAY, "k"), captures[0], captures[0]]
    got = filter_urls(spark.createDataFrame(captures, CAPTURES), spark.createDataFrame(entries, ENTRIES)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(((r["id"], r["url"], r["blocked"], r["pattern"]) for r in got), key=key) == sorted(
        brute(captures, entries), key=key)


def test_empty_lists_and_intervals(spark):
    captures = spark.createDataFrame([(1, "http://b.com/", DAY, "k")], CAPTURES)
    entries = spark.createDataFrame([], ENTRIES)
    assert [r["blocked"] for r in filter_urls(captures, entries).collect()] == [False]
    assert filter_urls(captures.limit(0), entries).count() == 0
    days = [DAY, DAY + dt.timedelta(5), DAY + dt.timedelta(9)]
    rows = [("host", "h", a, d) for a, d in zip(("block", "remove", "block"), days)] + [("host", "h", "remove", days[2])]
    got = sorted((r["valid_from"], r["valid_to"]) for r in intervals(spark.createDataFrame(rows, ENTRIES)).collect())
    assert got == [(days[0], days[1]), (days[2], None)]


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    count, kept = docs.count(), docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        kept = step(spark, kept, SF_SMALL)
        assert kept.columns == docs.columns and [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
        rows = kept.collect()
        assert 0.5 * count < len(rows) <= count
        count, kept = len(rows), spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF_SMALL)
    assert pieces.select("doc_id").distinct().count() == count


def test_run_gives_the_packed_pieces(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.filter(F.col("length") > 2048).count() == 0 and out.count() > 0


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (documents(spark, odd_documents(), clashing=True), documents(spark, [])):
        for name, step in corpus_pipeline.STAGES[:-1]:
            assert step(spark, docs, SF_SMALL).columns == docs.columns, name
            assert step(spark, docs, SF_SMALL).count() <= docs.count()
        corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).count()
