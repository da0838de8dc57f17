"""WARC round trip, index search and the oracle."""

import gzip
import hashlib

import duckdb
import pytest

from stratum.llm import warc
from stratum.llm.common import filesystem
from stratum.llm.queries import ORACLE, REGISTRY
from stratum.session import scratch_path

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def test_query_matches_oracle(spark):
    out = REGISTRY["op1_warc_capture_index"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    want = con.execute(ORACLE["op1_warc_capture_index"])
    cols = [d[0] for d in want.description]
    assert sorted(out.columns) == sorted(cols)
    key = lambda r: r[0]
    assert sorted((tuple(r[c] for c in cols) for r in out.collect()), key=key) == sorted(want.fetchall(), key=key)


def test_surt():
    assert warc.surt("HTTP://Blog.Example.com:80/En/7?a=B#top") == "com,example,blog)/En/7?a=B"
    assert warc.surt("https://example.com:8443") == "com,example:8443)/"
    assert warc.surt(None) == "" and warc.surt("No Url\n") == "no%20url%0a"
    assert warc.surt("http://[bad") == "http://[bad"


@pytest.mark.parametrize("n", [None, 0, 1, -1, 2**63 - 1, -2**63, 1 << 40])
def test_record_ids(n):
    assert warc.page_of(warc.record_id(n)) == n


def test_edges(spark):
    big, other = "ü" * 600, "x" * 1000
    rows = [(1, "http://a.org/", big), (2, "http://a.org/", big), (7, "http://b.org/%20 \r\nX: y", big), (7, "http://c.org", big),
            (3, None, None), (4, "", ""), (5, "http://s.org", "small"), (6, "http://s.org", "small"),
            (None, "http://n.org", big), (None, "http://n.org", other), (None, "http://n.org", other),
            (8, "http://é.org/ü", "long " * 100_000), (5, "http://s.org", "small")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS digest", "2 AS original", "3 AS payload")
    got = warc.round_trip(spark, pages, payloads=True).collect()
    seen = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.target_uri)
                   for r in got), key=repr)
    want = []
    for i, url, html in rows:
        data = (html or "").encode()
        revisit = html == big and i != 7
        want.append((i, "revisit" if revisit else "response", 7 if revisit else None, len(data),
                     hashlib.sha1(data).hexdigest(), url or ""))
    assert seen == sorted(want, key=repr)
    assert all((r.payload is None) == (r.record_type == "revisit") for r in got)
    assert warc.round_trip(spark, pages.limit(0)).count() == 0


def test_blocks_and_directory(spark):
    base = scratch_path(spark, "t")
    rows = [(i, f"http://h{i % 7}.org/{i % 50}", f"page {i}" * (i % 9)) for i in range(400)]
    captures = warc.write_archives(spark, spark.createDataFrame(rows, PAGES).repartition(3), base)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = warc.write_index(spark, captures, base, lines=16).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(p.captures for p in parts) == 400 and len(parts) > 1
    places = {}
    for c in captures.collect():
        places.setdefault((c.key, c.capture), []).append((c.file, c.offset, c.length))
    found = 0
    for p in parts:
        index = warc.Index(p["index"], p["directory"])
        for k, v in sorted(places.items()):
            if got := index.find("\t".join(k)):
                assert got == v
                found += 1
        assert index.find("org,h3)/zzz\tnone") == []
        assert index.reads <= 2 * -(-p.captures // 16) + 1
    assert found == len(places)
    file = next(iter(places.values()))[0][0]
    fs, path = filesystem(file)
    with gzip.open(path) as f:  # a standard reader sees all members
        assert f.read().count(b"WARC/1.1\r\n") == sum(v[0][0] == file for v in places.values())


def test_damage_is_noticed():
    import zlib
    raw = zlib.decompress(warc.record(1, "http://a.org", b"payload"), 31).replace(b"payload\r\n", b"paylaod\r\n")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(zlib.compress(raw, wbits=31))
