from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from paystrata.llm import queries, warc

SCHEMA = "page_id long, url string, html string"
BIG = "x" * 1500
PAGES = [
    (1, "http://A.example.org:80/b?q#f", "<p>"), (2, None, None), (3, "http://a/\t\r\nx", BIG),
    (4, "http://u@b.org", BIG), (None, "http://n/", BIG), (4, "http://u@b.org", BIG), (9, "http://a/z", ""),
    (10, "http://a/z", "é" * 600), (11, "http://a/z", "é" * 600), (2**60 + 1, "http://big", "y" * 999),
    (12, "http://big", "y" * 999), (13, "http://x/", "long " * 400_000),
]


def expected(rows):
    payloads = [(i, (html or "").encode()) for i, _, html in rows]
    largest: dict = {}
    for i, p in payloads:
        if len(p) >= 1000 and i is not None:
            largest[p] = max(largest.get(p, i), i)
    out = []
    for i, p in payloads:
        keeper = largest.get(p)
        revisit = keeper is not None and i != keeper
        out.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None))
    return sorted(out, key=str)


def read(directory):
    rows = warc.read_archives(directory).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(map(tuple, rows.collect()), key=str)


def test_round_trip_with_nulls_copies_and_extra_columns(llm, clash, tmp_path):
    pages = clash(llm.createDataFrame(PAGES, SCHEMA))
    entries = warc.write_archives(pages, f"{tmp_path}/a", archive_bytes=2000)  # many small archives
    directory = warc.write_index(entries, f"{tmp_path}/i", block_entries=2)
    assert read(directory) == expected(PAGES)
    payloads = {r.page_id: r.payload for r in warc.read_archives(directory).collect() if r.record_type == "response"}
    assert payloads[13] == ("long " * 400_000).encode() and payloads[2] == b""


def test_lookup_finds_all_captures_of_a_key(llm, tmp_path):
    rows = [(n, f"http://h{n % 7}.org/p{n % 3}", f"text {n}") for n in range(400)] + [(n, "http://one.org/", "t") for n in range(400, 500)]
    entries = warc.write_archives(llm.createDataFrame(rows, SCHEMA), f"{tmp_path}/a")
    directory = warc.write_index(entries, f"{tmp_path}/i", block_entries=8)
    keys = llm.createDataFrame([("org,one)/",), ("org,h3)/p1",), ("zz",), ("",), (None,), ("org,h3)/p1",)], "surt string")
    found = warc.lookup(directory, keys)
    got = {(r.surt, r.page_id) for r in found.select("surt", "page_id").collect()}
    want = {("org,one)/", n) for n in range(400, 500)} | {("org,h3)/p1", n) for n in range(400) if n % 7 == 3 and n % 3 == 1}
    assert got == want and found.count() == len(want)


def test_lookup_across_ranges_and_blocks(llm, conf, tmp_path):
    """Few lines and many keys in many ranges; keys that fill, begin, end and span blocks."""
    conf(spark__sql__shuffle__partitions="13", spark__sql__adaptive__enabled="false")
    rows = [(n, f"http://h{n % 90:02}.org/", "t") for n in range(900)] + [(n, "http://h45.org/", "t") for n in range(900, 1300)]
    entries = warc.write_archives(llm.createDataFrame(rows, SCHEMA), f"{tmp_path}/a")
    for block in (7, 10, 400, 5000):
        directory = warc.write_index(entries, f"{tmp_path}/i{block}", block_entries=block)
        wanted = [f"org,h{n:02})/" for n in range(0, 90, 2)] + ["org,h45)/", "a", "org,h449)/", "zz"]
        found = warc.lookup(directory, llm.createDataFrame([(k,) for k in wanted], "surt string"))
        want = sorted(n for n, url, _ in rows if int(url[8:10]) % 2 == 0 or "h45" in url)
        assert sorted(r.page_id for r in found.select("page_id").collect()) == want


def test_lookup_with_part_of_a_directory(llm, tmp_path):
    rows = [(n, f"http://h{n:04}.org/", "t") for n in range(1000)]
    entries = warc.write_archives(llm.createDataFrame(rows, SCHEMA), f"{tmp_path}/a")
    directory = warc.write_index(entries, f"{tmp_path}/i", block_entries=50).orderBy("first_key").collect()
    kept = llm.createDataFrame(directory[3:5], warc.DIRECTORY)
    for line in directory[:3] + directory[5:]:
        assert not set(range(150, 250)) & {int(line.first_key[5:9]), int(line.last_key[5:9])}
    keys = llm.createDataFrame([(f"org,h{n:04})/",) for n in range(0, 1000, 3)], "surt string")
    got = sorted(r.page_id for r in warc.lookup(kept, keys).select("page_id").collect())
    assert got == [n for n in range(150, 250) if n % 3 == 0]
    assert warc.lookup(kept, keys.where("false")).count() == 0


def test_query_equals_brute_force(llm, tmp_path):
    llm.createDataFrame(PAGES, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, queries.QUERIES["op1_warc"](llm, str(tmp_path)).collect()), key=str)
    assert got == expected(PAGES)


def test_keys_reverse_the_host(llm):
    urls = ["https://User@WWW.Example.org:443/A/b?x=1#top", "example.org", "http://example.org:8080/", None]
    df = llm.createDataFrame([(u,) for u in urls], "url string").select(warc.surt(F.col("url")).alias("k"))
    assert [r.k for r in df.collect()] == ["org,example,www)/a/b?x=1", "org,example)/", "org,example:8080)/", "-"]


def test_empty_table(llm, tmp_path):
    directory = warc.archive_pages(llm.createDataFrame([], SCHEMA), str(tmp_path))
    assert warc.read_archives(directory).count() == 0
    assert warc.lookup(directory, llm.createDataFrame([("a",)], "surt string")).count() == 0
