from __future__ import annotations

import base64
import glob
import gzip
import hashlib
from collections import Counter, defaultdict

from llm.tables import pages

from fiscalflow.llm import warc


def brute(rows, least=0):
    first = defaultdict(list)
    for i, _, t in rows:
        first[t or ""].append(i)
    out = Counter()
    for i, u, t in rows:
        data = (t or "").encode()
        ids = [x for x in first[t or ""] if x is not None]
        other = min(ids) if ids and min(ids) != i and len(data) >= least else None
        out[(i, u, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if other is None else "revisit", other)] += 1
    return out


def round_trip(df, scratch, name, **options):
    folder = f"file://{scratch}/{name}"
    index = warc.write_archives(df, folder, **options)
    return folder, index, warc.read_records(index, folder)


def check(df, scratch, name, **options):
    given = [tuple(r) for r in df.select("page_id", "url", "html").collect()]
    _, index, records = round_trip(df, scratch, name, **options)
    got = records.collect()
    assert Counter(tuple(r)[:6] for r in got) == brute(given, options.get("least_bytes", 0))
    payloads = Counter((i, u, (t or "").encode()) for i, u, t in given)
    assert all((r["page_id"], r["url"], bytes(r["payload"])) in payloads for r in got if r["record_type"] == "response")
    assert index.count() == len(given)


def test_pages(spark, scratch):
    check(pages(spark, "sf0.01"), scratch, "a", file_bytes=100_000)


def test_odd_rows(odd_pages, no_pages, scratch):
    check(odd_pages, scratch, "a")
    check(odd_pages, scratch, "b", least_bytes=3)
    check(no_pages, scratch, "c")


def test_archives_are_plain_warc_and_selections_read_only_what_they_need(spark, scratch):
    folder, index, _ = round_trip(pages(spark), scratch, "a")
    for path in glob.glob(f"{scratch}/a/*.warc.gz"):
        raw = gzip.open(path).read()
        n = 0
        while raw:
            fields, block = warc.parse_record(raw)
            head = raw.index(b"\r\n\r\n") + 4
            assert len(block) == int(fields["content-length"])
            raw = raw[head + len(block) + 4:]
            n += 1
        assert n == 1 + index.where(f"file = '{path.rsplit('/', 1)[1]}'").count()
    some = index.where("page_id % 7 = 0")
    got = warc.read_records(some, folder)
    assert {r["page_id"] for r in got.collect()} == {r["page_id"] for r in some.collect()}


def test_ranges():
    rows = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 100, 10), ("b", 0, 10), ("b", 10, 95)]
    got = [(f, s, e, len(m)) for f, s, e, m in warc.coalesced(rows, gap=5, most=100)]
    assert got == [("a", 0, 30, 3), ("a", 100, 110, 1), ("b", 0, 10, 1), ("b", 10, 105, 1)]
