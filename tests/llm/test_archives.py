import base64
import gzip
import hashlib
import random
import uuid

import pytest

import __spark_entry__ as entry
from stemma.llm import archives
from stemma.llm.archives import Assembler
from stemma.llm.common import read
from stemma.session import scratch_root

ODD = [None, "", "\r\n\r\n", "a\r\n\r\nb", "WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", "ends\r", "ends\r\n", "ends\n", "\n\n", "http://a.example/ 0.0.0.0 20000101000000 text/html 5\nabcde\n", "é🙂\x00", "x" * 3_000_000, "filedesc://x 0 2000 text/plain 3\n2 0 x"]


def sha(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows):
    """Rows ``page_id, html`` as the query must give them, ties between equal rows left open."""
    newest = {}
    for page, html in rows:
        body = (html or "").encode()
        newest[body] = max(newest.get(body, -(1 << 63)), -(1 << 63) if page is None else page)
    out = []
    taken = set()
    for page, html in rows:
        body = (html or "").encode()
        best = None if newest[body] == -(1 << 63) else newest[body]
        first = page == best and body not in taken
        if first:
            taken.add(body)
        out.append((page, len(body), sha(body), "response" if first else "revisit", None if first else best))
    return sorted(out, key=repr)


def folder(spark, name):
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_pages(spark, rows, parts, tmp_path):
    path = str(tmp_path / "pages.parquet")
    spark.createDataFrame(rows, "page_id long, url string, html string, kind string, key string, payload string").repartition(parts).write.parquet(path)
    return str(tmp_path)


@pytest.mark.parametrize("parts", [1, 5])
def test_odd_pages(spark, tmp_path, parts):
    rnd = random.Random(6)
    rows = [(i, rnd.choice([None, "", "http://a.example/a b\nc", "http://é.example/?q= x", "mailto:a"]), html, "k", "k", None) for i, html in enumerate(ODD * 2)]
    rows += [(100 + i, f"http://h.example/{i}", "hot", "k", "k", None) for i in range(700)]
    rows += [rows[0], rows[3], (None, None, None, None, None, None), (None, "u:x", "only here", None, None, None), (None, "u:x", "only here", None, None, None), (-5, "u:x", "hot", None, None, None)]
    found = entry.queries()["op13_warc"](spark, write_pages(spark, rows, parts, tmp_path))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected([(r[0], r[2]) for r in rows])
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_empty_table(spark, tmp_path):
    assert entry.queries()["op13_warc"](spark, write_pages(spark, [], 1, tmp_path)).count() == 0


def test_query(spark, sf):
    rows = [(r["page_id"], r["html"]) for r in read(spark, sf, "pages").collect()]
    found = entry.queries()["op13_warc"](spark, sf)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_revisits_from_a_size_on(spark, tmp_path):
    path = folder(spark, "small")
    pages = spark.createDataFrame([("1", "a:b", b"abc"), ("2", "a:b", b"abc"), ("3", "a:b", b"abcd"), ("4", "a:b", b"abcd")], "key string, url string, payload binary")
    archives.write_arc(pages, f"{path}/arc", versions=(2,))
    archives.convert(spark, f"{path}/arc", f"{path}/warc", least=4)
    found = archives.with_targets(archives.read_warc(spark, f"{path}/warc", payloads=True))
    assert sorted((r["key"], r["kind"], r["target_key"], bytes(r["payload"])) for r in found.where("key is not null").collect()) == [("1", "response", None, b"abc"), ("2", "response", None, b"abc"), ("3", "revisit", "4", b""), ("4", "response", None, b"abcd")]


def arc(version, *records):
    """A version block and records, each a member of its own."""
    titles = " ".join(archives._TITLES[f] for f in archives.FIELDS[version])
    body = f"{version} 0 X\n{titles}\n\n".encode()
    more = b" 200 - - 0 a.arc" if version == 2 else b""
    block = b"filedesc://a.arc 1.2.3.4 19990203040506 text/plain%b %d\n%b\n" % (more, len(body), body)
    return b"".join(gzip.compress(r) for r in (block, *records))


def test_header_lines_by_version(spark, tmp_path):
    http = b"HTTP/1.0 200 OK\r\nX-Page-Key: 7\r\n\r\npay\nload"
    one = arc(1, b"http://a.example/x y 1.1.1.1 20010203040506 text/html %d\n%b\n" % (len(http), http), b"rubbish\n\n", b"dns:a.example 1.1.1.1 2001 text/dns 4\nname\n", b"http://a.example/bare 1.1.1.1 200102 text/html 0\n\n", b"ftp://a.example/f 1.1.1.1 20010231000000 text/plain 3\nabc\n", b"ftp://a.example/g 1.1.1.1 20010301000000 text/plain 3\nabc\n", b"http://a.example/cut 1.1.1.1 20010203040506 text/html 900\nHTTP/1.1 200 OK\r\n\r\nhalf")
    two = arc(2, b"http://b.example/ 1.1.1.1 20020203040506 text/html 200 sum - 99 b.arc %d\n%b\n" % (len(http), http), b"http://b.example/one 1.1.1.1 20020203040506 text/html 5\nabcde\n")
    for name, data in (("one", one), ("two", two)):
        (tmp_path / f"{name}.arc.gz").write_bytes(data)
    records = archives.read_arc(spark, str(tmp_path)).collect()
    found = sorted((r["url"], r["kind"], r["date"], bytes(r["payload"]), r["key"], r["whole"]) for r in records if r["kind"] != "warcinfo")
    assert found == [
        ("dns:a.example", "response", "2001-01-01T00:00:00Z", b"name", None, True),
        ("ftp://a.example/g", "resource", "2001-03-01T00:00:00Z", b"abc", None, True),
        ("http://a.example/bare", "resource", "2001-02-01T00:00:00Z", b"", None, True),
        ("http://a.example/cut", "response", "2001-02-03T04:05:06Z", b"half", None, False),
        ("http://a.example/x y", "response", "2001-02-03T04:05:06Z", b"pay\nload", "7", True),
        ("http://b.example/", "response", "2002-02-03T04:05:06Z", b"pay\nload", "7", True),
    ]
    assert [r["date"] for r in records if r["kind"] == "warcinfo"] == ["1999-02-03T04:05:06Z"] * 2
    assert len({r["record_id"] for r in records}) == len(records)
    assert {r["record_id"] for r in archives.read_arc(spark, str(tmp_path)).collect()} == {r["record_id"] for r in records}
    out = folder(spark, "converted")
    archives.convert(spark, str(tmp_path), out)
    again = archives.read_warc(spark, out, payloads=True).collect()
    kinds = [r["kind"] for r in again]
    assert (kinds.count("revisit"), kinds.count("warcinfo"), len(kinds)) == (1, 2, 8)
    assert {r["url"]: r["whole"] for r in again if r["kind"] == "response"}["http://a.example/cut"] is False
    full = {r["record_id"]: (r["url"], len(r["payload"]), r["digest"]) for r in records if r["kind"] != "warcinfo"}
    assert {r["record_id"]: (r["url"], r["payload_bytes"], r["payload_digest"]) for r in again if r["kind"] != "warcinfo" and r["kind"] != "revisit"}.items() <= full.items()


def test_pieces_make_records_wherever_they_are_cut():
    rnd = random.Random(3)
    for _ in range(300):
        bodies = ["".join(rnd.choice(["\r\n", "\r", "\n", "a", "\r\n\r\n", "WARC/1.0"]) for _ in range(rnd.randint(0, 6))).encode() for _ in range(4)]
        data = b"".join(b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: %d\r\n\r\n%b\r\n\r\n" % (len(b), b) for b in bodies)
        pieces = data.split(b"\r\n\r\n")
        assembler = Assembler(b"\r\n\r\n", archives.warc_head)
        found = [r for p in pieces for r in assembler.piece(p)] + list(assembler.over())
        assert [(r[2], r[3]) for r in found] == [(b, True) for b in bodies]


def test_dates():
    assert archives.timestamp(b"1999") == "1999-01-01T00:00:00Z"
    assert archives.timestamp(b"19991231235959") == "1999-12-31T23:59:59Z"
    assert archives.timestamp(b"0042") == "0042-01-01T00:00:00Z"
    assert archives.timestamp(b"19990230") is None
    assert archives.timestamp(b"199") is None


def test_heavy_keys_are_joined_apart(spark):
    rows = spark.createDataFrame([(str(i), "hot" if i % 3 else f"k{i % 50}" if i % 2 else None) for i in range(3000)], "id string, k string")
    facts = rows.where("k is not null").groupBy("k").count().selectExpr("k", "count as n", "concat('=', k) as value")
    found = archives.join_by_share(rows, facts, "k", "id", share=10).collect()
    assert len(found) == 3000
    assert all(r["value"] == (None if r["k"] is None else f"={r['k']}") for r in found)
