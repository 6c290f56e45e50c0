import hashlib
import random

import pytest

from edgewatch.llm import warc
from edgewatch.session import shared_dir


def _pages():
    rng = random.Random(3)
    fake = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 12\r\n\r\nhello world!\r\n\r\n"
    rows = [(1, "http://a/1", None), (2, None, ""), (3, "http://a/\r\n3", fake * 3), (4, "u", "x\r\n\r\n")]
    rows += [(i, f"http://a/{i}", "é" * rng.randrange(1, 3000) + fake * rng.randrange(2)) for i in range(5, 60)]
    rows += [(i, "http://b/WARC/1.0", "copy " * 300) for i in range(60, 90)]
    rows += [(i, "http://b", "small") for i in range(90, 99)]
    return rows + [(200, "http://c", "WARC/1.0\r\n" * 5000), (201, "http://d", "long " * 100_000), (88, "e", "copy " * 300)]


def _want(rows):
    keepers = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000:
            keepers[html] = max(keepers.get(html, page), page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        again = keepers.get(html, page) != page
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), keepers[html] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", ["128m", "4k"])
def test_round_trip(spark, split):
    rows = _pages()
    pages = spark.createDataFrame([(*r, "c") for r in rows], "page_id long, url string, html string, digest string")
    path = warc.scratch_path(shared_dir(spark))
    warc.write_archives(pages.repartition(3), path, max_records=30)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_records(spark, path, payload=True).collect()
        digests = warc.read_records(spark, path).select("record_id", "bytes", "digest").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)

    def number(urn):
        return int(urn[len("<urn:x-page:") : -1]) if urn else None

    assert sorted(((number(r.record_id), r.bytes, r.digest, number(r.refers_to)) for r in got), key=str) == _want(rows)
    assert sorted(map(str, digests)) == sorted(
        f"Row(record_id={r.record_id!r}, bytes={r.bytes}, digest={r.digest!r})" for r in got
    )
    texts = {page: (html or "").encode() for page, _, html in rows}
    for r in got:
        assert r.type == ("revisit" if r.refers_to else "response")
        if r.type == "response":
            assert bytes(r.payload) == texts[number(r.record_id)]


def test_files_are_plain_warc_and_breaks_end_a_chain(spark, tmp_path):
    def record(body, kind="resource"):
        return b"WARC/1.0\r\nWARC-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (kind.encode(), len(body), body)

    raw = b"\xff\xfe\x00bytes"
    (tmp_path / "good.warc").write_bytes(record(raw) + record(record(b"inner")) + record(b""))
    (tmp_path / "bad.warc").write_bytes(record(b"one") + b"noise" + record(b"lost"))
    (tmp_path / "empty.warc").write_bytes(b"")
    got = warc.read_records(spark, f"file://{tmp_path}/*.warc", payload=True).collect()
    found = sorted((r.file.rsplit("/", 1)[1], r.offset, bytes(r.payload)) for r in got)
    start = len(record(raw))
    assert found == [
        ("bad.warc", 0, b"one"),
        ("good.warc", 0, raw),
        ("good.warc", start, record(b"inner")),
        ("good.warc", start + len(record(record(b"inner"))), b""),
    ]


def test_empty_table(spark):
    path = warc.scratch_path(shared_dir(spark))
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_records(spark, path).count() == 0
