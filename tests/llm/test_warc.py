"""WARC round trips with hostile payloads, and pointer jumping on its own."""

import base64
import hashlib
import os

import pytest

from stratus.llm import warc as W

FAKE = ("\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\n"
        "WARC-Payload-Digest: sha1:X\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(rows):
    out = []
    for page, _, html in rows:
        least = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        revisit = least is not None and page != least
        out.append((page, len((html or "").encode()), digest(html), "revisit" if revisit else "response",
                    least if revisit else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    html = ["", None, "<p>é日本😀</p>", FAKE, "x" + FAKE * 3 + "y", "\r\n\r\n", "\r\n\r\n\r\nWARC/1.1\r\n", "WARC/1.1\r\n",
            "WARC/1.1\r\nContent-Length: 5\r\n\r\n", "\r\n\r\nWARC/1.1\r\n", "\n", "copy", "copy", "copy", FAKE,
            "a" * 300_000, "\r\n\r\nWARC/1.1\r\nContent-Length: 99999999999\r\n\r\n", "\r", "end\r\n\r\nWARC/1.1"]
    out = [(i, f"http://h/{i}", h) for i, h in enumerate(html)]
    return out + [(50, None, "n"), (51, "http://x/WARC/1.1\r\nContent-Length: 7\r\n\r\n", "url"), (None, "u", "copy"),
                  (52, "u", "twice"), (52, "u", "twice"), (53, "u", "twice")]


@pytest.mark.parametrize("parts", [1, 7])
def test_round_trip(spark, rows, parts):
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, file string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(parts == 1).lower())
    try:
        got = sorted((tuple(r) for r in W.round_trip(pages).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == expected(rows)


def test_small_splits_read_the_same(spark, rows, tmp_path):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    W.write_archives(pages, f"file:{tmp_path}/a")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found = W.read_archives(spark, f"file:{tmp_path}/a").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = sorted((str(p).replace("None", "null"), d) for p, _, d, kind, _ in expected(rows) if kind == "response")
    assert sorted((r.page_id, r.payload_digest) for r in found if r.record_type == "response") == want
    # every offset is that of a record in its file, and the chain covers the file
    for name in {r.file for r in found}:
        data = open(name.removeprefix("file://").removeprefix("file:"), "rb").read()
        assert all(data[r.offset:].startswith(b"WARC/1.1\r\n") for r in found if r.file == name)


def test_scans_that_split_differently_read_the_same(spark, rows, tmp_path, monkeypatch):
    """Executors come and go between the two scans of the archives, and with them the splits."""
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    W.write_archives(pages, f"file:{tmp_path}/a")
    whole = sorted(tuple(r) for r in W.read_archives(spark, f"file:{tmp_path}/a").collect())
    written = W.written

    def then_split(df, purpose):
        out = written(df, purpose)
        if purpose == "candidates":
            spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return out

    monkeypatch.setattr(W, "written", then_split)
    try:
        again = sorted(tuple(r) for r in W.read_archives(spark, f"file:{tmp_path}/a").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert again == whole and all(r[7] for r in again if r[3] == "response")


def test_revisits_beyond_the_broadcast_bound(spark, rows, monkeypatch):
    monkeypatch.setattr(W, "MOST_BROADCAST", 0)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((tuple(r) for r in W.round_trip(pages).collect()), key=str) == expected(rows)


def test_a_payload_that_is_not_the_declared_one_is_an_error(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "payload"), (2, "u", "other")], "page_id long, url string, html string").coalesce(1)
    W.write_archives(pages, f"file:{tmp_path}/a")
    name = next(f for f in os.listdir(tmp_path / "a") if f.startswith("part"))
    data = (tmp_path / "a" / name).read_bytes()
    for f in os.listdir(tmp_path / "a"):
        os.remove(tmp_path / "a" / f)
    (tmp_path / "a" / name).write_bytes(data.replace(b"payload", b"pAyload"))
    with pytest.raises(Exception, match="not the declared one"):
        W.read_archives(spark, f"file:{tmp_path}/a").collect()


@pytest.mark.parametrize("html", ["\r\n\r\nWARC/1.1\r\nWARC/1.1\r\n", "WARC/1.1\r\n" * 2, "WARC/1.1\r\n" * 5 + "x",
                                  "a" + "\r\n\r\nWARC/1.1\r\nWARC/1.1\r\nContent-Length: 1\r\n\r\n" * 2])
def test_doubled_magic_line(spark, html):
    rows = [(i, f"http://h/{i}", html + str(i) if i % 2 else f"page {i}") for i in range(6)] + [(6, "u", html), (7, "u", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert sorted((tuple(r) for r in W.round_trip(pages).collect()), key=str) == expected(rows)


def test_lost_records_are_an_error(spark, monkeypatch):
    read = W.read_archives
    monkeypatch.setattr(W, "read_archives", lambda *a: read(*a).where("page_id <> '2'"))
    pages = spark.createDataFrame([(1, "u", "a"), (2, "u", "b")], "page_id long, url string, html string")
    with pytest.raises(ValueError, match="1 records read of 2 written"):
        W.round_trip(pages)


def test_payloads_below_the_bound_are_not_revisited(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.refers_to for r in W.round_trip(pages, least_bytes=3).collect()}
    assert got == {1: None, 2: None, 3: None, 4: 3}


def test_pointer_jumping(spark):
    links = [("f", 10 * i, 10 * (i + 1)) for i in range(100)] + [("f", 5, 10), ("g", 0, None), ("g", 7, 0), ("h", 3, 0)]
    links = spark.createDataFrame(links, "file string, offset long, next long")
    for block_bytes in (7, 64, 1 << 20):
        got = W.reachable(links, block_bytes).collect()
        assert sorted((r.file, r.offset) for r in got) == [("f", 10 * i) for i in range(100)] + [("g", 0)]


def test_empty_table_and_foreign_file(spark, tmp_path):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    os.makedirs(tmp_path / "b")
    (tmp_path / "b" / "x.warc").write_bytes(b"no archive" + FAKE.encode())
    assert W.read_archives(spark, f"file:{tmp_path}/b").count() == 0
