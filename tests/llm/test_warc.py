from __future__ import annotations

import base64
import hashlib

import pytest
from bindscope.llm import warc


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def want(rows, least=0):
    size = {i: (h or "").encode() for i, _, h in rows}
    out = set()
    for i, body in size.items():
        same = max(j for j, b in size.items() if b == body)
        revisit = len(body) >= least and same != i
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.add((i, len(body), digest, "revisit" if revisit else "response", same if revisit else None))
    return out


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a/x", "<p>é</p>"), (2, "http://a\r\nWARC-Type: x", "<p>é</p>"), (3, None, None), (4, "u", ""), (5, "u", "WARC/1.1\r\n"),
    (6, "u", f"before{FAKE}after{FAKE}"), (7, "u", "x" * 5000), (8, "u", FAKE), (9, "u", f"before{FAKE}after{FAKE}"), (10, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 99999\r\n\r\n"),
    (11, "u", "a\r\n\r\nb\r\n"), (-12, "u", "WARC/1.1\r\n\r\n"),
]


def fake(page="<urn:page:7>", length="5", kind="response"):
    return f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {page}\r\nContent-Length: {length}\r\n\r\nHTTP/1.1 200 OK\r\nContent-Length: abc\r\n\r\nhello\r\n\r\n"


#: Headers inside payloads that can't be read as a record's.
ODD = [fake(length=x) for x in ("²", "9" * 20, "-1", "٣", "1" * 18, "", "1 2")]
ODD += [fake(page=x) for x in ("<urn:page:--5>", "<urn:page:²>", "<urn:page:99999999999999999999>", "", "<urn:page:->")] + [fake(kind="revisit", length=str(n)) for n in (0, 40, 45)]


@pytest.mark.parametrize("least,split", [(0, None), (20, 300), (0, 57)])
def test_round_trip(spark, tmp_path, least, split):
    rows = [*ROWS, *[(300 + i, "u", text) for i, text in enumerate(ODD)], *[(100 + i, f"h{i}", f"<html>{i}{'y' * (i * 37 % 400)}</html>") for i in range(60)]]
    df = spark.createDataFrame([(*r, "t") for r in [*rows, (None, "u", "z"), (None, "u", "")]], "page_id long, url string, html string, file string").repartition(3)
    path = str(tmp_path / "warc")
    warc.write_archives(df, path, least)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = warc.read_archives(spark, path).collect()
        alone = {(None, 1, digest("z"), "response", None), (None, 0, digest(""), "revisit" if least == 0 else "response", 4 if least == 0 else None)}
        assert {tuple(r)[:5] for r in got} == want(rows, least) | alone
        pages = {i: (u, h or "") for i, u, h in rows}
        for r in got:
            assert r.payload is None if r.record_type == "revisit" else r.page_id is None or r.payload.decode() == pages[r.page_id][1]
            if r.page_id is not None:
                assert r.url == (pages[r.page_id][0] and pages[r.page_id][0].replace("\r", "%0D").replace("\n", "%0A"))
        for name in {r.file for r in got}:
            raw = open(name.removeprefix("file:").replace("///", "/"), "rb").read()
            for r in got:
                if r.file == name and r.page_id is not None:
                    assert raw[r.offset :].startswith(b"WARC/1.1\r\n") and f"<urn:page:{r.page_id}>".encode() in raw[r.offset : r.offset + 300]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_repeated_rows_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "a"), (1, "u", "a"), (0, "u", "a")], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "a"))
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, str(tmp_path / "a")).collect())
    assert got == [(0, "revisit", 1), (1, "response", None), (1, "response", None)]
    warc.write_archives(df.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_random_bytes_after_a_magic():
    import random

    rng = random.Random(4)
    alphabet = [b"WARC-Type: response", b"Content-Length:", b"\r\n", b":", b" ", b"5", b"\xc2\xb2", b"\xff", b"x", b"WARC-Record-ID: <urn:page:", b">", b"-"]
    for _ in range(20_000):
        raw = b"".join(rng.choices(alphabet, k=rng.randint(0, 14)))
        parsed = warc.parse(raw)
        assert parsed is None or int(parsed[1]["content-length"]) >= 0
        assert len(warc.content(raw)) == 7
