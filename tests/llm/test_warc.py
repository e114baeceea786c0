import gzip
import hashlib
import random

import pytest

from labelloom.llm import shared, warc

FAKE = (
    "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 10\r\n\r\n0123456789"
    "\r\n\r\nWARC/1.1\r\nContent-Length: 999999\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"
)
ROWS = [
    (1, "u", FAKE), (2, "u\r\nX: y", "a" * 200), (3, None, "a" * 200), (4, "u", None), (5, "u", ""), (6, "u", "WARC/1.1\r\n"), (7, "u", "\r\n\r\n"),
    (8, "u", "ends\r\n"), (9, "u", "a" * 50), (10, "u", "a" * 50), (2, "u", "a" * 200), (None, "u", "a" * 200), (11, "u", "é" * 60),
    (12, "u", "é" * 60), (13, "u", FAKE), (14, "z", "\r\n"), (15, "q", "\r\n\r\nWARC/"), (16, "q", "y" * 99), (17, "q", "y" * 99), (18, "q", "z" * 300_000),
]


def brute_force(rows):
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        first = min(p for p, _, other in rows if (other or "") == (html or "") and p is not None)
        again = len(data) >= 100 and page != first
        found.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(found, key=str)


@pytest.mark.parametrize("partitions, share", [(1, shared.HOT_SHARE), (4, 1.0)])
def test_round_trip(spark, monkeypatch, partitions, share):
    monkeypatch.setattr(shared, "HOT_SHARE", share)
    monkeypatch.setattr(warc, "FILE_RECORDS", 7)
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string").selectExpr("*", "url as id", "html as record", "1 as n")
    got = warc.round_trip(pages.repartition(partitions))
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(ROWS)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_archive_is_a_chain_of_records(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, "page_id bigint, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    (file,) = (tmp_path / "a").glob("*.gz")
    data, at, n = gzip.decompress(file.read_bytes()), 0, 0
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n")
        at += len(head) + 4 + int(head.rpartition(b"Content-Length: ")[2])
        assert data[at : at + 4] == b"\r\n\r\n"
        at, n = at + 4, n + 1
    assert at == len(data) and n == len(ROWS)
    candidates = warc.candidate_records(spark, str(tmp_path / "a"))
    assert candidates.where("record_type = 'response' and record_id = '<urn:page:77>'").count() == 1
    assert warc.read_archives(spark, str(tmp_path / "a")).where("record_id = '<urn:page:77>'").count() == 0


def test_damage_is_an_error(spark, tmp_path):
    record = "WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"
    with gzip.open(tmp_path / "a.warc.gz", "wb") as out:
        out.write(record.encode())
    with pytest.raises(ValueError, match="doesn't end where the file does"):
        warc.read_archives(spark, str(tmp_path))


def test_long_chains_take_few_rounds(spark):
    draw = random.Random(1)
    rows = [("f", i, i + 1) for i in range(700)] + [("f", 1000 + i, 700) for i in range(50)] + [("g", 0, 9), ("g", 5, 9), ("g", 9, 9)]
    draw.shuffle(rows)
    got = warc.reachable(spark.createDataFrame(rows, "file string, offset bigint, successor bigint")).collect()
    assert sorted((r.file, r.offset) for r in got) == [("f", i) for i in range(701)] + [("g", 0), ("g", 9)]
