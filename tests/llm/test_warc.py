import base64
import hashlib

import pytest

from dimfold.llm import warc_archive as W

SCHEMA = "page_id long, url string, html string"


def b32(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def test_round_trip_of_odd_pages(spark, tmp_path):
    big = "x\r\n\r\nWARC/1.1\r\n" * 40_000
    rows = [(1, "http://a/1", "same"), (7, "http://a/7", "same"), (7, "http://a/7", "same"), (3, None, None), (4, "http://a/ü b\n", ""), (None, "u", "same"),
            (None, "v", "lonely"), (9, "http://a/9", big), (10, "", "é\r\n\r\n"), (11, "z", big + "1"), (2 ** 62 + 1, "w", "last")]
    df = spark.createDataFrame([r + ("k", 0) for r in rows], SCHEMA + ", sha string, Key int")
    index = W.write_archives(df, str(tmp_path / "a"), file_bytes=500)
    got = sorted(((r.page_id, r.url, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload).decode() if r.payload is not None else None)
                  for r in W.read_records(index).collect()), key=repr)
    best = {"same": 7, "": 4, "lonely": None, big: 9, "é\r\n\r\n": 10, big + "1": 11, "last": 2 ** 62 + 1}
    want = []
    for page, url, html in rows:
        t = html or ""
        answer = page == best[t] or best[t] is None
        uri = (url or "").replace(" ", "%20").replace("\n", "%0A")
        want.append((page, uri, "response" if answer else "revisit", None if answer else best[t], len(t.encode()), b32(t), t if answer else None))
    assert got == sorted(want, key=repr)
    assert index.select("path").distinct().count() > 1
    some = W.read_records(index.where("page_id = 9"), range_bytes=1, with_payload=False).collect()
    assert [(r.page_id, r.payload_bytes) for r in some] == [(9, len(big.encode()))]


def test_ranges_coalesce_and_damage_shows(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}", f"page {i} " * 50) for i in range(60)], SCHEMA)
    index = W.write_archives(df, str(tmp_path / "a"))
    near = W.read_records(index).count()
    far = W.read_records(index, gap_bytes=-1).count()
    assert near == far == 60
    data = W.record_bytes(1, "u", b"abc", b32("abc"), 1)
    assert W.parse_record(data)[4] == 3
    with pytest.raises(ValueError):
        W.parse_record(data.replace(b"abc", b"abd"))


def test_tasks_follow_the_bytes_of_the_archives(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}", "".join(map(chr, range(40 + i, 900 + i)))) for i in range(200)], SCHEMA)
    index = W.write_archives(df, str(tmp_path / "a"))
    size = index.agg({"length": "sum"}).first()[0]
    some = W.read_records(index, task_bytes=size // 20)
    assert 20 <= some.rdd.getNumPartitions() <= 21
    assert {r.page_id for r in some.collect()} == set(range(200))
    assert W.read_records(index).rdd.getNumPartitions() == 1  # one range of bytes


def test_empty_table(spark, tmp_path):
    index = W.write_archives(spark.createDataFrame([], SCHEMA), str(tmp_path / "a"))
    assert index.count() == 0 and W.read_records(index).count() == 0
