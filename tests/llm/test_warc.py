import gzip
import hashlib
import re
from datetime import datetime, timezone
from pathlib import Path

import pytest

from lodestone.llm import warc

BIG = "<p>é\r\n\r\nWARC/1.1\r\nContent-Length: 7\r\n\r\n" + "x" * 1200


def expected(pages, least=1000):
    first = {}
    for i, _, html in pages:
        data = (html or "").encode()
        if len(data) >= least and i is not None:
            first[data] = max(i, first.get(data, i))
    out = []
    for i, _, html in pages:
        data = (html or "").encode()
        to = first.get(data)
        revisit = to is not None and to != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


PAGES = [(1, "http://a/", BIG), (2, "http://b/\r\nX: y", BIG), (3, None, BIG), (3, None, BIG), (None, "http://n/", BIG), (4, "u", None), (5, "u", ""), (6, "u", "short"),
         (7, "u", "short"), (8, "u", "\n" * 1500), (9, "u", "\r\n\r\n" * 500), (10, "u", "\n" * 1500), (11, "u", "y" * 300000), (None, "u", "only" * 400), (None, "u", "only" * 400)]


@pytest.mark.parametrize("pages", [PAGES, [], PAGES[:1]])
def test_round_trip(spark, pages):
    frame = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, record_id string").repartition(3)
    got = warc.archived(frame).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=str) == expected(pages)


def test_files_are_archives(spark, tmp_path):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write(frame, f"{tmp_path}/w")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(f"{tmp_path}/w").glob("part-*")))
    kinds = []
    while data:  # read by the format's own rules
        head, _, data = data.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines[1:])
        n = int(fields["Content-Length"])
        assert data[n:n + 4] == b"\r\n\r\n"
        data = data[n + 4:]
        kinds.append(fields["WARC-Type"])
    infos = kinds.count("warcinfo")
    assert sorted(kinds) == ["response"] * 11 + ["revisit"] * 4 + ["warcinfo"] * infos
    assert infos == sum(1 for p in Path(f"{tmp_path}/w").glob("part-*") if gzip.decompress(p.read_bytes())) and kinds[0] == "warcinfo"


def test_records_are_dated_when_written(spark, tmp_path):
    before = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    warc.write(spark.createDataFrame(PAGES, "page_id long, url string, html string"), f"{tmp_path}/w")
    after = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/w").glob("part-*")).decode()
    dates = re.findall(r"WARC-Date: (\S+)", data)
    assert len(dates) >= 15 + 1 and all(before <= d <= after for d in dates)
    warc.write(spark.createDataFrame(PAGES, "page_id long, url string, html string"), f"{tmp_path}/v", date="2020-02-02T00:00:00Z")
    assert "WARC-Date: 2020-02-02T00:00:00Z" in gzip.decompress(next(p for p in Path(f"{tmp_path}/v").glob("part-*")).read_bytes()).decode()


def test_payloads_come_back(spark, tmp_path):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write(frame, f"{tmp_path}/w")
    got = {bytes(r.payload) for r in warc.read(spark, f"{tmp_path}/w").where("record_type = 'response'").collect()}
    assert got == {(h or "").encode() for _, _, h in PAGES}


def test_damage_is_noticed(spark, tmp_path):
    frame = spark.createDataFrame(PAGES[:1], "page_id long, url string, html string")
    warc.write(frame, f"{tmp_path}/w")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/w").glob("part-*"))
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.warc.gz").write_bytes(gzip.compress(data.replace(b"xxxx", b"xxxz", 1)))
    with pytest.raises(Exception, match="damaged record"):
        warc.read(spark, f"{tmp_path}/bad").collect()


def test_archives_are_never_split(spark, tmp_path):
    """With splits far below an archive's size all records come back; files that Spark could split are refused."""
    pages = [(i, "u", f"page {i} " + "z" * 3000) for i in range(200)]
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1), f"{tmp_path}/w")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        assert warc.read(spark, f"{tmp_path}/w").count() == 200
        plain = tmp_path / "plain"
        plain.mkdir()
        (plain / "x.warc").write_bytes(b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/w").glob("part-*")))
        with pytest.raises(Exception, match="may be split"):
            warc.read(spark, str(plain)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
