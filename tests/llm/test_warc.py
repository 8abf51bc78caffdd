import base64
import gzip
import hashlib
import os

import pytest
from corpus_cases import rows_of

from custvalue.functions.scratch import scratch_path
from custvalue.llm import warc

PAGES = "page_id long, url string, html string, payload string, digest string"


def pages(spark):
    html = [None, "", "<p>é</p>", "x" * 200_000, "WARC/1.1\r\n\r\nnot a record", "\x1f\x8b\x08 raw", "same", "same", "same", "", "<p>é</p>"]
    rows = [(i, f"http://h.org/{i}", h, "clash", "clash") for i, h in enumerate(html)]
    rows += [(8, "http://h.org/8", "same", "c", "c"), (None, None, "same", "c", "c"), (None, "http://h.org/a b\né", "alone", "c", "c")]
    return spark.createDataFrame(rows, PAGES)


def brute(rows, least):
    first = {}
    for page_id, _, html, *_ in rows:
        if page_id is not None:
            first[html or ""] = max(page_id, first.get(html or "", page_id))
    found = []
    for page_id, _, html, *_ in rows:
        data = (html or "").encode()
        top = first.get(html or "")
        again = len(data) >= least and top is not None and page_id != top
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        found.append((page_id, len(data), digest, "revisit" if again else "response", top if again else None))
    return sorted(found, key=repr)


def read_back(spark, path, **options):
    return warc.read_warc(spark, path, **options).select(
        warc.page_of("record_id").alias("page_id"), "payload_length", "payload_digest", "record_type", warc.page_of("refers_to").alias("refers_to")
    )


@pytest.mark.parametrize("least", [0, 4, 5])
def test_records_of_pages(spark, least):
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(pages(spark), least), path)
    assert rows_of(read_back(spark, path, payload="digest")) == brute(pages(spark).collect(), least)
    assert not [f for f in os.listdir(path) if f.startswith("_temporary")]
    full = warc.read_warc(spark, path, types=("response",)).collect()
    texts = {r["html"] or "" for r in pages(spark).collect()}
    assert {r["payload"].decode() for r in full} == texts
    assert {r["record_type"] for r in full} == {"response"}


def test_predicates_reach_the_reader_and_skip_payloads(spark):
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(pages(spark)), path)
    reader = warc.PushingWarcReader({"path": path, "payload": "full"})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    other = GreaterThan(("payload_length",), 5)
    filters = [EqualTo(("record_type",), "response"), In(("record_id",), ("<urn:page:3>", "<urn:page:4>")), StringStartsWith(("target_uri",), "http://h"), other]
    assert list(reader.pushFilters(filters)) == [other]
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert sorted(r for b in batches for r in b.column("record_id").to_pylist()) == ["<urn:page:3>", "<urn:page:4>"]
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        found = warc.read_warc(spark, path).where("record_type = 'revisit' and record_id like '<urn:page:%'")
        assert found.count() == sum(r[3] == "revisit" for r in brute(pages(spark).collect(), 0))
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")


def test_a_skipped_member_is_not_inflated(tmp_path, monkeypatch):
    row = dict.fromkeys([*warc.HEADERS, "payload"]) | {"record_type": "response", "record_id": "<a>"}
    big = os.urandom(3_000_000)
    data = warc.member(warc.record_bytes(row | {"payload": big}), 4)
    last = warc.member(warc.record_bytes(row | {"record_type": "resource", "record_id": "<b>", "payload": b"z"}), 4)
    (tmp_path / "a.warc.gz").write_bytes(data + last)
    reader = warc.WarcReader({"path": str(tmp_path), "types": "resource"})
    blocks = []
    monkeypatch.setattr(warc._Member, "_read", lambda self, at: blocks.append(at))
    (batch,) = reader.read(reader.partitions()[0])
    assert batch.column("record_id").to_pylist() == ["<b>"] and not blocks


def test_other_writers_files_and_damage(spark, tmp_path):
    row = dict.fromkeys([*warc.HEADERS, "payload"]) | {"record_type": "resource"}
    plain = [warc.record_bytes(row | {"record_id": f"<{i}>", "payload": b"p" * i * 100_000}) for i in range(4)]
    (tmp_path / "a.warc").write_bytes(b"".join(plain))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, plain)))
    found = warc.read_warc(spark, str(tmp_path), payload="digest").collect()
    assert sorted(r["payload_length"] for r in found) == [0, 0, 100_000, 100_000, 200_000, 200_000, 300_000, 300_000]
    assert warc.read_warc(spark, str(tmp_path), types=("response",)).count() == 0
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(plain[2])[:-20])
    with pytest.raises(Exception, match="ends within a record|cut"):
        warc.read_warc(spark, str(tmp_path)).collect()
    wrong = warc.record_bytes(row | {"record_id": "<x>", "payload": b"q", "payload_digest": "sha1:AAAA"})
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(wrong))
    with pytest.raises(Exception, match="does not match its digest"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_no_pages_and_rolled_files(spark):
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.page_records(pages(spark).limit(0)), path)
    assert read_back(spark, path).count() == 0
    records = warc.page_records(pages(spark)).coalesce(1).select(*warc.HEADERS, "payload")
    records.write.format("warc").mode("append").option("max_bytes", "300").save(path)
    assert len([f for f in os.listdir(path) if f.endswith(".gz")]) > 5
    assert read_back(spark, path).count() == pages(spark).count()
    records.write.format("warc").mode("overwrite").save(path)
    assert read_back(spark, path).count() == pages(spark).count()


def test_several_records_in_a_member(spark, tmp_path):
    row = dict.fromkeys([*warc.HEADERS, "payload"]) | {"record_type": "resource"}
    sizes = [0, 5, 300_000, 1, 70_000]
    plain = [warc.record_bytes(row | {"record_id": f"<{i}>", "payload": os.urandom(n)}) for i, n in enumerate(sizes)]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(b"".join(plain[:3])) + gzip.compress(b"".join(plain[3:])))
    (tmp_path / "b.warc.gz").write_bytes(warc.member(b"".join(plain), 4) + warc.member(plain[0], 4))
    for payload in ("full", "digest"):
        found = warc.read_warc(spark, str(tmp_path), payload=payload).collect()
        assert sorted(r["payload_length"] for r in found) == sorted(sizes * 2 + [0])
    none = warc.read_warc(spark, str(tmp_path), payload="none", ids=("<1>", "<4>")).collect()
    assert sorted(r["record_id"] for r in none) == ["<1>", "<1>", "<4>", "<4>"]
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(plain[1] + plain[2][:-1000]))
    with pytest.raises(Exception, match="cut"):
        warc.read_warc(spark, str(tmp_path)).collect()


def test_folders_names_and_headers_of_others(spark, tmp_path):
    row = dict.fromkeys([*warc.HEADERS, "payload"]) | {"record_type": "resource", "payload": b"p"}
    one = [warc.member(warc.record_bytes(row | {"record_id": f"<{i}>", "target_uri": f"http://{'ab'[i % 2]}.org/{i}", "date": f"202{i}-01-01T00:00:00Z"}), 4) for i in range(5)]
    (tmp_path / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "A.WARC.GZ").write_bytes(one[0])
    (tmp_path / "sub" / "b.warc.gz").write_bytes(one[1] + one[2])
    (tmp_path / "sub" / "deep" / "c.Warc").write_bytes(gzip.decompress(one[3]))
    (tmp_path / "_hidden" / "d.warc.gz").write_bytes(one[4])
    (tmp_path / ".e.crc").write_bytes(b"")

    def ids(**options):
        return sorted(r["record_id"] for r in warc.read_warc(spark, str(tmp_path), **options).collect())

    assert ids() == ["<0>", "<1>", "<2>", "<3>"]
    assert ids(uri_prefix="http://a.") == ["<0>", "<2>"]
    assert ids(date_prefix="2021-", payload="none") == ["<1>"]
    assert ids(uri_prefix="http://a.", date_prefix="2020") == ["<0>"]
    assert warc.read_warc(spark, str(tmp_path / "A.WARC.GZ")).count() == 1
    latin = warc.record_bytes(row | {"record_id": "<x>", "target_uri": "http://a.org/?"}).replace(b"?", "é".encode("latin-1"))
    (tmp_path / "sub" / "l.warc").write_bytes(latin)
    assert "http://a.org/é" in [r["target_uri"] for r in warc.read_warc(spark, str(tmp_path)).collect()]
    (tmp_path / "sub" / "notes.txt").write_bytes(b"x")
    with pytest.raises(Exception, match="notes.txt is no archive"):
        ids()
