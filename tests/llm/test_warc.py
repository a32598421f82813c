"""Archives: round trip, determinism, revisits, repeated commits."""

import gzip
import hashlib

import pytest
from oracle import compare

from ledgerspark.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, kind int"


def rows():
    big, other = "<p>" + "é" * 800, "x" * 1000
    return [(1, "http://a/ b", big, None, 1), (9, None, big, None, 2), (4, "http://c", big, "d", 3),
            (2, "u", "short", None, 0), (3, "u", "short", None, 0), (5, None, None, None, 0), (6, "", "", None, 0),
            (7, "u", other, None, 0), (7, "u", other, None, 0), (None, "u", other, None, 0), (None, None, None, None, 0),
            (8, "v", "\r\n\r\nWARC/1.1\r\n" * 40_000, None, 0), (10, "w", "y" * 999, None, 0), (11, "w", "y" * 999, None, 0)]


def write(spark, data, folder, parts=3, **options):
    archive = warc.Archive(str(folder), roll_bytes=600)
    return warc.write_archives(spark.createDataFrame(data, SCHEMA).repartition(parts), archive, **options), archive


def test_query_matches_sql(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op7_warc") is None


def test_round_trip_and_revisits(spark, tmp_path):
    manifest, archive = write(spark, rows(), tmp_path / "a", shard_bytes=2000)
    back = warc.read_archives(manifest, archive, payloads=True).collect()
    assert len(back) == len(rows())
    found = {r.page_id: r for r in back}
    revisits = {(r.page_id, r.refers_to) for r in back if r.record_type == "revisit"}
    assert revisits == {(1, 9), (4, 9), (None, 7)}
    for page_id, _, html, *_ in rows():
        payload = (html or "").encode()
        if page_id is not None:
            r = found[page_id]
            assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
            assert r.payload == (payload if r.record_type == "response" else b"")
    assert found[1].url == "http://a/%20b" and found[9].url == "about:blank"


def test_files_depend_on_the_rows_alone(spark, tmp_path):
    first, _ = write(spark, rows(), tmp_path / "a", parts=1, shard_bytes=2000)
    second, _ = write(spark, rows()[::-1], tmp_path / "b", parts=5, shard_bytes=2000)
    listed = ["name", "records", "bytes", "sha256"]
    assert sorted(map(tuple, first.select(listed).collect())) == sorted(map(tuple, second.select(listed).collect()))
    assert first.count() > 3
    for r in first.collect():
        data = (tmp_path / "a" / r.name).read_bytes()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (r.bytes, r.sha256)
    assert not (tmp_path / "a" / "_temporary").exists() and (tmp_path / "a" / "_COMMITTED").exists()


def test_commit_again_and_missing_file(spark, tmp_path):
    manifest, archive = write(spark, rows(), tmp_path / "a")
    warc.commit(manifest, archive)
    name = manifest.first()["name"]
    (tmp_path / "a" / name).write_bytes(b"cut")
    with pytest.raises(Exception, match="not complete"):
        warc.commit(manifest, archive)


def test_damage_is_found(spark, tmp_path):
    manifest, archive = write(spark, rows(), tmp_path / "a")
    for path in (tmp_path / "a").glob("*.gz"):
        path.write_bytes(gzip.compress(gzip.decompress(path.read_bytes()).replace(b"short", b"shore")))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(manifest, archive).collect()


def test_empty_table(spark, tmp_path):
    manifest, archive = write(spark, rows(), tmp_path / "a")
    empty = spark.createDataFrame([], SCHEMA)
    archive = warc.Archive(str(tmp_path / "none"))
    assert warc.read_archives(warc.write_archives(empty, archive), archive).collect() == []


def test_files_are_read_by_many_tasks(spark, tmp_path):
    data = [(i, "u", f"{i}-" + "".join(chr(97 + i * j % 26) for j in range(400)), None, 0) for i in range(60)]
    manifest, archive = write(spark, data, tmp_path / "a", shard_bytes=4000)
    assert manifest.count() > 8
    assert warc.spread(manifest.select("name", "bytes"), task_bytes=600).rdd.getNumPartitions() > 8
    back = warc.read_archives(manifest, archive)
    assert back.rdd.getNumPartitions() >= 4 and back.count() == 60
