import hashlib
import io

import pyarrow.fs
import zstandard
from pyspark.sql import functions as F

from tests.llm.cases import rows
from wardline.llm.warc import archive_pages, parse_records, read_archives, read_index, read_records, seek_table, write_archives
from wardline.session import scratch_path

BIG = "<p>" + "x" * 200 + "é</p>"
PAGES = [
    (1, "http://a.example/", "<html>one</html>"),
    (2, "http://b.example/", "<html>one</html>"),
    (9, "http://c.example/", BIG),
    (4, "http://d.example/", BIG),
    (4, "http://d.example/", BIG),
    (5, None, None),
    (6, "http://e.example/\r\nX-Bad: 1 %41", ""),
    (7, "http://f.example/", "é" * 50),
    (8, "http://g.example/", "é" * 50),
    (10, "http://h.example/", "a\r\n\r\nWARC/1.1\r\n\r\n" * 3000),
    (None, "http://i.example/", BIG),
    (None, "http://j.example/", "lone " * 100),
]


def pages(spark, rows=PAGES):
    clash = "payload digest refers_to path frame record_type"
    schema = "page_id long, url string, html string, " + ", ".join(f"`{c}` string" for c in clash.split())
    return spark.createDataFrame([(*r, *["x"] * 6) for r in rows], schema)


def expected():
    out = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "").encode() == payload and p is not None]
        revisit = len(payload) >= 100 and bool(same) and page_id != min(same)
        digest = hashlib.sha256(payload).hexdigest()
        out.append((page_id, len(payload), digest, "revisit" if revisit else "response", min(same) if revisit else None))
    return sorted(out, key=repr)


def test_what_is_read_back(spark):
    assert rows(archive_pages(pages(spark))) == expected()


def test_bundles_and_their_index(spark):
    index = write_archives(pages(spark).repartition(2), scratch_path(spark, "warc"), frame_bytes=500, bundle_bytes=5000)
    records = read_archives(index).collect()
    assert len(records) == index.count() == len(PAGES)
    found = read_records(index.where("page_id in (4, 7)")).collect()
    assert sorted((r["page_id"], r["payload"]) for r in found) == [(4, BIG.encode()), (4, BIG.encode()), (7, ("é" * 50).encode())]
    assert {r["url"] for r in records} == {url for _, url, _ in PAGES}
    by_payload = {r["payload"] for r in records if r["record_type"] == "response"}
    assert by_payload == {(html or "").encode() for _, _, html in PAGES}
    for path in {r["path"] for r in index.collect()}:
        system, at = pyarrow.fs.FileSystem.from_uri(path)
        with system.open_input_file(at) as file:
            frames = seek_table(file)
            whole = file.read_at(file.size(), 0)
        # Frames are independent, and a plain reader gets the same records from front to back.
        parts = [zstandard.ZstdDecompressor().decompress(whole[start : start + packed]) for start, packed, _ in frames]
        assert [len(p) for p in parts] == [raw for _, _, raw in frames]
        plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(whole), read_across_frames=True).read()
        assert plain == b"".join(parts)
        assert len(list(parse_records(plain))) == sum(1 for r in index.collect() if r["path"] == path)


def test_empty_table(spark):
    assert archive_pages(pages(spark, [])).collect() == []


def test_bundles_are_read_side_by_side(spark):
    many = pages(spark, [(n, f"http://x.example/{n}", f"{n} " * 40) for n in range(400)])
    index = write_archives(many, scratch_path(spark, "warc"), frame_bytes=500, bundle_bytes=1500)
    bundles = index.select("path").distinct().count()
    assert bundles > 60
    read = read_archives(index).groupBy(F.spark_partition_id().alias("task")).count().collect()
    # A bundle to a task, up to ranges that a sample of their names leaves uneven.
    assert len(read) > bundles / 2 and sum(r["count"] for r in read) == 400


def test_names_are_steady_and_the_index_is_kept(spark):
    folders = [scratch_path(spark, "warc") for _ in range(2)]
    names = []
    for folder in folders:
        index = write_archives(pages(spark), folder)
        again = read_index(spark, folder)
        assert rows(again) == rows(index) and again.count() == len(PAGES)
        names.append(sorted((r["page_id"] or 0, r["record_id"], r["record_type"]) for r in read_archives(again).collect()))
    assert names[0] == names[1]
    by_id = {}
    for page, name, kind in names[0]:
        by_id.setdefault(name, set()).add((page, kind))
    assert all(len(v) == 1 for v in by_id.values())

