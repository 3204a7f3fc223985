"""Round trips: Matroska files and web archives."""

import base64
import hashlib
import struct
import zlib

import pytest

from ebbtide.llm import media, warc


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 511, 512, 513, 4096, 4097, 5000, 300_000])
def test_matroska_round_trip(n):
    data = media.padded(bytes(i * 7 % 256 for i in range(n)))
    assert len(data) % 64 == 0 and len(data) >= max(n, 64)
    m = media.parse(media.mux(data))
    assert media.payload(media.mux(data), m) == data
    assert not m.broken and m.tracks[1]["codec"] == "A_PCM/INT/LIT" and m.cues[0][0] == 0
    times = [p.timestamp for p in m.packets]
    assert times == sorted(times)


def test_cues_point_at_clusters():
    data = media.mux(bytes(64 * 40_000))
    m = media.parse(data)
    assert len(m.cues) > 5
    for _, _, at in m.cues:
        assert data[at : at + 4] == media.CLUSTER.to_bytes(4, "big")


def _file(block: bytes, unknown: bool = False) -> bytes:
    body = media._uint(media.CLUSTER_TIMESTAMP, 5) + media._element(media.BLOCK_GROUP, media._element(media.BLOCK, block))
    size = b"\xff" if unknown else media._size(len(body))
    cluster = media.CLUSTER.to_bytes(4, "big") + size + body
    return media._HEAD + media.SEGMENT.to_bytes(4, "big") + (b"\xff" if unknown else media._size(len(cluster))) + cluster


@pytest.mark.parametrize("unknown", [False, True])
def test_lacing_kinds(unknown):
    head = b"\x81" + struct.pack(">h", 3)
    xiph = head + b"\x02" + b"\x02" + b"\xff\x01" + b"\x03" + bytes(256) + b"abc" + b"tail"
    assert [(p.size, p.timestamp) for p in media.parse(_file(xiph, unknown)).packets] == [(256, 8), (3, 8), (4, 8)]
    fixed = head + b"\x04" + b"\x01" + b"aabb"
    assert [p.size for p in media.parse(_file(fixed, unknown)).packets] == [2, 2]
    ebml = head + b"\x06" + b"\x02" + b"\x85" + b"\xbd" + b"aaaaa" + b"bbb" + b"cc"
    assert [p.size for p in media.parse(_file(ebml, unknown)).packets] == [5, 3, 2]


def test_broken_files():
    whole = media.mux(bytes(range(256)) * 40)
    for cut in (0, 3, 40, len(whole) // 2):
        m = media.parse(whole[:cut])
        assert m.broken or not m.packets or cut
    assert media.parse(b"\x00garbage").broken
    assert media.parse(bytes([0xA0, 0xFF]) * 20_000).packets == []  # nested groups of unknown size
    assert media.parse(whole + media._element(media.CLUSTER, b"\xff")).broken


def test_clashing_names_are_replaced(spark):
    df = spark.createDataFrame([(1, "x" * 70_000, "f", 5, "kept")], "doc_id long, text string, feature string, track long, block_ string")
    made = media.with_features(media.with_media(df.withColumn("media", df.text)))
    assert made.columns[:3] == ["doc_id", "track", "block_"] and made.columns.count("feature") == 1
    row = made.first()
    assert row.feature != "f" and row.payload_sha256 == hashlib.sha256(media.padded(b"x" * 70_000)).hexdigest()
    packets = media.packet_table(media.with_media(df))
    assert packets.columns.count("track") == 1 and packets.count() == 137 and packets.first().block_ == "kept"


def test_op5_query(spark, tmp_path):
    texts = ["añb", None, "", "y" * 5000, "añb"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = media.op5_matroska(spark, str(tmp_path)).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        data = media.padded((t or "").encode())
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len((t or "").encode()), len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(media.mux(data)), hashlib.sha256(media.mux(data)).hexdigest())


def test_media_columns(spark):
    df = spark.createDataFrame([(1, "añb", "x"), (2, None, "y"), (3, "", "y"), (1, "añb", "x")], "doc_id long, text string, n_cues string")
    with_media = media.with_media(df.select("doc_id", "text"))
    rows = media.with_features(with_media).collect()
    assert [(r.doc_id, r.n_bytes, r.payload_bytes) for r in rows] == [(1, 4, 64), (2, 0, 64), (3, 0, 64), (1, 4, 64)]
    assert rows[0].payload_sha256 == hashlib.sha256("añb".encode() + bytes(60)).hexdigest()
    packets = media.packet_table(with_media).collect()
    assert len(packets) == 4 and packets[0].codec == "A_PCM/INT/LIT" and packets[0].cued
    assert media.with_features(media.with_media(df.limit(0).select("doc_id", "text"))).count() == 0


PAGES = [
    (1, "http://a/1", "<p>é</p>" * 50), (2, "http://a/2", "<p>é</p>" * 50), (3, None, "x"), (None, "http://b", "<p>é</p>" * 50),
    (5, "http://b\r\nX: y", None), (6, "http://c", ""), (6, "http://c", ""),
]


def test_warc_round_trip(spark, tmp_path):
    warc.register(spark)
    path = f"file://{tmp_path}/a"
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.deduplicated(pages).write.format("warc").mode("append").option("roll_bytes", 300).save(path)
    rows = spark.read.format("warc").load(path).collect()
    assert len(rows) == len(PAGES)
    for r in rows:
        html = next(h for p, _, h in PAGES if p == r.page_id) or ""
        assert r.payload_digest == base64.b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert r.payload_length == len(html.encode())
        assert r.record_type == "revisit" or bytes(r.payload) == html.encode()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to_page) for r in rows)
    assert kinds == [(0, "response", None), (1, "revisit", 2), (2, "response", None), (3, "response", None), (5, "revisit", 6), (6, "response", None), (6, "response", None)]
    revisits = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit'")
    assert sorted(r.page_id for r in revisits.collect()) == [1, 5] and revisits.where("payload is not null").count() == 0
    assert spark.read.format("warc").load(path).where("target_uri = 'http://c'").count() == 2


def test_warc_reads_plain_and_foreign_files(tmp_path):
    import gzip

    import pyarrow as pa

    one = warc.record_bytes({"record_type": "response", "page_id": 1, "payload": b"a" * 5000})
    two = warc.record_bytes({"record_type": "request", "page_id": 2, "payload": b""})
    for name, data in (("plain", one + two), ("whole", gzip.compress(one) + gzip.compress(two)), ("skip", warc.gzip_member(one) + warc.gzip_member(two)), ("cut", one + two[:-40])):
        (tmp_path / name).write_bytes(data)
        with pa.OSFile(str(tmp_path / name)) as f:
            got = list(warc.records(warc._Window(f), lambda h: True, lambda h: True))
        assert [len(r.body) for r in got] == ([5000, 0] if name != "cut" else [5000]), name
        with pa.OSFile(str(tmp_path / name)) as f:
            got = list(warc.records(warc._Window(f), lambda h: h["warc-type"] == "request", lambda h: False))
        assert [r.headers["x-page-id"] for r in got] == (["2"] if name != "cut" else [])
    assert gzip.decompress(warc.gzip_member(one)) == one


def test_empty_archive(spark, tmp_path):
    warc.register(spark)
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.deduplicated(none).write.format("warc").mode("append").save(f"file://{tmp_path}/e")
    assert spark.read.format("warc").load(f"file://{tmp_path}/e").count() == 0
