import hashlib
import tarfile
import zlib

import pytest

from tracklode.llm import media
from tracklode.llm.common import Scratch


def docs(spark):
    data = [(1, "abc"), (2, None), (3, ""), (None, "abc"), (4, "é" * 5000), (5, "x" * 576), (5, "x" * 576)]
    return spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "'a' as shard", "9 as width")


def test_png_round_trip():
    for data in (b"", b"a", bytes(range(256)) * 9, b"\xff" * 576):
        payload = media.pad(data)
        assert len(payload) % 576 == 0 and payload.startswith(data) and set(payload[len(data) :]) <= {255}
        png = media.to_png(payload)
        assert media.png_header(png[:33]) == (576, len(payload) // 576, 8, 0)
        assert media.from_png(png) == payload


def test_bad_header_raises():
    with pytest.raises(ValueError):
        media.png_header(b"\0" * 33)


def test_store_headers_and_payloads(spark):
    index = media.store(docs(spark), Scratch(spark))
    got = media.payloads(media.headers(index)).collect()
    source = docs(spark).collect()
    assert len(got) == len(source)
    by_id = {}
    for r in source:
        by_id.setdefault(r.doc_id, (r.text or "").encode())
    for r in got:
        text = by_id[r.doc_id]
        payload = media.pad(text)
        assert r.n_bytes == len(text) and r.payload_bytes == len(payload) == r.width * r.height
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-32:])
        assert r.media_sha256 == r.digest and r.media_bytes == r.length
    one = {(r.payload_sha256, r.media_sha256, r.feature, r.media_bytes) for r in got}
    assert len(one) == len(set(map(media.pad, by_id.values())))
    raw = {bytes(r.payload) for r in media.read_payloads(index).collect()}
    assert raw == set(map(media.pad, by_id.values()))


def test_shards_are_tar_files_named_by_content(spark):
    index = media.store(docs(spark).coalesce(1), Scratch(spark)).collect()
    shards = {r.shard for r in index}
    assert len(shards) == 1
    path = shards.pop().removeprefix("file://")
    with tarfile.open(path) as tar:
        names = tar.getnames()
        assert len(names) == len(set(names)) == 4  # copies share a member
        for m in tar.getmembers():
            assert m.name == hashlib.sha256(tar.extractfile(m).read()).hexdigest() + ".png"
    assert media.members(path) == names


def test_headers_read_no_more_than_the_header(spark, monkeypatch):
    read = []
    reader = media.Reader(lambda data: (len(data),))

    class File:
        def read_at(self, n, at):
            read.append((n, at))
            return b"\0" * n

    reader.name, reader.file = "s", File()
    assert reader.get("s", 512, 33) == (33,) and reader.get("s", 512, 33) == (33,) and read == [(33, 512)]


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert media.payloads(media.headers(media.store(none, Scratch(spark)))).count() == 0
