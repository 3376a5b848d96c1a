"""Media columns (op 1): content-addressed payloads in tar shards of the shared folder.

A payload becomes a grey 8-bit PNG, 576 samples wide, so no sample is lost. Each task of ``store`` writes one tar
shard whose members are named by the sha256 of their bytes, equal payloads of a task once; rows carry digest,
shard, offset and length. ``headers`` fills metadata columns from range reads of the first bytes alone, and
``payloads`` reads whole members back. Nothing is shuffled: rows stay with the task that wrote their shard, in the
order of their offsets. A copied payload is stored at most once a task, however many rows carry it.

A task writes under a name of its own attempt, and rows name the shard of the attempt that Spark kept, so that
lost executors and repeated tasks do no harm; shards of attempts that were lost are left over, unread.
"""

from __future__ import annotations

import hashlib
import io
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklode.llm.common import Scratch, scratch_path, small_batches

WIDTH = 576
PAD = b"\xff"
#: Bytes of a PNG up to the end of its header chunk.
HEADER = 33
SIGNATURE = b"\x89PNG\r\n\x1a\n"
INDEX = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"


def pad(data: bytes) -> bytes:
    """Appends bytes 255 up to a positive multiple of 576."""
    return data + PAD * (WIDTH * max(1, -(-len(data) // WIDTH)) - len(data))


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def to_png(payload: bytes) -> bytes:
    rows = len(payload) // WIDTH
    lines = np.zeros((rows, WIDTH + 1), np.uint8)  # each line begins with filter 0
    lines[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, WIDTH)
    head = struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)
    return SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), 1)) + _chunk(b"IEND", b"")


def png_header(head: bytes) -> tuple[int, int, int, int]:
    """Width, height, bit depth and colour type from the first 33 bytes; raises if they are no PNG's."""
    if head[:8] != SIGNATURE or head[12:16] != b"IHDR" or zlib.crc32(head[12:29]) != int.from_bytes(head[29:33], "big"):
        raise ValueError("no PNG header")
    return struct.unpack(">IIBB", head[16:26])


def from_png(data: bytes) -> bytes:
    """The samples of a PNG that ``to_png`` wrote."""
    width, height, _, _ = png_header(data[:HEADER])
    at, packed = 8, []
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        if data[at + 4 : at + 8] == b"IDAT":
            packed.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    return lines[:, 1:].tobytes()


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri else (fs.LocalFileSystem(), uri)


def store(docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes every text's payload to tar shards and returns the index: ``doc_id, n_bytes, digest, shard, offset, length``.

    Null texts count as empty, and an empty text has one line of padding. Repeated rows share a member.
    """
    base = scratch_path(scratch.spark, "shards")
    small_batches(scratch.spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, system, out, at = f"{base}/{uuid.uuid4().hex}.tar", None, None, 0
        found: dict[bytes, tuple[str, int, int]] = {}
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or b""
                key = hashlib.sha256(text).digest()
                if key not in found:
                    if out is None:
                        system, path = _open(base)
                        system.create_dir(path, recursive=True)
                        out = system.open_output_stream(_open(name)[1])
                    data = to_png(pad(text))
                    digest = hashlib.sha256(data).hexdigest()
                    info = tarfile.TarInfo(f"{digest}.png")
                    info.size = len(data)
                    head = info.tobuf(tarfile.USTAR_FORMAT)
                    out.write(head + data + b"\0" * (-len(data) % 512))
                    found[key] = (digest, at + len(head), len(data))
                    at += len(head) + len(data) + -len(data) % 512
                digest, offset, length = found[key]
                rows.append((i, len(text), digest, name, offset, length))
            cols = list(zip(*rows)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()))], names=["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        if out is not None:
            out.write(b"\0" * 1024)
            out.close()

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return scratch.write(picked.mapInArrow(write, INDEX), "media-index")


class Reader:
    """Range reads of members, one shard open at a time; keeps the last member's result for rows that share it."""

    def __init__(self, make):
        self.make, self.name, self.file, self.at, self.last = make, None, None, None, None

    def get(self, shard: str, offset: int, length: int):
        if shard != self.name:
            if self.file is not None:
                self.file.close()
            system, path = _open(shard)
            self.name, self.file, self.at = shard, system.open_input_file(path), None
        if self.at != (offset, length):
            self.at, self.last = (offset, length), self.make(self.file.read_at(length, offset))
        return self.last


def _columns(index: DataFrame, schema: str, take, make) -> DataFrame:
    """The index with columns of ``make(bytes)``; ``take`` gives the range to read of a member's offset and length."""
    kept = index.columns
    extra = [p.split()[0] for p in schema.split(",")]
    full = ", ".join([*(f"`{n}` {t}" for n, t in index.dtypes), schema])
    target = index.sparkSession.createDataFrame([], full).schema

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        reader, arrow = Reader(make), to_arrow_schema(target)
        for batch in batches:
            spans = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("shard", "offset", "length"))))
            got: dict[int, tuple] = {}
            for k in sorted(range(len(spans)), key=spans.__getitem__):
                got[k] = reader.get(spans[k][0], *take(*spans[k][1:]))
            cols = list(zip(*(got[k] for k in range(len(spans))))) or [()] * len(extra)
            new = [pa.array(c, arrow.field(len(kept) + n).type) for n, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], schema=pa.schema([*batch.schema, *(arrow.field(len(kept) + n) for n in range(len(new)))]))

    return index.mapInArrow(read, full)


def headers(index: DataFrame) -> DataFrame:
    """Adds ``width, height, bit_depth, color_type`` from reads of 33 bytes a member."""
    return _columns(index, "width int, height int, bit_depth int, color_type int", lambda offset, length: (offset, min(HEADER, length)), png_header)


def describe(data: bytes) -> tuple:
    """Payload figures of a stored form, and a feature: shares of 16 grey levels, each in 1/255, as hex."""
    payload = from_png(data)
    bins = np.bincount(np.frombuffer(payload, np.uint8) >> 4, minlength=16)
    feature = bytes((bins * 255 // len(payload)).tolist()).hex()
    return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(data), hashlib.sha256(data).hexdigest(), feature


def payloads(index: DataFrame) -> DataFrame:
    """Adds figures of the payload that is read back whole, and of its stored form."""
    schema = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return _columns(index, schema, lambda offset, length: (offset, length), describe)


def read_payloads(index: DataFrame) -> DataFrame:
    """Adds ``payload binary``, the samples read back, padding included."""
    return _columns(index, "payload binary", lambda offset, length: (offset, length), lambda data: (from_png(data),))


def members(shard: str) -> list[str]:
    """Names in one shard, as any tar reader sees them."""
    system, path = _open(shard)
    with system.open_input_file(path) as f:
        return tarfile.open(fileobj=io.BytesIO(f.read())).getnames()
