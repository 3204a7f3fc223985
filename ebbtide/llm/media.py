"""Media columns: Matroska files in a binary column, and the packets in them.

``mux`` stores bytes losslessly as 8-bit PCM audio in a Matroska file; ``parse`` reads any
Matroska file: variable-length element ids and sizes, unknown sizes, clusters, SimpleBlocks
and BlockGroups, all four kinds of lacing, and cues.  ``packet_table`` has one row a packet
with its track, timestamp and byte range; ``payload`` puts the bytes of one track together
again from those ranges.

Every row is handled alone, in Arrow batches: no shuffle, and memory is bounded by a batch
plus one file.

Edge cases: null is the empty payload, which still gets one unit of 64 zero bytes; equal
payloads give equal files (no dates, no random ids); a broken file gives the packets before
the break and ``broken`` = true, and elements may be nested to any depth; extra columns pass
through ``with_media``, ``packet_table`` and ``with_features``, where columns named as their
outputs are replaced; very long texts are muxed and read whole; repeated rows give equal files.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm.common import table

# Fixed values of the Matroska format (element ids, with their length markers).
EBML, SEGMENT, CUES, CLUSTER = 0x1A45DFA3, 0x18538067, 0x1C53BB6B, 0x1F43B675
INFO, TIMESTAMP_SCALE, TRACKS, TRACK_ENTRY = 0x1549A966, 0x2AD7B1, 0x1654AE6B, 0xAE
TRACK_NUMBER, TRACK_UID, TRACK_TYPE, CODEC_ID, AUDIO = 0xD7, 0x73C5, 0x83, 0x86, 0xE1
SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH, DEFAULT_DURATION = 0xB5, 0x9F, 0x6264, 0x23E383
CLUSTER_TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, REFERENCE = 0xE7, 0xA3, 0xA0, 0xA1, 0xFB
CUE_POINT, CUE_TIME, CUE_POSITIONS, CUE_TRACK, CUE_CLUSTER = 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
MASTERS = {SEGMENT, CLUSTER, BLOCK_GROUP, TRACKS, TRACK_ENTRY, AUDIO, INFO, CUES, CUE_POINT, CUE_POSITIONS}
TOP = {SEGMENT, CLUSTER, CUES, TRACKS, INFO}

UNIT = 64
RATE = 8000
FRAME = 512  # bytes, and samples: 64 ms
FRAMES_PER_BLOCK = 8
BLOCKS_PER_CLUSTER = 48


class Packet(NamedTuple):
    track: int
    cluster: int
    block: int
    lace: int
    timestamp: int  # in ticks of the file's timestamp scale
    start: int
    size: int
    key: bool


class Media(NamedTuple):
    packets: list[Packet]
    tracks: dict[int, dict[str, object]]
    cues: list[tuple[int, int, int]]  # time, track, byte position of the cluster
    scale: int
    broken: bool


def _size(n: int) -> bytes:
    length = 1
    while n >= (1 << (7 * length)) - 1:
        length += 1
    return ((1 << (7 * length)) | n).to_bytes(length, "big")


def _element(ident: int, body: bytes) -> bytes:
    return ident.to_bytes((ident.bit_length() + 7) // 8, "big") + _size(len(body)) + body


def _uint(ident: int, n: int) -> bytes:
    return _element(ident, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _block(relative: int, frames: list[bytes]) -> bytes:
    """A SimpleBlock of track 1: fixed-size lacing for equal frames, EBML lacing for others."""
    if len(frames) == 1:
        return _element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hB", relative, 0x80) + frames[0])
    if len({len(f) for f in frames}) == 1:
        head, sizes = 0x84, b""
    else:
        head, sizes = 0x86, _size(len(frames[0]))
        for a, b in zip(frames, frames[1:-1], strict=False):
            step, length = len(b) - len(a), 1
            while not -(1 << (7 * length - 1)) < step < (1 << (7 * length - 1)):
                length += 1
            sizes += ((1 << (7 * length)) | (step + (1 << (7 * length - 1)) - 1)).to_bytes(length, "big")
    return _element(SIMPLE_BLOCK, b"\x81" + struct.pack(">hBB", relative, head, len(frames) - 1) + sizes + b"".join(frames))


_HEAD = _element(EBML, _uint(0x4286, 1) + _uint(0x42F7, 1) + _uint(0x42F2, 4) + _uint(0x42F3, 8) + _element(0x4282, b"matroska") + _uint(0x4287, 4) + _uint(0x4285, 2))
_FIRST = _element(INFO, _uint(TIMESTAMP_SCALE, 1_000_000) + _element(0x4D80, b"ebbtide") + _element(0x5741, b"ebbtide")) + _element(
    TRACKS,
    _element(
        TRACK_ENTRY,
        _uint(TRACK_NUMBER, 1)
        + _uint(TRACK_UID, 1)
        + _uint(TRACK_TYPE, 2)
        + _uint(DEFAULT_DURATION, FRAME * 1_000_000_000 // RATE)
        + _element(CODEC_ID, b"A_PCM/INT/LIT")
        + _element(AUDIO, _element(SAMPLING_FREQUENCY, struct.pack(">f", RATE)) + _uint(CHANNELS, 1) + _uint(BIT_DEPTH, 8)),
    ),
)


def padded(data: bytes) -> bytes:
    """The bytes, with zeros up to a positive multiple of the unit."""
    return data + bytes(-len(data) % UNIT or (0 if data else UNIT))


def mux(data: bytes) -> bytes:
    """A Matroska file with the bytes as unsigned 8-bit samples of one audio track."""
    body, cues = [_FIRST], b""
    at = len(_FIRST)
    per_block = FRAME * FRAMES_PER_BLOCK
    per_cluster = per_block * BLOCKS_PER_CLUSTER
    ticks = lambda offset: offset * 1000 // RATE
    for c in range(0, max(len(data), 1), per_cluster):
        parts = [_uint(CLUSTER_TIMESTAMP, ticks(c))]
        for b in range(c, min(c + per_cluster, len(data)), per_block):
            chunk = data[b : b + per_block]
            parts.append(_block(ticks(b) - ticks(c), [chunk[i : i + FRAME] for i in range(0, len(chunk), FRAME)]))
        cues += _element(CUE_POINT, _uint(CUE_TIME, ticks(c)) + _element(CUE_POSITIONS, _uint(CUE_TRACK, 1) + _uint(CUE_CLUSTER, at)))
        body.append(_element(CLUSTER, b"".join(parts)))
        at += len(body[-1])
    return _HEAD + _element(SEGMENT, b"".join(body) + _element(CUES, cues))


class _Broken(ValueError):
    pass


def _vint(data: bytes, at: int, keep_marker: bool) -> tuple[int, int, bool]:
    """(value, next position, whether all value bits are one)."""
    if at >= len(data) or not data[at]:
        raise _Broken
    length = 9 - data[at].bit_length()
    if at + length > len(data):
        raise _Broken
    raw = int.from_bytes(data[at : at + length], "big")
    ones = (1 << (7 * length)) - 1
    return (raw if keep_marker else raw & ones), at + length, raw & ones == ones


def _lacing(data: bytes, at: int, end: int, kind: int) -> tuple[list[int], int]:
    """Sizes of the frames of a block, and where the first begins."""
    if kind == 0:
        return [end - at], at
    if at >= end:
        raise _Broken
    count, at = data[at] + 1, at + 1
    if kind == 2:  # all of one size
        if (end - at) % count:
            raise _Broken
        return [(end - at) // count] * count, at
    sizes: list[int] = []
    for i in range(count - 1):
        if kind == 1:  # Xiph: bytes of 255 and a last smaller one
            n = 0
            while True:
                if at >= end:
                    raise _Broken
                n, at = n + data[at], at + 1
                if data[at - 1] != 255:
                    break
        else:  # EBML: the first size, then signed differences
            n, after, _ = _vint(data, at, False)
            if i:
                n = sizes[-1] + n - ((1 << (7 * (after - at) - 1)) - 1)
            at = after
        sizes.append(n)
    last = end - at - sum(sizes)
    if last < 0 or min(sizes, default=0) < 0:
        raise _Broken
    return [*sizes, last], at


def parse(data: bytes) -> Media:
    """The tracks, cues and packets of a Matroska file."""
    packets: list[Packet] = []
    tracks: dict[int, dict[str, object]] = {}
    cues: list[tuple[int, int, int]] = []
    state = {"scale": 1_000_000, "segment": 0, "cluster": -1, "time": 0, "block": 0}

    def block(at: int, end: int, simple: bool, key: bool) -> None:
        track, at, _ = _vint(data, at, False)
        if at + 3 > end:
            raise _Broken
        relative, flags = struct.unpack_from(">hB", data, at)
        sizes, at = _lacing(data, at + 3, end, flags >> 1 & 3)
        step = int(tracks.get(track, {}).get("frame_ns", 0) or 0)
        for i, n in enumerate(sizes):
            time = state["time"] + relative + i * step // state["scale"]
            packets.append(Packet(track, state["cluster"], state["block"], i, time, at, n, bool(flags & 0x80) if simple else key))
            at += n
        state["block"] += 1

    def opened(ident: int, at: int, end: int, unknown: bool, parent: dict[str, object]) -> tuple:
        """A master element on the stack: what it is, where it ends, whether its size is unknown, its values."""
        if ident == SEGMENT:
            state["segment"] = at
        elif ident == CLUSTER:
            state["cluster"] += 1
            state["time"] = 0
        return ident, end, unknown, {} if ident in (TRACK_ENTRY, CUE_POINT, BLOCK_GROUP) else parent

    def closed(ident: int, own: dict[str, object]) -> None:
        if ident == TRACK_ENTRY and "number" in own:
            tracks[own["number"]] = own
        elif ident == CUE_POINT:
            cues.append((own.get("time", 0), own.get("track", 0), state["segment"] + own.get("position", 0)))
        elif ident == BLOCK_GROUP and "block" in own:
            block(*own["block"], False, "reference" not in own)

    def value(ident: int, at: int, stop: int, parent: dict[str, object]) -> None:
        number = lambda: int.from_bytes(data[at:stop], "big")
        if ident == SIMPLE_BLOCK:
            block(at, stop, True, False)
        elif ident == BLOCK:
            parent["block"] = (at, stop)
        elif ident == CLUSTER_TIMESTAMP:
            state["time"] = number()
        elif ident == TIMESTAMP_SCALE:
            state["scale"] = number() or 1_000_000
        elif ident == SAMPLING_FREQUENCY:
            parent["rate"] = struct.unpack(">f" if stop - at == 4 else ">d", data[at:stop])[0]
        elif ident == CODEC_ID:
            parent["codec"] = data[at:stop].decode("latin-1")
        elif name := _NUMBERS.get(ident):
            parent[name] = number()

    def walk() -> None:
        """Elements in order; those that hold others wait on a stack, so any depth is read."""
        at, stack = 0, [(0, len(data), False, {})]
        while stack:
            inside, end, unknown, own = stack[-1]
            if at >= end:
                stack.pop()
                closed(inside, own)
                continue
            begin = at
            ident, at, _ = _vint(data, at, True)
            if inside == CLUSTER and ident in TOP:  # a cluster of unknown size ends where the next top element begins
                stack.pop()
                at = begin if unknown else end
                continue
            n, at, boundless = _vint(data, at, False)
            stop = end if boundless else at + n
            if stop > end and ident not in MASTERS:
                raise _Broken
            stop = min(stop, end)
            if ident in MASTERS:
                stack.append(opened(ident, at, stop, boundless, own))
            else:
                value(ident, at, stop, own)
                at = stop

    broken = False
    try:
        walk()
    except (_Broken, struct.error):
        broken = True
    return Media(packets, tracks, cues, state["scale"], broken)


_NUMBERS = {
    TRACK_NUMBER: "number", TRACK_TYPE: "type", CHANNELS: "channels", BIT_DEPTH: "bits", DEFAULT_DURATION: "frame_ns",
    CUE_TIME: "time", CUE_TRACK: "track", CUE_CLUSTER: "position", REFERENCE: "reference",
}


def payload(data: bytes, media: Media, track: int = 1) -> bytes:
    """The bytes of one track, put together from the byte ranges of its packets."""
    return b"".join(data[p.start : p.start + p.size] for p in media.packets if p.track == track)


def feature(samples: bytes) -> str:
    """Mean, mean square about the mid level, zero crossings and peak of 8-bit samples."""
    x = np.frombuffer(samples, np.uint8).astype(np.int64) - 128
    if not len(x):
        return "0.000000|0.000000|0|0"
    crossings = int(np.count_nonzero((x[1:] >= 0) != (x[:-1] >= 0)))
    return f"{x.sum() / len(x):.6f}|{(x * x).sum() / len(x):.6f}|{crossings}|{int(np.abs(x).max())}"


def with_media(df: DataFrame, column: str = "text", media: str = "media", n_bytes: str = "n_bytes") -> DataFrame:
    """Replace a text or binary column by its Matroska file and the length before padding."""
    kept = [c for c in df.columns if c not in (column, n_bytes, media)]
    schema = df.select(*kept).schema.add(n_bytes, "long").add(media, "binary")
    df = df.select(*kept, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                raw = [v if isinstance(v, bytes) else (v or "").encode() for v in part.column(column).to_pylist()]
                columns = [part.column(c) for c in kept] + [pa.array([len(v) for v in raw], pa.int64()), pa.array([mux(padded(v)) for v in raw], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, n_bytes, media])

    return df.mapInArrow(run, schema)


def packet_table(df: DataFrame, media: str = "media") -> DataFrame:
    """One row a packet: the other columns, then track, codec, cluster, block, lace, time in ns,
    byte range, key flag, and whether the file has a cue to the packet's cluster time."""
    own = "track long, codec string, cluster long, block long, lace long, time_ns long, byte_start long, byte_size long, key_frame boolean, cued boolean"
    names = [x.split()[0] for x in own.split(", ")]
    kept = [c for c in df.columns if c not in (media, *names)]
    schema = df.select(*kept).schema
    df = df.select(*kept, media)
    for x in own.split(", "):
        schema = schema.add(*x.split())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in enumerate(batch.column(media)):
                data = raw.as_py() or b""
                m = parse(data)
                cued = {(t, k) for t, k, _ in m.cues}
                rows = [(p.track, m.tracks.get(p.track, {}).get("codec"), p.cluster, p.block, p.lace, p.timestamp * m.scale, p.start, p.size, p.key, (p.timestamp, p.track) in cued) for p in m.packets]
                if rows:
                    repeat = pa.array([i] * len(rows), pa.int64())
                    columns = [batch.column(c).take(repeat) for c in kept]
                    types = [pa.int64(), pa.string(), *[pa.int64()] * 6, pa.bool_(), pa.bool_()]
                    columns += [pa.array(list(v), t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return df.mapInArrow(run, schema)


def with_features(df: DataFrame, media: str = "media") -> DataFrame:
    """Replace the media column by digests of the payload read back from it, and its features."""
    own = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, n_packets long, n_cues long, duration_ms long, feature string"
    names = [x.split()[0] for x in own.split(", ")]
    kept = [c for c in df.columns if c not in (media, *names)]
    schema = df.select(*kept).schema
    df = df.select(*kept, media)
    for x in own.split(", "):
        schema = schema.add(*x.split())
    types = [pa.string() if x.endswith("string") else pa.int64() for x in own.split(", ")]

    def one(data: bytes) -> tuple:
        m = parse(data)
        back = payload(data, m)
        rate = m.tracks.get(1, {}).get("rate") or RATE
        return (
            len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-UNIT:]), len(data), hashlib.sha256(data).hexdigest(),
            len(m.packets), len(m.cues), int(len(back) * 1000 // rate), feature(back),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(v.as_py() or b"") for v in batch.column(media)]
            if rows:
                columns = [batch.column(c) for c in kept] + [pa.array(list(v), t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *names])

    return df.mapInArrow(run, schema)


def op5_matroska(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_features(with_media(docs))


QUERIES = {"op5_matroska": op5_matroska}
ORACLE_SQL: dict[str, str] = {}
