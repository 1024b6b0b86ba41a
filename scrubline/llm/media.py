"""MPEG audio columns: frames, tags, variable-bitrate tables, checksums, seek offsets.

``encode`` stores bytes losslessly in the frames of a silent MPEG-1 Layer III
stream (the bytes behind the side information, which decoders skip), with an
ID3v2 tag, a table frame with a table of contents, and a checksum in every
frame.  ``read`` parses any MPEG-1/2/2.5 stream: it skips and parses tags, finds
frames by their headers (searching anew after damage), reads Xing, Info and
VBRI tables, verifies checksums, and gives exact durations and frame offsets.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scrubline.llm.base import slices, table, with_fields

# Fixed values of the format: kbit/s by bitrate index, Hz by rate index.
_V1 = {
    1: (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    2: (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    3: (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
}
_V2 = {
    1: (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    2: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    3: (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
_RATES = {1.0: (44100, 48000, 32000), 2.0: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
_VERSIONS = {0: 2.5, 2: 2.0, 3: 1.0}

_RATE, _SIDE, _SAMPLES = 48000, 17, 1152  # of the streams that encode() writes: mono, 48 kHz
_HEAD = 4 + 2 + _SIDE
_OWNER = b"scrubline/payload\0"


def _crc_table() -> list[int]:
    out = []
    for i in range(256):
        x = i << 8
        for _ in range(8):
            x = (x << 1 ^ 0x8005 if x & 0x8000 else x << 1) & 0xFFFF
        out.append(x)
    return out


_CRC = _crc_table()


@lru_cache(4096)
def crc16(data: bytes) -> int:
    """The format's checksum; streams repeat few headers, so results are kept."""
    x = 0xFFFF
    for b in data:
        x = (x << 8 & 0xFF00) ^ _CRC[x >> 8 ^ b]
    return x


@lru_cache(4096)
def header(word: bytes) -> tuple | None:
    """(bytes, samples, Hz, kbit/s, layer, checked, side information bytes) of a 4-byte frame header."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = _VERSIONS.get(word[1] >> 3 & 3), 4 - (word[1] >> 1 & 3)
    rate_index, bit_index = word[2] >> 2 & 3, word[2] >> 4
    if version is None or layer == 4 or rate_index == 3 or bit_index in (0, 15):
        return None  # reserved values, and free format, whose length the header lacks
    kbps, hz, pad = (_V1 if version == 1 else _V2)[layer][bit_index], _RATES[version][rate_index], word[2] >> 1 & 1
    samples = 384 if layer == 1 else 1152 if layer == 2 or version == 1 else 576
    size = (12000 * kbps // hz + pad) * 4 if layer == 1 else samples // 8 * 1000 * kbps // hz + pad
    mono = word[3] >> 6 == 3
    side = (17 if mono else 32) if version == 1 else (9 if mono else 17)
    return size, samples, hz, kbps, layer, not word[1] & 1, side if layer == 3 else 0


@lru_cache(64)
def _frame_head(kbps: int) -> bytes:
    """Header, checksum and empty side information of a frame that encode() writes."""
    head = bytes([0xFF, 0xFA, _V1[3].index(kbps) << 4 | 1 << 2, 3 << 6])
    return head + struct.pack(">H", crc16(head[2:4] + bytes(_SIDE))) + bytes(_SIDE)


def _synchsafe(n: int) -> bytes:
    return bytes(n >> s & 0x7F for s in (21, 14, 7, 0))


def encode(payload: bytes) -> bytes:
    """A stream that holds payload."""
    room = 3 * 320 - _HEAD
    full, rest = divmod(len(payload), room)
    last = next(k for k in _V1[3][1:] if 3 * k - _HEAD >= rest) if rest else 0
    body = np.zeros((full, 3 * 320), np.uint8)
    body[:, :_HEAD] = np.frombuffer(_frame_head(320), np.uint8)
    body[:, _HEAD:] = np.frombuffer(payload, np.uint8, full * room).reshape(full, room)
    frames = body.tobytes()
    if rest:
        frames += (_frame_head(last) + payload[full * room :]).ljust(3 * last, b"\0")
    n = full + bool(rest)
    total = 3 * 96 + len(frames)
    toc = bytes(min(255, 256 * (3 * 96 + (i * n // 100) * 3 * 320) // total) for i in range(100))
    table_frame = (_frame_head(96) + b"Xing" + struct.pack(">III", 7, n, total) + toc).ljust(3 * 96, b"\0")
    private = _OWNER + struct.pack(">Q", len(payload))
    tag = b"PRIV" + struct.pack(">IH", len(private), 0) + private
    return b"ID3\x03\x00\x00" + _synchsafe(len(tag)) + tag + table_frame + frames


def _tags(data: bytes) -> tuple[int, int, dict[str, list[bytes]]]:
    """Start and end of the frames' area, and the tags' frames by name."""
    at, end, found = 0, len(data), {}
    while data[at : at + 3] == b"ID3" and at + 10 <= end:
        size = sum((b & 0x7F) << s for b, s in zip(data[at + 6 : at + 10], (21, 14, 7, 0), strict=True))
        major, p, stop = data[at + 3], at + 10, min(end, at + 10 + size)
        if data[at + 5] & 0x40 and p + 4 <= stop:  # an extended header, whose length counts itself from 2.4 on
            extra = data[p : p + 4]
            p += sum((b & 0x7F) << s for b, s in zip(extra, (21, 14, 7, 0), strict=True)) if major >= 4 else 4 + int.from_bytes(extra, "big")
        width = 6 if major == 2 else 10
        while p + width <= stop and data[p]:
            raw = data[p + 3 : p + 6] if major == 2 else data[p + 4 : p + 8]
            n = int.from_bytes(raw, "big") if major < 4 else sum((b & 0x7F) << s for b, s in zip(raw, (21, 14, 7, 0), strict=True))
            if p + width + n > stop:
                break
            found.setdefault(data[p : p + (3 if major == 2 else 4)].decode("latin-1"), []).append(data[p + width : p + width + n])
            p += width + n
        at = min(end, at + 10 + size + (10 if data[at + 5] & 0x10 else 0))
    if end - at >= 128 and data[end - 128 : end - 125] == b"TAG":
        end -= 128
        for name, lo, hi in (("TIT1", 3, 33), ("ART1", 33, 63), ("ALB1", 63, 93), ("YER1", 93, 97)):
            if value := data[end + lo : end + hi].rstrip(b"\0 "):
                found.setdefault(name, []).append(value)
    if end - at >= 32 and data[end - 32 : end - 24] == b"APETAGEX":
        size, flags = struct.unpack_from("<I4xI", data, end - 20)
        end = max(at, end - size - (32 if flags >> 31 else 0))
    return at, end, found


def _bitrate_table(frame: bytes, side: int, checked: bool) -> tuple[str, int | None, int | None, bytes] | None:
    """(kind, frames, bytes, table of contents) if this frame is a table."""
    p = 4 + 2 * checked + side
    for p in (p, 4 + side):  # writers disagree on whether a checksum moves the table
        if frame[p : p + 4] in (b"Xing", b"Info"):
            flags, q = int.from_bytes(frame[p + 4 : p + 8], "big"), p + 8
            values = []
            for bit in (1, 2):
                values.append(int.from_bytes(frame[q : q + 4], "big") if flags & bit else None)
                q += 4 * bool(flags & bit)
            return frame[p : p + 4].decode(), *values, frame[q : q + 100] if flags & 4 else b""
    if frame[36:40] == b"VBRI":
        return "VBRI", int.from_bytes(frame[50:54], "big"), int.from_bytes(frame[46:50], "big"), b""
    return None


def parse(data: bytes) -> dict:
    """What a stream holds; damage is counted, never raised.

    frame_offsets: the start of each audio frame (the table frame is none);
    samples and sample_rate: the exact duration is their quotient (0 samples and
    rate 0 without frames); skipped_bytes: bytes between tags and frames;
    crc_errors of crc_checked frames (Layer II has its checksum's extent in its
    bit allocation and counts as unchecked); payload: see encode(), else null.
    """
    at, end, tags = _tags(data)
    first = at
    offsets, samples, rate, skipped, checked, errors, bits = [], 0, 0, 0, 0, 0, 0
    found, parts, kinds = None, [], set()
    known = False  # whether the last frame was followed without a search
    while at + 4 <= end:
        h = header(data[at : at + 4])
        if h is None or at + h[0] > end or (rate and h[2] != rate):
            known = False
        elif not known and at + h[0] + 4 <= end and header(data[at + h[0] : at + h[0] + 4]) is None:
            h = None  # a lone header may be chance
        if h is None or at + h[0] > end or (rate and h[2] != rate):
            to = data.find(b"\xff", at + 1, end)
            to = end if to < 0 else to
            skipped += to - at
            at = to
            continue
        known = True
        size, n, hz, kbps, layer, has_crc, side = h
        if has_crc and layer == 3:
            checked += 1
            errors += crc16(data[at + 2 : at + 4] + data[at + 6 : at + 6 + side]) != int.from_bytes(data[at + 4 : at + 6], "big")
        rate = hz
        if not offsets and found is None and (found := _bitrate_table(data[at : at + size], side, has_crc)):
            at += size
            continue
        offsets.append(at)
        samples += n
        bits += kbps
        kinds.add(kbps)
        parts.append(data[at + 4 + 2 * has_crc + side : at + size])
        at += size
    payload = None
    for private in tags.get("PRIV", []):
        if private.startswith(_OWNER):
            payload = b"".join(parts)[: int.from_bytes(private[len(_OWNER) :], "big")]
    return {
        "first_frame": first, "frame_offsets": offsets, "samples": samples, "sample_rate": rate, "skipped_bytes": skipped,
        "crc_checked": checked, "crc_errors": errors, "tags": sorted(tags), "mean_kbps": bits / len(offsets) if offsets else 0.0,
        "variable": len(kinds) > 1, "table": found and found[0], "table_frames": found and found[1], "table_bytes": found and found[2],
        "toc": list(found[3]) if found else [], "payload": payload,
    }


_FIELDS = [
    ("frame_offsets", "array<bigint>"), ("samples", "bigint"), ("sample_rate", "int"), ("duration_s", "double"),
    ("skipped_bytes", "bigint"), ("crc_checked", "bigint"), ("crc_errors", "bigint"), ("tags", "array<string>"),
    ("mean_kbps", "double"), ("variable", "boolean"), ("table", "string"), ("table_frames", "bigint"),
    ("table_bytes", "bigint"), ("toc", "array<int>"), ("payload", "binary"),
]


def encode_column(df: DataFrame, text_col: str = "text", out_col: str = "media", unit: int = 64) -> DataFrame:
    """df plus ``out_col`` (binary): the stream that holds the text's UTF-8 bytes,
    with zero bytes up to a positive multiple of unit.  Null counts as empty; rows
    do not see each other, so repeated ones get equal streams; whole texts of any
    length; an empty table gives no rows.  A column called out_col is replaced."""
    schema = with_fields(df.schema, (out_col, "binary"))
    names = schema.names[:-1]

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, text_col):
                made = []
                for text in b.column(text_col).cast(pa.binary()):
                    raw = text.as_py() or b""
                    made.append(encode(raw.ljust(max(unit, -(-len(raw) // unit) * unit), b"\0")))
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(made, pa.binary())], [*names, out_col])

    return df.mapInArrow(tasks, schema)


def read_column(df: DataFrame, media_col: str = "media") -> DataFrame:
    """df plus what ``parse`` finds in a binary column, as columns (a null stream
    is an empty one; columns of df with the same names are replaced).  Rows do not
    see each other, so repeated ones get the same; an empty table gives no rows."""
    schema = with_fields(df.schema, *_FIELDS)
    names = [n for n in schema.names if n not in dict(_FIELDS)]
    types = dict(zip((n for n, _ in _FIELDS), (
        pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()),
        pa.float64(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.binary()), strict=True))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, media_col):
                found = [parse(x.as_py() or b"") for x in b.column(media_col)]
                for x in found:
                    x["duration_s"] = x["samples"] / x["sample_rate"] if x["sample_rate"] else 0.0
                new = [pa.array([x[n] for x in found], t) for n, t in types.items()]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *new], [*names, *types])

    return df.mapInArrow(tasks, schema)


def op6_media_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    read = read_column(encode_column(sized).drop("text"))
    feature = F.concat_ws(
        ";", F.col("table"), F.concat(F.size("frame_offsets"), F.lit(" frames")),
        F.concat(F.col("samples"), F.lit("/"), F.col("sample_rate"), F.lit(" s")),
        F.concat(F.col("crc_checked") - F.col("crc_errors"), F.lit(" of "), F.col("crc_checked"), F.lit(" checksums")),
        F.concat(F.lit("skipped "), F.col("skipped_bytes")),
        F.concat(F.lit("last frame at "), F.coalesce(F.try_element_at("frame_offsets", F.lit(-1)), F.lit(-1))),
    )
    return read.select(
        "doc_id", "n_bytes", F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"), F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"), feature.alias("feature"),
    )
