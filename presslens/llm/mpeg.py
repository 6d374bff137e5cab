"""Media columns of MPEG audio.

:func:`write_mpeg` stores bytes without loss in a valid MPEG-1 layer III stream:
an ID3v2 tag, a variable-bitrate header frame with its seek table, and
CRC-protected silent frames whose ancillary bytes are the payload (the unit in
which this format keeps foreign bytes). :func:`read_mpeg` works on any MPEG audio
bytes: it skips and parses ID3 tags, finds frames by resynchronising on header
chains, parses Xing, Info and VBRI tables, verifies frame checksums and returns
exact durations and the offset of every frame.

What happens in special cases:

* null text is an empty payload of 64 zero bytes;
* null media reads as a stream without frames (all counts 0, no payload);
* junk between frames is counted and skipped: at the start and after lost sync a
  frame needs a header of its version, layer and rate behind it (or the end of
  the data); a last frame that is cut short counts as junk, and free-format frames (no stated bitrate) are not frames;
* checksums of layers I and II are counted as unchecked;
* equal payloads give equal media; repeated rows are treated alike;
* other columns of the input stay, ``media`` and the result columns are added
  and replace input columns of these names.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 64
#: Fixed values of the format: kbit/s by (MPEG version 1 or not, layer) and bitrate index.
BITRATES = {
    (True, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (True, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (True, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (False, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (False, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (False, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
#: Hz by version bits and sample-rate index.
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}

RATE, RATE_INDEX = 48000, 1
MONO = 0xC0
SIDE = 17  # side-information bytes of a mono MPEG-1 layer III frame
HEAD = 4 + 2 + SIDE
XING_BITRATE = 5  # index: 64 kbit/s, 192 bytes
TAG = "payload-bytes"


def crc16(data: bytes) -> int:
    """The format's checksum: polynomial 0x8005, start 0xFFFF, high bit first."""
    crc = 0xFFFF
    for byte in data:
        crc ^= byte << 8
        for _ in range(8):
            crc = (crc << 1 ^ 0x8005 if crc & 0x8000 else crc << 1) & 0xFFFF
    return crc


@lru_cache(4096)
def _crc16(data: bytes) -> int:
    return crc16(data)


@dataclass(frozen=True)
class Header:
    version: int
    layer: int
    protected: bool
    kbps: int
    rate: int
    length: int
    samples: int
    side: int

    def kin(self, other: Header | None) -> bool:
        """Whether both belong to one stream: version, layer and rate."""
        return other is not None and (self.version, self.layer, self.rate) == (other.version, other.layer, other.rate)


@lru_cache(4096)
def header(word: bytes) -> Header | None:
    """The header in four bytes, or None."""
    if len(word) < 4 or word[0] != 0xFF or word[1] & 0xE0 != 0xE0:
        return None
    version, layer = word[1] >> 3 & 3, 4 - (word[1] >> 1 & 3)
    bitrate, rate = word[2] >> 4, word[2] >> 2 & 3
    if version == 1 or layer == 4 or bitrate in (0, 15) or rate == 3:
        return None
    first, mono, padding = version == 3, word[3] >> 6 == 3, word[2] >> 1 & 1
    kbps, hz = BITRATES[first, layer][bitrate], RATES[version][rate]
    samples = 384 if layer == 1 else 1152 if layer == 2 or first else 576
    length = (12 * kbps * 1000 // hz + padding) * 4 if layer == 1 else samples // 8 * kbps * 1000 // hz + padding
    side = (17 if mono else 32) if first else (9 if mono else 17)
    return Header(version, layer, not word[1] & 1, kbps, hz, length, samples, side if layer == 3 else 0)


def _frame_head(bitrate: int, protected: bool) -> bytes:
    word = bytes([0xFF, 0xFA if protected else 0xFB, bitrate << 4 | RATE_INDEX << 2, MONO])
    side = bytes(SIDE)
    return word + (_crc16(word[2:] + side).to_bytes(2, "big") if protected else b"") + side


_HEADS = {i: _frame_head(i, True) for i in range(1, 15)}
_LENGTHS = {i: 144 * BITRATES[True, 3][i] * 1000 // RATE for i in range(1, 15)}
_FULL = _LENGTHS[14] - HEAD


def _id3(tags: dict[str, str]) -> bytes:
    frames = b""
    for key, value in tags.items():
        body = b"\x00" + key.encode("latin-1") + b"\x00" + value.encode("latin-1")
        frames += b"TXXX" + len(body).to_bytes(4, "big") + b"\x00\x00" + body
    size = len(frames)
    return b"ID3\x03\x00\x00" + bytes(size >> s & 127 for s in (21, 14, 7, 0)) + frames


def encode(payload: bytes) -> bytes:
    """A layer III stream that carries ``payload``: full frames at the highest bitrate, the last at the lowest that fits."""
    full, rest = divmod(len(payload), _FULL)
    parts, lengths = [], []
    for k in range(full):
        parts += (_HEADS[14], payload[k * _FULL : (k + 1) * _FULL])
        lengths.append(_LENGTHS[14])
    if rest or not full:
        last = next(i for i in range(1, 15) if _LENGTHS[i] - HEAD >= rest)
        parts += (_HEADS[last], payload[full * _FULL :], bytes(_LENGTHS[last] - HEAD - rest))
        lengths.append(_LENGTHS[last])
    frames, start = len(lengths), _LENGTHS[XING_BITRATE]
    size = start + sum(lengths)
    toc = bytes(min(255, 256 * (start + p * frames // 100 * _LENGTHS[14]) // size) for p in range(100))  # all but the last frame are full
    xing = _frame_head(XING_BITRATE, False) + b"Xing" + (15).to_bytes(4, "big") + frames.to_bytes(4, "big") + size.to_bytes(4, "big") + toc + (100).to_bytes(4, "big")
    return _id3({TAG: str(len(payload))}) + xing.ljust(start, b"\x00") + b"".join(parts)


@dataclass
class Stream:
    tags: dict[str, str] = field(default_factory=dict)
    offsets: list[int] = field(default_factory=list)
    frames: int = 0
    samples: int = 0
    rate: int = 0
    min_kbps: int = 0
    max_kbps: int = 0
    junk_bytes: int = 0
    crc_good: int = 0
    crc_bad: int = 0
    crc_unchecked: int = 0
    vbr: str | None = None
    vbr_frames: int | None = None
    vbr_bytes: int | None = None
    vbr_toc: bytes | None = None
    payload: bytes = b""


def _tags(media: bytes, at: int) -> tuple[dict[str, str], int]:
    """Text frames of an ID3v2.3 or 2.4 tag at ``at`` and where it ends."""
    syncsafe = lambda b: b[0] << 21 | b[1] << 14 | b[2] << 7 | b[3]
    major, flags, size = media[at + 3], media[at + 5], syncsafe(media[at + 6 : at + 10])
    end, pos, tags = min(len(media), at + 10 + size), at + 10, {}
    if flags & 0x40 and pos + 4 <= end:
        pos += syncsafe(media[pos : pos + 4]) if major == 4 else 4 + int.from_bytes(media[pos : pos + 4], "big")
    while pos + 10 <= end and media[pos : pos + 4].strip(b"\x00"):
        name = media[pos : pos + 4].decode("latin-1")
        length = syncsafe(media[pos + 4 : pos + 8]) if major == 4 else int.from_bytes(media[pos + 4 : pos + 8], "big")
        body = media[pos + 10 : min(end, pos + 10 + length)]
        if name[0] == "T" and body:
            text = body[1:].decode(("latin-1", "utf-16", "utf-16-be", "utf-8")[min(body[0], 3)], "replace").strip("\x00")
            key, _, value = text.partition("\x00") if name == "TXXX" else (name, "", text)
            tags[key] = value
        pos += 10 + length
    return tags, at + 10 + size + (10 if flags & 0x10 else 0)


def _vbr(media: bytes, at: int, head: Header) -> tuple[str, int | None, int | None, bytes | None] | None:
    """The variable-bitrate table in the frame at ``at``: kind, frames, bytes, seek table."""
    number = lambda p: int.from_bytes(media[p : p + 4], "big")
    for pos in (at + 4 + head.side, at + 6 + head.side):
        kind = media[pos : pos + 4]
        if kind in (b"Xing", b"Info"):
            flags, pos = number(pos + 4), pos + 8
            frames = number(pos) if flags & 1 else None
            pos += 4 * (flags & 1)
            size = number(pos) if flags & 2 else None
            pos += 2 * (flags & 2)
            return kind.decode(), frames, size, media[pos : pos + 100] if flags & 4 else None
    if media[at + 36 : at + 40] == b"VBRI":
        return "VBRI", number(at + 50), number(at + 46), None
    return None


def _follows(media: bytes, pos: int, head: Header) -> bool:
    """Whether behind the frame at ``pos`` another of its stream begins."""
    return head.kin(header(media[pos + head.length : pos + head.length + 4]))


def _starts_inside(media: bytes, pos: int, head: Header) -> bool:
    """Whether two frames in a row begin within the bytes that the header at ``pos`` claims, so that it is junk."""
    at = media.find(b"\xff", pos + 1, pos + head.length)
    while at >= 0:
        inner = header(media[at : at + 4])
        if head.kin(inner) and _follows(media, at, inner):
            return True
        at = media.find(b"\xff", at + 1, pos + head.length)
    return False


def decode(media: bytes | None) -> Stream:
    """Parse MPEG audio bytes; ``payload`` holds the frames' ancillary bytes of streams that :func:`encode` wrote."""
    out, media = Stream(), media or b""
    pos, end = 0, len(media)
    if end >= 128 and media[-128:-125] == b"TAG":
        end -= 128
        for key, a, b in (("title", 3, 33), ("artist", 33, 63), ("album", 63, 93)):
            if value := media[end + a : end + b].split(b"\x00")[0].strip():
                out.tags[key] = value.decode("latin-1")
    while media[pos : pos + 3] == b"ID3" and pos + 10 <= end:
        tags, pos = _tags(media, pos)
        out.tags |= tags
    ancillary, own = [], TAG in out.tags
    last, synced = None, False
    while pos < end:
        head = header(media[pos : pos + 4])
        after = pos + head.length if head else 0
        goes_on = head is not None and after <= end and (_follows(media, pos, head) or (after == end and (last is None or head.kin(last))))
        if not goes_on and synced and head is not None and after <= end and head.kin(last):
            goes_on = not _starts_inside(media, pos, head)
        if not goes_on:
            synced = False
            found = media.find(b"\xff", pos + 1, end)
            out.junk_bytes += (found if found > 0 else end) - pos
            pos = found if found > 0 else end
            continue
        last, synced = head, True
        if not out.offsets and out.vbr is None and (table := _vbr(media, pos, head)):
            out.vbr, out.vbr_frames, out.vbr_bytes, out.vbr_toc = table
            out.rate = head.rate
            pos = after
            continue
        out.offsets.append(pos)
        out.frames += 1
        out.samples += head.samples
        out.rate = out.rate or head.rate
        out.min_kbps = min(out.min_kbps or head.kbps, head.kbps)
        out.max_kbps = max(out.max_kbps, head.kbps)
        if head.protected:
            if head.layer != 3:
                out.crc_unchecked += 1
            elif _crc16(media[pos + 2 : pos + 4] + media[pos + 6 : pos + 6 + head.side]) == int.from_bytes(media[pos + 4 : pos + 6], "big"):
                out.crc_good += 1
            else:
                out.crc_bad += 1
        if own:
            ancillary.append(media[pos + HEAD : after])
        pos = after
    if own:
        out.payload = b"".join(ancillary)[: int(out.tags[TAG])]
    return out


def write_mpeg(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``n_bytes`` and ``media``: the whole text in UTF-8, padded with zeros to a positive multiple of 64, as MPEG audio."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), ROWS):
                part = batch.slice(at, ROWS)
                texts = [x.as_py() or b"" for x in part.column(len(keep))]
                media = [encode(t + bytes(-len(t) % BLOCK if t else BLOCK)) for t in texts]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], pa.array([len(t) for t in texts], pa.int64()), pa.array(media, pa.binary())], names=[*keep, "n_bytes", "media"])

    keep = [c for c in docs.columns if c not in (text_col, "n_bytes", "media")]
    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("n_bytes", T.LongType()), T.StructField("media", T.BinaryType())])
    inner = [F.col(f"`{c}`").alias(f"d{i}") for i, c in enumerate(keep)]  # rows go by place, so that no names meet
    return docs.select(*inner, F.encode(F.col(text_col), "UTF-8").alias("text_bytes")).mapInArrow(write, schema)


#: Rows that a worker turns into media at a time.
ROWS = 256
FEATURES = T.StructType(
    [
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_sha256", T.StringType()),
        T.StructField("tail_crc32", T.LongType()),
        T.StructField("media_bytes", T.LongType()),
        T.StructField("media_sha256", T.StringType()),
        T.StructField("frames", T.LongType()),
        T.StructField("samples", T.LongType()),
        T.StructField("rate", T.LongType()),
        T.StructField("min_kbps", T.LongType()),
        T.StructField("max_kbps", T.LongType()),
        T.StructField("junk_bytes", T.LongType()),
        T.StructField("crc_good", T.LongType()),
        T.StructField("crc_bad", T.LongType()),
        T.StructField("crc_unchecked", T.LongType()),
        T.StructField("vbr", T.StringType()),
        T.StructField("vbr_frames", T.LongType()),
        T.StructField("vbr_bytes", T.LongType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
    ]
)


def _features(media: bytes | None) -> tuple:
    s = decode(media)
    m = media or b""
    return (
        len(s.payload), hashlib.sha256(s.payload).hexdigest(), zlib.crc32(s.payload[-BLOCK:]), len(m), hashlib.sha256(m).hexdigest(),
        s.frames, s.samples, s.rate, s.min_kbps, s.max_kbps, s.junk_bytes, s.crc_good, s.crc_bad, s.crc_unchecked, s.vbr, s.vbr_frames, s.vbr_bytes, list(s.tags.items()), s.offsets,
    )


def read_mpeg(stored: DataFrame, media_col: str = "media") -> DataFrame:
    """Replace the media column by what it holds: durations in samples, frame offsets, tags, tables, checksums, payload digests."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(1, batch.num_rows), ROWS):
                part = batch.slice(at, ROWS)
                rows = [_features(x.as_py()) for x in part.column(len(keep))]
                columns = [pa.array([r[k] for r in rows], types[k]) for k in range(len(types))]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *columns], names=[*keep, *FEATURES.names])

    text = pa.string()
    types = [pa.int64(), text, pa.int64(), pa.int64(), text, *[pa.int64()] * 9, text, pa.int64(), pa.int64(), pa.map_(text, text), pa.list_(pa.int64())]
    keep = [c for c in stored.columns if c != media_col and c not in FEATURES.names]
    return stored.select(*keep, media_col).mapInArrow(read, T.StructType([*[stored.schema[c] for c in keep], *FEATURES.fields]))
