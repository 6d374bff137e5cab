"""Damaged and foreign MPEG streams."""

import pytest

from presslens.llm import mpeg

FRAME = 672  # 224 kbit/s at 48 kHz, mono, layer III


def frame(i, fill=0):
    return mpeg._frame_head(12, True).ljust(FRAME, bytes([fill or i % 200 + 1]))


def test_plain_frames():
    s = mpeg.decode(b"".join(map(frame, range(5))))
    assert (s.frames, s.samples, s.rate, s.crc_good, s.crc_bad, s.junk_bytes) == (5, 5 * 1152, 48000, 5, 0, 0)
    assert s.offsets == [k * FRAME for k in range(5)]


@pytest.mark.parametrize("junk", [b"\x00" * 50, b"\xff" * 7, mpeg._frame_head(1, False)[:4] + b"xyz", b"\xff\xfb\x90\x00" + b"z" * 300])
@pytest.mark.parametrize("before", [0, 2, 5])
def test_junk_is_skipped_even_if_it_looks_like_a_header(junk, before):
    s = mpeg.decode(b"".join(map(frame, range(before))) + junk + b"".join(map(frame, range(6))))
    assert s.junk_bytes == len(junk) and s.frames == before + 6
    assert s.offsets == [k * FRAME + (len(junk) if k >= before else 0) for k in range(before + 6)]


def test_cut_frame_bad_checksum_and_old_tag():
    bad = bytearray(frame(1))
    bad[10] ^= 1
    tag = b"TAG" + b"Song".ljust(30, b"\0") + b"Band".ljust(30, b"\0") + bytes(65)
    s = mpeg.decode(frame(0) + bytes(bad) + frame(2) + frame(3)[:100] + tag)
    assert (s.frames, s.crc_good, s.crc_bad, s.junk_bytes) == (3, 2, 1, 100)
    assert s.tags == {"title": "Song", "artist": "Band"}


def test_variable_bitrate_tables():
    table = bytearray(frame(0))
    table[36:62] = b"VBRI" + bytes(6) + (9999).to_bytes(4, "big") + (14).to_bytes(4, "big") + bytes(8)
    s = mpeg.decode(bytes(table) + frame(1) + frame(2))
    assert (s.vbr, s.vbr_frames, s.vbr_bytes, s.frames, s.offsets) == ("VBRI", 14, 9999, 2, [FRAME, 2 * FRAME])
    info = bytearray(frame(0))
    info[mpeg.HEAD : mpeg.HEAD + 12] = b"Info" + (1).to_bytes(4, "big") + (2).to_bytes(4, "big")
    s = mpeg.decode(bytes(info) + frame(1) + frame(2))
    assert (s.vbr, s.vbr_frames, s.vbr_bytes, s.vbr_toc, s.frames) == ("Info", 2, None, None, 2)


@pytest.mark.parametrize("media", [None, b"", b"\xff", b"text only", frame(0)[:-1], b"ID3\x03\x00\x00\x00\x00\x00\x05"])
def test_no_frames(media):
    s = mpeg.decode(media)
    assert (s.frames, s.offsets, s.payload) == (0, [], b"")
