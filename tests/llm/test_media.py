import hashlib
import struct
import zlib

import numpy as np
import pytest

from lodestack.llm import media


def filtered_png(rows, kinds):
    """A PNG whose rows use the given filters, made from the standard's definitions."""
    height, width = rows.shape
    out = bytearray()
    for y in range(height):
        above = rows[y - 1].astype(int) if y else np.zeros(width, int)
        out.append(kinds[y])
        for x in range(width):
            a = int(rows[y, x - 1]) if x else 0
            b = int(above[x])
            c = int(above[x - 1]) if x else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((int(rows[y, x]) - (0, a, b, (a + b) // 2, paeth)[kinds[y]]) % 256)
    body = zlib.compress(bytes(out))
    half = len(body) // 2
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return media.SIGNATURE + media._chunk(b"IHDR", header) + media._chunk(b"tEXt", b"a\0b") + media._chunk(b"IDAT", body[:half]) + media._chunk(b"IDAT", body[half:]) + media._chunk(b"IEND", b"")


def test_all_filters_undone():
    rng = np.random.default_rng(1)
    for _ in range(20):
        rows = rng.integers(0, 256, (rng.integers(1, 12), rng.integers(1, 9)), dtype=np.uint8)
        kinds = rng.integers(0, 5, len(rows)).tolist()
        assert (media.decode_png(filtered_png(rows, kinds)) == rows).all()


def test_round_trip_of_gradients():
    for rows in (np.arange(6400, dtype=np.int64) // 3, np.arange(6400) % 64 * 2, np.random.default_rng(2).integers(0, 256, 6400)):
        raw = rows.astype(np.uint8).tobytes()
        assert media.decode_png(media.encode_png(raw)).tobytes() == raw


def test_damage_is_seen():
    good = bytearray(media.encode_png(b"x" * 128))
    good[50] ^= 1
    with pytest.raises(ValueError):
        media.decode_png(bytes(good))


def test_hash_of_like_pictures():
    y, x = np.mgrid[0:96, 0:64]
    rows = (128 + 80 * np.sin(x / 9) * np.cos(y / 13)).astype(np.uint8)
    noisy = np.clip(rows.astype(int) + np.random.default_rng(3).integers(-3, 4, rows.shape), 0, 255).astype(np.uint8)
    bits = lambda r: np.unpackbits(np.frombuffer(media.picture_hash(r), np.uint8))
    assert (bits(rows) != bits(noisy)).sum() <= 12 < (bits(rows) != bits(np.random.default_rng(4).integers(0, 256, rows.shape, dtype=np.uint8))).sum()


def test_columns(edge, edge_rows, nothing):
    got = media.decode_media(media.encode_media(edge)).collect()
    expected = []
    for r in edge_rows:
        raw = (r[1] or "").encode()
        expected.append((r[0], len(raw), hashlib.sha256(raw + bytes(-len(raw) % 64 if raw else 64)).hexdigest()))
    assert sorted(((r.doc_id, r.n_bytes, hashlib.sha256(r.payload).hexdigest()) for r in got), key=repr) == sorted(expected, key=repr)
    assert len({bytes(r.media) for r in got}) == len({bytes(r.payload) for r in got})
    assert media.decode_media(media.encode_media(nothing)).count() == 0
