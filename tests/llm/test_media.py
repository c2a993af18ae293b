import hashlib
import random
import struct
import zlib

import numpy as np

from ledgerloom.llm import media


def test_round_trip_of_any_bytes():
    r = random.Random(2)
    for n in (0, 1, 63, 64, 65, 2048, 2049, 9000):
        payload = media.pad(bytes(r.choice([255, 0, r.randrange(256)]) for _ in range(n)))
        movie = media.Movie(media.store(payload))
        assert media.payload(movie) == payload
        head, coefs = movie.coefficients()[0]
        scan = movie.frames[0][media._scan_start(movie.frames[0]) : -2]
        assert (media._huffman_scan(head, scan) == coefs).all()  # the general decoder agrees


def bits_to_bytes(bits):
    bits += "1" * (-len(bits) % 8)
    return bytes(int(bits[k : k + 8], 2) for k in range(0, len(bits), 8)).replace(b"\xff", b"\xff\0")


def grey_frame(levels):
    """A baseline frame of flat 8x8 blocks, with ordinary prefix codes of several lengths."""
    dc = {s: (3, s) for s in range(6)} | {6: (4, 12), 7: (5, 26), 8: (6, 54)}
    counts = [0, 0, 6, 1, 1, 1] + [0] * 10
    tables = bytes([0, *counts, *range(9)]) + bytes([0x10, 1, *[0] * 15, 0])
    body, last = "", 0
    for v in levels:
        d, last = v - last, v
        s = abs(d).bit_length()
        length, code = dc[s]
        body += format(code, f"0{length}b") + (format(d if d > 0 else d + (1 << s) - 1, f"0{s}b") if s else "") + "0"
    quant = bytes([0] + [8] * 64)
    sof = struct.pack(">BHHBBBB", 8, 8, 8 * len(levels), 1, 1, 0x11, 0)
    return b"\xff\xd8" + media._segment(0xDB, quant) + media._segment(0xC0, sof) + media._segment(0xC4, tables) + media._segment(0xDA, bytes([1, 1, 0, 0, 63, 0])) + bits_to_bytes(body) + b"\xff\xd9"


def avi(frames):
    chunks, index, at = [], [], 4
    for f in frames:
        chunks.append(media._chunk(b"00dc", f))
        index.append(b"00dc" + struct.pack("<III", 16, at, len(f)))
        at += len(chunks[-1])
    head = media._list(b"hdrl", media._chunk(b"avih", struct.pack("<14I", 100_000, *[0] * 13)))
    return media._chunk(b"RIFF", b"AVI " + head + media._list(b"movi", b"".join(chunks)) + media._chunk(b"idx1", b"".join(index)))


def test_shots_of_an_ordinary_movie(spark):
    dark, light = grey_frame([-100, -90, -100, -95]), grey_frame([100, 90, 95, 100])
    film = avi([dark] * 5 + [light] * 4)
    h = media.Movie(film).histograms()
    assert np.allclose(h.sum(axis=1), 1) and media.shots(h) == [(0, 5), (5, 9)]
    rows = media.clips(spark.createDataFrame([(1, bytearray(film)), (2, None), (3, bytearray(b"RIFF....")), (4, bytearray(film[:200]))], "k int, film binary"), "k", "film").collect()
    assert [(r.id, r.clip, r.start_ms, r.end_ms) for r in rows] == [(1, 0, 0, 500), (1, 1, 500, 900)]


def test_digests(spark):
    texts = [None, "", "a", "é" * 5000, "a", "x" * 64]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], "doc_id long, text string, avi int")
    got = {r.id: r for r in media.digests(df).collect()}
    for k, t in enumerate(texts):
        raw = (t or "").encode()
        p = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        assert (got[k].n_bytes, got[k].payload_bytes, got[k].payload_sha256, got[k].tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
    assert got[2][1:] == got[4][1:] and got[0][1:] == got[1][1:]
    stored = {r.id: bytes(r.avi) for r in media.store_texts(df).collect()}
    assert all(hashlib.sha256(stored[k]).hexdigest() == got[k].media_sha256 for k in got)
    assert media.digests(df.limit(0)).collect() == []
