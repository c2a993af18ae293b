"""Media columns: AVI files of motion JPEG in a binary column.

``store`` puts bytes into the quantised coefficients of baseline JPEG frames: each byte is one coefficient of magnitude
category 8 (-255..-128 for bytes below 128, else 128..255), whose eight magnitude bits are the byte itself. The Huffman
tables hold that one symbol as the code 0, each block is a restart interval of its own, so a block of 64 bytes takes 72
bytes and a marker. Any baseline decoder reads such frames. The unit of the format is the coefficient, in zigzag order.

``Movie`` parses the RIFF lists and the idx1 index of any such AVI and decodes its intra frames (baseline Huffman, restart
intervals, chroma subsampling); luma comes from an exact integer inverse transform. ``shots`` compares the luma histograms
of neighbouring frames with a threshold that follows their recent mean and spread; the cuts give timed clips.

Defined results: null text or payload counts as empty and is stored as one block of zeros; very long payloads are split
over frames of FRAME_BLOCKS blocks, the last filled up with zero bytes; equal payloads give equal files and features;
repeated rows each give a row; an empty table gives an empty result; a null or broken file gives no clips.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import _arrow_type
from .common import narrow

BLOCK, FRAME_BLOCKS, FPS, BINS = 64, 32, 25, 16
#: Frames looked back on, spreads over their mean, and the least difference (of 2 at most) that a cut takes.
WINDOW, SPREADS, FLOOR = 8, 3.0, 0.25


@lru_cache
def zigzag() -> np.ndarray:
    """Natural place of each coefficient in zigzag order: anti-diagonals walked in turns."""
    places = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda p: (p[0] + p[1], p[0] if (p[0] + p[1]) % 2 else p[1]))
    return np.array([8 * r + c for r, c in places])


@lru_cache
def transform() -> np.ndarray:
    """64 coefficients in zigzag order -> 64 samples, in 2**-14; whole numbers, so that sums are exact in doubles."""
    x = np.arange(8)
    one = np.cos((2 * x[None, :] + 1) * x[:, None] * np.pi / 16) / 2
    one[0] = np.sqrt(1 / 8)
    both = np.einsum("ux,vy->uvxy", one, one).reshape(64, 64)
    return np.rint(both[zigzag()] * 2**14)


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _one_symbol_table(kind: int) -> bytes:
    return bytes([kind << 4, 1, *[0] * 15, 8])


@lru_cache
def _frame_head(width: int, height: int) -> bytes:
    return b"\xff\xd8" + _segment(0xDB, bytes([0] + [1] * 64)) + _segment(0xC0, struct.pack(">BHHBBBB", 8, height, width, 1, 1, 0x11, 0)) + _segment(0xC4, _one_symbol_table(0) + _one_symbol_table(1)) + _segment(0xDD, struct.pack(">H", 1)) + _segment(0xDA, bytes([1, 1, 0, 0, 63, 0]))


def pad(raw: bytes) -> bytes:
    """raw with zero bytes up to a positive multiple of a block."""
    return raw + bytes(-len(raw) % BLOCK or (BLOCK if not raw else 0))


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def _list(name: bytes, body: bytes) -> bytes:
    return _chunk(b"LIST", name + body)


def store(payload: bytes) -> bytes:
    """An AVI whose frames hold the payload (a positive multiple of 64 bytes)."""
    blocks = len(payload) // BLOCK
    per_frame = min(blocks, FRAME_BLOCKS)
    frames = -(-blocks // per_frame)
    data = np.frombuffer(payload + bytes((frames * per_frame - blocks) * BLOCK), np.uint8)
    bits = np.zeros((len(data), 9), np.uint8)
    bits[:, 1:] = np.unpackbits(data).reshape(-1, 8)
    coded = np.empty((frames, per_frame, 74), np.uint8)
    coded[:, :, :72] = np.packbits(bits).reshape(frames, per_frame, 72)
    coded[:, :, 72] = 0xFF
    coded[:, :, 73] = 0xD0 + np.arange(per_frame) % 8
    width, height = 8, 8 * per_frame
    head, chunks, index, at = _frame_head(width, height), [], [], 4
    stuffed = (coded[:, :, :72] == 0xFF).any(axis=(1, 2))
    for k in range(frames):
        if stuffed[k]:  # a 0 goes after each data byte of all ones
            body = b"".join(row[:72].tobytes().replace(b"\xff", b"\xff\0") + row[72:].tobytes() for row in coded[k])
        else:
            body = coded[k].tobytes()
        chunks.append(_chunk(b"00dc", head + body[:-2] + b"\xff\xd9"))
        index.append(b"00dc" + struct.pack("<III", 0x10, at, len(head) + len(body)))
        at += len(chunks[-1])
    most = max(map(len, chunks))
    avih = struct.pack("<14I", 1_000_000 // FPS, most * FPS, 0, 0x10, frames, 0, 1, most, width, height, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIiI4h", 0, 0, 0, 0, 1, FPS, 0, frames, most, -1, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 8, b"MJPG", width * height, 0, 0, 0, 0)
    hdrl = _list(b"hdrl", _chunk(b"avih", avih) + _list(b"strl", _chunk(b"strh", strh) + _chunk(b"strf", strf)))
    info = _list(b"INFO", _chunk(b"ICMT", b"payload=%d\0" % len(payload)))
    return _chunk(b"RIFF", b"AVI " + hdrl + info + _list(b"movi", b"".join(chunks)) + _chunk(b"idx1", b"".join(index)))


class Broken(ValueError):
    """Not an AVI of baseline motion JPEG."""


@lru_cache(maxsize=256)
def _head(head: bytes) -> dict:
    """What the segments of a frame up to its scan say."""
    if head[:2] != b"\xff\xd8":
        raise Broken("a frame doesn't begin with a JPEG marker")
    out, at = {"quant": {}, "huff": {}, "restart": 0}, 2
    while True:
        if at + 4 > len(head) or head[at] != 0xFF:
            raise Broken("a JPEG segment is cut off")
        marker, size = head[at + 1], struct.unpack(">H", head[at + 2 : at + 4])[0]
        body = head[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                wide, n = body[0] >> 4, 65 + 64 * (body[0] >> 4)
                out["quant"][body[0] & 15] = np.frombuffer(body[1:n], ">u2" if wide else np.uint8).astype(np.int64)
                body = body[n:]
        elif marker == 0xC0:
            _, out["height"], out["width"], n = struct.unpack(">BHHB", body[:6])
            out["parts"] = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise Broken("only baseline frames are decoded")
        elif marker == 0xC4:
            while body:
                counts, n = body[1:17], sum(body[1:17])
                codes, code, k = {}, 0, 17
                for length, many in enumerate(counts, 1):
                    for _ in range(many):
                        codes[length, code] = body[k]
                        code, k = code + 1, k + 1
                    code <<= 1
                out["huff"][body[0] >> 4, body[0] & 15] = codes
                body = body[17 + n :]
        elif marker == 0xDD:
            out["restart"] = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            out["tables"] = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
            out["end"] = at + 2 + size
            break
        at += 2 + size
    if "parts" not in out:
        raise Broken("a frame has no size")
    one = {(1, 0): 8}
    part = out["parts"][0]
    out["plain"] = len(out["parts"]) == 1 and out["restart"] == 1 and all(out["huff"].get((kind, t)) == one for kind, t in enumerate(out["tables"][part[0]]))
    out["blocks"] = -(-out["width"] // 8) * -(-out["height"] // 8)
    return out


def _scan_start(frame: bytes) -> int:
    at = 2
    while at + 4 <= len(frame) and frame[at] == 0xFF:
        size = struct.unpack(">H", frame[at + 2 : at + 4])[0]
        if frame[at + 1] == 0xDA:
            return at + 2 + size
        at += 2 + size
    raise Broken("a frame has no scan")


def _huffman_scan(head: dict, scan: bytes) -> np.ndarray:
    """Quantised coefficients (blocks, 64) of the first component of any baseline scan, in raster order of its blocks."""
    intervals = re.split(rb"\xff[\xd0-\xd7]", scan)
    wide, high = max(p[1] for p in head["parts"]), max(p[2] for p in head["parts"])
    alone = len(head["parts"]) == 1
    across = -(-head["width"] // (8 if alone else 8 * wide))
    down = -(-head["height"] // (8 if alone else 8 * high))
    h0, v0 = (1, 1) if alone else head["parts"][0][1:3]
    out = np.zeros((down * v0, across * h0, 64), np.int64)
    mcu, units = 0, across * down
    for body in intervals:
        bits = np.unpackbits(np.frombuffer(body.replace(b"\xff\0", b"\xff"), np.uint8)).tolist()
        at, last = 0, dict.fromkeys([p[0] for p in head["parts"]], 0)
        until = min(units, mcu + head["restart"]) if head["restart"] else units

        def take(n: int) -> int:
            nonlocal at
            value = 0
            for b in bits[at : at + n]:
                value = 2 * value + b
            at += n
            return value

        def symbol(codes: dict) -> int:
            nonlocal at
            code = 0
            for length in range(1, 17):
                if at >= len(bits):
                    raise Broken("a scan is cut off")
                code, at = 2 * code + bits[at], at + 1
                if (length, code) in codes:
                    return codes[length, code]
            raise Broken("a scan has an unknown code")

        def signed(size: int) -> int:
            v = take(size)
            return v if not size or v >> (size - 1) else v - (1 << size) + 1

        while mcu < until:
            for k, (name, h, v, _) in enumerate(head["parts"]):
                dc, ac = (head["huff"][kind, t] for kind, t in enumerate(head["tables"][name]))
                for y in range(1 if alone else v):
                    for x in range(1 if alone else h):
                        block = np.zeros(64, np.int64)
                        last[name] += signed(symbol(dc))
                        block[0], i = last[name], 1
                        while i < 64:
                            s = symbol(ac)
                            if s == 0:
                                break
                            i += s >> 4
                            if s != 0xF0:
                                if i > 63:
                                    raise Broken("a block is too long")
                                block[i] = signed(s & 15)
                            i += 1
                        if k == 0:
                            out[mcu // across * v0 + y, mcu % across * h0 + x] = block
            mcu += 1
    return out[: -(-head["height"] // 8), : -(-head["width"] // 8)].reshape(-1, 64)


class Movie:
    """The video frames that an AVI's index names, and the notes beside them."""

    def __init__(self, avi: bytes):
        if avi[:4] != b"RIFF" or avi[8:12] != b"AVI ":
            raise Broken("not an AVI")
        self.avi, self.info, self.usec = avi, {}, 1_000_000 // FPS
        index, movi = None, None
        stack = [(12, min(len(avi), 8 + struct.unpack("<I", avi[4:8])[0]))]
        while stack:
            at, end = stack.pop()
            while at + 8 <= end:
                name, size = avi[at : at + 4], struct.unpack("<I", avi[at + 4 : at + 8])[0]
                body = at + 8
                if name == b"LIST" and avi[body : body + 4] == b"movi":
                    movi = body
                elif name == b"LIST":
                    stack.append((body + 4, body + size))
                elif name == b"avih":
                    self.usec = struct.unpack("<I", avi[body : body + 4])[0] or self.usec
                elif name == b"idx1":
                    index = avi[body : body + size]
                elif name == b"ICMT":
                    self.info["comment"] = avi[body : body + size].rstrip(b"\0").decode("latin-1")
                at = body + size + size % 2
        if index is None or movi is None:
            raise Broken("no index")
        entries = [struct.unpack("<4sIII", index[i : i + 16]) for i in range(0, len(index) - 15, 16)]
        entries = [e for e in entries if e[0][2:] in (b"dc", b"db")]
        base = movi if not entries or avi[movi + entries[0][2] : movi + entries[0][2] + 4] == entries[0][0] else 0
        self.frames = [avi[base + at + 8 : base + at + 8 + size] for _, _, at, size in entries if size]

    def coefficients(self) -> list[tuple[dict, np.ndarray]]:
        """(head, quantised coefficients of the first component) of each frame."""
        out: list = []
        plain: list[tuple[int, bytes]] = []
        for frame in self.frames:
            start = _scan_start(frame) if not out or not frame.startswith(out[0][2]) else len(out[0][2])
            head = _head(frame[:start])
            scan = frame[start:]
            scan = scan[:-2] if scan.endswith(b"\xff\xd9") else scan
            if head["plain"]:
                size = 74 * head["blocks"] - 2
                if len(scan) != size:
                    scan = re.sub(rb"\xff\0", b"\xff", scan)
                if len(scan) != size:
                    raise Broken("a scan is cut off")
                plain.append((len(out), scan + b"\0\0"))
                out.append([head, None, frame[:start]])
            else:
                out.append([head, _huffman_scan(head, scan), frame[:start]])
        if plain:  # every code is one 0 bit and eight magnitude bits
            rows = np.frombuffer(b"".join(s for _, s in plain), np.uint8).reshape(-1, 74)[:, :72]
            bits = np.unpackbits(np.ascontiguousarray(rows), axis=1).reshape(-1, 9)
            if bits[:, 0].any():
                raise Broken("a scan has an unknown code")
            data = np.packbits(bits[:, 1:]).astype(np.int64)
            coefs, at = np.where(data < 128, data - 255, data).reshape(-1, 64), 0
            for k, _ in plain:
                n = out[k][0]["blocks"]
                out[k][1] = coefs[at : at + n]
                at += n
        return [(h, c) for h, c, _ in out]

    def histograms(self, decoded: list | None = None) -> np.ndarray:
        """Shares of luma in BINS steps, in frames; from the samples that the inverse transform gives."""
        out = []
        for group in _runs(self.coefficients() if decoded is None else decoded):
            head = group[0][0]
            quant = head["quant"][head["parts"][0][3]]
            n = len(group[0][1])
            coefs = np.concatenate([c for _, c in group]).astype(np.float64) * quant
            levels = np.clip(np.floor(coefs @ transform() / 2**14 + 128.5), 0, 255).astype(np.int64) * BINS // 256
            of = np.repeat(np.arange(len(group)), n * 64)
            out.append(np.bincount(of * BINS + levels.ravel(), minlength=len(group) * BINS).reshape(-1, BINS) / (n * 64))
        return np.concatenate(out) if out else np.zeros((0, BINS))


def _runs(decoded: list, most: int = 2048):
    """Neighbouring frames of one kind together, some thousand blocks at once."""
    group: list = []
    for h, c in decoded:
        if group and (h is not group[0][0] or len(c) != len(group[0][1]) or len(group) * len(c) >= most):
            yield group
            group = []
        group.append((h, c))
    if group:
        yield group


def payload(movie: Movie, decoded: list | None = None) -> bytes:
    """The bytes that store() put in."""
    coefs = [c for _, c in (movie.coefficients() if decoded is None else decoded)]
    size = int(re.fullmatch(r"payload=(\d+)", movie.info.get("comment", ""))[1])
    data = np.concatenate(coefs).ravel()
    return np.where(data < 0, data + 255, data).astype(np.uint8).tobytes()[:size]


def shots(histograms: np.ndarray) -> list[tuple[int, int]]:
    """[first, end) frames of each shot. A cut lies before a frame whose histogram differs from the last one's by more than
    FLOOR and more than the mean of the last WINDOW differences plus SPREADS times their spread."""
    if not len(histograms):
        return []
    diff = np.abs(np.diff(histograms, axis=0)).sum(axis=1)
    cuts = [0]
    for k, d in enumerate(diff.tolist()):
        past = diff[max(0, k - WINDOW) : k]
        if d > FLOOR and (not len(past) or d > past.mean() + SPREADS * past.std()):
            cuts.append(k + 1)
    return list(zip(cuts, [*cuts[1:], len(histograms)], strict=True))


def clip_rows(avi: bytes | None) -> list[dict]:
    try:
        movie = Movie(avi or b"")
        h = movie.histograms()
    except (Broken, struct.error, KeyError, IndexError):
        return []
    levels = (np.arange(BINS) + 0.5) * 256 / BINS
    return [{"clip": k, "first_frame": a, "n_frames": b - a, "start_ms": a * movie.usec // 1000, "end_ms": b * movie.usec // 1000, "luma": round(float(h[a:b].mean(axis=0) @ levels), 3)} for k, (a, b) in enumerate(shots(h))]


def clips(media: DataFrame, id_col: str, avi_col: str) -> DataFrame:
    """A row for each clip of each AVI: (id, clip, first_frame, n_frames, start_ms, end_ms, luma)."""
    arrow = pa.schema([("id", _arrow_type(media, id_col)), ("clip", pa.int32()), ("first_frame", pa.int32()), ("n_frames", pa.int32()), ("start_ms", pa.int64()), ("end_ms", pa.int64()), ("luma", pa.float64())])

    def run(batches):
        for b in batches:
            for i, avi in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if rows := clip_rows(avi.as_py()):
                    yield pa.RecordBatch.from_pylist([{"id": i} | r for r in rows], schema=arrow)

    return narrow(media, id=id_col, avi=avi_col).mapInArrow(run, f"id {media.schema[id_col].dataType.simpleString()}, clip int, first_frame int, n_frames int, start_ms long, end_ms long, luma double")


def store_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, avi): each whole text as UTF-8, stored."""
    arrow = pa.schema([("id", _arrow_type(docs, id_col)), ("avi", pa.binary())])

    def run(batches):
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                yield pa.RecordBatch.from_pylist([{"id": i, "avi": store(pad((t.as_py() or "").encode()))}], schema=arrow)

    return narrow(docs, id=id_col, text=text_col).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, avi binary")


def describe(text: str | None) -> dict:
    """Store a text, read it back and describe it."""
    raw = (text or "").encode()
    avi = store(pad(raw))
    movie = Movie(avi)
    decoded = movie.coefficients()
    back = payload(movie, decoded)
    h = movie.histograms(decoded)
    cuts = ",".join(f"{a * movie.usec // 1000}-{b * movie.usec // 1000}" for a, b in shots(h))
    levels = ",".join(map(str, np.rint(h.mean(axis=0) * 10_000).astype(int).tolist()))
    return {"n_bytes": len(raw), "payload_bytes": len(back), "payload_sha256": hashlib.sha256(back).hexdigest(), "tail_crc32": zlib.crc32(back[-BLOCK:]), "media_bytes": len(avi), "media_sha256": hashlib.sha256(avi).hexdigest(), "feature": f"frames={len(movie.frames)};clips={cuts};luma={levels}"}


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """describe() of every text, without carrying the files through Spark."""
    fields = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    arrow = pa.schema([("id", _arrow_type(docs, id_col)), *fields])

    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for k in range(0, len(ids), 500):
                rows = [{"id": i} | describe(t.as_py()) for i, t in zip(ids[k : k + 500], texts[k : k + 500], strict=True)]
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow(docs, id=id_col, text=text_col).mapInArrow(run, f"id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
