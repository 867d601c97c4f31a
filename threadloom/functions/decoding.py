"""Whether an image's bytes hold together to their end: structure, checksums and, for PNG, all pixels. A check of one file, for samples."""

from __future__ import annotations

import struct
import zlib

#: Samples of a pixel by PNG colour kind (fixed values).
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def deep_problem(data: bytes | None) -> str:
    """What is wrong; empty if nothing is found. Kinds whose pixels can't be read here are checked by their structure."""
    if not data:
        return "empty"
    for magic, look in ((b"\x89PNG\r\n\x1a\n", _png), (b"GIF8", _gif), (b"\xff\xd8\xff", _jpeg), (b"RIFF", _riff)):
        if data.startswith(magic):
            try:
                return look(data)
            except (struct.error, IndexError):
                return "cut off"
    return "" if data.startswith((b"BM", b"\0\0\1\0")) else "unknown kind"


def _png(data: bytes) -> str:
    at, head, pixels, size = 8, None, zlib.decompressobj(), 0
    while True:
        n, kind = struct.unpack_from(">I4s", data, at)
        if at + 12 + n > len(data):
            return "cut off"
        body = data[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", data, at + 8 + n)[0] != zlib.crc32(kind + body):
            return f"checksum of {kind.decode('latin-1')}"
        if head is None:
            if kind != b"IHDR":
                return "no head"
            head = struct.unpack(">IIBBBBB", body)
        if kind == b"IDAT":
            try:
                while body:  # a little at a time: few bytes may stand for very many
                    size += len(pixels.decompress(body, 1 << 20))
                    body = pixels.unconsumed_tail
            except zlib.error:
                return "pixels: bad compression"
        if kind == b"IEND":
            break
        at += 12 + n
    w, h, depth, colour, _, _, interlaced = head
    if colour not in SAMPLES:
        return "colour kind"
    want = h * (1 + (w * depth * SAMPLES[colour] + 7) // 8)
    return "" if size == want or interlaced and size else f"pixels: {size} bytes of {want}"


def _gif(data: bytes) -> str:
    flags = data[10]
    at = 13 + (3 << (flags & 7) + 1 if flags & 0x80 else 0)
    while data[at] != 0x3B:
        if data[at] == 0x21:
            at += 2
        elif data[at] == 0x2C:
            flags = data[at + 9]
            at += 11 + (3 << (flags & 7) + 1 if flags & 0x80 else 0)
        else:
            return f"block {data[at]:#x}"
        while data[at]:
            at += 1 + data[at]
        at += 1
    return ""


def _jpeg(data: bytes) -> str:
    return "" if b"\xff\xda" in data and data.rstrip(b"\0").endswith(b"\xff\xd9") else "cut off"


def _riff(data: bytes) -> str:
    return "" if data[8:12] == b"WEBP" and len(data) >= 8 + struct.unpack_from("<I", data, 4)[0] else "cut off"
