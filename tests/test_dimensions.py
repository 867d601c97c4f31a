"""Image sizes from bytes, deep decoding, and the verification of a stage's images."""

import struct
import zlib

from pyspark.sql import functions as F

from threadloom.functions import decoding
from threadloom.functions import dimensions as m
from threadloom.operators import images


def png(w, h):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", b"x") + chunk(b"IEND", b"")


def jpeg(w, h, before=(), frame=0xC0):
    out = b"\xff\xd8"
    for marker, data in before:
        out += bytes([0xFF, marker]) + (struct.pack(">H", len(data) + 2) + data if data is not None else b"")
    return out + bytes([0xFF, frame]) + struct.pack(">HBHHB", 17, 8, h, w, 3) + b"\0" * 9 + b"\xff\xda\0\x02..\xff\xd9"


def webp(kind, body):
    return b"RIFF" + struct.pack("<I", 12 + len(body)) + b"WEBP" + kind + struct.pack("<I", len(body)) + body


def ico(*sides):
    return struct.pack("<HHH", 0, 1, len(sides)) + b"".join(struct.pack("<BBBBHHII", w % 256, h % 256, 0, 0, 1, 32, 0, 0) for w, h in sides)


def u24(x):
    return struct.pack("<I", x)[:3]


SIZES = [
    (png(640, 480), (640, 480)), (png(70000, 1), (70000, 1)), (png(5, 6)[:20], None), (b"\x89PNG\r\n\x1a\n", None), (b"  " + png(3, 3), None),
    (b"GIF89a" + struct.pack("<HH", 300, 65535), (300, 65535)), (b"GIF87a\1", None),
    (b"BM" + b"\0" * 12 + struct.pack("<Iii", 40, 100, -50), (100, 50)), (b"BM" + b"\0" * 12 + struct.pack("<IHH", 12, 9, 8), (9, 8)), (b"BM" + b"\0" * 12 + struct.pack("<Iii", 40, -1, 5), (-1, 5)),
    (ico((16, 16), (256, 256), (32, 32)), (256, 256)), (ico(), None),
    (webp(b"VP8 ", b"\0\0\0\x9d\x01\x2a" + struct.pack("<HH", 0x4000 | 321, 0x8000 | 123)), (321, 123)), (webp(b"VP8 ", b"\0" * 12), None),
    (webp(b"VP8L", b"\x2f" + struct.pack("<I", (16383 - 0) | (99 << 14))), (16384, 100)), (webp(b"VP8X", b"\0" * 4 + u24(20000) + u24(7)), (20001, 8)), (webp(b"ALPH", b"\0" * 20), None),
    (jpeg(800, 600), (800, 600)), (jpeg(800, 600, [(0xE0, b"JFIF"), (0xFE, b"\xff\xc0" * 40), (0xC4, b"tables"), (0xDB, b"")]), (800, 600)), (jpeg(7, 9, frame=0xC2), (7, 9)),
    (jpeg(1, 2, [(0xFF, None), (0x01, None), (0xD0, None)]), (1, 2)), (jpeg(4000, 3000, [(0xE1, b"x" * k) for k in range(90)]), (4000, 3000)),
    (b"\xff\xd8\xff\xda\0\2", None), (b"\xff\xd8\xff\xe0\0\1" + b"\0" * 40, None), (b"\xff\xd8\xff\xe0\xff\xff", None), (b"\xff\xd8\xff", None), (jpeg(3, 3)[:8], None),
    (b"text", None), (b"", None), (None, None),
]


def test_dimensions(spark):
    df = spark.createDataFrame([(k, None if c is None else bytearray(c)) for k, (c, _) in enumerate(SIZES)], "k int, c binary")
    for r in df.select("k", m.dimensions(F.col("c")).alias("d"), m.within_limits(m.dimensions(F.col("c"))).alias("ok")).collect():
        got = None if r.d is None else (r.d.width, r.d.height)
        assert got == SIZES[r.k][1], r.k
        assert r.ok == (got is not None and 0 < min(got) and max(got) <= 16384 and got[0] * got[1] <= 100_000_000), r.k


def test_limits(spark):
    cases = [(16384, 1, True), (16385, 1, False), (10000, 10000, True), (10001, 10000, False), (0, 5, False), (16384, 6103, True), (16384, 6104, False)]
    df = spark.createDataFrame([(w, h, ok, bytearray(png(w, h))) for w, h, ok in cases], "w int, h int, ok boolean, c binary")
    for r in df.select("*", m.is_decodable_image(F.col("c")).alias("got")).collect():
        assert r.got == r.ok, r
    assert not df.limit(1).select(m.is_decodable_image(F.concat(F.col("c"), F.lit(b"<html>"))).alias("x")).first().x


def whole_png(w, h, colour=2, cut=0, interlaced=0):
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    line = 1 + (w * 8 * {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour] + 7) // 8
    data = zlib.compress(b"\0" * (line * h - cut))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, interlaced)) + chunk(b"IDAT", data[:5]) + chunk(b"IDAT", data[5:]) + chunk(b"IEND", b"")


def whole_gif(blocks=b""):
    return b"GIF89a" + struct.pack("<HHBBB", 2, 2, 0x80, 0, 0) + b"\0" * 6 + b"\x21\xf9\x04\0\0\0\0\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, 2, 2, 0) + b"\2\2\x4c\1\0" + blocks + b"\x3b"


def test_deep_decoding():
    good = [whole_png(4, 3), whole_png(5, 2, 6), whole_png(3, 3, 0), whole_gif(), jpeg(3, 3), webp(b"VP8X", b"\0" * 4 + u24(3) + u24(3)), ico((16, 16))]
    assert [decoding.deep_problem(c) for c in good] == [""] * len(good)
    flipped = bytearray(whole_png(4, 3))
    flipped[20] ^= 1
    bad = {bytes(flipped): "checksum", whole_png(4, 3)[:-8]: "cut off", whole_png(4, 3, cut=1): "pixels", whole_gif()[:-1]: "cut off", whole_gif(b"\x99"): "block", jpeg(3, 3)[:-2]: "cut off", jpeg(3, 3).replace(b"\xff\xda", b"\xff\xdb"): "cut off", webp(b"VP8X", b"\0" * 10)[:-4]: "cut off", b"": "empty"}
    for c, word in bad.items():
        assert word in decoding.deep_problem(c), (c, word)


def test_verification(spark):
    good, place = whole_gif(), png(8, 8)
    import hashlib

    names = [f"{k:016x}" for k in range(9)]
    manifest = [(names[0].upper(), "ok"), (names[0], "candidate"), (names[1], "recovered"), (names[2], "upgrade_candidate"), (names[3], "candidate"), (names[4], "fail"), (names[5], "ok"), (names[6], "ok"), ("", "ok"), (None, "ok")]
    files = [(names[0], good), (names[2], place), (names[3], place), (names[4], b""), (names[5], b"<html>" * 9), (names[6], png(20000, 2)), (names[7], good), ("note.txt", b"x" * 9)]
    m_ = spark.createDataFrame(manifest, "hash string, status string")
    f_ = spark.createDataFrame([(n, bytearray(c)) for n, c in files], "name string, content binary")
    states = images.states(m_, f_, len(place), hashlib.sha256(place).hexdigest())
    got = {r["hash"]: (r.recovered, r.problem) for r in states.collect()}
    assert got == {names[0]: (True, None), names[1]: (True, "missing-file"), names[2]: (True, "placeholder"), names[3]: (False, None), names[4]: (False, "empty-file"), names[5]: (True, "invalid-image"), names[6]: (True, "invalid-image")}
    sample = images.deep_sample(f_, 100, 1)
    assert {r.name: r.problem for r in sample.collect() if r.problem} == {names[2]: "pixels: 0 bytes of 200", names[3]: "pixels: 0 bytes of 200", names[4]: "empty", names[5]: "unknown kind", names[6]: "pixels: 0 bytes of 120002"}
    assert images.deep_sample(f_, 3, 1).count() == 3 and images.deep_sample(f_, 0, 1).count() == 0
    r = images.summary(states, sample).first().asDict()
    assert r == {"hashes_checked": 7, "recovered_entries": 5, "placeholders_remaining": 2, "problems": 5, "sampled": 7, "sample_issues": 5, "result": "FAIL"}
    r = images.summary(states.where("hash = '0000000000000000'"), sample.where("problem = ''")).first()
    assert (r.result, r.problems, r.sampled) == ("PASS", 0, 2)
