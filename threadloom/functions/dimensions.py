"""Width and height of images from their bytes, in column functions, and limits on them.

Most formats have both at fixed places of their heads. A JPEG has them in the first frame segment, which is found by walking from one
segment's length to the next; the walk is an aggregate over a sequence of steps, first a few, and as many as the bytes could hold only
for files that need more.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import media, urls

# The greatest side, the greatest area, JPEG's markers of frames, of what has no length, of where the walk ends.
MAX_SIDE, MAX_PIXELS = 16_384, 100_000_000
FRAMES = ["C0", "C1", "C2", "C3", "C5", "C6", "C7", "C9", "CA", "CB", "CD", "CE", "CF"]
BARE = ["01", "D0", "D1", "D2", "D3", "D4", "D5", "D6", "D7", "D8"]
ENDS = ["D9", "DA"]
FEW_STEPS = 24


def number(content: Column, at: Column | int, n: int, little: bool = False) -> Column:
    """The unsigned number of the ``n`` bytes from place ``at`` (from 0); null where they aren't there."""
    h = F.hex(F.substring(content, F.lit(at) + 1 if isinstance(at, int) else at + 1, F.lit(n)))
    if little:
        h = F.concat(*[F.substring(h, 2 * k + 1, 2) for k in reversed(range(n))])
    return F.when(F.length(h) == 2 * n, F.conv(h, 16, 10).cast("bigint"))


def pair(width: Column, height: Column) -> Column:
    return F.struct(width.cast("bigint").alias("width"), height.cast("bigint").alias("height"))


def signed(x: Column) -> Column:
    """A 32-bit number's value with its sign."""
    return F.when(x >= 1 << 31, x - (1 << 32)).otherwise(x)


def _bmp(c: Column) -> Column:
    old = number(c, 14, 4, True) == 12
    return pair(F.when(old, number(c, 18, 2, True)).otherwise(signed(number(c, 18, 4, True))), F.when(old, number(c, 20, 2, True)).otherwise(F.abs(signed(number(c, 22, 4, True)))))


def _ico(c: Column) -> Column:
    """The largest of the pictures in it; a side of 0 stands for 256."""
    side = lambda at: F.when(number(c, at, 1) == 0, 256).otherwise(number(c, at, 1))
    n = F.coalesce(number(c, 4, 2, True), F.lit(0))
    each = F.transform(F.sequence(F.lit(0), F.greatest(n.cast("int") - 1, F.lit(0))), lambda k: F.struct((side(6 + 16 * k) * side(7 + 16 * k)).alias("area"), side(6 + 16 * k).alias("w"), side(7 + 16 * k).alias("h")))
    best = F.array_max(each)
    return F.when(n > 0, pair(best["w"], best["h"]))


def _webp(c: Column) -> Column:
    kind = F.hex(F.substring(c, 13, 4))
    bits = number(c, 21, 4, True)
    lossy = F.when(F.hex(F.substring(c, 24, 3)) == "9D012A", pair(number(c, 26, 2, True).bitwiseAND(0x3FFF), number(c, 28, 2, True).bitwiseAND(0x3FFF)))
    lossless = F.when(number(c, 20, 1) == 0x2F, pair(bits.bitwiseAND(0x3FFF) + 1, F.shiftright(bits, 14).bitwiseAND(0x3FFF) + 1))
    wide = pair(number(c, 24, 3, True) + 1, number(c, 27, 3, True) + 1)
    return F.when(kind == "56503820", lossy).when(kind == "5650384C", lossless).when(kind == "56503858", wide)


def _jpeg(c: Column) -> Column:
    def step(s: Column, _: Column) -> Column:
        """From a segment to the next, or to a frame's sizes. A place of -1 is the end."""
        at = s["at"]
        marker = F.hex(F.substring(c, at + 2, F.lit(1)))
        length = number(c, at + 2, 2)
        alive = (at >= 0) & (number(c, at, 1) == 0xFF) & (marker != "")
        frame = marker.isin(FRAMES)
        to = F.when(marker == "FF", at + 1).when(marker.isin(BARE), at + 2).when(marker.isin(ENDS) | frame, F.lit(-1)).otherwise(F.when(length >= 2, at + 2 + length))
        return F.struct(F.coalesce(F.when(alive, to), F.lit(-1)).cast("bigint").alias("at"), F.when(alive & frame, number(c, at + 7, 2)).otherwise(s["width"]).alias("width"), F.when(alive & frame, number(c, at + 5, 2)).otherwise(s["height"]).alias("height"))

    none = F.lit(None).cast("bigint")
    start = F.struct(F.lit(2).cast("bigint").alias("at"), none.alias("width"), none.alias("height"))
    walk = lambda n: urls.let(F.aggregate(F.sequence(F.lit(1), n), start, step), lambda s: F.struct((s["at"] < 0).alias("over"), pair(s["width"], s["height"]).alias("size")))
    # a segment takes four bytes, a bare marker or a fill byte one at least
    return urls.let(walk(F.lit(FEW_STEPS)), lambda few: F.when(few["over"], few["size"]).otherwise(walk(F.greatest(F.octet_length(c), F.lit(1)))["size"]))


def dimensions(content: Column) -> Column:
    """struct(width, height) by the kind of the bytes; null where there is none or the head is cut off. Leading white space, which kinds overlook,
    makes a head unreadable, as it would for a decoder."""
    return urls.let(content, _dimensions)


def _dimensions(content: Column) -> Column:
    h = F.hex(F.substring(content, 1, 12))
    png = F.when(F.hex(F.substring(content, 13, 4)) == "49484452", pair(number(content, 16, 4), number(content, 20, 4)))
    gif = pair(number(content, 6, 2, True), number(content, 8, 2, True))
    size = F.when(h.startswith(media.PNG), png).when(h.startswith(media.JPEG), _jpeg(content)).when(h.startswith(media.GIFS[0]) | h.startswith(media.GIFS[1]), gif).when(h.startswith(media.RIFF) & (F.substring(h, 17, 8) == media.WEBP), _webp(content)).when(h.startswith(media.BMP), _bmp(content)).when(h.startswith(media.ICO), _ico(content))
    return urls.let(size, lambda s: F.when(s["width"].isNotNull() & s["height"].isNotNull(), s))


def within_limits(size: Column, side: int = MAX_SIDE, pixels: int = MAX_PIXELS) -> Column:
    """Whether an image has sides, none too long, and not too many pixels. False for a null."""

    def fits(s: Column) -> Column:
        w, h = s["width"], s["height"]
        return F.coalesce((w > 0) & (h > 0) & (w <= side) & (h <= side) & (w * h <= pixels), F.lit(False))

    return urls.let(size, fits)


def is_decodable_image(content: Column) -> Column:
    """As ``media.is_valid_image``, and with a head that says a size within the limits."""
    return media.is_valid_image(content) & within_limits(dimensions(content))
