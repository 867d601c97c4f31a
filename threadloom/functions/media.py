"""Functions on image bytes (binary columns)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magic numbers in hex, markup tokens, extensions.
PNG, JPEG, RIFF, WEBP, BMP, ICO = "89504E470D0A1A0A", "FFD8FF", "52494646", "57454250", "424D", "00000100"
GIFS = ["474946383761", "474946383961"]
MARKUP = ["<html", "<!doctype", "<svg", "<?xml", "<head", "<body"]
HEAD = 4096


def _hex(content: Column, n: int = 64) -> Column:
    return F.hex(F.substring(content, 1, n))


def _stripped(content: Column) -> Column:
    """First bytes in hex, without leading white space (09-0D, 20)."""
    return F.regexp_replace(_hex(content, HEAD), "^(?:09|0A|0B|0C|0D|20)+", "")


def _raster(h: Column, gif: list[str]) -> list[tuple[Column, str]]:
    any_gif = h.startswith(gif[0])
    for g in gif[1:]:
        any_gif = any_gif | h.startswith(g)
    return [(h.startswith(PNG), "image/png"), (h.startswith(JPEG), "image/jpeg"), (any_gif, "image/gif"), (h.startswith(RIFF) & (F.substring(h, 17, 8) == WEBP), "image/webp"), (h.startswith(BMP), "image/bmp"), (h.startswith(ICO), "image/x-icon")]


def _case(pairs: list[tuple[Column, str]], other: str) -> Column:
    out = F
    for test, value in pairs:
        out = out.when(test, value)
    return out.otherwise(other)


def _ascii_hex(s: str) -> str:
    return s.encode().hex().upper()


def sniff(content: Column) -> Column:
    """Kind by magic number after leading white space: the library's rule."""
    h = _stripped(content)
    xml = h.startswith(_ascii_hex("<?xml")) | h.startswith(_ascii_hex("<svg")) | h.startswith(_ascii_hex("<SVG"))
    return _case([*_raster(h, GIFS), (xml, "image/svg+xml")], "unknown")


def sniff_payload(content: Column) -> Column:
    """Kind of a downloaded payload: markup and challenge pages come first, and raster magic isn't stripped. The worker's rule."""
    low = F.lower(F.decode(F.substring(content, 1, HEAD), "ISO-8859-1"))
    d = F.regexp_replace(low, "^[\\x09-\\x0d\\x20]+", "")
    page = d.startswith("<!doctype") | d.startswith("<html") | d.contains("<title>just a moment") | d.contains("cloudflare")
    xml = d.startswith("<?xml") | d.startswith("<svg")
    return _case([(content.isNull() | (F.octet_length(content) == 0), "empty"), (page, "text/html"), (xml, "image/svg+xml"), *_raster(_hex(content), GIFS)], "unknown")


def is_valid_image(content: Column) -> Column:
    """A raster image by magic number and without markup in its head. No decoder is at hand, so sizes aren't looked at."""
    low = F.lower(F.decode(F.substring(content, 1, HEAD), "ISO-8859-1"))
    markup = low.contains(MARKUP[0])
    for t in MARKUP[1:]:
        markup = markup | low.contains(t)
    return F.coalesce((F.octet_length(content) >= 4) & ~sniff(content).isin("unknown", "image/svg+xml") & ~markup, F.lit(False))


def is_placeholder(content: Column, size: int, sha256: str | None) -> Column:
    """Size and digest must both agree; without a digest nothing is a placeholder. The size is compared before content is hashed."""
    if not sha256:
        return F.lit(False)
    return F.when(F.octet_length(content) == size, F.sha2(content, 256) == sha256.lower()).otherwise(F.lit(False))


def validate_payload(content: Column, max_bytes: int) -> Column:
    """struct(ok, mime, reason)."""
    mime = sniff_payload(content)
    reason = F.when(mime == "empty", "empty").when(F.octet_length(content) > max_bytes, "too-large").when(mime.isin("text/html", "image/svg+xml", "unknown"), F.concat(F.lit("not-an-image:"), mime)).otherwise("")
    return F.struct((reason == "").alias("ok"), mime.alias("mime"), reason.alias("reason"))


def ext_matches(ext: Column, content: Column) -> Column:
    """Whether a file's magic number suits its extension; null for extensions that aren't looked at."""
    h, s = _hex(content), _stripped(content)
    return F.when(ext == ".png", h.startswith(PNG)).when(ext.isin(".jpg", ".jpeg"), h.startswith(JPEG)).when(ext == ".gif", h.startswith("47494638")).when(ext == ".webp", h.startswith(RIFF) & (F.substring(h, 17, 8) == WEBP)).when(ext.isin(".svg", ".html", ".htm"), s.startswith("3C"))


def extension_of(mime: Column) -> Column:
    return F.when(mime == "image/png", ".png").when(mime == "image/jpeg", ".jpg").when(mime == "image/gif", ".gif").when(mime == "image/webp", ".webp").when(mime == "image/bmp", ".bmp").otherwise("")
