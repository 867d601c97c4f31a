"""Address functions: cleaning, classes, candidate addresses and image keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts and patterns of the archive's image addresses.
PRIMARY_HOST = "i.sstatic.net"
OLD_HOST = "i.stack.imgur.com"
SHARD_NAME = r"(?i)^https?://i\.stack\.imgur\.com/[A-Za-z0-9]{5}\.(?:png|jpe?g|gif)$"
DUMP_NAME = r"(?i)i\.(?:stack\.imgur\.com|sstatic\.net)/([A-Za-z0-9]{3,12}\.(?:png|jpe?g|gif|webp|bmp|tiff?|svg)|[A-Za-z0-9]{3,12})"
HISTORY_NAME = r"(?i)i\.stack\.imgur\.com/([A-Za-z0-9]+)\.([a-zA-Z]+)"
HOPELESS = ["http://...", "https://...", "http://:none", "http://127.0.0.1", "http://localhost"]
#: Python's white space, as its ``strip`` takes it off.
BLANK = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"\A[{BLANK}]+|[{BLANK}]+\z", "")


def normalize_url(url: Column) -> Column:
    s = strip(F.coalesce(url, F.lit("")))
    return F.when(s.startswith("//"), F.concat(F.lit("https:"), s)).otherwise(s)


def host_of(url: Column) -> Column:
    """From the scheme to the next slash, lower-cased; port and user stay. Empty without http(s)."""
    return F.lower(F.regexp_extract(url, "(?i)^https?://([^/]+)", 1))


def classify_url(url: Column) -> Column:
    """struct(source_class, host, url). The first class that fits counts; the last one has no host."""
    u = normalize_url(url)
    host = host_of(u)
    kind = F.when(u.rlike(SHARD_NAME), "ia_stack_imgur").when(host == PRIMARY_HOST, "sstatic_candidate").when(u.rlike("^https?://"), "other_http").otherwise("no_original_url")
    return F.struct(kind.alias("source_class"), F.when(kind == "no_original_url", F.lit("")).otherwise(host).alias("host"), u.alias("url"))


def ia_filename(url: Column) -> Column:
    """Last segment of the path, without query and fragment."""
    return F.substring_index(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1), "/", -1)


def posts_candidates(name: Column) -> Column:
    """Addresses under which a dump's file name may have been keyed, in order."""
    four = F.array(*[F.concat(F.lit(f"{scheme}://{host}/"), name) for scheme, host in (("https", PRIMARY_HOST), ("https", OLD_HOST), ("http", OLD_HOST), ("http", PRIMARY_HOST))])
    return F.when(name.contains("."), four).otherwise(F.array_append(four, F.concat(F.lit(f"https://{PRIMARY_HOST}/"), name, F.lit(".png"))))


def history_candidates(name: Column, ext: Column) -> Column:
    full = F.concat(name, F.lit("."), ext)
    return F.array(*[F.concat(F.lit(p), full) for p in (f"https://{PRIMARY_HOST}/", f"https://{OLD_HOST}/", f"http://{OLD_HOST}/")])


def image_key(url: Column) -> Column:
    return F.md5(url)


def dump_names(line: Column) -> Column:
    """File names after a known image host. The cheap test for the host's name is case-sensitive, unlike the pattern."""
    worth = line.contains("imgur") | line.contains("sstatic")
    return F.when(worth, F.regexp_extract_all(line, F.lit(DUMP_NAME), F.lit(1))).otherwise(F.array().cast("array<string>"))


def history_names(line: Column) -> Column:
    """array<struct<name, ext>> of a line's history names."""
    whole = F.regexp_extract_all(line, F.lit(HISTORY_NAME), F.lit(0))
    return F.transform(whole, lambda m: F.struct(F.regexp_extract(m, HISTORY_NAME, 1).alias("name"), F.regexp_extract(m, HISTORY_NAME, 2).alias("ext")))


def clean_url(url: Column) -> Column:
    """Takes off quotes and punctuation at the end, takes the first embedded address, mends doubled schemes and escaped brackets."""
    def inner(s: Column) -> Column:
        found = F.regexp_extract(s, "(https?://[^\\s\\x00-\\x1f<>\"']+)", 1)
        return F.when(found != "", F.regexp_replace(found, "\\)+\\z", "")).otherwise(s)

    def unescaped(s: Column) -> Column:
        plain = s
        for code, char in (("%5B", "["), ("%5D", "]"), ("%28", "("), ("%29", ")")):
            plain = F.replace(plain, F.lit(code), F.lit(char))
        return F.when(s.startswith("http"), plain).otherwise(s)

    s = let(F.regexp_replace(strip(F.coalesce(url, F.lit(""))), "['\"),.;:]+\\z", ""), inner)
    return let(F.regexp_replace(s, "^https?://https?://", "https://"), unescaped)


def is_unrecoverable(url: Column) -> Column:
    return F.lower(url).rlike(f"^(?:{'|'.join(p.replace('.', '[.]') for p in HOPELESS)})")


def is_usable(url: Column) -> Column:
    return url.rlike("^https?://")


def worth_trying(url: Column) -> Column:
    """An http(s) address that isn't hopeless."""
    return is_usable(url) & ~is_unrecoverable(url)


def decode_camo(path: Column) -> Column:
    """The address that a proxy path ``/digest/hex`` stands for; null if it is none. Bytes that are no UTF-8 become U+FFFD."""
    p = F.regexp_replace(path, "^/+", "")
    code = F.regexp_replace(F.regexp_extract(p, "^[^/]*/(.*)$", 1), "[ \\t\\n\\r\\f\\x0b]", "")
    ok = code.rlike("^(?:[0-9a-fA-F]{2})+\\z") & p.contains("/")
    text = F.when(ok, F.make_valid_utf8(F.unhex(F.when(ok, code)).cast("string")))
    return F.when(text.rlike("^https?://"), text)


def url_prefix(url: Column, n: int = 120) -> Column:
    return F.substring(url, 1, n)


def bundle_entry_problem(path: Column) -> Column:
    """Why an entry of a bundle may not be restored; null if it may. A part ``..`` counts between slashes of either kind; the bundle's own
    folder is no entry of it."""
    up = F.array_contains(F.split(path, r"[/\\]"), "..")
    return F.when(path.isNull() | (path == ""), "not-a-path").when(path.rlike(r"^[/\\]"), "absolute").when(up | path.rlike("^[./]+\\z") & ~path.rlike("[.]{3}"), "escapes")
