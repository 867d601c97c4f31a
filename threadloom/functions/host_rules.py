"""Further addresses of an image by rules on its host: an ordered table of rules, each a condition and the forms that follow, all of them
column functions on the address's parsed parts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import urls

# Hosts, repository patterns, forms of badges, thumbnails, extensions.
BADGE_HOSTS = ["badge.fury.io", "img.shields.io", "travis-ci.org", "travis-ci.com", "codecov.io", "codeclimate.com", "david-dm.org", "api.codacy.com", "app.codacy.com", "coveralls.io", "scrutinizer-ci.com", "circleci.com", "ci.appveyor.com", "gemnasium.com", "inch-ci.org", "houndci.com", "semaphoreci.com", "bintray.com", "badges.gitter.im", "shippable.com", "requires.io", "readthedocs.org"]
REPOSITORY = [
    r"badge\.fury\.io/(?:gh|js|rb|py)/([^/]+(?:/[^/]+)+)",
    r"travis-ci\.(?:org|com)/([^/]+(?:/[^/\s?]+)+)",
    r"codecov\.io/(?:gh|github)/([^/]+(?:/[^/\s?]+)+)",
    r"codeclimate\.com/github/([^/]+(?:/[^/\s?]+)+)",
    r"david-dm\.org/([^/]+(?:/[^/\s?]+)+)",
    r"coveralls\.io/(?:repos/)?github/([^/]+(?:/[^/\s?]+)+)",
    r"img\.shields\.io/(.+?)(?:\?|$)",
    r"readthedocs\.org/projects/([^/]+)/badge/",
]
BADGE_FORMS = [
    ("badge.fury.io", "https://badge.fury.io/gh/{}.svg"),
    ("travis-ci.", "https://api.travis-ci.org/{}.svg?branch=master"),
    ("codecov.io", "https://codecov.io/gh/{}/branch/master/graph/badge.svg"),
    ("codeclimate.com", "https://api.codeclimate.com/v1/badges/github/{}/maintainability"),
    ("david-dm.org", "https://david-dm.org/{}.svg"),
]
THUMBS = ["maxresdefault", "hqdefault", "sddefault", "mqdefault"]
PICTURE_EXT = [".png", ".jpg", ".gif", ".mp4", ".webp"]
#: Parts of an address, by the standard's own pattern: scheme, host with port and user, path, query, fragment.
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


@dataclass
class Address:
    """An address's parts as columns."""

    url: Column
    scheme: Column
    host: Column
    path: Column
    query: Column
    fragment: Column

    @classmethod
    def of(cls, url: Column) -> Address:
        scheme, host, *rest = [F.regexp_extract(url, PARTS, k) for k in range(1, 6)]
        return cls(url, F.lower(scheme), F.lower(host), *rest)

    def on(self, *marks: str) -> Column:
        """Whether the host contains one of the marks."""
        return reduce(Column.__or__, [self.host.contains(m) for m in marks])

    def steps(self) -> Column:
        """The path's parts, slashes at its ends apart."""
        return F.split(F.regexp_replace(self.path, "^/+|/+$", ""), "/")

    def pairs(self) -> Column:
        """The query's names and values, decoded; those without a value don't count."""
        pair = lambda p: F.struct(plain(F.substring_index(p, "=", 1)).alias("name"), plain(F.regexp_extract(p, "(?s)=(.*)$", 1)).alias("value"))
        return F.filter(F.transform(F.split(self.query, "&"), pair), lambda p: p["value"] != "")


def plain(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), F.replace(text, F.lit("+"), F.lit(" ")))


def quoted(text: Column) -> Column:
    """Percent-encoded for a query: letters, digits and ``_.-~`` stay, a space becomes a plus."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def filled(form: str, value: Column) -> Column:
    before, after = form.split("{}")
    return F.concat(F.lit(before), value, F.lit(after))


def thumbnails(a: Address) -> tuple[Column, list[Column]]:
    short = a.host.endswith("youtu.be")
    key = F.when(short, F.get(a.steps(), F.lit(0))).when(a.path.startswith("/shorts/"), F.get(F.split(a.path, "/"), F.lit(2))).otherwise(F.get(F.filter(a.pairs(), lambda p: p["name"] == "v"), F.lit(0))["value"])
    return a.on("youtube.com", "youtu.be") & (F.coalesce(key, F.lit("")) != ""), [filled(f"https://i.ytimg.com/vi/{{}}/{t}.jpg", key) for t in THUMBS]


def diagrams(a: Address) -> tuple[Column, list[Column]]:
    return a.on("plantuml.com") & a.path.contains("/plantuml/uml/"), [F.replace(a.url, F.lit("/plantuml/uml/"), F.lit(f"/plantuml/{kind}/")) for kind in ("png", "svg")]


def drawings(a: Address) -> tuple[Column, list[Column]]:
    code = F.regexp_extract(a.url, "(?s)#pako:(.*)$", 1)
    return a.on("mermaid.live") & a.url.contains("#pako:"), [filled(f"https://mermaid.ink/{kind}/pako:{{}}", code) for kind in ("img", "svg")]


def repository_files(a: Address) -> tuple[Column, list[Column]]:
    """Owner and repository, then what follows the third part."""
    steps = a.steps()
    raw = F.concat(F.lit("https://raw.githubusercontent.com/"), F.array_join(F.concat(F.slice(steps, 1, 2), F.slice(steps, F.lit(4), F.size(steps))), "/"))
    return a.on("github.com") & a.path.contains("/blob/") & (F.size(steps) >= 5), [raw]


def shared_files(a: Address) -> tuple[Column, list[Column]]:
    """The query with dl=1, at the place where it has a dl already; values of a name stand together."""
    every = a.pairs()
    names = F.array_distinct(F.array_append(F.transform(every, lambda p: p["name"]), F.lit("dl")))
    values = lambda n: F.when(n == "dl", F.array(F.lit("1"))).otherwise(F.transform(F.filter(every, lambda p: p["name"] == n), lambda p: p["value"]))
    query = F.array_join(F.flatten(F.transform(names, lambda n: F.transform(values(n), lambda v: F.concat(quoted(n), F.lit("="), quoted(v))))), "&")
    # parts that are empty leave no sign behind
    mark = F.when(a.fragment != "", F.concat(F.lit("#"), a.fragment)).otherwise("")
    return a.on("dropbox.com"), [F.concat(F.regexp_extract(a.url, "^[^?#]*", 0), F.lit("?"), query, mark)]


def drives(a: Address) -> tuple[Column, list[Column]]:
    return a.on("1drv.ms"), [F.concat(a.url, F.lit("?download=1"))]


def pictures(a: Address) -> tuple[Column, list[Column]]:
    """A gallery page's picture under every extension."""
    name = F.regexp_extract(F.regexp_replace(a.path, r"(?:/+\.?)+$", ""), "([^/]+)$", 1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    return a.on("imgur.com") & ~a.host.startswith("i.") & (name != ""), [filled(f"https://i.imgur.com/{{}}{e}", stem) for e in PICTURE_EXT]


def proxies(a: Address) -> tuple[Column, list[Column]]:
    return a.on("camo.githubusercontent.com"), [urls.decode_camo(a.path)]


def badges(a: Address) -> tuple[Column, list[Column]]:
    """The address as a picture, the shields' own forms, and the service's form for the first repository that a pattern finds."""
    bare = F.concat(a.scheme, F.lit("://"), a.host, a.path)
    direct = [F.when(~a.path.endswith(e), F.concat(bare, F.lit(e))) for e in (".svg", ".png")]
    shields = [F.when(a.on("shields.io"), a.url), F.when(a.on("shields.io") & ~a.path.endswith(".svg"), F.concat(a.url, F.lit("?style=flat")))]
    repository = F.coalesce(*[F.nullif(F.regexp_extract(a.url, p, 1), F.lit("")) for p in REPOSITORY])
    return a.on(*BADGE_HOSTS), [*direct, *shields, *[F.when(a.on(mark), filled(form, repository)) for mark, form in BADGE_FORMS]]


#: In the order in which candidates are tried.
RULES = [thumbnails, diagrams, drawings, repository_files, shared_files, drives, pictures, proxies, badges]


def special_candidates(url: Column) -> Column:
    """array<string>: what the rules make of an address; empty for a null."""
    a = Address.of(F.coalesce(url, F.lit("")))
    none = F.array().cast("array<string>")
    return F.array_compact(F.concat(*[F.when(holds, F.array(*forms)).otherwise(none) for holds, forms in (rule(a) for rule in RULES)]))
