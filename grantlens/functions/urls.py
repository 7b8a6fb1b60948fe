"""Web address expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"

# ---- fixed values: endings of files that are no pages --------------------------
FILE_ENDINGS = tuple(
    # archives
    "7z bz2 gz rar tar xz zip "
    # images and drawings
    "ai bmp cdr drw dxf eps gif ico jpeg jpg png ps svg tif tiff webp "
    # sound and moving pictures
    "aac aiff avi flv m4a m4v mid mov mp3 mp4 mpg ogg wav webm wma wmv "
    # documents
    "doc docx odp ods odt pdf pps ppt pptx xls xlsx "
    # others
    "apk bin css dmg exe iso jar js msi rss".split()
)
DEFAULT_PORTS = {"http": "80", "https": "443"}
# -----------------------------------------------------------------------------


def absolute_url(base: Column, href: Column) -> Column:
    """Address of a link on a page, made absolute."""
    scheme = F.regexp_extract(base, _SCHEME, 1)
    site = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"^([^?#]*)", 1)
    without_fragment = F.regexp_extract(base, r"^([^#]*)", 1)
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    above = F.split(F.substring(page, F.length(site) + 1, F.length(page)), "/", -1)
    folder = F.when(F.element_at(above, -1) == "", above).otherwise(
        F.slice(above, F.lit(1), F.size(above) - 1)
    )
    own = F.split(path, "/", -1)
    segments = F.when(F.startswith(href, F.lit("/")), own).otherwise(F.concat(folder, own))
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(href == "", base)
        .when(F.startswith(href, F.lit("?")), F.concat(page, href))
        .when(F.startswith(href, F.lit("#")), F.concat(without_fragment, href))
        .otherwise(F.concat(site, _folded(segments), rest))
    )


def _folded(segments: Column) -> Column:
    """Path of segments with steps up and stays taken, and empty ones inside left out."""

    def fold(given):
        last = F.element_at(given, -1)
        inside = F.filter(F.slice(given, F.lit(2), F.greatest(F.size(given) - 2, F.lit(0))), lambda s: s != "")
        kept = F.when(F.size(given) > 1, F.concat(F.array(given[0]), inside, F.array(last))).otherwise(given)

        def step(path, segment):
            up = F.slice(path, F.lit(1), F.greatest(F.size(path) - 1, F.lit(0)))
            return (
                F.when(segment == "..", up)
                .when(segment == ".", path)
                .otherwise(F.concat(path, F.array(segment)))
            )

        walked = F.aggregate(kept, F.array().cast("array<string>"), step)
        joined = F.array_join(
            F.when(last.isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked), "/"
        )
        return F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))

    # The segments are named once, however often they are used.
    return F.transform(F.array(segments), fold)[0]


def normal_form(url: Column, keep_fragment: bool = False) -> Column:
    """One form for addresses that name the same page; applied again it changes nothing.

    Scheme and host in lower case, no default port, ``/`` for an empty path, parameters in the order of
    their names and values without empty ones, percent escapes in upper case, no fragment unless it is
    kept.  Characters beyond ASCII stay as they are.  Addresses without a host only have their scheme
    lowered and their fragment left out; NULL stays NULL.
    """

    def form(given):
        scheme = F.lower(F.regexp_extract(given, _SCHEME, 1))
        fragment = F.regexp_extract(given, r"(?s)^[^#]*(#.+)$", 1) if keep_fragment else F.lit("")
        body = F.regexp_extract(given, r"^([^#]*)", 1)
        rest = F.regexp_replace(body, _SCHEME, "")
        authority = F.regexp_extract(rest, r"^//([^/?]*)", 1)
        user = F.regexp_extract(authority, r"^(.*@)", 1)
        site = F.lower(F.regexp_extract(authority, r"^(?:.*@)?(.*)$", 1))
        usual = [(scheme == name) & site.rlike(f":{port}$") for name, port in DEFAULT_PORTS.items()]
        named = F.when(reduce(lambda a, b: a | b, usual) | F.endswith(site, F.lit(":")), F.regexp_replace(site, ":[0-9]*$", "")).otherwise(site)
        path = F.regexp_extract(rest, r"^//[^/?]*([^?]*)", 1)
        query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
        parameters = F.transform(
            F.array_sort(
                F.transform(
                    F.filter(F.split(_escapes_raised(query), "&", -1), lambda p: p != ""),
                    lambda p: F.struct(F.substring_index(p, "=", 1).alias("name"), p.alias("whole")),
                )
            ),
            lambda p: p["whole"],
        )
        ordered = F.array_join(parameters, "&")
        whole = F.concat(
            scheme, F.lit("://"), user, named,
            F.when(path == "", F.lit("/")).otherwise(_escapes_raised(path)),
            F.when(ordered == "", F.lit("")).otherwise(F.concat(F.lit("?"), ordered)),
            fragment,
        )
        without_host = F.concat(scheme, F.substring(body, F.length(scheme) + 1, F.length(body)), fragment)
        return F.when(authority == "", without_host).otherwise(whole)

    # The address is named once, however often it is used.
    return F.transform(F.array(url), lambda given: F.when(given.isNotNull(), form(given)))[0]


def _escapes_raised(text: Column) -> Column:
    """Percent escapes in upper case."""
    pieces = F.split(text, "%", -1)
    raised = F.transform(
        pieces,
        lambda piece, at: F.when(
            (at > 0) & piece.rlike("^[0-9A-Fa-f]{2}"),
            F.concat(F.upper(F.substring(piece, 1, 2)), F.substring(piece, F.lit(3), F.length(piece))),
        ).otherwise(piece),
    )
    return F.array_join(raised, "%")


def has_ending(url: Column, endings: Sequence[str] = FILE_ENDINGS) -> Column:
    """Whether the path of an address ends like a file of one of the kinds, in any case."""
    path = F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1)).isin(*endings)


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def on_domain(url: Column, domains: Sequence[str]) -> Column:
    """Whether the host is one of the domains or below one of them."""
    name = host(url)
    tests = [
        (name == domain.lower()) | F.endswith(name, F.lit("." + domain.lower()))
        for domain in domains
    ]
    return reduce(lambda left, right: left | right, tests)


def is_page(url: Column) -> Column:
    return url.rlike(r"(?i)^(https?|ftp|file)://")
