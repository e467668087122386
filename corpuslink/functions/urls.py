"""URL rules as native Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Parts of a URL as laid out in RFC 3986, appendix B: scheme 2, host 4, path 5, query 7, fragment 9.
_PARTS = r"(?s)^(([a-zA-Z][a-zA-Z0-9+.-]*):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?$"

# Endings that mark a bare host name.
HOST_ENDINGS = [".edu", ".org", ".com", ".net"]


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def is_absolute_url(url: Column) -> Column:
    """True when the URL names a host."""
    return F.coalesce(_part(url, 4) != "", F.lit(False))


def remove_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "(?s)#.*$", "")


def _merged_path(base_path: Column, path: Column) -> Column:
    """Path of a relative reference merged with the path of its base, dot segments resolved."""
    folder = F.regexp_replace(base_path, "[^/]+$", "")
    joined = F.when(path.startswith("/"), path).when(folder == "", F.concat(F.lit("/"), path)).otherwise(
        F.concat(folder, path)
    )
    squeezed = F.when(path.startswith("/"), joined).otherwise(F.regexp_replace(joined, "/{2,}", "/"))
    parts = F.split(squeezed, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    open_end = F.when(squeezed.rlike(r"(^|/)\.\.?$"), F.array(F.lit(""))).otherwise(
        F.array().cast("array<string>")
    )
    merged = F.array_join(F.concat(kept, open_end), "/")
    return F.when(merged.startswith("/"), merged).otherwise(F.concat(F.lit("/"), merged))


def _relative(base: Column, link: Column) -> Column:
    scheme, path, query, fragment = _part(link, 2), _part(link, 5), _part(link, 7), _part(link, 9)
    foreign = (scheme != "") & (F.lower(scheme) != F.lower(_part(base, 2)))
    new_path = F.when(path == "", _part(base, 5)).otherwise(_merged_path(_part(base, 5), path))
    new_query = F.when((path == "") & (query == ""), _part(base, 7)).otherwise(query)
    scheme_of_base = F.when(_part(base, 2) == "", "").otherwise(F.concat(F.lower(_part(base, 2)), F.lit(":")))
    return F.when(foreign, link).otherwise(
        F.concat(
            scheme_of_base,
            F.lit("//"),
            _part(base, 4),
            new_path,
            F.when(new_query == "", "").otherwise(F.concat(F.lit("?"), new_query)),
            F.when(fragment == "", "").otherwise(F.concat(F.lit("#"), fragment)),
        )
    )


def resolve_link(page_url: Column, link: Column) -> Column:
    """Absolute URL of a link found on a page; null for an empty link or a page without host.

    Links that start with a bare host name (known ending, or ``www``) only lack the scheme.
    """
    path = _part(link, 5)
    first = F.regexp_extract(path, "^[^/]*", 0)
    first = F.when(path.contains("/"), first).otherwise(F.regexp_extract(first, "^[^;]*", 0))
    bare_host = F.right(first, F.lit(4)).isin(HOST_ENDINGS) | link.startswith("www")
    return F.when(
        (link != "") & is_absolute_url(page_url),
        F.when(is_absolute_url(link), link)
        .when(bare_host, F.concat(F.lit("http://"), link))
        .otherwise(_relative(page_url, link)),
    )


def process_link(page_url: Column, link: Column) -> Column:
    """Resolved link without its fragment."""
    return remove_fragment(resolve_link(page_url, link))


def is_ok_to_follow(url: Column, domain: str, excluded_prefixes: Sequence[str] = ()) -> Column:
    """True for http(s) pages inside ``domain``: no mail address, query or fragment, outside the
    excluded prefixes, and a path without extension or ending in ``.html``."""
    host = _part(url, 4)
    name = F.regexp_extract(_part(url, 5), "[^/]*$", 0)
    name = F.regexp_replace(F.regexp_extract(name, "^[^;]*", 0), r"^\.+", "")
    extension = F.regexp_extract(name, r"\.[^.]*$", 0)
    ok = (
        ~url.contains("mailto:")
        & ~url.contains("@")
        & F.lower(_part(url, 2)).isin("http", "https")
        & (host != "")
        & (_part(url, 7) == "")
        & (_part(url, 9) == "")
        & ((host == domain) | host.endswith("." + domain))
        & extension.isin("", ".html")
    )
    for prefix in excluded_prefixes:
        ok = ok & ~url.startswith(prefix)
    return F.coalesce(ok, F.lit(False))
