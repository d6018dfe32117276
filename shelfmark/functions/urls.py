"""Repository ids and urls."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import constants as K
from .text import any_of, col, java_quote, strip

ID_PREFIX = K.PLATFORM + ":"
WEB_PREFIX = f"https://{K.HOST}/"

_HOSTS = "(?:" + "|".join(java_quote(h) for h in (K.HOST, *K.HOST_ALIASES)) + ")"
_ON_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//" + _HOSTS
_H = java_quote(K.HOST)

# Five accepted spellings as one pattern. Spellings that end in .git lose it; the others keep
# their path. Owner and name are groups 1 and 2, or 3 and 4; a path needs text behind the owner.
_SPELLINGS = (
    rf"^(?:(?:git@{_H}:|git://{_H}/|https://{_H}/)([^/]*)/(?=/*[^/].*\.git$)([^/]*?)(?:/.*)?\.git"
    rf"|(?:git@ssh\.{_H}:/|https://{_H}/)([^/]*)/(?=/*[^/])([^/]*)(?:/.*)?)$"
)
_SPELLED_ID = ID_PREFIX + "$1$3/$2$4"

# A web url: first two path parts; edge slashes, one .git at the path's end, parameters of the
# last part, query and fragment do not count.
_WEB_URL = (
    _ON_HOST + r"/+([^/?#]+)/(?:\.git|/+[^/?#][^?#]*?|([^/?#;][^/?#]*?)(?:/[^?#]*?)?(?:\.git)?)"
    r"/*(?:;[^/?#]*)?(?:[?#].*)?$"
)
_SSH_URL = rf"^git@{_H}:([^/]+)/([^/]+?)(?:\.git)?$"
_TWO_PART_ID = f"^{ID_PREFIX}([^/]*)/([^/]*)$"


def repository_id(owner: Column | str, name: Column | str) -> Column:
    return F.concat(F.lit(ID_PREFIX), F.lower(strip(owner)), F.lit("/"), F.lower(strip(name)))


def normalize_url(url: Column | str) -> Column:
    """Id for the five accepted spellings, else the url without trailing slashes; null -> ''."""
    u = strip(F.coalesce(col(url), F.lit("")))
    return F.when(u.rlike(_SPELLINGS), F.lower(F.regexp_replace(u, _SPELLINGS, _SPELLED_ID))).otherwise(
        F.rtrim(u, F.lit("/")))


def _web(url: Column | str) -> Column:
    """A url as parsers read it: no leading blanks, no tabs or line ends."""
    return F.ltrim(F.translate(col(url), "\t\r\n", ""))


def is_catalog_url(url: Column | str) -> Column:
    return F.coalesce(_web(url).rlike(_ON_HOST + r"(?:[/?#]|$)"), F.lit(False))


def canonical_https(url: Column | str) -> Column:
    """Https url without suffix, query and fragment; foreign urls unchanged."""
    path = F.regexp_replace(F.regexp_extract(_web(url), _ON_HOST + r"/([^?#]*)", 1), r";[^/]*$", "")
    bare = F.regexp_replace(F.btrim(path, F.lit("/")), r"\.git$", "")
    return F.when(is_catalog_url(url), F.concat(F.lit(WEB_PREFIX), bare)).otherwise(col(url))


def id_from_url(url: Column | str) -> Column:
    """Id from any web or ssh url of the catalog host, else null."""
    web, ssh = _web(url), col(url)
    to_id = lambda u, pattern: F.when(u.rlike(pattern), F.lower(F.regexp_replace(u, pattern, ID_PREFIX + "$1/$2")))
    return F.coalesce(to_id(web, _WEB_URL), to_id(ssh, _SSH_URL))


def id_from_link(url: Column | str) -> Column:
    """As :func:`id_from_url`, also accepting the short ``platform:owner/name`` form."""
    u = strip(url)
    expanded = F.concat(F.lit(WEB_PREFIX), F.substr(u, F.lit(len(ID_PREFIX) + 1)))
    return id_from_url(F.when(u.startswith(ID_PREFIX), expanded).otherwise(u))


def split_id(rid: Column | str) -> Column:
    """``struct(owner, name)``; null when malformed."""
    c = col(rid)
    part = lambda i: F.regexp_extract(c, _TWO_PART_ID, i)
    return F.when(c.rlike(_TWO_PART_ID), F.struct(part(1).alias("owner"), part(2).alias("name")))


def url_from_id(rid: Column | str) -> Column:
    """Canonical url; null when the id is malformed."""
    c = col(rid)
    return F.when(c.rlike(_TWO_PART_ID), F.regexp_replace(c, f"^{ID_PREFIX}", WEB_PREFIX))


def display_path(owner: Column | str, name: Column | str) -> Column:
    return F.concat_ws("/", col(owner), col(name))


def is_list_name(name: Column | str) -> Column:
    lowered = F.lower(col(name))
    return any_of([lowered.startswith(K.LIST_WORD), lowered.contains("-" + K.LIST_WORD)])


def is_list_url(url: Column | str) -> Column:
    """Url of a curated list, judged by its repository name.

    A name with the list word as one of its dashed tokens starts with it or has it behind a dash.
    """
    name = F.lower(F.regexp_extract(_web(url), _WEB_URL, 2))
    return F.coalesce(name.rlike(f"(?:^|-){K.LIST_WORD}"), F.lit(False))


def is_list_hit(name, description, topics) -> Column:
    """Curated-list test on the fields of a search hit."""
    text = F.lower(F.coalesce(col(description), F.lit("")))
    return any_of(
        [is_list_name(name), F.array_contains(col(topics), K.LIST_TOPIC)]
        + [text.contains(phrase) for phrase in K.LIST_PHRASES]
    )


def is_list_record(name, description, topics, url) -> Column:
    return is_list_hit(name, description, topics) | is_list_url(url)


def package_name(c: Column | str) -> Column:
    """Lower case, with runs of separators joined to one dash; null -> ''."""
    return F.regexp_replace(F.lower(strip(F.coalesce(col(c), F.lit("")))), "[-_.]+", "-")


def package_candidates(name: Column | str, extra: Column | str) -> Column:
    """Normalized own name first, then extra package names; unique, blanks dropped."""
    own = F.array(col(name))
    names = F.transform(F.concat(own, F.coalesce(col(extra), F.array().cast("array<string>"))), package_name)
    return F.array_distinct(F.filter(names, lambda n: n != ""))
