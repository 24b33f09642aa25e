"""URL normalization as a pure column expression (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The protocols whose URLs are normalized (any letter case);
# anything else passes through unchanged, like a URL the reference's parser
# rejects.
NORMALIZED_PROTOCOLS = ["http", "https", "ftp"]

# A port is a 32-bit number (leading zeros allowed).
PORT = ("0*(?:[0-9]{0,9}|1[0-9]{9}|20[0-9]{8}|21[0-3][0-9]{7}|214[0-6][0-9]{6}|2147[0-3][0-9]{5}"
        "|21474[0-7][0-9]{4}|214748[0-2][0-9]{3}|2147483[0-5][0-9]{2}|21474836[0-3][0-9]|214748364[0-7])")

# protocol :// [userinfo@] host [:port] [path] [?query | #fragment]
# group 1 = protocol, group 2 = host (bracketed IPv6 allowed), group 3 = path.
# An authority with two or more "@" has no host.
URL_PATTERN = (
    r"(?s)^((?i:" + "|".join(NORMALIZED_PROTOCOLS) + r"))://"
    r"(?:[^/?#@]*@[^/?#@]*@[^/?#]*|(?:[^/?#@]*@)?(\[[^\]@]*\]|[^:/?#@]*)(?::" + PORT + r")?)"
    r"((?:/[^?#]*)?)(?:[?#].*)?$"
)

# Dropped around a URL: control characters and blanks, then a "url:" in front.
SURROUNDINGS = r"(?s)^[\x00-\x20]*(?:(?i:url):)?|[\x00-\x20]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_url(url: Column | str) -> Column:
    """protocol://host/path of ``url``; port, user info, query and fragment are
    dropped, the protocol is lower-cased and the host keeps its case; control
    characters and blanks around it and a leading ``url:`` are ignored.

    A URL that does not parse (unknown protocol, a port that is no 32-bit number,
    no ``://``) is returned unchanged; NULL stays NULL. Codegen'd regex
    evaluations, never per-row Python.
    """
    u = _col(url)
    return F.when(_is_plain(u), _head(u)).otherwise(_by_patterns(u))


def _by_patterns(u: Column) -> Column:
    t = F.regexp_replace(u, SURROUNDINGS, "")
    proto = F.regexp_extract(t, URL_PATTERN, 1)       # '' when the URL does not match
    rest = F.regexp_replace(t, URL_PATTERN, "://$2$3")
    return F.when(proto != "", F.concat(F.lower(proto), rest)).otherwise(u)


def _head(u: Column) -> Column:
    """What stands before the query and the fragment."""
    return F.substring_index(F.substring_index(u, "?", 1), "#", 1)


def _is_plain(u: Column) -> Column:
    """True for URLs of which normalization drops just the query and the fragment: told, and
    cut, by searches for single characters, at a small part of the patterns' time. They have a
    lower-case protocol, no user info, port or bracketed host, and nothing to strip at the end."""
    head, last = _head(u), F.substring(u, -1, 1)
    return ((u.startswith("http://") | u.startswith("https://"))
            & (F.locate(":", head, len("https:") + 1) == 0) & (F.locate("@", head) == 0)
            & ~u.contains("://[") & last.between("!", "~"))


def opaque(c: Column) -> Column:
    """A generator giving ``c`` itself, for ``select``.

    The optimizer does not see through it: a URL expression that views are
    grouped and joined by is not copied into every constraint it infers
    (which grows combinatorially), and is computed where it stands.
    """
    return F.explode(F.array(c))


def is_valid_url(url: Column | str) -> Column:
    """True when ``normalize_url`` would rewrite the URL (it parses)."""
    return F.coalesce(F.regexp_replace(_col(url), SURROUNDINGS, "").rlike(URL_PATTERN), F.lit(False))
