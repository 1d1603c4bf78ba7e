"""Identifiers and providers read out of streaming and knowledge-base links."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that marks a provider's link, and the name stored for it. A link that carries
# several marks belongs to the first provider listed.
PROVIDERS = {
    "spotify": "spotify",
    "apple": "applemusic",
    "tidal": "tidal",
}
UNKNOWN_PROVIDER = "unknown"

# Patterns of the identifiers. \z and \A are the ends of the whole text: $ would also
# match before a last line break.
_APPLE_TRACK = r"[?&]i=([0-9]+)"
_QUERY_OR_FRAGMENT = r"\A([^?#]*)[?#][^\n]*"
_LAST_PATH_SEGMENT = r"([^/]+)\z"
_LAST_URI_SEGMENT = r"([^/:]+)\z"
_WIKIDATA_ITEM = r"(Q[0-9]+)"


def _column(url: Column | str) -> Column:
    return F.col(url) if isinstance(url, str) else url


def has_provider(url: Column | str) -> Column:
    """True for links of a known provider."""
    link = _column(url)
    return reduce(lambda a, b: a | b, [link.contains(mark) for mark in PROVIDERS])


def url_provider(url: Column | str) -> Column:
    link = _column(url)
    branches = reduce(
        lambda chain, item: chain.when(link.contains(item[0]), F.lit(item[1])), PROVIDERS.items(), F
    )
    return branches.otherwise(F.lit(UNKNOWN_PROVIDER))


def _identifier(link: Column, last_segment: str) -> Column:
    # Only the first query or fragment mark counts, hence the anchor in the pattern.
    bare = F.regexp_replace(link, _QUERY_OR_FRAGMENT, "$1")
    apple_track = link.contains("apple") & link.rlike(_APPLE_TRACK)
    return F.when(apple_track, F.regexp_extract(link, _APPLE_TRACK, 1)).otherwise(
        F.regexp_extract(bare, last_segment, 1)
    )


def url_identifier(url: Column | str) -> Column:
    """Track id of a catalogue link: Apple's ``i=`` parameter, otherwise the last path segment.

    A link that ends in a slash has the empty identifier, not NULL.
    """
    return _identifier(_column(url), _LAST_PATH_SEGMENT)


def history_identifier(uri: Column | str) -> Column:
    """As :func:`url_identifier`, but also reads colon-separated URIs such as ``app:track:id``."""
    return _identifier(_column(uri), _LAST_URI_SEGMENT)


def is_wikidata(url: Column | str) -> Column:
    return _column(url).contains("wikidata.org")


def wikidata_id(url: Column | str) -> Column:
    """First ``Q`` number in a knowledge-base link; the empty string when there is none."""
    return F.regexp_extract(_column(url), _WIKIDATA_ITEM, 1)
