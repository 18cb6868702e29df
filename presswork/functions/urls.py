"""Article keys and URL removal."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from presswork.functions.constants import (
    SPACE_CHARS,
    URL_TRAILING_PUNCTUATION,
    WORD_CHARS,
)


def article_key(url: Column) -> Column:
    """Key of an article: MD5 hex of its URL."""
    return F.md5(url)


# A URL is a head, then units, the last of which must be a "closing" unit. A unit is one visible
# character or one parenthesised group (nested two deep); a closing unit is any unit that is not
# sentence punctuation. Characters and groups never start alike, so repeats can be possessive.
# Head characters are units too: once a head and enough units are known to follow, the URL is
# simply all units up to the last closing one.
_CHAR = rf"[^{SPACE_CHARS}()<>]"
_CLOSING = rf"[^{SPACE_CHARS}()<>{URL_TRAILING_PUNCTUATION}]"
_GROUP = rf"\((?:{_CHAR}++|\({_CHAR}++\))*+\)"
_UNITS = rf"(?:{_CHAR}|{_GROUP})(?:[{URL_TRAILING_PUNCTUATION}]*+(?:{_CLOSING}++|{_GROUP}))++"
_ENOUGH = rf"(?:{_CHAR}|{_GROUP})[{URL_TRAILING_PUNCTUATION}]*+(?:{_CLOSING}|{_GROUP})"

# A head starts at a word boundary. All starts within one run of head characters share the end
# of the run, so only the first start of a run is tried, from the run's beginning: a text is
# searched in linear time, however long its runs are.
_WORD = rf"[{WORD_CHARS}]"
_SCHEME = (  # run of words and hyphens; first word that starts with a letter; colon
    rf"(?<![{WORD_CHARS}-])(?:-++|(?![a-z]){_WORD}++)*+"
    rf"(?=[a-z][{WORD_CHARS}-]++:[/a-z0-9%]{_ENOUGH})"
)
_DOMAIN = (  # run of letters, digits, dots and hyphens; first word boundary; ends in .tld/
    rf"(?<![a-z0-9.-])(?:(?<!{_WORD})[.-]*+(?=[a-z0-9])|(?<={_WORD})[a-z0-9]*+(?=[.-]))"
    rf"(?=[a-z0-9.-]+[.][a-z]{{2,4}}/{_ENOUGH})"
)
_WWW = rf"(?<!{_WORD})(?=www\p{{Nd}}{{0,3}}+[.]{_ENOUGH})"

# Group 1 is the URL.
URL_PATTERN = rf"(?iu)(?:{_SCHEME}|{_DOMAIN}|{_WWW})({_UNITS})"


# No URL spans these, so a text is searched piece by piece.
_GAP = rf"[{SPACE_CHARS}<>]+"


def _may_hold_url(piece: Column) -> Column:
    """Cheap test: every head has a ":" or a "/", or is "www" and a dot."""
    www = piece.contains(".") & F.lower(piece).contains("www")
    return piece.contains(":") | piece.contains("/") | www


def find_urls(text: Column) -> Column:
    """All URLs of a text, in order, repeats kept."""
    pieces = F.filter(F.split(text, _GAP), _may_hold_url)
    found = F.transform(pieces, lambda p: F.regexp_extract_all(p, F.lit(URL_PATTERN), F.lit(1)))
    return F.flatten(found)


def remove_urls(text: Column) -> Column:
    """Delete every occurrence of every found URL, one URL after the other.

    Deletion is by string, so a short URL also cuts a longer one that starts with it.
    """
    return F.aggregate(find_urls(text), text, lambda rest, url: F.replace(rest, url, F.lit("")))
