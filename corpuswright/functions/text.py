"""Column functions on text: casing, normalisation, words, markup, addresses."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's ``str.split()`` takes for white space.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
_SPACES = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: Horizontal white space that is not one plain space already: a longer run, or another character.
_HORIZONTAL = "[\\t\\x0b\\f\\r\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
_RUN = f"{_HORIZONTAL}(?: |{_HORIZONTAL})*+| (?: |{_HORIZONTAL})++"
#: A word; a word with a letter in it, told from its first character on (so that a run without any is read once).
WORD = r"[^\s\x1c-\x1f\x85\p{Z}]+"
LETTERED = r"(?<![^\s\x1c-\x1f\x85\p{Z}])[^\s\x1c-\x1f\x85\p{Z}\p{L}]*+\p{L}[^\s\x1c-\x1f\x85\p{Z}]*+"
#: Code points below this are never changed by canonical composition.
_COMPOSED_BELOW = r"[^\x00-˿]"


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def nfc(text: Column | str) -> Column:
    """Canonical composition. Only texts with a character that composition can touch are handed to Python."""

    @F.pandas_udf("string")
    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    text = _col(text)
    return F.coalesce(compose(F.when(text.rlike(_COMPOSED_BELOW), text)), text)


def turkish_lower(text: Column | str) -> Column:
    """Lower case with the Turkish pairs of i (dotted with dotted, dotless with dotless), composed or not."""
    # three plain replacements are half the time of a translation by character
    for letter, lower in (("I\u0307", "i"), ("I", "\u0131"), ("\u0130", "i")):
        text = F.replace(_col(text), F.lit(letter), F.lit(lower))
    return F.lower(text)


def turkish_upper(text: Column | str) -> Column:
    return F.upper(F.translate(_col(text), "iı", "İI"))


def turkish_title(text: Column | str) -> Column:
    """First character in upper case, the rest in lower case."""
    text = _col(text)
    return F.concat(turkish_upper(F.substring(text, 1, 1)), turkish_lower(F.substr(text, F.lit(2))))


def strip(text: Column | str) -> Column:
    return F.btrim(_col(text), F.lit(_SPACES))


def collapse(text: Column | str) -> Column:
    """One line: every run of white space is one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), f"{SPACE}+", " "))


def normalize(text: Column | str, composed: bool = True, repair: Callable[[Column], Column] | None = None) -> Column:
    """Repaired by a function of columns, if one is given (for texts that were decoded wrongly), composed, without control and format characters (tab and line ends stay), horizontal white space collapsed, no spaces
    at line ends, at most one blank line in a row, trimmed. Letter case is kept."""
    out = repair(_col(text)) if repair else _col(text)
    out = nfc(out) if composed else out
    out = F.regexp_replace(out, r"[\p{Cc}\p{Cf}&&[^\t\n\r]]+", "")
    out = F.regexp_replace(out, _RUN, " ")
    out = F.regexp_replace(out, " +(?=\n)", "")
    return F.regexp_replace(F.regexp_replace(out, "\n{3,}", "\n\n"), r"\A[ \n]+|[ \n]+\z", "")


def dedup_key(text: Column | str) -> Column:
    """What texts are compared by: composed, Turkish lower case, horizontal white space collapsed, trimmed."""
    return strip(F.regexp_replace(turkish_lower(nfc(text)), _RUN, " "))


def words(text: Column | str) -> Column:
    """Runs of anything but white space, as an array; empty for null."""
    return F.coalesce(F.filter(F.split(_col(text), f"{SPACE}+"), lambda w: w != ""), F.array().cast("array<string>"))


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(_col(text), F.lit(WORD)), F.lit(0)).cast("long")


def stable_unit(key: Column | str) -> Column:
    """A number in [0, 1) that depends on the key alone: the leading 52 bits of its MD5 digest."""
    digest = F.md5(_col(key).cast("string").cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def safe_filename(name: Column | str, fallback: str = "file") -> Column:
    """Letters, digits, dot, dash and underscore stay, runs of others are one underscore; no leading dots, 240 characters."""
    out = F.substring(F.ltrim(F.regexp_replace(_col(name), "[^A-Za-z0-9._-]+", "_"), F.lit(".")), 1, 240)
    return F.when(F.coalesce(out, F.lit("")) == "", fallback).otherwise(out)


#: Elements that stand on lines of their own.
_LINE_TAGS = "p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|main|nav|aside|blockquote|pre|hr|title"
_SILENT = "script|style|head|noscript|template"


def html_text(html: Column | str) -> Column:
    """Text of markup by patterns alone: silent elements and comments go, block tags become line ends, other tags nothing;
    the common entities are decoded; each line is trimmed and empty lines go."""
    out = F.regexp_replace(_col(html), rf"(?is)<!--.*?-->|<({_SILENT})\b[^>]*>.*?</\1\s*>", " ")
    out = F.regexp_replace(out, rf"(?is)</?(?:{_LINE_TAGS})\b[^>]*>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", "")
    for entity, plain in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(plain))
    out = F.regexp_replace(F.regexp_replace(out, r"[ \t\r\f\x0b]+", " "), " ?\n[ \n]*", "\n")
    return F.regexp_replace(out, r"\A[ \n]+|[ \n]+\z", "")


def html_title(html: Column | str) -> Column:
    """The trimmed title, null if there is none."""
    return F.nullif(collapse(F.regexp_extract(_col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def hrefs(html: Column | str) -> Column:
    """Targets of all quoted links, in order, repeats included."""
    return F.regexp_extract_all(_col(html), F.lit(r"(?i)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1))


def url_host(url: Column | str) -> Column:
    """Lower-case host of an http(s) address, null if it is none."""
    return F.nullif(F.lower(F.regexp_extract(_col(url), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:@]+)", 1)), F.lit(""))


def without_www(host: Column | str) -> Column:
    return F.regexp_replace(F.lower(F.trim(_col(host))), r"^www\.", "")


def robots_url(host: Column | str) -> Column:
    return F.concat(F.lit("https://"), F.lower(F.trim(_col(host))), F.lit("/robots.txt"))


#: Addresses of this machine and of private networks.
_PRIVATE = r"^(?:localhost|127\.0\.0\.1|\[?::1\]?|169\.254\..*|10\..*|192\.168\..*|172\.(?:1[6-9]|2\d|3[01])\..*)$"


def is_safe_url(url: Column | str, allowed: tuple[str, ...] = ()) -> Column:
    """http(s), not on this machine or a private network, and on an allowed host if any are named; false when in doubt."""
    host = url_host(url)
    out = host.isNotNull() & ~host.rlike(_PRIVATE)
    if allowed:
        out &= host.isin(*allowed)
    return F.coalesce(out, F.lit(False))
