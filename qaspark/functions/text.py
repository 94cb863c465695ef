"""Text column expressions; everything here stays on the JVM."""

from __future__ import annotations

import html
import html.entities
import json

from pyspark.sql import Column
from pyspark.sql import functions as F

from qaspark.fixed_values import DOMAIN_STOPWORDS, ENGLISH_STOPWORDS, ERROR_PATTERNS

# All code points that count as white space; `trim` and `\s` know fewer.
WHITESPACE = "\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def collapse_whitespace(c: Column | str) -> Column:
    return strip(F.regexp_replace(_col(c), f"[{WHITESPACE}]+", " "))


# --- HTML -----------------------------------------------------------------------

_NUMBER = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?"
# In titles a name runs up to the next separator and may match by its beginning; in markup it is
# a word and matches as a whole.
_IN_TITLE = rf"(?s)({_NUMBER}|&[^\t\n\f <&#;]{{1,32}};?|[^&]+|&)"
_IN_MARKUP = rf"(?s)({_NUMBER}|&[a-zA-Z][-.a-zA-Z0-9]*;?|[^&]+|&)"

# HTML names that may stand without a semicolon, longest first, as one alternation.
_OPEN_NAMES = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _literal_map(entries: dict) -> Column:
    """A constant map column (folded once by the optimizer, cheap to analyse)."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def _decode_number(piece: Column) -> Column:
    hexadecimal = piece.rlike("^&#[xX]")
    digits = F.regexp_extract(piece, "^&#[xX]?([0-9a-fA-F]+)", 1)
    code = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
    # 0x80-0x9f and 0x0d are read as Windows-1252 and carriage return.
    legacy = {str(i): html.unescape(f"&#{i};") for i in [0x0D, *range(0x80, 0xA0)]}
    in_plane = code.bitwiseAND(F.lit(0xFFFF))
    return (
        F.when(
            code.isNull() | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF),
            F.lit("\ufffd"),
        )
        .when((code == 0x0D) | code.between(0x80, 0x9F), F.try_element_at(_literal_map(legacy), code.cast("string")))
        .when(
            code.between(0x01, 0x08)
            | code.between(0x0E, 0x1F)
            | code.isin(0x0B, 0x7F)
            | code.between(0xFDD0, 0xFDEF)
            | (in_plane >= 0xFFFE),
            F.lit(""),
        )
        .otherwise(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    )


def _decode_piece(piece: Column, by_beginning: bool) -> Column:
    names = _literal_map(html.entities.html5)
    common = _literal_map({n: html.entities.html5[n] for n in ("amp;", "lt;", "gt;", "quot;", "nbsp;")})
    # A map is searched from its start: most entities are found in the short one.
    name = F.substring(piece, 2, 64)
    exact = F.coalesce(F.try_element_at(common, name), F.try_element_at(names, name))
    prefix = F.regexp_extract(piece, f"^&({'|'.join(_OPEN_NAMES)})", 1)
    by_prefix = F.concat(
        F.try_element_at(names, prefix),
        F.substr(piece, F.length(prefix) + F.lit(2)),
    )
    return (
        F.when(~piece.startswith("&") | (F.length(piece) < 2), piece)
        .when(piece.rlike("^&#"), _decode_number(piece))
        .otherwise(F.coalesce(exact, by_prefix, piece) if by_beginning else F.coalesce(exact, piece))
    )


def unescape_html(c: Column | str, in_markup: bool = False) -> Column:
    """Decode every HTML entity exactly once (``&amp;lt;`` becomes ``&lt;``)."""
    c = _col(c)
    pieces = F.regexp_extract_all(c, F.lit(_IN_MARKUP if in_markup else _IN_TITLE), 0)
    decoded = F.transform(pieces, lambda piece: _decode_piece(piece, not in_markup))
    return F.when(F.instr(c, "&") > 0, F.array_join(decoded, "")).otherwise(c)


#: The rest of a tag: a ``>`` inside quotes does not end it. Possessive, so that a long tag costs one pass.
_ATTRIBUTES = r"""(?:[^>"']|"[^"]*"|'[^']*')*+"""


def html_to_text(c: Column | str) -> Column:
    """Visible text of an HTML fragment, words parted by one space."""
    c = _col(c)
    for pattern in (
        rf"(?is)<script{_ATTRIBUTES}>.*?</script[^>]*>",
        rf"(?is)<style{_ATTRIBUTES}>.*?</style[^>]*>",
        rf"(?is)<template{_ATTRIBUTES}>.*?</template[^>]*>",
        r"(?s)<!--.*?-->",
        r"(?s)<!\[CDATA\[.*?\]\]>",
        r"<\?[^>]*>",
        rf"<!?/?[A-Za-z]{_ATTRIBUTES}>",
    ):
        c = F.regexp_replace(c, pattern, " ")
    return collapse_whitespace(unescape_html(c, in_markup=True))


def clean_body(c: Column | str) -> Column:
    """Text of a post body with all white space collapsed; null stays null."""
    return html_to_text(c)


# --- tags and titles ------------------------------------------------------------

def parse_tags(c: Column | str) -> Column:
    """``"['a', 'b']"`` -> ``[a, b]``; null gives an empty list."""
    c = _col(c)
    inner = F.regexp_replace(F.regexp_replace(c, r"^[\[\]]+|[\[\]]+$", ""), "'", "")
    return F.coalesce(F.split(inner, ", "), F.array().cast("array<string>"))


def text_combined(title: Column | str, tags: Column | str) -> Column:
    """Title, one space, and the tags with ``-`` turned into ``_``."""
    words = F.transform(_col(tags), lambda t: F.replace(t, F.lit("-"), F.lit("_")))
    joined = F.coalesce(F.array_join(words, " "), F.lit(""))
    return F.concat(F.coalesce(_col(title), F.lit("")), F.lit(" "), joined)


def error_names(c: Column | str, patterns: list[str] = ERROR_PATTERNS) -> Column:
    """All error class names in the text, in order, repeats kept."""
    return F.regexp_extract_all(_col(c), F.lit("(" + "|".join(patterns) + ")"), 1)


# --- words ----------------------------------------------------------------------

def default_stopwords() -> list[str]:
    """English stop words and the domain words."""
    return sorted({*ENGLISH_STOPWORDS, *DOMAIN_STOPWORDS})


def without(words: Column, stopwords: list[str]) -> Column:
    """Drop the stop words and keep repeats of the others."""
    return F.filter(words, lambda w: ~w.isin(*stopwords)) if stopwords else words


def words(c: Column | str) -> Column:
    """Lower-case words of letters only; code in backticks is left out."""
    c = F.lower(F.regexp_replace(_col(c), "`[^`]+`", " "))
    c = F.regexp_replace(c, r"([,:;@#$%&?!()\[\]{}<>\"]|--)", " $1 ")
    c = F.regexp_replace(c, r"(n't|'s|'m|'d|'ll|'re|'ve)([^\p{L}\p{N}_]|$)", " $1$2")
    # One pass over the text, not one per word: letters up to white space, less full stops and quotes at their end. Other words are
    # taken whole and give an empty string.
    found = F.regexp_extract_all(c, F.lit(rf"([a-z\p{{L}}]++)[.'\"]*+(?![^{WHITESPACE}])|[^{WHITESPACE}]++"), 1)
    return F.array_remove(found, "")


def tokenize(c: Column | str, stopwords: list[str] | None = None) -> Column:
    return without(words(c), default_stopwords() if stopwords is None else stopwords)


def removed_words(c: Column | str, stopwords: list[str] | None = None) -> Column:
    """The distinct words that stop-word removal takes out."""
    raw = words(c)
    return F.array_except(raw, without(raw, default_stopwords() if stopwords is None else stopwords))


def kept_words(c: Column | str, stopwords: list[str] | None = None) -> Column:
    """Lower-case words of two or more letters, digits or ``_``, stop words out."""
    found = F.regexp_extract_all(F.lower(F.coalesce(_col(c), F.lit(""))), F.lit(r"([\p{L}\p{N}_]{2,})"), 1)
    return without(found, default_stopwords() if stopwords is None else stopwords)


def with_pairs(kept: Column | str) -> Column:
    """The words, then every two neighbours joined by a space."""
    kept = _col(kept)
    # Zip the list with itself shifted by one; the last word finds no partner and drops out.
    shifted = F.slice(kept, F.lit(2), F.greatest(F.size(kept), F.lit(1)))
    pairs = F.zip_with(kept, shifted, lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(kept, F.filter(pairs, lambda p: p.isNotNull()))
