"""Text cleaning."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Every character Python calls whitespace: the Unicode White_Space property
# (Java's \s only under the U flag) and the four separators U+001C..U+001F.
_SPACE = r"[\s\x1C-\x1F]"
# The same characters one by one, to cut them off without a pattern.
_SPACES = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
                            0x2029, 0x202F, 0x205F, 0x3000)))


# Usual references, the ampersand's own last: what it leaves is not read again.
_USUAL_REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&#x2F;", "/"),
                     ("&nbsp;", "\u00a0"), ("&amp;", "&"))


@F.pandas_udf(T.StringType())
def _html_unescape(values: pd.Series) -> pd.Series:
    if values.isna().all():
        return values
    return pd.Series([None if pd.isna(text) else html.unescape(text) for text in values], dtype=object)


# Declared so to be evaluated exactly once where it stands: a deterministic UDF
# is copied into every filter and expression that uses its result.
_unescape_once = _html_unescape.asNondeterministic()


def unescape(text: Column) -> Column:
    """Resolve HTML character references.

    The 2,231 HTML5 names and their prefix rules live in Python's standard
    library, so this is the one Arrow UDF of the package. Only texts with an
    ampersand that begins none of the usual references are sent to it; all
    others cross as nulls and stay in the JVM. No usual reference can come out
    of replacing another, for none of their characters ends or goes on a name.
    """
    usual = text
    for name, character in _USUAL_REFERENCES[:-1]:
        usual = F.replace(usual, F.lit(name), F.lit(character))
    name, character = _USUAL_REFERENCES[-1]
    strange = F.replace(usual, F.lit(name), F.lit("")).contains("&")
    return F.coalesce(_unescape_once(F.when(strange, text)), F.replace(usual, F.lit(name), F.lit(character)))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(_SPACES))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def squeeze(text: Column) -> Column:
    """Squeeze whitespace, trim; empty becomes null."""
    return blank_to_null(F.trim(F.regexp_replace(text, f"(?U){_SPACE}+", " ")))


def clean_text(text: Column) -> Column:
    """Unescape, squeeze whitespace, trim; empty becomes null. Tags stay."""
    return squeeze(unescape(text))


def clean_html(text: Column) -> Column:
    """As clean_text, but tags are removed, also those that were escaped."""
    return squeeze(F.regexp_replace(unescape(text), "<[^>]+>", " "))
