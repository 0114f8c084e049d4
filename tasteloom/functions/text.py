"""Text columns with the trimming and splitting rules of JVM strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# Every character up to U+0020.
CONTROLS = "".join(chr(code) for code in range(0x21))


def strip_controls(value: Column | str) -> Column:
    """Trim every character up to U+0020 at both ends; plain ``trim`` strips spaces only."""
    return F.btrim(_col(value), F.lit(CONTROLS))


def delimited(value: Column | str, mark: str) -> Column:
    """Split on one literal character."""
    return F.split(_col(value), "\\" + mark)


def genre_text(genres: Column | str) -> Column:
    """``a|b|c`` as blank-separated words."""
    return F.translate(_col(genres), "|", " ")


def whitespace_tokens(value: Column | str) -> Column:
    """Lower-cased tokens, cut at every single whitespace character.

    Same tokens as ``ml.feature.Tokenizer``: inner and leading blanks give empty
    tokens, trailing empty ones are dropped, and an empty text is one empty token.
    """
    lowered = F.lower(_col(value))
    cut = F.regexp_replace(lowered, r"\s+\z", "")
    only_blanks = (cut == "") & (lowered != "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(F.split(cut, r"\s"))
