"""Tokens, n-grams, clipping and text templates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Runs of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column, stop_words: Sequence[str] = (), pattern: str = TOKEN) -> Column:
    """Lower-case tokens of a text in order, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*stop_words)) if stop_words else words


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring words, joined by blanks.

    ``words`` should be a plain column: neighbours are read by position, in constant
    time each, so the cost is linear in the text."""
    if n == 1:
        return words
    starts = F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))
    return F.transform(
        starts, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + j) for j in range(1, n)])
    )


def clip(col: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), col))


def fill_template(template: str, **fields: Column) -> Column:
    """Fill ``{name}`` places of a template with columns."""
    filled = F.lit(template)
    for name, value in fields.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value.cast("string"))
    return filled
