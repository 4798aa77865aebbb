"""Column functions: predicates, number parsing, hash noise, tokens and n-grams."""

from fundscape.functions.noise import normal, uniform
from fundscape.functions.numbers import parse_eu_number, to_number
from fundscape.functions.predicates import contains_any, holds, lacks, matches_any, starts_with_any
from fundscape.functions.text import clip, fill_template, ngrams, tokens

__all__ = [
    "clip",
    "contains_any",
    "fill_template",
    "holds",
    "lacks",
    "matches_any",
    "ngrams",
    "normal",
    "parse_eu_number",
    "starts_with_any",
    "to_number",
    "tokens",
    "uniform",
]
