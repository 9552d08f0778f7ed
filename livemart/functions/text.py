"""Tokenizer and term matching for the sale-name search (F8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One token per Han character, otherwise maximal runs of letters/digits.
TOKEN_PATTERN = r"\p{IsHan}|[\p{L}\p{N}&&[^\p{IsHan}]]+"


def tokens(text) -> Column:
    """Lower-cased tokens of ``text`` (array<string>)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


def query_terms(keyword: str) -> Column:
    """Distinct tokens of a search keyword, as a literal-derived array column."""
    return F.array_distinct(tokens(F.lit(keyword or "")))


def matches_all(text_tokens: Column, terms: Column) -> Column:
    """Every query term occurs in the text (AND); an empty query matches nothing."""
    return (F.size(terms) > 0) & (F.size(F.array_except(terms, text_tokens)) == 0)


def term_hits(text_tokens: Column, terms: Column) -> Column:
    """Relevance: how many tokens of the text are query terms."""
    return F.size(F.filter(text_tokens, lambda t: F.array_contains(terms, t)))
