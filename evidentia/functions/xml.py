"""Claims out of patent XML as Columns. A claim is independent if it names no other: a relation between a claim and its text, so claims become an array and those that
refer to another are filtered from it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from evidentia.functions.text import unescaped

#: What begins a numbered unit, and a reference to other claims.
NUMBER, REFERENCE = r"^\s*\d+\.\s", r"(?i)\bclaims?\s+\d+"


def _inside(c: Column, tag: str) -> Column:
    """What stands in each element of a name, whatever its prefix; elements of one name are taken as not nested."""
    return F.regexp_extract_all(c, F.lit(rf"(?s)<(?:[\w.-]+:)?{tag}(?:\s[^>]*)?>(.*?)</(?:[\w.-]+:)?{tag}\s*>"), F.lit(1))


def plain(c: Column) -> Column:
    """Text without tags, its white space single."""
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(c, "<[^>]*>", "")), r"\s+", " "))


def numbered(lines: Column) -> Column:
    """Lines joined to units; a unit begins at a line with a number (and the first at the first line)."""
    marked = F.transform(lines, lambda x: F.when(x.rlike(NUMBER), F.concat(F.lit("\x01"), x)).otherwise(x))
    return F.filter(F.transform(F.split(F.array_join(marked, " "), "\x01"), lambda x: F.trim(x)), lambda x: x != "")


def independent_claims(c: Column) -> Column:
    """Claims that do not refer to another: those of the elements ``claim``, without the ones that hold a ``claim-ref``; a single ``claim`` with several ``claim-text`` is a list of numbered units.
    Without claims, and of null, an empty array."""
    bodies = _inside(F.coalesce(c, F.lit("")), "claim")
    lines = F.transform(_inside(F.element_at(bodies, 1), "claim-text"), plain)
    one_by_one = F.transform(F.filter(bodies, lambda x: ~x.rlike(r"<(?:[\w.-]+:)?claim-ref\b")), plain)
    is_list = (F.size(bodies) == 1) & (F.size(F.when(F.size(bodies) == 1, lines)) > 1)
    texts = F.when(is_list, numbered(lines)).otherwise(one_by_one)
    return F.filter(texts, lambda x: ~x.rlike(REFERENCE))
