"""Name parsing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern: characters kept in a cleaned name. The letter ё/Ё lies outside the range and becomes a space.
NOT_NAME = "[^A-Za-z0-9А-Яа-я]+"
# Tokens (spaces removed) that mean another platform name. The last two start with look-alike letters:
# Latin p with Cyrillic es, and Cyrillic er.
TYPE_SPELLINGS = {"x360": "xbox360", "": "mac", "pс": "pc", "рs3": "ps3"}


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def token(name: str | Column, position: int) -> Column:
    """Space-separated token, counted from 1; NULL when there are fewer."""
    return F.try_element_at(F.split(_col(name), " "), F.lit(position))


def first_word(name: str | Column) -> Column:
    """First run of non-space text that is followed by a space; NULL without one."""
    return _blank_to_null(F.regexp_extract(_col(name), r"(\S+)\s", 1))


def subtype(name: str | Column) -> Column:
    """Trimmed text between the first and second dash, or the whole trimmed name without a dash."""
    parts = F.split(_col(name), "-")
    return F.trim(F.coalesce(F.try_element_at(parts, F.lit(2)), F.try_element_at(parts, F.lit(1))))


def greedy_prefix(name: str | Column) -> Column:
    """Longest text before white space and a dash; NULL without one."""
    return _blank_to_null(F.regexp_extract(_col(name), r"([\s\S]+)\s-", 1))


def multi_match(name: str | Column, needles: Sequence[str], none: str = "None") -> Column:
    """All needles found in the name, joined in the order given."""
    c = _col(name)
    found = F.concat_ws("", *[F.when(c.contains(n), F.lit(n)) for n in needles])
    return F.when(found == "", F.lit(none)).otherwise(found)


def contains_flag(name: str | Column, marker: str) -> Column:
    return F.instr(_col(name), marker) > 0


def _after(name: Column, mark: str) -> Column:
    at = F.instr(name, mark)
    return F.when(at > 0, F.substr(name, at + 1))


def _words(c: Column) -> Column:
    return F.lower(F.regexp_replace(c, NOT_NAME, " "))


def bracket_part(name: str | Column) -> Column:
    """Cleaned text after the first '[' without its last character; '0' when there is none.

    A text that reads '0' itself keeps its only character.
    """
    shortened = F.regexp_replace(_words(_after(_col(name), "[")), "^(?!0$)(.*).$", "$1")
    return F.coalesce(shortened, F.lit("0"))


def parenthesis_part(name: str | Column) -> Column:
    """Cleaned text after the first '('; '0' when there is none."""
    return F.coalesce(_words(_after(_col(name), "(")), F.lit("0"))


def normalise_name(name: str | Column) -> Column:
    """Lower-case name, cut before brackets, other characters as single spaces, trimmed."""
    head = F.substring_index(F.substring_index(F.lower(_col(name)), "[", 1), "(", 1)
    return F.trim(F.regexp_replace(head, NOT_NAME, " "))


def item_type(name2: str | Column) -> Column:
    """Platform token of a bracket part: its first word, or its first 8 characters when that word is 'xbox'.

    Spaces are removed and spellings unified. The input is read once, so the expression stays small when inlined.
    """
    token_text = F.regexp_extract(_col(name2), "^(xbox(?= |$).{0,4}|[^ ]*)", 1)
    tight = F.replace(token_text, F.lit(" "), F.lit(""))
    spellings = F.create_map(*[F.lit(x) for pair in TYPE_SPELLINGS.items() for x in pair])
    return F.coalesce(F.try_element_at(spellings, tight), tight)
