"""Bit queries over relationship bytes, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unsigned(b: Column) -> Column:
    """A signed byte, as stored in ORC, as 0 ... 255."""
    return b.cast("int").bitwiseAND(255)


def mut_match(b: Column, query: int, subsets: bool = False, supersets: bool = False) -> Column:
    """Whether byte `b` answers `query`: equal, a non-blank subset, a superset, or either of those two.

    A blank byte answers nothing. Trivial queries fold to constants or equalities here.
    """
    if isinstance(query, bool) or not isinstance(query, int):
        raise TypeError(f"a query is an int, not {type(query).__name__}")
    if not 0 <= query <= 255:
        raise ValueError(f"a query is 0 to 255, not {query}")
    covered = b != 0
    within = F.lit(False) if query == 0 else covered if query == 255 else b == query if query.bit_count() == 1 else covered & (b.bitwiseOR(F.lit(query)) == query)
    around = covered if query == 0 else b == 255 if query == 255 else b.bitwiseAND(F.lit(query)) == query
    if subsets and supersets:
        return within | around
    if subsets:
        return within
    if supersets:
        return around
    return F.lit(False) if query == 0 else b == query


def mut_overlap(b: Column, query: int) -> Column:
    """The older superset mode: any common bit."""
    return b.bitwiseAND(F.lit(query)) != 0


def consensus(first: Column, second: Column) -> Column:
    """Of two mates' bytes: what both allow, or all that either allows when they share nothing."""
    both = first.bitwiseAND(second)
    return F.when(both != 0, both).otherwise(first.bitwiseOR(second))


def flag(value: Column, bit: int) -> Column:
    return value.bitwiseAND(F.lit(bit)) != 0


def rendered(vector: Column) -> Column:
    """An array of bytes as one line of glyphs."""
    from chemprobe.functions.codes import glyph

    signs = F.create_map(*[x for c in range(256) if glyph(c) != "?" for x in (F.lit(c), F.lit(glyph(c)))])
    return F.array_join(F.transform(vector, lambda x: F.coalesce(F.try_element_at(signs, x), F.lit("?"))), "")
