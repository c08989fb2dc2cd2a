"""Column functions on numbers: idf, gravity, shares, decay."""

from pyspark.sql import Column, functions as F

from broadsheet.settings import GRAVITY, GRAVITY_OFFSET_HOURS, RANK_DIGITS


def inverse_frequency(n_docs: Column, df: Column) -> Column:
    return F.log10(n_docs.cast("double") / df)


def gravity(votes: Column, hours: Column) -> Column:
    """An article published after the time of asking counts as published just then."""
    return votes / F.pow(F.greatest(hours, F.lit(0)) + GRAVITY_OFFSET_HOURS, F.lit(GRAVITY))


def recover_count(tf: Column, n_terms: Column) -> Column:
    """The integer count behind a term frequency."""
    return F.round(tf * n_terms).cast("bigint")


def share_text(share: Column) -> Column:
    """A share with two or three decimals, rounded half to even."""
    return F.regexp_replace(F.format_number(F.bround(share, 3), 3), "0$", "")


def decay(hours: Column, half_life_hours: float) -> Column:
    return F.pow(F.lit(2.0), -hours / F.lit(float(half_life_hours)))


def rank_key(score: Column) -> Column:
    """The value scores are compared on: the score in units of the last digit.

    Float sums depend on their order, so scores that differ by less are equal.
    """
    return F.rint(score * F.lit(10.0**RANK_DIGITS))
