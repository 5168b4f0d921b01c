"""Column helpers of the cleaning step."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from storelake.functions.numeric import ColumnOrName, as_col

# The characters, besides whitespace, after which a new word starts.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+-*%/|\[](){}<>"""

_BREAK_CLASS = "[" + "".join("\\" + ch for ch in WORD_BREAKS) + "]"


def title_case(c: ColumnOrName) -> Column:
    """First letter of every word in upper case, the rest in lower case.

    The built-in splits at whitespace only. Values that hold another word break
    are cut after each break, and the pieces are title-cased one by one.
    """
    c = as_col(c)
    pieces = F.split(c, f"(?<={_BREAK_CLASS})")
    by_piece = F.array_join(F.transform(pieces, F.initcap), "")
    return F.when(c.rlike(_BREAK_CLASS), by_piece).otherwise(F.initcap(c))


def clamp_min(c: ColumnOrName, floor: float = 0) -> Column:
    """``greatest`` that keeps NULL, where the built-in would skip it."""
    c = as_col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor).cast("int")))


def default_to(c: ColumnOrName, value) -> Column:
    return F.coalesce(as_col(c), F.lit(value))


def normalize_code(c: ColumnOrName) -> Column:
    return F.upper(F.trim(as_col(c)))


def to_type(c: ColumnOrName, dtype: str) -> Column:
    """Cast that gives NULL on dirty input; fractions round on the way to an integer."""
    c = as_col(c)
    if dtype in ("int", "integer", "bigint"):
        number = c.try_cast("decimal(38,9)")
        return F.round(number, 0).try_cast(dtype)
    return c.try_cast(dtype)


def has_elements(c: ColumnOrName) -> Column:
    return F.size(as_col(c)) > 0
