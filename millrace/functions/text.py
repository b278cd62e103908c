"""Text expressions and column-name rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def spaced_name(name: str) -> str:
    """Trim, lower-case, blanks to underscores; parentheses stay."""
    return name.strip().lower().replace(" ", "_")


def bracketed_name(name: str) -> str:
    """Drop square brackets, then blanks to underscores and lower-case."""
    return re.sub(r"[\[\]]", "", name).replace(" ", "_").lower()


def zip_code(value: Column, parity: bool = False) -> Column:
    """A postal code as text of at least five digits.

    The sound form removes one trailing ``.0`` and keeps null. ``parity`` removes every
    ``.0`` wherever it stands and turns null into ``00nan``, as text conversion of a
    missing number does.
    """
    text = value.cast("string")
    if parity:
        stripped = F.replace(F.coalesce(text, F.lit("nan")), F.lit(".0"), F.lit(""))
    else:
        stripped = F.when(F.endswith(text, F.lit(".0")), F.left(text, F.length(text) - 2)).otherwise(text)
    # lpad() alone would cut longer codes.
    return F.when(F.length(stripped) < 5, F.lpad(stripped, 5, "0")).otherwise(stripped)
