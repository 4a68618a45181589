"""Row predicates shared by every report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
# Finishing-position codes that are not a placing (scratched / disqualified).
NOT_PLACED = ("00", "99")
# Parent id meaning "unknown".
UNKNOWN_PARENT = "0000000000"
# ----------------------------------------------------------------------------

# Whole-text match of ASCII digits.  \A and \z anchor at the very start and
# end (a Java '$' would also accept a trailing newline).
_DIGITS_ONLY = r"\A[0-9]+\z"


def is_placed(finish: Column) -> Column:
    """Finish is all digits and not a 'no placing' code (F1, F2)."""
    return finish.rlike(_DIGITS_ONLY) & ~finish.isin(*NOT_PLACED)


def is_rated(finish: Column, odds: Column) -> Column:
    """A runner that counts for ROI: placed, with win odds (F1-F3)."""
    return is_placed(finish) & odds.isNotNull()


def since_year(year_text: Column, year: int | None) -> Column | None:
    """Year filter on the text year column; text comparison, as the source
    stores the year as 4-character text (F4)."""
    return None if year is None else year_text >= F.lit(str(year))


def known_parent(parent_id: Column) -> Column:
    """Parent id present and not the 'unknown' sentinel (drops NULL too)."""
    return parent_id != F.lit(UNKNOWN_PARENT)
