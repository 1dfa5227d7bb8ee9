"""Text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a Python ``str.strip`` removes that matters in HTML text: white space and the no-break space.
_BLANKS = r"\s\x{00A0}\x{2000}-\x{200A}\x{202F}\x{3000}"
BLANK = f"[{_BLANKS}]+"


def strip(text: Column) -> Column:
    """Remove blanks, no-break spaces included, at both ends."""
    return F.regexp_replace(text, f"^{BLANK}|{BLANK}$", "")


def present(text: Column) -> Column:
    """True for text that is neither null nor blank."""
    return F.coalesce(F.rlike(text, F.lit(f"[^{_BLANKS}]")), F.lit(False))


def first_filled(*candidates: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates])


def title_key(title: Column) -> Column:
    """A title as it is searched for: ampersands and en dashes taken out."""
    return F.translate(title, "&–", "")


def zero_pad(part: Column, width: int = 2) -> Column:
    """Left-pad with zeros, leaving longer text whole."""
    return F.when(F.length(part) < width, F.lpad(part, width, "0")).otherwise(part)


def int_or_zero(text: Column) -> Column:
    """A missing number counts as 0; malformed text is an error, as ANSI casts are."""
    return F.coalesce(text.cast("bigint"), F.lit(0).cast("bigint"))


def capture_number(text: Column, pattern: str, group: int = 1) -> Column:
    """The number in a regex group, or null where the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).cast("bigint")
