"""Text columns to typed columns. Bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the short trending-date text (year, day, month), and the words for flags
SHORT_DATE_PATTERN = r"^\d{2}\.\d{2}\.\d{2}$"
SHORT_DATE_FORMAT = "yy.dd.MM"
TRUE_WORDS = ("t", "true", "y", "yes", "1")
FALSE_WORDS = ("f", "false", "n", "no", "0")
UNKNOWN_REGION = "unknown"

# A failing try_cast raises and catches an exception per row, which is some hundred
# times slower than a pattern test, so text is tested before it is cast.
NUMBER_PATTERN = r"^\s*[+-]?\d+(\.\d*)?\s*$"
FRACTION_PATTERN = r"^\s*[+-]?\.\d*\s*$"
ISO_DATE_PATTERN = r"^\s*[+-]?\d{4,7}(-\d{1,2}(-\d{1,2}([ T].*)?)?)?\s*$"


def to_long(text: Column) -> Column:
    """Text to bigint; a decimal fraction is cut off ("12.9" gives 12), other bad text gives null."""
    text = text.cast("string")
    whole = F.substring_index(text, ".", 1).try_cast("bigint")
    return F.when(text.rlike(NUMBER_PATTERN), whole).when(text.rlike(FRACTION_PATTERN), F.lit(0))


def to_bool(text: Column) -> Column:
    word = F.lower(F.trim(text.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(word.isin(*FALSE_WORDS), F.lit(False))


def tags_text(tags: Column, is_array: bool) -> Column:
    """One ``|``-joined text for both kinds of input."""
    return F.array_join(tags, "|") if is_array else tags.cast("string")


def clean_region(region: Column) -> Column:
    return F.lower(F.trim(region))


def trending_day(text: Column) -> Column:
    """Short text (two-digit years are 2000 to 2099) or ISO text to a date; anything else gives null."""
    year, day, month = (F.substring(text, start, 2) for start in (1, 4, 7))
    iso = F.when(
        text.rlike(SHORT_DATE_PATTERN), F.concat(F.lit("20"), year, F.lit("-"), month, F.lit("-"), day)
    ).when(text.rlike(ISO_DATE_PATTERN), text)
    return iso.try_cast("date")


def region_from_path(path: Column) -> Column:
    """The value of the first ``region=`` folder in a path."""
    found = F.regexp_extract(path, r"(?:^|/)region=([^/=]*)", 1)
    return F.when(path.rlike(r"(?:^|/)region="), found).otherwise(F.lit(UNKNOWN_REGION))
