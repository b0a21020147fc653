"""Column functions for station readings and the measure ids they come with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the published pattern of a rainfall measure id, with station, qualifier and unit. The unit is
# all up to the last slash.
MEASURE_ID = r"^.*/(.*)-rainfall-(.*)-t-15_min-(.*)/.*"
# A number as texts hold it; without the suffixes that a cast would also take.
NUMBER = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity))\s*$"


def number_or_null(value: Column) -> Column:
    """Numeric value of a text, NULL for anything else (NaN included)."""
    text = value.cast("string")
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def clean_value(value: Column) -> Column:
    """A reading as a number; of ``a|b`` the first part counts."""
    first = F.split(value.cast("string"), r"\|")[0]
    return F.coalesce(number_or_null(value), number_or_null(first))


def event_time(value: Column) -> Column:
    """Timestamp of a text or timestamp column, NULL where it cannot be read."""
    return F.try_to_timestamp(value.cast("string"))


def measure_part(measure: Column, part: int) -> Column:
    text = F.regexp_extract(measure, MEASURE_ID, part)
    return F.when(text != "", text)


def measure_station(measure: Column) -> Column:
    return measure_part(measure, 1)


def measure_qualifier(measure: Column) -> Column:
    return measure_part(measure, 2)


def measure_unit(measure: Column) -> Column:
    return measure_part(measure, 3)


def tidy_qualifier(qualifier: Column) -> Column:
    """Underscores become blanks; a letter after anything but a letter is a capital, all others are small."""
    chars = F.split(F.lower(F.replace(qualifier, F.lit("_"), F.lit(" "))), "")

    def cased(chars: Column) -> Column:
        after_letter = lambda i: F.get(chars, i - 1) != F.upper(F.get(chars, i - 1))
        return F.transform(chars, lambda c, i: F.when((i > 0) & after_letter(i), c).otherwise(F.upper(c)))

    # What a lambda takes is worked out once a row; named inside it, the text would be made anew for every letter.
    return F.get(F.transform(F.array(chars), lambda chars: F.array_join(cased(chars), "")), F.lit(0))


def parameter_is(parameter: Column, wanted: str) -> Column:
    """Case-blind 'contains' by regular expression; NULL never matches."""
    return F.coalesce(F.lower(parameter).rlike(wanted.lower()), F.lit(False))
