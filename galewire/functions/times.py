"""Column helpers for time."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted ISO-8601 forms.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?"
    r"(Z|[+-]\d{2}:?\d{2})?)?$"
)


def parse_timestamp(c: Column) -> Column:
    """ISO-8601 text to a timestamp; no offset means UTC; anything else is null."""
    return F.when(c.rlike(ISO_PATTERN), c.try_cast("timestamp"))


def iso_seconds(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
