"""Which date formats a text has, as a bit mask that aggregates with AND.

A text column is a date column if one format reads all its values; the first
such format in the order below is the column's format (so 03/04/2024 is month
first unless another value rules that out). Values of different formats are
refused; the ISO dates and timestamps are one format, with or without a time.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_TIME = "[ H:mm[:ss]]"

# Name -> (shape of the text, patterns of the parser). Epochs
# have no pattern: seconds (10 digits) or milliseconds (13).
FORMATS = {
    "iso": (r"^\d{4}-\d{2}-\d{2}", ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss[.SSSSSS]", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")),
    "month/day/year": (r"^\d{1,2}/\d{1,2}/\d{4}", ("M/d/yyyy" + _TIME,)),
    "day/month/year": (r"^\d{1,2}/\d{1,2}/\d{4}", ("d/M/yyyy" + _TIME,)),
    "year/month/day": (r"^\d{4}/\d{1,2}/\d{1,2}", ("yyyy/M/d" + _TIME,)),
    "day.month.year": (r"^\d{1,2}\.\d{1,2}\.\d{4}", ("d.M.yyyy" + _TIME,)),
    "day-month-year": (r"^\d{1,2}-\d{1,2}-\d{4}", ("d-M-yyyy" + _TIME,)),
    "day month-name year": (r"^\d{1,2} [A-Za-z]{3,9} \d{4}", ("d MMM yyyy" + _TIME, "d MMMM yyyy" + _TIME)),
    "month-name day, year": (r"^[A-Za-z]{3,9} \d{1,2}, \d{4}", ("MMM d, yyyy" + _TIME, "MMMM d, yyyy" + _TIME)),
    "yearmonthday": (r"^\d{8}$", ("yyyyMMdd",)),
    "epoch seconds": (r"^\d{10}$", ()),
    "epoch milliseconds": (r"^\d{13}$", ()),
}
LONGEST = 32  # characters of the longest text that a format reads


def parse(text: Column, name: str) -> Column:
    """Timestamp of a text by a format's name; NULL where it does not fit."""
    shape, patterns = FORMATS[name]
    if patterns:
        read = F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns])
    else:
        read = F.timestamp_millis(text.try_cast("long") * F.lit(1 if name.endswith("milliseconds") else 1000))
    return F.when(text.rlike(shape), read)


def format_mask(text: Column) -> Column:
    """Bit i for the i-th format that reads the text (NULL for NULL)."""
    bits = [F.when(parse(text, n).isNotNull(), 1 << i).otherwise(0) for i, n in enumerate(FORMATS)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    # only short texts with a digit are tried
    return F.when(text.isNull(), F.lit(None).cast("int")).when((F.char_length(text) <= LONGEST) & text.rlike("[0-9]"), mask).otherwise(0)


def format_name(mask: Column) -> Column:
    """Name of the first format of an AND-ed mask, NULL for none."""
    return F.coalesce(*[F.when(mask.bitwiseAND(1 << i) != 0, F.lit(n)) for i, n in enumerate(FORMATS)])


def to_dates(text: Column, name: Column) -> Column:
    """Date of a text by the format that ``name`` (a column) tells."""
    return F.to_date(F.coalesce(*[F.when(name == n, parse(text, n)) for n in FORMATS]))
