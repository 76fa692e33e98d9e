"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: markdown marks removed from report text, in this order
MARKDOWN_MARKS = ["#{1,3} ", r"\*\*", r"\*"]


def strip_markdown(text: Column) -> Column:
    for mark in MARKDOWN_MARKS:
        text = F.regexp_replace(text, mark, "")
    return text


def counted(template: str, count: Column) -> Column:
    """``template`` with ``{n}`` replaced by the count."""
    before, after = template.split("{n}")
    return F.concat(F.lit(before), count.cast("string"), F.lit(after))


def json_object(*fields: Column) -> Column:
    """One JSON object per row; keys whose value is NULL are left out."""
    return F.to_json(F.struct(*fields))
