"""Where landed files go."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.times import stamp_text


def landing_path(source: str, moment: Column, extension: str, root: str = "landing") -> Column:
    """``landing/<source>/<source>_<stamp>.<extension>``"""
    return F.concat(
        F.lit(f"{root}/{source}/{source}_"), stamp_text(moment), F.lit(f".{extension}")
    )
