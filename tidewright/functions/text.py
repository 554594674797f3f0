"""Paths, keys and text used by file loads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_key(*cols) -> Column:
    """Key columns as one text, parts joined by ``_``."""
    return F.concat_ws("_", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])


def folder_up(path, levels: int) -> Column:
    """Name of the folder ``levels`` above the file (1 is its own folder)."""
    return F.try_element_at(F.split(path, "/"), F.lit(-1 - levels))


def strip_home(path, home: str) -> Column:
    """The part of a path after the home folder; other paths stay as they are."""
    return F.element_at(F.split(path, F.lit("\\Q" + home.rstrip("/") + "/\\E")), -1)


def fill_placeholders(text, values: dict[str, str]) -> Column:
    """Replace each placeholder word by its value, longest placeholder first."""
    out = F.col(text) if isinstance(text, str) else text
    for name in sorted(values, key=len, reverse=True):
        out = F.replace(out, F.lit(name), F.lit(values[name]))
    return out


def typed_literal(value, kind: str = "text") -> Column:
    """A value from outside as a typed literal, never as SQL text.

    Null text becomes '' and an interval is given as a count of seconds.
    """
    if kind == "interval":
        if value is None:
            return F.lit(None).cast("interval day to second")
        return F.make_dt_interval(secs=F.lit(float(value)).cast("decimal(18,6)"))
    return F.lit("" if value is None else str(value))


def non_blank_text(col) -> Column:
    """Neither null nor only spaces."""
    return F.col(col).isNotNull() & (F.trim(F.col(col)) != "")
