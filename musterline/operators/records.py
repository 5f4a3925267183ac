"""Typed rows from loose text records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from musterline.functions.text import finite, parse_integer, parse_number
from musterline.model import SNAKE, RosterColumns
from musterline.operators.contracts import present_codes


def typed_from_text(df: DataFrame, columns: RosterColumns = SNAKE) -> DataFrame:
    """Cast the numeric fields of a text frame and list what could not be cast.

    ``cast_errors`` holds ``<field>:missing`` for an absent value and ``<field>:type`` for one
    that is not a number. An absent text value stays null and is reported as missing.
    """
    c = columns
    casts: dict[str, Column] = {
        c.id: parse_integer(F.col(c.id)),
        c.salary: finite(parse_number(F.col(c.salary))),
        c.score: parse_integer(F.col(c.score), "int"),
    }
    errors = []
    for name in c.base:
        errors.append(F.when(F.col(name).isNull(), F.lit(f"{name}:missing")))
        if name in casts:
            errors.append(
                F.when(F.col(name).isNotNull() & casts[name].isNull(), F.lit(f"{name}:type"))
            )
    return df.withColumns({**casts, "cast_errors": present_codes(errors)})
