"""Nested user payloads to roster rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from musterline.fixed_values import (
    DEPARTMENTS,
    DESIGNATION_DEFAULT,
    DESIGNATION_MIN_LENGTH,
    PAYLOAD_KEY_OFFSET,
    PAYLOAD_SALARY_BASE,
    PAYLOAD_SALARY_STEP,
    PAYLOAD_YEAR,
)
from musterline.functions.text import parse_integer
from musterline.model import SNAKE
from musterline.operators.contracts import ENTITY, REASONS, annotate, split, standardise


def designation_of(role: Column) -> Column:
    """First word of the role with a capital first letter, or the default for a short one."""
    word = F.element_at(F.split(role, " "), 1)
    capitalised = F.concat(F.upper(F.left(word, F.lit(1))), F.lower(F.substring(word, 2, 1 << 30)))
    long_enough = F.coalesce(F.length(word) >= DESIGNATION_MIN_LENGTH, F.lit(False))
    return F.when(long_enough, capitalised).otherwise(F.lit(DESIGNATION_DEFAULT))


def flatten_users(users: DataFrame) -> DataFrame:
    """One annotated roster row per user; ``reasons`` is empty for an accepted one.

    Every field is derived from the user id; remainders are those of floor division, so they are
    never negative.
    """
    # A generated column is computed once. A plain one would be copied into every rule of the
    # filters that Catalyst pushes below this projection, and the id would be parsed each time.
    users = users.select("*", F.explode(F.array(parse_integer(F.col("id")))).alias("__user_id"))
    user_id = F.col("__user_id")

    def cycle(n: int) -> Column:
        return F.pmod(user_id, F.lit(n)).cast("int")

    departments = F.array(*[F.lit(name) for name in DEPARTMENTS])
    rows = users.select(
        # A sum beyond the range is null, and the row is rejected for it.
        F.try_add(user_id, F.lit(PAYLOAD_KEY_OFFSET)).alias(SNAKE.id),
        F.col("name").alias(SNAKE.name),
        F.get(departments, cycle(len(DEPARTMENTS))).alias(SNAKE.department),
        designation_of(F.col("company.bs")).alias(SNAKE.designation),
        (F.lit(PAYLOAD_SALARY_BASE) + user_id * F.lit(PAYLOAD_SALARY_STEP)).alias(SNAKE.salary),
        F.make_date(F.lit(PAYLOAD_YEAR), cycle(12) + 1, cycle(28) + 1).alias(SNAKE.joining_date),
        (cycle(5) + 1).alias(SNAKE.score),
        *[F.col(name) for name in users.columns if name not in {*SNAKE.base, *_USER_FIELDS, "__user_id"}],
    )
    return annotate(rows, ENTITY)


_USER_FIELDS = ("id", "name", "username", "email", "address", "phone", "website", "company")


def roster_from_users(users: DataFrame) -> DataFrame:
    """The accepted users as typed roster rows."""
    clean, _ = split(flatten_users(users))
    return standardise(clean)


def rejected_users(users: DataFrame) -> DataFrame:
    """The users that do not make a legal roster row, with the reasons."""
    return flatten_users(users).where(F.size(REASONS) > 0)
