"""Data contracts: declared rules, compiled into one pass of Column expressions.

A contract names what each roster field must satisfy. :func:`annotate` adds, per row, the list of
violated rules in declaration order; every other operator here is a projection of that frame.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F, types as T

from musterline.errors import ContractError
from musterline.fixed_values import DEPARTMENTS, SALARY_MAX, SALARY_MIN, SCORE_MAX, SCORE_MIN
from musterline.functions.text import (
    is_blank,
    is_true,
    parse_date,
    parse_integer,
    parse_number,
    strip,
    valid_date,
    valid_date_shape,
)
from musterline.model import SNAKE, RosterColumns
from musterline.operators.dedup import mark_duplicates

REASONS = "reasons"
DUPLICATE = "duplicate"


@dataclass(frozen=True)
class Contract:
    """What a row must satisfy. Fields left at None are not checked."""

    name: str
    columns: RosterColumns = SNAKE
    key_above: int | None = 0
    digits_only_key: bool = False  # no sign, blanks or digit groups in a text key
    departments: tuple[str, ...] | None = DEPARTMENTS
    trim_department: bool = False
    salary_min: float | None = SALARY_MIN
    salary_max: float | None = SALARY_MAX
    score_min: float | None = SCORE_MIN
    score_max: float | None = SCORE_MAX
    whole_scores: bool = True
    date_rule: str = "real"  # real | shape | present
    text_fields: tuple[str, ...] = ()  # must hold more than white space
    present_fields: tuple[str, ...] = ()  # must not be null
    quarantine_duplicates: bool = False

    def using(self, **changes) -> Contract:
        """The same contract for other columns, departments or bounds."""
        return replace(self, **changes)


ENTITY = Contract("entity", trim_department=True, text_fields=("name", "designation"))
FRAME = Contract(
    "frame", digits_only_key=True, whole_scores=False, date_rule="shape", quarantine_duplicates=True
)
TABLE = Contract(
    "table",
    key_above=None,
    departments=None,
    salary_min=0.0,
    salary_max=None,
    date_rule="present",
    present_fields=("name", "department", "designation"),
)


def _is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def integer_of(df: DataFrame, name: str, to: str = "bigint") -> Column:
    return parse_integer(F.col(name), to) if _is_text(df, name) else F.col(name).cast(to)


def number_of(df: DataFrame, name: str) -> Column:
    """The field as a double, possibly NaN or infinite."""
    return parse_number(F.col(name)) if _is_text(df, name) else F.col(name).cast("double")


def date_of(df: DataFrame, name: str) -> Column:
    return parse_date(F.col(name)) if _is_text(df, name) else F.col(name).cast("date")


def _between(value: Column, low: float | None, high: float | None) -> Column:
    """Inclusive bounds. NaN sorts above every number, so each upper test also rejects it."""
    ok = value <= F.lit(float(high)) if high is not None else value < F.lit(float("inf"))
    if low is not None:
        ok = ok & (value >= F.lit(float(low)))
    return is_true(ok)


def _rules(df: DataFrame, contract: Contract) -> list[tuple[str, str, Column]]:
    """(field, reason code, holds) in declaration order of the fields."""
    c = contract.columns
    rules: list[tuple[str, str, Column]] = []
    key = integer_of(df, c.id)
    if contract.key_above is None:
        key_ok = key.isNotNull()
    else:
        key_ok = is_true(key > F.lit(contract.key_above))
    if contract.digits_only_key and _is_text(df, c.id):
        key_ok = key_ok & is_true(F.col(c.id).rlike("^[0-9]+$"))
    rules.append((c.id, "id", key_ok))

    for field, code in ((c.name, "name"), (c.department, "department"), (c.designation, "designation")):
        if code == "department" and contract.departments is not None:
            text = strip(F.col(field)) if contract.trim_department else F.col(field)
            rules.append((field, code, is_true(text.isin(*contract.departments))))
        elif code in contract.text_fields:
            rules.append((field, code, ~is_blank(F.col(field))))
        elif code in contract.present_fields:
            rules.append((field, code, F.col(field).isNotNull()))

    rules.append(
        (c.salary, "salary", _between(number_of(df, c.salary), contract.salary_min, contract.salary_max))
    )

    dates = F.col(c.joining_date)
    if contract.date_rule == "present" or not _is_text(df, c.joining_date):
        date_ok = dates.isNotNull()
    elif contract.date_rule == "shape":
        date_ok = valid_date_shape(dates)
    else:
        date_ok = valid_date(dates)
    rules.append((c.joining_date, "joining_date", date_ok))

    if contract.whole_scores:
        score = integer_of(df, c.score, "int")
    else:
        score = number_of(df, c.score)
    rules.append(
        (c.score, "performance_score", _between(score, contract.score_min, contract.score_max))
    )
    return rules


def present_codes(codes: list[Column]) -> Column:
    """The non-null codes as an array.

    ``array_compact`` is a higher-order function, which would take the rules below it out of
    generated code.
    """
    return F.array_except(F.array(*codes), F.array(F.lit(None).cast("string")))


def annotate(df: DataFrame, contract: Contract) -> DataFrame:
    """Add ``reasons``: the codes of the violated rules, empty for a clean row.

    A later row of a key gets the reason ``duplicate`` if the contract asks for it. That is found
    before any other rule, so an invalid first row still uses up its key. Keys are compared as
    numbers, and rows without a usable key are not compared at all: their key is a violation
    already.
    """
    c = contract.columns
    reasons = [
        F.when(~holds, F.lit(code)) for _, code, holds in _rules(df, contract)
    ]
    if contract.quarantine_duplicates:
        keyed = df.withColumn("__typed_key", integer_of(df, c.id))
        df = mark_duplicates(keyed, "__typed_key", c.ordinal, "__duplicate")
        reasons.append(
            F.when(F.col("__duplicate") & F.col("__typed_key").isNotNull(), F.lit(DUPLICATE))
        )
    annotated = df.withColumn(REASONS, present_codes(reasons))
    return annotated.drop("__typed_key", "__duplicate")


def split(annotated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined): every annotated row is in exactly one of them."""
    return (
        annotated.where(F.size(REASONS) == 0).drop(REASONS),
        annotated.where(F.size(REASONS) > 0),
    )


def standardise(clean: DataFrame, columns: RosterColumns = SNAKE, typed_dates: bool = False) -> DataFrame:
    """Clean rows with typed numbers (fractional scores truncated) and trimmed text."""
    c = columns
    date_text = clean.schema[c.joining_date].dataType
    if typed_dates:
        joined = date_of(clean, c.joining_date)
    elif isinstance(date_text, T.StringType):
        joined = strip(F.col(c.joining_date))
    else:
        joined = F.col(c.joining_date)
    return clean.withColumns(
        {
            c.id: integer_of(clean, c.id),
            c.name: strip(F.col(c.name)),
            c.department: strip(F.col(c.department)),
            c.designation: strip(F.col(c.designation)),
            c.salary: number_of(clean, c.salary),
            c.joining_date: joined,
            c.score: number_of(clean, c.score).cast("int"),
        }
    )


def first_violation(df: DataFrame, contract: Contract) -> DataFrame:
    """Per row, the first field in declaration order that breaks the contract, with its value."""
    found = F.coalesce(
        *[
            F.when(
                ~holds,
                F.struct(
                    F.lit(name).alias("violated_field"),
                    F.lit(code).alias("violation"),
                    F.coalesce(F.col(name).cast("string"), F.lit("")).alias("violating_value"),
                ),
            )
            for name, code, holds in _rules(df, contract)
        ]
    )
    return df.withColumn("__found", found).select("*", "__found.*").drop("__found")


def quarantine_summary(annotated: DataFrame) -> DataFrame:
    """Rows per reason. A row that breaks several rules counts once for each of them."""
    # Grouped by the whole list first: a few combinations are exploded, not the rows.
    combinations = annotated.groupBy(REASONS).agg(F.count(F.lit(1)).alias("__rows"))
    return (
        combinations.select(F.explode(REASONS).alias("reason"), "__rows")
        .groupBy("reason")
        .agg(F.sum("__rows").alias("rows"))
    )


def split_counts(annotated: DataFrame) -> DataFrame:
    """One row: total, clean and quarantined rows."""
    clean = F.size(REASONS) == 0
    return annotated.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(clean).alias("clean_rows"),
        F.count_if(~clean).alias("quarantined_rows"),
    )


def assert_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` unchanged, or ContractError naming some offending rows (a check job runs now)."""
    offending = first_violation(df, contract).where(F.col("violation").isNotNull())
    sample = offending.select(contract.columns.id, "violation", "violating_value").limit(5).collect()
    if sample:
        shown = ", ".join(f"{row[0]}: {row[1]}={row[2]!r}" for row in sample)
        raise ContractError(f"rows break contract '{contract.name}', for example {shown}")
    return df


def write_split(annotated: DataFrame, folder: str) -> None:
    """Write clean and quarantined rows below one folder in a single pass over the input."""
    (
        annotated.withColumn("verdict", F.when(F.size(REASONS) == 0, "clean").otherwise("quarantine"))
        .write.partitionBy("verdict")
        .parquet(folder)
    )
