"""Column names and schemas of the roster entity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from musterline.fixed_values import ROSTER_HEADER


@dataclass(frozen=True)
class RosterColumns:
    """Names under which an operator finds the roster fields in a DataFrame."""

    id: str = "employee_id"
    name: str = "name"
    department: str = "department"
    designation: str = "designation"
    salary: str = "salary"
    joining_date: str = "joining_date"
    score: str = "performance_score"
    tenure: str = "tenure_years"
    ordinal: str = "ordinal"

    @property
    def base(self) -> tuple[str, ...]:
        """The seven stored fields in declaration order."""
        return (
            self.id,
            self.name,
            self.department,
            self.designation,
            self.salary,
            self.joining_date,
            self.score,
        )


SNAKE = RosterColumns()
PASCAL = RosterColumns(*ROSTER_HEADER, tenure="TenureYears", ordinal="Ordinal")

ROSTER_SCHEMA = T.StructType(
    [
        T.StructField(SNAKE.id, T.LongType()),
        T.StructField(SNAKE.name, T.StringType()),
        T.StructField(SNAKE.department, T.StringType()),
        T.StructField(SNAKE.designation, T.StringType()),
        T.StructField(SNAKE.salary, T.DoubleType()),
        T.StructField(SNAKE.joining_date, T.DateType()),
        T.StructField(SNAKE.score, T.IntegerType()),
    ]
)



def _texts(*names: str, **nested: T.StructType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in names]
    return T.StructType(fields + [T.StructField(k, v) for k, v in nested.items()])


# The id stays text until the flatten step has checked it: payloads carry numbers and strings.
USER_SCHEMA = _texts(
    "id",
    "name",
    "username",
    "email",
    "phone",
    "website",
    address=_texts("street", "suite", "city", "zipcode", geo=_texts("lat", "lng")),
    company=_texts("name", "catchPhrase", "bs"),
)
