"""The whole run: landed files to a published roster, its metrics, chart data and reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from musterline.errors import SourceError
from musterline.model import PASCAL, SNAKE
from musterline.operators import distributions, growth, metrics, reports
from musterline.operators.changes import checked_offers, insert_batch, merge_sources, new_rows
from musterline.operators.cleaning import clean_roster
from musterline.operators.contracts import (
    DUPLICATE,
    ENTITY,
    REASONS,
    TABLE,
    Contract,
    integer_of,
    split,
    standardise,
)
from musterline.operators.dedup import keep_first, mark_duplicates
from musterline.operators.flatten import flatten_users
from musterline.session import written
from musterline.sources.payloads import users_or_default
from musterline.sources.roster_files import read_checked_csv
from musterline.sources.snapshots import current_snapshot, full_reload


# Where a user was read: file, block, row, position in its array.
_PLACE = "__place"


@dataclass(frozen=True)
class RunResult:
    rows: int
    roster: DataFrame
    rejected_rows: DataFrame
    rejected_users: DataFrame
    cleaned: DataFrame


def publish_roster(
    spark: SparkSession,
    csv_path: str,
    payload_path: str,
    base: str,
    contract: Contract = ENTITY,
    on_conflict: str = "fail",
    as_of: str | dt.date | None = None,
    on_corrupt: str = "fail",
    one_per_line: bool = False,
) -> RunResult:
    """Check both sources, merge them and publish the result as the new snapshot below ``base``.

    Repeated keys stop the run before anything is published (``on_conflict='fail'``), or lose to the row
    read first: unnamed (``'keep_first'``), or listed among the rejected rows and users with the reason
    ``duplicate`` or ``present`` (``'quarantine'``). An empty merge leaves the published roster as it is.
    ``on_corrupt`` and ``one_per_line`` say how payloads are read; one per line lets Spark split
    large files.
    """
    if on_conflict not in ("fail", "keep_first", "quarantine"):
        raise ValueError(f"on_conflict is 'fail', 'keep_first' or 'quarantine', not {on_conflict!r}")
    # Written once: clean and rejected rows, the key checks and the load all read it.
    checked = written(read_checked_csv(spark, csv_path, contract))
    clean, rejected = split(checked)
    if on_conflict == "quarantine":
        marked = clean.withColumn("__typed", integer_of(clean, PASCAL.id))
        marked = written(mark_duplicates(marked, "__typed", PASCAL.ordinal, "__later").drop("__typed"))
        clean = marked.where(~F.col("__later")).drop("__later")
        losers = marked.where("__later").drop("__later").withColumn(REASONS, F.array(F.lit(DUPLICATE)))
        rejected = rejected.unionByName(losers)
    to_stored_names = dict(zip((*PASCAL.base, PASCAL.ordinal), (*SNAKE.base, SNAKE.ordinal)))
    from_file = standardise(clean, PASCAL, typed_dates=True).withColumnsRenamed(to_stored_names)
    if on_conflict == "keep_first":
        from_file = keep_first(from_file, SNAKE.id, SNAKE.ordinal)
    from_file = from_file.select(*SNAKE.base)

    # Written once too: payloads are parsed a single time.
    users = users_or_default(spark, payload_path, on_corrupt, one_per_line, _PLACE)
    accepted, refused = split(written(flatten_users(users)))
    from_users = standardise(accepted).select(*SNAKE.base, _PLACE)
    if on_conflict == "quarantine":
        offers = written(checked_offers(from_file, from_users, _PLACE))
        taken, others = split(offers)
        refused = refused.unionByName(accepted.join(others.select(_PLACE, REASONS), _PLACE))
        merged = merge_sources(from_file, taken)
    elif on_conflict == "keep_first":
        merged = merge_sources(from_file, new_rows(from_file, from_users, order=_PLACE))
    else:
        merged = insert_batch(from_file, from_users.drop(_PLACE))

    refused = refused.drop(_PLACE)

    rows, _ = full_reload(merged, base, contract=TABLE)
    roster = current_snapshot(spark, base)
    if roster is None:
        raise SourceError("no rows to publish and nothing published before")
    # Written once: every dataset below is a scan of a few of its columns.
    cleaned = written(clean_roster(roster.withColumn(SNAKE.ordinal, F.col(SNAKE.id)), as_of=as_of))
    return RunResult(rows, roster, rejected, refused, cleaned)


def datasets(cleaned: DataFrame, roster: DataFrame) -> dict[str, DataFrame]:
    """All published datasets: the data of the sixteen charts, the metrics and the reports."""
    c = SNAKE
    kpi_row = metrics.kpis(cleaned)
    summary = metrics.department_summary(roster)
    return {
        "chart_01_headcount_by_department": metrics.count_by(cleaned, c.department),
        "chart_02_salary_by_department": metrics.sum_by(cleaned, c.department, c.salary),
        "chart_03_average_salary_by_department": metrics.mean_by(cleaned, c.department, c.salary),
        "chart_04_salary_histogram": distributions.histogram(cleaned, c.salary, 15),
        "chart_05_salary_boxes": distributions.box_stats(cleaned, c.department, c.salary),
        "chart_05_salary_outliers": distributions.outliers(
            cleaned.select(c.id, c.department, c.salary), c.department, c.salary
        ),
        "chart_06_score_shares": metrics.score_distribution(cleaned),
        "chart_07_score_salary": distributions.value_pairs(cleaned, c.score, c.salary),
        "chart_08_cumulative_headcount": growth.cumulative_headcount(cleaned),
        "chart_09_tenure_salary": distributions.value_pairs(cleaned, c.tenure, c.salary),
        "chart_10_average_score_by_department": metrics.mean_by(
            cleaned, c.department, c.score, descending=False
        ),
        "chart_11_average_salary_by_designation": metrics.mean_by(
            cleaned, c.designation, c.salary, descending=True
        ),
        "chart_12_tenure_histogram": distributions.histogram(cleaned, c.tenure, 10),
        "chart_13_average_score_by_designation": metrics.mean_by(
            cleaned, c.designation, c.score, descending=False
        ),
        "chart_14_high_performers": metrics.high_performers_by(cleaned, c.department),
        "chart_15_salary_density": distributions.density(cleaned, c.department, c.salary),
        "chart_15_salary_violins": distributions.violin_stats(cleaned, c.department, c.salary),
        "chart_16_correlations": metrics.correlation_matrix(cleaned, [c.salary, c.score, c.tenure]),
        "kpis": metrics.kpis_with_top_earners(cleaned),
        "kpi_report": reports.kpi_report(kpi_row),
        "department_report": reports.department_report(summary),
        "top_earner_report": reports.top_earner_report(metrics.top_earners(cleaned)),
        "workbook_directory": reports.directory_export(roster),
        "workbook_departments": metrics.department_summary_with_total(roster),
        "dashboard_tiles": metrics.dashboard_tiles(cleaned),
        "dashboard_directory": reports.directory_view(roster),
    }


def write_datasets(frames: dict[str, DataFrame], folder: str) -> None:
    for name, frame in frames.items():
        frame.write.parquet(f"{folder}/{name}")
