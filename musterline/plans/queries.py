"""Every operator as a query over the given tables: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from musterline.functions.dates import tenure_days, tenure_years
from musterline.functions.numbers import round_half_up
from musterline.functions.text import valid_date, valid_date_shape, valid_email
from musterline.model import PASCAL, SNAKE
from musterline.operators import (
    changes,
    cleaning,
    contracts,
    dedup,
    distributions,
    flatten,
    growth,
    metrics,
    records,
    reports,
    search,
)
from musterline.operators.quantiles import approximate_quantiles, exact_quantiles, rank_distances
from musterline.plans import views
from musterline.session import work_folder, written
from musterline.sources import file_table, json_arrays, name_index, payloads, roster_files, snapshots
from musterline.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__.rstrip("_")] = query
    return query


def _stored(df: DataFrame) -> DataFrame:
    return df.select(*SNAKE.base)


def _written(df: DataFrame, *columns: str) -> DataFrame:
    """The columns an operator needs, written once: it scans them several times, and the joins
    behind a roster view should not run again for each scan."""
    return written(df.select(*columns))


def _reason_text(df: DataFrame) -> DataFrame:
    return df.withColumn("reasons", F.concat_ws(",", "reasons"))


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    """Doubles that sum in any order, cut to the digits that do not depend on it."""
    return df.withColumns({name: round_half_up(F.col(name), digits) for name in names})


_MEASURES = (SNAKE.salary, SNAKE.score, SNAKE.tenure)


# --- sources -----------------------------------------------------------------------------------


def _text_file(spark: SparkSession, folder: str) -> str:
    path = work_folder(spark)
    rows = views.text_roster(spark, folder).select(*SNAKE.base)
    rows.withColumnsRenamed(dict(zip(SNAKE.base, PASCAL.base))).write.option("header", True).option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return path


@register
def csv_contract_read(spark: SparkSession, folder: str) -> DataFrame:
    contract = views.SEGMENT_ENTITY
    checked = roster_files.read_checked_csv(spark, _text_file(spark, folder), contract)
    return _reason_text(checked).select(*PASCAL.base, "reasons")


@register
def csv_raw_read(spark: SparkSession, folder: str) -> DataFrame:
    return roster_files.read_raw_csv(spark, _text_file(spark, folder)).select(*PASCAL.base)


@register
def table_scan_rename(spark: SparkSession, folder: str) -> DataFrame:
    return roster_files.rename_to_report_columns(_stored(views.roster(spark, folder)))


@register
def source_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return roster_files.first_available(
        [
            lambda: roster_files.read_table(spark, f"{folder}/no_such_table.parquet"),
            lambda: roster_files.empty_roster(spark),
            lambda: _stored(views.roster(spark, folder)),
        ]
    )


def _landed_payloads(spark: SparkSession, folder: str) -> str:
    """The users as JSON arrays, one per line, of up to 500 users with neighbouring event ids."""
    path = work_folder(spark)
    user = F.struct("id", "name", "company")
    arrays = (
        views.users(spark, folder)
        .groupBy(F.floor(F.col("event_id") / 500).alias("part"))
        .agg(F.to_json(F.collect_list(user)).alias("value"))
    )
    arrays.select("value").write.text(path)
    return path


@register
def json_source(spark: SparkSession, folder: str) -> DataFrame:
    landed = payloads.read_payloads(spark, _landed_payloads(spark, folder), one_per_line=True)
    return landed.groupBy("id", F.col("company.bs").alias("role")).agg(F.count(F.lit(1)).alias("users"))


@register
def json_array_source(spark: SparkSession, folder: str) -> DataFrame:
    """The same users as one array a file, a file for every 5000 events, cut by byte ranges."""
    path = work_folder(spark)
    user = F.struct("id", "name", "company")
    arrays = (
        views.users(spark, folder)
        .groupBy(F.floor(F.col("event_id") / 5000).alias("part"))
        .agg(F.to_json(F.collect_list(user)).alias("value"))
    )
    arrays.write.partitionBy("part").text(path)
    landed = json_arrays.read_large_arrays(spark, path)
    return landed.groupBy("id", F.col("company.bs").alias("role")).agg(F.count(F.lit(1)).alias("users"))


@register
def json_default_source(spark: SparkSession, folder: str) -> DataFrame:
    fallback = payloads.users_or_default(spark, f"{folder}/no_such_landing")
    merged = changes.merge_sources(
        _stored(views.roster(spark, folder)), flatten.roster_from_users(fallback)
    )
    return metrics.department_summary(merged)


@register
def feed_resolution(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    feed = F.when(kind == "click", "Weather").when(kind == "view", "Holidays").otherwise(kind)
    landed = views.table(spark, folder, "events").select(
        feed.alias("feed"), F.col("props").alias("data"), "event_id"
    )
    return payloads.resolve_feeds(landed, epoch=0, order="event_id")


@register
def file_headcount(spark: SparkSession, folder: str) -> DataFrame:
    return roster_files.file_headcount(spark, _text_file(spark, folder))


# --- sinks -------------------------------------------------------------------------------------


@register
def csv_export_rows(spark: SparkSession, folder: str) -> DataFrame:
    base = work_folder(spark)
    rows = views.roster(spark, folder)
    # The second export replaces the first.
    snapshots.publish_csv(rows.where(F.col(SNAKE.score) > 3), base)
    snapshots.publish_csv(rows, base)
    return snapshots.current_csv(spark, base).select(*PASCAL.base)


@register
def full_reload(spark: SparkSession, folder: str) -> DataFrame:
    base = work_folder(spark)
    snapshots.full_reload(_stored(views.roster(spark, folder)), base, cluster_by=SNAKE.department)
    return snapshots.current_snapshot(spark, base)


@register
def directory_export(spark: SparkSession, folder: str) -> DataFrame:
    return reports.directory_export(views.roster(spark, folder))


@register
def dept_summary_with_total(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.department_summary_with_total(views.roster(spark, folder))


@register
def kpi_report_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written(views.roster_with_tenure(spark, folder), *_MEASURES)
    return reports.kpi_report(metrics.kpis(rows))


@register
def dept_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    return reports.department_report(metrics.department_summary(views.roster(spark, folder)))


@register
def top5_report_rows(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_earner_report(metrics.top_earners(views.roster(spark, folder)))


# --- keyed changes -----------------------------------------------------------------------------


@register
def insert_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored(views.roster(spark, folder))
    offered = views.event_rows(spark, folder, F.col("event_id") * 3 + 1)
    return changes.insert_batch(rows, changes.new_rows(rows, offered))


@register
def batch_insert(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored(views.roster(spark, folder))
    return changes.insert_batch(rows, views.event_rows(spark, folder, -1 - F.col("event_id")))


@register
def batch_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster(spark, folder)
    return changes.batch_conflicts(rows, views.event_rows(spark, folder, F.col("user_id") * 37))


@register
def insert_offers(spark: SparkSession, folder: str) -> DataFrame:
    """Offers without key, with repeated and held keys, and with a salary that no table may hold."""
    event_id = F.col("event_id")
    key = F.when(event_id % 7 != 0, F.col("user_id") * 37)
    offers = views.event_rows(spark, folder, key, event_id.alias("offer")).withColumn(
        SNAKE.salary,
        F.when(F.col("offer") % 5 == 0, -F.col(SNAKE.salary)).otherwise(F.col(SNAKE.salary)),
    )
    checked = changes.checked_offers(views.roster(spark, folder), offers, "offer")
    return _reason_text(checked).select("offer", SNAKE.id, "reasons")


@register
def update_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored(views.roster(spark, folder))
    return changes.update_rows(rows, views.event_rows(spark, folder, F.col("event_id") + 1))


@register
def update_missing_keys(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster(spark, folder)
    return changes.missing_keys(rows, views.event_rows(spark, folder, F.col("event_id") * 2))


@register
def delete_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _stored(views.roster(spark, folder))
    errors = views.table(spark, folder, "events").where("event_type = 'error'")
    return changes.delete_rows(rows, errors.select((F.col("event_id") + 1).alias(SNAKE.id)))


@register
def merge_sources(spark: SparkSession, folder: str) -> DataFrame:
    return changes.merge_sources(
        _stored(views.roster(spark, folder)),
        flatten.roster_from_users(views.users(spark, folder)),
    )


# --- a table of immutable files ----------------------------------------------------------------


def _file_table(spark: SparkSession, folder: str, parts: int = 12) -> file_table.FileTable:
    rows = _stored(views.roster(spark, folder))
    return file_table.replace_rows(rows, work_folder(spark), contract=contracts.TABLE, parts=parts)


@register
def update_files(spark: SparkSession, folder: str) -> DataFrame:
    table = _file_table(spark, folder)
    changed = views.event_rows(spark, folder, F.col("event_id") + 1)
    return file_table.update(spark, table, changed).read(spark)


@register
def delete_files(spark: SparkSession, folder: str) -> DataFrame:
    table = _file_table(spark, folder)
    errors = views.table(spark, folder, "events").where("event_type = 'error'")
    return file_table.delete(spark, table, errors.select((F.col("event_id") + 1).alias(SNAKE.id))).read(spark)


@register
def files_kept_by_update(spark: SparkSession, folder: str) -> DataFrame:
    """A change of the ten lowest keys: one file is written anew, the others belong to both versions."""
    table = _file_table(spark, folder)
    rows = table.read(spark)
    lowest = written(rows.orderBy(SNAKE.id).limit(10).withColumn(SNAKE.name, F.lit("Renamed")))
    changed = file_table.update(spark, table, lowest)
    kept = len(set(table.files) & set(changed.files))
    return changed.read(spark).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col(SNAKE.name) == "Renamed").alias("renamed"),
        F.lit(len(table.files) - kept).alias("files_replaced"),
    )


@register
def lookup_in_files(spark: SparkSession, folder: str) -> DataFrame:
    keys = views.table(spark, folder, "events").select(F.col("user_id").alias(SNAKE.id))
    return file_table.find(spark, _file_table(spark, folder), keys)


@register
def search_names_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """The search for a name with a wildcard, after a change that replaced one of the indexed files."""
    table = _file_table(spark, folder)
    name_index.index_names(spark, table)
    lowest = written(table.read(spark).orderBy(SNAKE.id).limit(10).withColumn(SNAKE.name, F.lit("Cust_mer#x9")))
    table = file_table.update(spark, table, lowest)
    name_index.index_names(spark, table)
    return name_index.search_names(spark, table, "cust_MER#%9")


@register
def create_if_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Created, filled, and not emptied by being created again."""
    base = work_folder(spark)
    table = file_table.create_if_missing(spark, base)
    table = file_table.insert(spark, table, views.event_rows(spark, folder, F.col("event_id") + 1))
    return file_table.create_if_missing(spark, base).read(spark)


@register
def recheck_on_read(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that are legal in the table but break the entity's contract are left out when it is read."""
    return file_table.read_checked(spark, _file_table(spark, folder), views.SEGMENT_ENTITY, "quarantine")


@register
def recheck_violations(spark: SparkSession, folder: str) -> DataFrame:
    found = file_table.violations(spark, _file_table(spark, folder), views.SEGMENT_ENTITY)
    return _reason_text(found).select(SNAKE.id, "reasons")


# --- lookups, searches, projections ------------------------------------------------------------


@register
def lookup_by_id(spark: SparkSession, folder: str) -> DataFrame:
    keys = views.table(spark, folder, "events").select(F.col("user_id").alias(SNAKE.id))
    return search.find_by_keys(_stored(views.roster(spark, folder)), keys)


@register
def scan_ordered(spark: SparkSession, folder: str) -> DataFrame:
    return search.scan_ordered(_stored(views.roster(spark, folder)))


@register
def search_name(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_stored(views.roster(spark, folder)), query="cust_MER#%9")


@register
def search_department(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_stored(views.roster(spark, folder)), department="FURNITURE")


@register
def search_salary_range(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(_stored(views.roster(spark, folder)), min_salary=50000, max_salary=100000)


@register
def search_combined(spark: SparkSession, folder: str) -> DataFrame:
    return search.search(
        _stored(views.roster(spark, folder)),
        query="r#0000",
        department="BUILDING",
        min_salary=0,
        max_salary=250000,
    )


@register
def high_performer_flag(spark: SparkSession, folder: str) -> DataFrame:
    rows = search.flag_high_performers(views.damaged_roster(spark, folder))
    return rows.select(SNAKE.ordinal, SNAKE.score, "is_high_performer")


@register
def compensation(spark: SparkSession, folder: str) -> DataFrame:
    return reports.with_compensation(_stored(views.roster(spark, folder)))


@register
def typed_from_raw(spark: SparkSession, folder: str) -> DataFrame:
    typed = records.typed_from_text(views.text_roster(spark, folder))
    return typed.withColumn("cast_errors", F.concat_ws(",", "cast_errors"))


@register
def tenure(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events")
    return events.select(
        "event_id",
        tenure_days(events, "ts").cast("bigint").alias("tenure_days"),
        tenure_years(events, "ts").alias("tenure_years"),
    )


@register
def scatter_score_salary(spark: SparkSession, folder: str) -> DataFrame:
    return distributions.value_pairs(views.roster(spark, folder), SNAKE.score, SNAKE.salary)


@register
def scatter_tenure_salary(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster_with_tenure(spark, folder)
    return distributions.value_pairs(rows, SNAKE.tenure, SNAKE.salary)


@register
def scatter_tenure_salary_cells(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster_with_tenure(spark, folder)
    return distributions.pair_counts(rows, SNAKE.tenure, SNAKE.salary, 40, 25)


@register
def directory_view(spark: SparkSession, folder: str) -> DataFrame:
    return reports.directory_view(views.roster(spark, folder))


# --- contracts ---------------------------------------------------------------------------------


@register
def valid_email_(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    local = F.replace(F.lower("c_name"), F.lit("#"), F.lit("."))
    email = (
        F.when(key % 5 == 0, F.concat(local, F.lit("@company.co.in")))
        .when(key % 5 == 1, F.concat(F.lit(" "), local, F.lit("-x@mail.example\t")))
        .when(key % 5 == 2, F.concat(local, F.lit("@com")))
        .when(key % 5 == 3, F.col("c_name"))
    )
    rows = views.table(spark, folder, "customer").select("c_custkey", email.alias("email"))
    return rows.select("c_custkey", valid_email(F.col("email")).alias("valid"))


@register
def valid_date_shape_(spark: SparkSession, folder: str) -> DataFrame:
    return _date_texts(spark, folder).select(
        "o_orderkey", valid_date_shape(F.col("text")).alias("valid")
    )


@register
def valid_date_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _date_texts(spark, folder).select("o_orderkey", valid_date(F.col("text")).alias("valid"))


def _date_texts(spark: SparkSession, folder: str) -> DataFrame:
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    text = (
        F.when(key % 6 == 0, F.date_format(date, "yyyy-MM-dd"))
        .when(key % 6 == 1, F.date_format(date, "yyyy-M-d"))
        .when(key % 6 == 2, F.date_format(date, "dd-MM-yyyy"))
        .when(key % 6 == 3, F.concat(F.date_format(date, "yyyy-MM"), F.lit("-31 ")))
        .when(key % 6 == 4, F.concat(F.date_format(date, "yyyy"), F.lit("-99-99")))
    )
    return views.table(spark, folder, "orders").select("o_orderkey", text.alias("text"))


def _split_frame(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.annotate(views.damaged_roster(spark, folder), views.SEGMENT_FRAME)


@register
def contract_split(spark: SparkSession, folder: str) -> DataFrame:
    return _reason_text(_split_frame(spark, folder)).select(SNAKE.ordinal, SNAKE.id, "reasons")


@register
def contract_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.split_counts(_split_frame(spark, folder))


@register
def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    _, quarantined = contracts.split(_split_frame(spark, folder))
    return _reason_text(quarantined)


@register
def clean_standardised(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.text_roster(spark, folder)
    clean, _ = contracts.split(contracts.annotate(rows, views.SEGMENT_FRAME))
    return contracts.standardise(clean)


@register
def quarantine_summary(spark: SparkSession, folder: str) -> DataFrame:
    return contracts.quarantine_summary(_split_frame(spark, folder))


@register
def entity_contract(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.text_roster(spark, folder)
    return _reason_text(contracts.annotate(rows, views.SEGMENT_ENTITY)).select(
        SNAKE.ordinal, "reasons"
    )


@register
def table_constraints(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.damaged_roster(spark, folder)
    return _reason_text(contracts.annotate(rows, views.SEGMENT_TABLE)).select(
        SNAKE.ordinal, "reasons"
    )


@register
def first_violation(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.text_roster(spark, folder)
    return contracts.first_violation(rows, views.SEGMENT_ENTITY).select(
        SNAKE.ordinal, "violated_field", "violation", "violating_value"
    )


@register
def duplicate_mask(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.damaged_roster(spark, folder)
    return dedup.mark_duplicates(rows, SNAKE.id, SNAKE.ordinal).select(
        SNAKE.ordinal, SNAKE.id, "is_duplicate"
    )


# --- cleaning ----------------------------------------------------------------------------------


@register
def dedup_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first(views.damaged_roster(spark, folder), SNAKE.id, SNAKE.ordinal)


@register
def coerce_numeric(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.text_roster(spark, folder)
    return cleaning.coerce_numeric(rows, SNAKE.salary, SNAKE.score).select(
        SNAKE.ordinal, SNAKE.salary, SNAKE.score
    )


@register
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written(views.damaged_roster(spark, folder), SNAKE.ordinal, SNAKE.salary)
    return _rounded(cleaning.impute_median(rows, SNAKE.salary), SNAKE.salary, digits=4)


@register
def impute_constant(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.damaged_roster(spark, folder).select(SNAKE.ordinal, SNAKE.score)
    return cleaning.impute_constant(rows, SNAKE.score)


@register
def coerce_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.damaged_roster(spark, folder).select(SNAKE.ordinal, SNAKE.joining_date)
    return cleaning.coerce_date(rows, SNAKE.joining_date)


@register
def clean_roster(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.clean_roster(written(views.damaged_roster(spark, folder)))
    return _rounded(cleaned, SNAKE.salary, digits=4)


# --- metrics -----------------------------------------------------------------------------------


@register
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.kpis(_written(views.roster_with_tenure(spark, folder), *_MEASURES))


@register
def kpis_of_damaged(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = cleaning.clean_roster(written(views.damaged_roster(spark, folder)))
    return metrics.kpis(_written(cleaned, *_MEASURES))


@register
def kpis_nested(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster_with_tenure(spark, folder)
    named = (*_MEASURES, SNAKE.id, SNAKE.name, SNAKE.department, SNAKE.ordinal)
    nested = metrics.kpis_with_top_earners(_written(rows, *named))
    return nested.select(
        "Headcount",
        "MedianSalary",
        F.concat_ws(
            ";",
            F.transform(
                "Top5Earners",
                lambda e: F.concat_ws(
                    "|",
                    e["EmployeeID"].cast("string"),
                    e["Name"],
                    F.format_string("%.2f", e["Salary"]),
                    e["Department"],
                ),
            ),
        ).alias("Top5Earners"),
    )


@register
def dept_summary(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.department_summary(views.roster(spark, folder))


@register
def headcount_by_dept(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.count_by(views.roster(spark, folder), SNAKE.department)


@register
def salary_by_dept(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.sum_by(views.roster(spark, folder), SNAKE.department, SNAKE.salary)


@register
def avg_salary_by_dept(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.mean_by(views.roster(spark, folder), SNAKE.department, SNAKE.salary)


@register
def score_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.score_distribution(views.damaged_roster(spark, folder))


@register
def avg_score_by_dept(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster(spark, folder)
    return metrics.mean_by(rows, SNAKE.department, SNAKE.score, descending=False)


@register
def avg_salary_by_designation(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster(spark, folder)
    return metrics.mean_by(rows, SNAKE.designation, SNAKE.salary, descending=True)


@register
def avg_score_by_designation(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster(spark, folder)
    return metrics.mean_by(rows, SNAKE.designation, SNAKE.score, descending=False)


@register
def high_performers_by_dept(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.high_performers_by(views.roster(spark, folder), SNAKE.department)


@register
def correlation_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster_with_tenure(spark, folder)
    return metrics.correlation_matrix(rows, [SNAKE.salary, SNAKE.score, SNAKE.tenure])


@register
def correlation_matrix_with_nulls(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.damaged_roster(spark, folder).withColumn("constant", F.lit(1.0))
    return metrics.correlation_matrix(rows, [SNAKE.salary, SNAKE.score, "constant"])


@register
def distinct_departments(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.distinct_groups(views.roster(spark, folder), SNAKE.department)


@register
def departments_by_appearance(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster(spark, folder)
    return metrics.first_seen_groups(rows, SNAKE.department, SNAKE.ordinal)


@register
def dashboard_tiles(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.dashboard_tiles(views.roster(spark, folder))


@register
def top_earners(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.top_earners(views.roster(spark, folder))


# --- distributions and growth ------------------------------------------------------------------


@register
def salary_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return distributions.histogram(views.roster(spark, folder), SNAKE.salary, 15)


@register
def tenure_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return distributions.histogram(views.roster_with_tenure(spark, folder), SNAKE.tenure, 10)


_BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@register
def salary_box_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written(views.roster(spark, folder), SNAKE.department, SNAKE.salary)
    stats = distributions.box_stats(rows, SNAKE.department, SNAKE.salary)
    return _rounded(stats, *_BOX)


@register
def event_box_stats(spark: SparkSession, folder: str) -> DataFrame:
    events = views.table(spark, folder, "events")
    return _rounded(distributions.box_stats(events, "event_type", "value"), *_BOX)


_QUARTILES = ("q1", "median", "q3")


def _quartiles(spark: SparkSession, folder: str, value: Column, scale: float, *by: str) -> DataFrame:
    """Quartiles of event values that logarithmic buckets cannot tell apart."""
    events = views.table(spark, folder, "events").select(*by, value.alias("x"))
    found = exact_quantiles(
        events, "x", [0.25, 0.5, 0.75], by=by, names=_QUARTILES, rows_per_bucket=100
    )
    return _rounded(found.withColumns({q: F.col(q) * scale for q in _QUARTILES}), *_QUARTILES, digits=3)


@register
def quantiles_narrow(spark: SparkSession, folder: str) -> DataFrame:
    return _quartiles(spark, folder, F.col("value") * 1e-9, 1e9, "event_type")


@register
def quantiles_of_times(spark: SparkSession, folder: str) -> DataFrame:
    return _quartiles(spark, folder, F.col("ts").cast("timestamp").cast("double"), 1.0)


def _rank_checks(rows: DataFrame, value: str, by: tuple[str, ...], error: float) -> DataFrame:
    """Per group and quartile, whether the approximate answer's exact rank is within the error allowed."""
    answers = written(approximate_quantiles(rows, value, [0.25, 0.5, 0.75], by, _QUARTILES, error))
    found = rank_distances(rows, value, answers, [0.25, 0.5, 0.75], _QUARTILES, by)
    within = F.col("distance") <= F.col("n") * F.lit(error) + 1
    return found.select(*by, "name", "n", "wanted", within.alias("within_bound"))


@register
def median_approximate(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written(views.damaged_roster(spark, folder), SNAKE.department, SNAKE.salary)
    return _rank_checks(rows, SNAKE.salary, (SNAKE.department,), 0.001)


@register
def quartiles_approximate(spark: SparkSession, folder: str) -> DataFrame:
    """Of all event values, coarsely: a few hundred numbers summarise the table."""
    rows = views.table(spark, folder, "events").select("value")
    return _rank_checks(rows, "value", (), 0.01)


@register
def kpis_approximate(spark: SparkSession, folder: str) -> DataFrame:
    """All indicators but the median as exact ones, the median by how far it is from the exact one."""
    rows = _written(views.roster_with_tenure(spark, folder), *_MEASURES)
    near = written(metrics.kpis(rows, median_rank_error=0.001))
    exact = exact_quantiles(rows, SNAKE.salary, [0.499, 0.501], names=["low", "high"])
    bounds = exact.select(F.struct("low", "high").alias("b")).scalar()
    inside = F.col("MedianSalary").between(bounds["low"] - 0.01, bounds["high"] + 0.01)
    return near.withColumn("MedianSalary", inside).withColumnRenamed("MedianSalary", "median_within_bound")


@register
def salary_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Order prices have no outliers within a segment; event values within a type do."""
    events = views.table(spark, folder, "events").select("event_id", "event_type", "value")
    return distributions.outliers(events, "event_type", "value")


@register
def salary_density(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written(views.roster(spark, folder), SNAKE.department, SNAKE.salary)
    grid = distributions.density(rows, SNAKE.department, SNAKE.salary)
    return grid.select(
        SNAKE.department,
        "point",
        round_half_up(F.col("at"), 4).alias("at"),
        # Densities are near 1e-6: scale before cutting the digits that depend on sum order.
        round_half_up(F.col("density") * 1e6, 6).alias("density_per_million"),
    )


@register
def salary_violin_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = _written(views.roster(spark, folder), SNAKE.department, SNAKE.salary)
    stats = distributions.violin_stats(rows, SNAKE.department, SNAKE.salary)
    return _rounded(stats, "mean", "median", digits=4)


@register
def cumulative_headcount(spark: SparkSession, folder: str) -> DataFrame:
    return growth.cumulative_headcount(views.roster(spark, folder))


@register
def cumulative_headcount_rows(spark: SparkSession, folder: str) -> DataFrame:
    return growth.cumulative_headcount_rows(views.roster(spark, folder))


# --- payload flattening ------------------------------------------------------------------------


@register
def json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.roster_from_users(views.users(spark, folder))


@register
def json_flatten_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return _reason_text(flatten.rejected_users(views.users(spark, folder))).select(
        "event_id", "reasons"
    )


# --- streams, run to the end of the landed data ------------------------------------------------


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = views.table(spark, folder, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def _landed_in_parts(spark: SparkSession, rows: DataFrame, parts: int) -> DataFrame:
    """A stream of ``rows`` from files, one file a micro-batch, by ranges of the order."""
    landing = work_folder(spark)
    rows.repartitionByRange(parts, SNAKE.ordinal).write.parquet(landing)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landing)


@register
def stream_contract_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.damage(views.roster_from_orders(spark, folder, _stream(spark, folder, "orders")))
    out = work_folder(spark)
    jobs.contract_split_stream(rows, views.SEGMENT_FRAME, out, f"{out}/state").awaitTermination()
    return _reason_text(spark.read.parquet(f"{out}/rows")).select(
        SNAKE.ordinal, SNAKE.id, "verdict", "reasons"
    )


@register
def stream_contract_split_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The split over several micro-batches. Which batch comes first is up to the file source, so the
    rows per key and verdict are compared: of a key's rows, one at most is no duplicate."""
    rows = _landed_in_parts(spark, views.damaged_roster(spark, folder), 6)
    out = work_folder(spark)
    jobs.contract_split_stream(rows, views.SEGMENT_FRAME, out, f"{out}/state").awaitTermination()
    found = spark.read.parquet(f"{out}/rows")
    repeated = F.array_contains("reasons", contracts.DUPLICATE)
    return found.groupBy(SNAKE.id).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(repeated).alias("repeated"),
        F.count_if(F.size(F.array_remove("reasons", contracts.DUPLICATE)) > 0).alias("otherwise_bad"),
    )


@register
def stream_dept_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows = views.roster_from_orders(spark, folder, _stream(spark, folder, "orders"))
    out = work_folder(spark)
    jobs.department_summary_stream(rows, f"{out}/summary", f"{out}/state").awaitTermination()
    return jobs.latest_summary(spark, f"{out}/summary")


@register
def stream_json_flatten(spark: SparkSession, folder: str) -> DataFrame:
    users = views.users_from_events(_stream(spark, folder, "events"))
    out = work_folder(spark)
    jobs.flatten_stream(users, f"{out}/rows", f"{out}/state").awaitTermination()
    clean, _ = contracts.split(spark.read.parquet(f"{out}/rows"))
    return contracts.standardise(clean).select(*SNAKE.base, "event_id")
