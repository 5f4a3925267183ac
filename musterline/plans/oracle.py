"""The same results as the registered queries, in SQL over the given tables."""

from __future__ import annotations

from musterline.fixed_values import AS_OF_DEFAULT, DEPARTMENTS, KPI_REPORT_ROWS
from musterline.plans.views import SEGMENTS

ORACLE: dict[str, str] = {}

_BASE = "employee_id, name, department, designation, salary, joining_date, performance_score"
_PASCAL = (
    "employee_id AS EmployeeID, name AS Name, department AS Department, designation AS Designation, "
    "salary AS Salary, joining_date AS JoiningDate, performance_score AS PerformanceScore"
)
_SEGMENT_LIST = ", ".join(f"'{name}'" for name in SEGMENTS)

# --- views -------------------------------------------------------------------------------------

_ROSTER = """
roster AS (
  SELECT o_orderkey + 1 AS employee_id, c_name AS name, c_mktsegment AS department,
         n_name AS designation, o_totalprice AS salary, CAST(o_orderdate AS DATE) AS joining_date,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS performance_score,
         o_orderkey + 1 AS ordinal
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""

_TENURED = f"""
tenured AS (
  SELECT *, date_diff('day', joining_date, DATE '{AS_OF_DEFAULT}') / CAST(365.25 AS DOUBLE)
            AS tenure_years
  FROM roster
)"""

_DAMAGED = """
damaged AS (
  SELECT CASE WHEN ordinal % 37 = 0 THEN NULL
              WHEN ordinal % 13 = 0 THEN employee_id - employee_id % 10
              ELSE employee_id END AS employee_id,
         name,
         CASE WHEN ordinal % 23 = 0 THEN 'UNKNOWN' ELSE department END AS department,
         designation,
         CASE WHEN ordinal % 17 <> 0 THEN salary END AS salary,
         CASE WHEN ordinal % 29 = 0 THEN strftime(joining_date, '%Y/%m/%d')
              ELSE strftime(joining_date, '%Y-%m-%d') END AS joining_date,
         CASE WHEN ordinal % 19 <> 0 THEN performance_score END AS performance_score,
         ordinal
  FROM roster
)"""

_TEXTS = """
texts AS (
  SELECT CASE WHEN ordinal % 41 = 0 THEN 'x' || CAST(employee_id AS VARCHAR)
              WHEN ordinal % 43 = 0 THEN ' +' || CAST(employee_id AS VARCHAR) || chr(9)
              ELSE CAST(employee_id AS VARCHAR) END AS employee_id,
         name,
         CASE WHEN ordinal % 47 = 0 THEN ' ' || department || ' ' ELSE department END AS department,
         CASE WHEN ordinal % 53 = 0 THEN '   ' ELSE designation END AS designation,
         CASE WHEN ordinal % 31 = 0 THEN '5d' WHEN ordinal % 59 = 0 THEN 'nan'
              WHEN ordinal % 61 = 0 THEN '20_000'
              WHEN salary IS NOT NULL THEN printf('%.2f', salary) END AS salary,
         joining_date,
         CASE WHEN ordinal % 11 = 0 THEN CAST(performance_score AS VARCHAR) || '.7'
              ELSE CAST(performance_score AS VARCHAR) END AS performance_score,
         ordinal
  FROM damaged
)"""

# The text fields as numbers: null where the text is none.
_PARSED = r"""
parsed AS (
  SELECT *,
    CASE WHEN regexp_full_match(trim(employee_id, ' ' || chr(9)), '[+-]?[0-9]+(_[0-9]+)*')
         THEN CAST(replace(trim(employee_id, ' ' || chr(9)), '_', '') AS BIGINT) END AS id_number,
    CASE WHEN regexp_full_match(salary, '[0-9]+(_[0-9]+)*([.][0-9]+)?')
         THEN CAST(replace(salary, '_', '') AS DOUBLE) END AS salary_number,
    CASE WHEN regexp_full_match(performance_score, '[0-9]+')
         THEN CAST(performance_score AS INTEGER) END AS score_number,
    CASE WHEN regexp_full_match(performance_score, '[0-9]+([.][0-9]+)?')
         THEN CAST(performance_score AS DOUBLE) END AS loose_score
  FROM texts
)"""

_USERS = """
users AS (
  SELECT event_id,
         CASE WHEN event_id % 11 = 0 THEN 'u' || CAST(k AS VARCHAR)
              WHEN event_id % 13 = 0 THEN CAST(-k AS VARCHAR) ELSE CAST(k AS VARCHAR) END AS id,
         CASE WHEN event_id % 17 <> 0 THEN 'User ' || CAST(user_id AS VARCHAR) END AS name,
         CASE WHEN event_id % 19 = 0 THEN NULL
              WHEN event_id % 3 = 0 THEN upper(event_type) || ' online MARKETS'
              WHEN event_id % 5 = 0 THEN 'a b'
              WHEN event_id % 7 = 0 THEN ''
              ELSE event_type || '-driven growth' END AS role
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) AS e
)"""


def _mod(n: int) -> str:
    return f"(((u % {n}) + {n}) % {n})"


_FLAT = f"""
flat AS (
  SELECT event_id, u + 2000 AS employee_id, name,
         [{", ".join(f"'{name}'" for name in DEPARTMENTS)}][CAST({_mod(5)} + 1 AS INTEGER)] AS department,
         CASE WHEN length(split_part(role, ' ', 1)) >= 3
              THEN upper(left(split_part(role, ' ', 1), 1)) || lower(substr(split_part(role, ' ', 1), 2))
              ELSE 'Associate' END AS designation,
         CAST(40000 + u * 10000 AS DOUBLE) AS salary,
         make_date(2024, CAST({_mod(12)} + 1 AS INTEGER), CAST({_mod(28)} + 1 AS INTEGER)) AS joining_date,
         CAST({_mod(5)} + 1 AS INTEGER) AS performance_score
  FROM (SELECT *, CASE WHEN regexp_full_match(id, '-?[0-9]+') THEN CAST(id AS BIGINT) END AS u
        FROM users) AS numbered
),
flat_checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT coalesce(employee_id > 0, false) THEN 'id' END,
    CASE WHEN name IS NULL THEN 'name' END,
    CASE WHEN department IS NULL THEN 'department' END,
    CASE WHEN NOT coalesce(salary BETWEEN 15000 AND 300000, false) THEN 'salary' END,
    CASE WHEN joining_date IS NULL THEN 'joining_date' END,
    CASE WHEN performance_score IS NULL THEN 'performance_score' END) AS reasons
  FROM flat
)"""

_SPLIT = f"""
checked AS (
  SELECT *, concat_ws(',',
    CASE WHEN NOT coalesce(employee_id > 0, false) THEN 'id' END,
    CASE WHEN department NOT IN ({_SEGMENT_LIST}) THEN 'department' END,
    CASE WHEN NOT coalesce(salary BETWEEN 15000 AND 300000, false) THEN 'salary' END,
    CASE WHEN NOT regexp_full_match(joining_date, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')
         THEN 'joining_date' END,
    CASE WHEN NOT coalesce(performance_score BETWEEN 1 AND 5, false) THEN 'performance_score' END,
    CASE WHEN employee_id IS NOT NULL
          AND row_number() OVER (PARTITION BY employee_id ORDER BY ordinal) > 1
         THEN 'duplicate' END) AS reasons
  FROM damaged
)"""

_KEPT = """
kept AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY ordinal) AS rn FROM damaged
  ) AS ranked WHERE rn = 1
)"""

_CLEANED = f"""
cleaned AS (
  SELECT employee_id, name, department, designation,
         coalesce(salary, (SELECT median(salary) FROM kept)) AS salary,
         coalesce(try_cast(CASE WHEN joining_date LIKE '%-%' THEN joining_date END AS DATE),
                  DATE '2024-01-01') AS joining_date,
         coalesce(performance_score, 3) AS performance_score, ordinal
  FROM kept
),
clean_tenured AS (
  SELECT *, date_diff('day', joining_date, DATE '{AS_OF_DEFAULT}') / CAST(365.25 AS DOUBLE)
            AS tenure_years
  FROM cleaned
)"""


def _with(*views: str, query: str) -> str:
    return "WITH " + ",".join(views) + "\n" + query


def _round(value: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(28,8)), {digits}) AS DOUBLE)"


def _sum(value: str) -> str:
    return f"CAST(round(sum(CAST({value} AS DECIMAL(18,4))), 2) AS DOUBLE)"


def _mean(value: str) -> str:
    return _round(f"CAST(sum(CAST({value} AS DECIMAL(18,4))) AS DOUBLE) / count({value})")


# --- sources and sinks -------------------------------------------------------------------------

_ENTITY_REASONS = f"""concat_ws(',',
    CASE WHEN NOT coalesce(id_number > 0, false) THEN 'id' END,
    CASE WHEN trim(department) NOT IN ({_SEGMENT_LIST}) THEN 'department' END,
    CASE WHEN trim(designation) = '' THEN 'designation' END,
    CASE WHEN NOT coalesce(salary_number BETWEEN 15000 AND 300000, false) THEN 'salary' END,
    CASE WHEN joining_date NOT LIKE '%-%' THEN 'joining_date' END,
    CASE WHEN NOT coalesce(score_number BETWEEN 1 AND 5, false) THEN 'performance_score' END)"""

_TEXT_VIEWS = (_ROSTER, _DAMAGED, _TEXTS)
ORACLE["csv_contract_read"] = _with(
    *_TEXT_VIEWS, _PARSED, query=f"SELECT {_PASCAL}, {_ENTITY_REASONS} AS reasons FROM parsed"
)
ORACLE["csv_raw_read"] = _with(*_TEXT_VIEWS, query=f"SELECT {_PASCAL} FROM texts")
ORACLE["table_scan_rename"] = _with(_ROSTER, query=f"SELECT {_PASCAL} FROM roster")
ORACLE["source_fallback"] = _with(_ROSTER, query=f"SELECT {_BASE} FROM roster")
ORACLE["json_source"] = _with(
    _USERS, query="SELECT id, role, count(*) AS users FROM users GROUP BY id, role"
)
ORACLE["feed_resolution"] = """
WITH landed AS (
  SELECT CASE event_type WHEN 'click' THEN 'Weather' WHEN 'view' THEN 'Holidays'
                         ELSE event_type END AS feed, arg_max(props, event_id) AS data
  FROM events GROUP BY 1
)
SELECT s.feed, CASE WHEN l.data IS NULL THEN 'fallback' ELSE 'success' END AS status,
       coalesce(l.data, s.fallback) AS data
FROM (VALUES
  ('Weather', '{"temperature": 28.5, "condition": "Sunny", "location": "Bangalore Office"}'),
  ('Holidays', '{"upcoming_holidays_count": 3, "next_holiday": "Republic Day"}'),
  ('Time', '{"timezone": "Asia/Kolkata", "dst": false, "epoch": 0}')) AS s(feed, fallback)
LEFT JOIN landed AS l ON l.feed = s.feed
"""
ORACLE["file_headcount"] = "SELECT count(*) AS headcount FROM orders"
ORACLE["csv_export_rows"] = _with(
    _ROSTER,
    query="""
SELECT CAST(employee_id AS VARCHAR) AS EmployeeID, name AS Name, department AS Department,
       designation AS Designation, printf('%.2f', salary) AS Salary,
       CAST(joining_date AS VARCHAR) AS JoiningDate,
       CAST(performance_score AS VARCHAR) AS PerformanceScore
FROM roster""",
)
ORACLE["full_reload"] = ORACLE["source_fallback"]

_PAY = """
       salary * 12 AS annual_salary, salary * 12 * CAST(0.1 AS DOUBLE) AS annual_bonus,
       salary * 12 * CAST(0.08 AS DOUBLE) AS annual_tax,
       salary * 12 + salary * 12 * CAST(0.1 AS DOUBLE) - salary * 12 * CAST(0.08 AS DOUBLE)
         AS net_salary"""
ORACLE["directory_export"] = _with(_ROSTER, query=f"SELECT {_BASE}, {_PAY} FROM roster")
ORACLE["compensation"] = ORACLE["directory_export"]


def _summary(source: str) -> str:
    return f"""
  SELECT department AS Department, count(*) AS Headcount, {_sum("salary")} AS TotalSalary,
         {_mean("salary")} AS AverageSalary, {_round("max(salary)")} AS MaxSalary
  FROM {source} GROUP BY department"""


ORACLE["dept_summary"] = _with(_ROSTER, query=_summary("roster"))
ORACLE["stream_dept_summary"] = ORACLE["dept_summary"]
ORACLE["json_array_source"] = ORACLE["json_source"]
ORACLE["json_default_source"] = _with(
    _ROSTER,
    """
merged AS (
  SELECT department, salary FROM roster
  UNION ALL SELECT * FROM (VALUES ('Engineering', CAST(50000 AS DOUBLE)), ('Finance', 60000),
    ('Sales', 70000), ('Marketing', 80000), ('HR', 90000)) AS d(department, salary)
)""",
    query=_summary("merged"),
)
ORACLE["dept_summary_with_total"] = _with(
    _ROSTER,
    f" summary AS ({_summary('roster')})",
    query=f"""
SELECT * FROM summary
UNION ALL
SELECT 'Grand Total', CAST(sum(Headcount) AS BIGINT), {_sum("TotalSalary")},
       {_mean("AverageSalary")}, max(MaxSalary) FROM summary""",
)

_HIGH = "count(*) FILTER (WHERE performance_score >= 4)"


def _kpis(source: str) -> str:
    return f"""
  SELECT count(*) AS Headcount, {_sum("salary")} AS TotalSalaryExpense,
         {_mean("salary")} AS AverageSalary, {_round("median(salary)")} AS MedianSalary,
         {_round("max(salary)")} AS MaxSalary, {_round("min(salary)")} AS MinSalary,
         {_round("CAST(sum(performance_score) AS DOUBLE) / count(*)")} AS AveragePerformanceScore,
         {_round("avg(tenure_years)")} AS AverageTenureYears, {_HIGH} AS HighPerformersCount,
         {_round(f"CAST({_HIGH} AS DOUBLE) / count(*) * 100")} AS HighPerformersRatio
  FROM {source}"""


_TOP = """
top AS (
  SELECT employee_id AS EmployeeID, name AS Name, salary AS Salary, department AS Department
  FROM roster ORDER BY salary DESC, ordinal LIMIT 5
)"""

ORACLE["kpis"] = _with(_ROSTER, _TENURED, query=_kpis("tenured"))
ORACLE["kpis_of_damaged"] = _with(_ROSTER, _DAMAGED, _KEPT, _CLEANED, query=_kpis("clean_tenured"))
ORACLE["kpis_nested"] = _with(
    _ROSTER,
    _TOP,
    query=f"""
SELECT (SELECT count(*) FROM roster) AS Headcount,
       (SELECT {_round("median(salary)")} FROM roster) AS MedianSalary,
       (SELECT string_agg(concat_ws('|', CAST(EmployeeID AS VARCHAR), Name, printf('%.2f', Salary),
                                    Department), ';' ORDER BY Salary DESC, EmployeeID)
        FROM top) AS Top5Earners""",
)
ORACLE["kpis_approximate"] = _with(
    _ROSTER,
    _TENURED,
    query=f"""
SELECT * EXCLUDE (MedianSalary), true AS median_within_bound FROM ({_kpis("tenured")}) AS exact""",
)


def _within(group: str, source: str, where: str) -> str:
    """Per group and quartile, the rank wanted; every approximate answer must be within its bound."""
    key, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    return f"""
SELECT {key}name, n, p * (n - 1) AS wanted, true AS within_bound
FROM (SELECT {key}count(*) AS n FROM {source} WHERE {where} {by}) AS counted,
     (VALUES ('q1', 0.25::DOUBLE), ('median', 0.5::DOUBLE), ('q3', 0.75::DOUBLE)) AS quartiles(name, p)"""


ORACLE["median_approximate"] = _with(
    _ROSTER, _DAMAGED, query=_within("department", "damaged", "salary IS NOT NULL")
)
ORACLE["quartiles_approximate"] = _within("", "events", "value IS NOT NULL")
ORACLE["top_earners"] = _with(_ROSTER, _TOP, query="SELECT * FROM top")


def _short(value: str) -> str:
    return f"regexp_replace(format('{{:,.2f}}', {value}), '0$', '')"


def _kpi_text(column: str, before: str) -> str:
    if column in ("Headcount", "HighPerformersCount"):
        return f"CAST({column} AS VARCHAR)"
    return _short(column) if before else f"replace({_short(column)}, ',', '')"


ORACLE["kpi_report_long"] = _with(
    _ROSTER,
    _TENURED,
    f" k AS ({_kpis('tenured')})",
    query="\nUNION ALL ".join(
        f"SELECT {position} AS position, '{metric}' AS metric, "
        f"'{before}' || {_kpi_text(column, before)} || '{after}' AS value, "
        f"'{description}' AS description FROM k"
        for position, (column, metric, before, after, description) in enumerate(KPI_REPORT_ROWS, 1)
    ),
)
ORACLE["dept_report_rows"] = _with(
    _ROSTER,
    f" summary AS ({_summary('roster')})",
    query=f"""
SELECT Department, Headcount, '₹' || {_short("AverageSalary")} AS AverageSalary,
       '₹' || {_short("MaxSalary")} AS MaxSalary, '₹' || {_short("TotalSalary")} AS TotalSalary
FROM summary""",
)
ORACLE["top5_report_rows"] = _with(
    _ROSTER,
    _TOP,
    query=f"""
SELECT EmployeeID AS ID, Name, Department, '₹' || {_short("Salary")} AS MonthlySalary FROM top""",
)

# --- keyed changes -----------------------------------------------------------------------------


def _event_rows(key: str) -> str:
    return f"""
changed AS (
  SELECT {key} AS employee_id, 'Event ' || event_type AS name, 'BUILDING' AS department,
         'Clerk' AS designation, 15000 + value AS salary, CAST(ts AS DATE) AS joining_date,
         CAST(user_id % 5 + 1 AS INTEGER) AS performance_score
  FROM events
)"""


ORACLE["insert_rows"] = _with(
    _ROSTER,
    _event_rows("event_id * 3 + 1"),
    query=f"""
SELECT {_BASE} FROM roster
UNION ALL
SELECT {_BASE} FROM changed
WHERE employee_id NOT IN (SELECT employee_id FROM roster)""",
)
ORACLE["batch_insert"] = _with(
    _ROSTER,
    _event_rows("-1 - event_id"),
    query=f"SELECT {_BASE} FROM roster UNION ALL SELECT {_BASE} FROM changed",
)
ORACLE["batch_conflicts"] = _with(
    _ROSTER,
    _event_rows("user_id * 37"),
    query="""
SELECT * FROM (
  SELECT employee_id, count(*) AS rows_in_batch,
         employee_id IN (SELECT employee_id FROM roster) AS in_table
  FROM changed GROUP BY employee_id) AS c
WHERE rows_in_batch > 1 OR in_table""",
)
ORACLE["insert_offers"] = _with(
    _ROSTER,
    query="""
, offers AS (
  SELECT event_id AS offer, CASE WHEN event_id % 7 <> 0 THEN user_id * 37 END AS employee_id,
         event_id % 5 = 0 AND value > -15000 OR event_id % 5 <> 0 AND value < -15000 AS illegal
  FROM events
),
firsts AS (
  SELECT employee_id, min(offer) AS first FROM offers
  WHERE employee_id IS NOT NULL AND NOT illegal GROUP BY employee_id
)
SELECT o.offer, o.employee_id, CASE
  WHEN o.employee_id IS NULL OR o.illegal THEN
    concat_ws(',', CASE WHEN o.employee_id IS NULL THEN 'id' END, CASE WHEN o.illegal THEN 'salary' END)
  ELSE concat_ws(',',
    CASE WHEN o.offer > f.first THEN 'duplicate' END,
    CASE WHEN o.employee_id IN (SELECT employee_id FROM roster) THEN 'present' END)
  END AS reasons
FROM offers AS o LEFT JOIN firsts AS f USING (employee_id)""",
)
ORACLE["update_rows"] = _with(
    _ROSTER,
    _event_rows("event_id + 1"),
    query=f"""
SELECT {_BASE} FROM roster WHERE employee_id NOT IN (SELECT employee_id FROM changed)
UNION ALL SELECT {_BASE} FROM changed""",
)
ORACLE["update_missing_keys"] = _with(
    _ROSTER,
    _event_rows("event_id * 2"),
    query="""
SELECT DISTINCT employee_id FROM changed
WHERE employee_id NOT IN (SELECT employee_id FROM roster)""",
)
ORACLE["delete_rows"] = _with(
    _ROSTER,
    query=f"""
SELECT {_BASE} FROM roster
WHERE employee_id NOT IN (SELECT event_id + 1 FROM events WHERE event_type = 'error')""",
)
ORACLE["update_files"] = ORACLE["update_rows"]
ORACLE["delete_files"] = ORACLE["delete_rows"]
ORACLE["files_kept_by_update"] = """
SELECT count(*) AS rows, least(count(*), 10) AS renamed, 1 AS files_replaced FROM orders
"""
ORACLE["search_names_indexed"] = _with(
    _ROSTER,
    """
renamed AS (
  SELECT * REPLACE (CASE WHEN row_number() OVER (ORDER BY employee_id) <= 10 THEN 'Cust_mer#x9' ELSE name END AS name)
  FROM roster
)""",
    query=f"SELECT {_BASE} FROM renamed WHERE name ILIKE '%cust_MER#%9%'",
)
ORACLE["create_if_missing"] = _with(_event_rows("event_id + 1"), query=f"SELECT {_BASE} FROM changed")
_LEGAL = "salary BETWEEN 15000 AND 300000 AND performance_score BETWEEN 1 AND 5"
ORACLE["recheck_on_read"] = _with(_ROSTER, query=f"SELECT {_BASE} FROM roster WHERE {_LEGAL}")
ORACLE["recheck_violations"] = _with(
    _ROSTER, query=f"SELECT employee_id, 'salary' AS reasons FROM roster WHERE NOT ({_LEGAL})"
)
ORACLE["merge_sources"] = _with(
    _ROSTER,
    _USERS,
    _FLAT,
    query=f"""
SELECT {_BASE} FROM roster
UNION ALL SELECT {_BASE} FROM flat_checked WHERE reasons = ''""",
)

# --- lookups, searches, projections ------------------------------------------------------------

ORACLE["lookup_by_id"] = _with(
    _ROSTER,
    query=f"SELECT {_BASE} FROM roster WHERE employee_id IN (SELECT user_id FROM events)",
)
ORACLE["lookup_in_files"] = ORACLE["lookup_by_id"]
ORACLE["scan_ordered"] = _with(_ROSTER, query=f"SELECT {_BASE} FROM roster ORDER BY employee_id")
ORACLE["search_name"] = _with(
    _ROSTER, query=f"SELECT {_BASE} FROM roster WHERE name ILIKE '%cust_MER#%9%'"
)
ORACLE["search_department"] = _with(
    _ROSTER, query=f"SELECT {_BASE} FROM roster WHERE department = 'FURNITURE'"
)
ORACLE["search_salary_range"] = _with(
    _ROSTER, query=f"SELECT {_BASE} FROM roster WHERE salary >= 50000 AND salary <= 100000"
)
ORACLE["search_combined"] = _with(
    _ROSTER,
    query=f"""
SELECT {_BASE} FROM roster
WHERE name ILIKE '%r#0000%' AND department = 'BUILDING' AND salary >= 0 AND salary <= 250000""",
)
ORACLE["high_performer_flag"] = _with(
    _ROSTER,
    _DAMAGED,
    query="""
SELECT ordinal, performance_score, coalesce(performance_score >= 4, false) AS is_high_performer
FROM damaged""",
)
ORACLE["typed_from_raw"] = _with(
    *_TEXT_VIEWS,
    _PARSED,
    query="""
SELECT id_number AS employee_id, name, department, designation, salary_number AS salary,
       joining_date, score_number AS performance_score, ordinal,
       concat_ws(',',
         CASE WHEN employee_id IS NULL THEN 'employee_id:missing'
              WHEN id_number IS NULL THEN 'employee_id:type' END,
         CASE WHEN salary IS NULL THEN 'salary:missing'
              WHEN salary_number IS NULL THEN 'salary:type' END,
         CASE WHEN performance_score IS NULL THEN 'performance_score:missing'
              WHEN score_number IS NULL THEN 'performance_score:type' END) AS cast_errors
FROM parsed""",
)
ORACLE["tenure"] = f"""
SELECT event_id, days AS tenure_days, days / CAST(365.25 AS DOUBLE) AS tenure_years
FROM (SELECT event_id,
             CAST(floor((epoch_us(TIMESTAMP '{AS_OF_DEFAULT} 00:00:00') - epoch_us(ts))
                        / CAST(86400000000 AS DOUBLE)) AS BIGINT) AS days
      FROM events) AS d
"""
ORACLE["scatter_score_salary"] = _with(
    _ROSTER, query="SELECT performance_score, salary FROM roster"
)
ORACLE["scatter_tenure_salary"] = _with(
    _ROSTER, _TENURED, query="SELECT tenure_years, salary FROM tenured"
)
ORACLE["scatter_tenure_salary_cells"] = _with(
    _ROSTER,
    _TENURED,
    query="""
SELECT CAST(least(floor((t.tenure_years - s.x0) / (s.x1 - s.x0) * 40), 39) AS INTEGER) AS x_bin,
       CAST(least(floor((t.salary - s.y0) / (s.y1 - s.y0) * 25), 24) AS INTEGER) AS y_bin,
       count(*) AS points
FROM tenured AS t,
     (SELECT min(tenure_years) AS x0, max(tenure_years) AS x1, min(salary) AS y0, max(salary) AS y1
      FROM tenured) AS s
GROUP BY 1, 2""",
)
ORACLE["directory_view"] = _with(
    _ROSTER,
    query="""
SELECT employee_id, name, department, designation, '₹' || format('{:,.2f}', salary) AS monthly_salary,
       performance_score AS rating,
       CASE WHEN performance_score >= 4 THEN 'score-high' ELSE '' END AS badge
FROM roster""",
)

# --- contracts ---------------------------------------------------------------------------------

ORACLE["valid_email"] = """
SELECT c_custkey, c_custkey % 5 IN (0, 1) AS valid FROM customer
"""
_DATE_TEXTS = """
dates AS (
  SELECT o_orderkey,
         CASE o_orderkey % 6
           WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
           WHEN 1 THEN strftime(o_orderdate, '%Y-%-m-%-d')
           WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y')
           WHEN 3 THEN strftime(o_orderdate, '%Y-%m') || '-31'
           WHEN 4 THEN strftime(o_orderdate, '%Y') || '-99-99' END AS text
  FROM orders
)"""
ORACLE["valid_date_shape"] = _with(
    _DATE_TEXTS,
    query="""
SELECT o_orderkey, coalesce(regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}'), false) AS valid
FROM dates""",
)
ORACLE["valid_date_strict"] = _with(
    _DATE_TEXTS,
    query="""
SELECT o_orderkey, coalesce(text LIKE '____-%' AND try_strptime(text, '%Y-%m-%d') IS NOT NULL, false)
         AS valid
FROM dates""",
)
_SPLIT_VIEWS = (_ROSTER, _DAMAGED, _SPLIT)
ORACLE["contract_split"] = _with(*_SPLIT_VIEWS, query="SELECT ordinal, employee_id, reasons FROM checked")
ORACLE["contract_split_counts"] = _with(
    *_SPLIT_VIEWS,
    query="""
SELECT count(*) AS total_rows, count(*) FILTER (WHERE reasons = '') AS clean_rows,
       count(*) FILTER (WHERE reasons <> '') AS quarantined_rows FROM checked""",
)
ORACLE["quarantine"] = _with(*_SPLIT_VIEWS, query="SELECT * FROM checked WHERE reasons <> ''")
ORACLE["quarantine_summary"] = _with(
    *_SPLIT_VIEWS,
    query="""
SELECT reason, count(*) AS rows
FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM checked WHERE reasons <> '') AS r
GROUP BY reason""",
)
ORACLE["stream_contract_split"] = _with(
    *_SPLIT_VIEWS,
    query="""
SELECT ordinal, employee_id, CASE WHEN reasons = '' THEN 'clean' ELSE 'quarantine' END AS verdict,
       reasons FROM checked""",
)
ORACLE["stream_contract_split_batches"] = _with(
    *_SPLIT_VIEWS,
    query="""
SELECT employee_id, count(*) AS rows, CASE WHEN employee_id IS NULL THEN 0 ELSE count(*) - 1 END AS repeated,
       count(*) FILTER (reasons NOT IN ('', 'duplicate')) AS otherwise_bad
FROM checked GROUP BY employee_id""",
)
ORACLE["clean_standardised"] = _with(
    *_TEXT_VIEWS,
    _PARSED,
    query=f"""
SELECT id_number AS employee_id, name, department, trim(designation) AS designation,
       salary_number AS salary, joining_date, CAST(floor(loose_score) AS INTEGER) AS performance_score,
       ordinal
FROM (SELECT *, row_number() OVER (PARTITION BY id_number ORDER BY ordinal) AS rn FROM parsed) AS p
WHERE rn = 1 AND regexp_full_match(employee_id, '[0-9]+') AND id_number > 0
  AND department IN ({_SEGMENT_LIST}) AND salary_number BETWEEN 15000 AND 300000
  AND joining_date LIKE '%-%' AND loose_score BETWEEN 1 AND 5""",
)
ORACLE["entity_contract"] = _with(
    *_TEXT_VIEWS, _PARSED, query=f"SELECT ordinal, {_ENTITY_REASONS} AS reasons FROM parsed"
)
ORACLE["table_constraints"] = _with(
    _ROSTER,
    _DAMAGED,
    query="""
SELECT ordinal, concat_ws(',', CASE WHEN employee_id IS NULL THEN 'id' END,
         CASE WHEN salary IS NULL OR salary < 0 THEN 'salary' END,
         CASE WHEN NOT coalesce(performance_score BETWEEN 1 AND 5, false)
              THEN 'performance_score' END) AS reasons
FROM damaged""",
)
ORACLE["first_violation"] = _with(
    *_TEXT_VIEWS,
    _PARSED,
    query=f"""
SELECT ordinal,
       CASE violation WHEN 'id' THEN 'employee_id' ELSE violation END AS violated_field, violation,
       CASE violation WHEN 'id' THEN coalesce(employee_id, '') WHEN 'department' THEN department
         WHEN 'designation' THEN designation WHEN 'salary' THEN coalesce(salary, '')
         WHEN 'joining_date' THEN joining_date
         WHEN 'performance_score' THEN coalesce(performance_score, '') END AS violating_value
FROM (SELECT *, nullif(split_part({_ENTITY_REASONS}, ',', 1), '') AS violation FROM parsed) AS v""",
)
ORACLE["duplicate_mask"] = _with(
    _ROSTER,
    _DAMAGED,
    query="""
SELECT ordinal, employee_id,
       row_number() OVER (PARTITION BY employee_id ORDER BY ordinal) > 1 AS is_duplicate
FROM damaged""",
)

# --- cleaning ----------------------------------------------------------------------------------

ORACLE["dedup_keep_first"] = _with(_ROSTER, _DAMAGED, _KEPT, query="SELECT * FROM kept")
ORACLE["coerce_numeric"] = _with(
    *_TEXT_VIEWS,
    query="""
SELECT ordinal,
       CASE WHEN regexp_full_match(salary, '[0-9]+([.][0-9]+)?') THEN CAST(salary AS DOUBLE) END
         AS salary,
       CAST(performance_score AS DOUBLE) AS performance_score
FROM texts""",
)
ORACLE["impute_median"] = _with(
    _ROSTER,
    _DAMAGED,
    query=f"""
SELECT ordinal, {_round("coalesce(salary, (SELECT median(salary) FROM damaged))", 4)} AS salary
FROM damaged""",
)
ORACLE["impute_constant"] = _with(
    _ROSTER,
    _DAMAGED,
    query="SELECT ordinal, coalesce(performance_score, 3) AS performance_score FROM damaged",
)
ORACLE["coerce_date"] = _with(
    _ROSTER,
    _DAMAGED,
    query="""
SELECT ordinal, coalesce(CASE WHEN joining_date LIKE '%-%' THEN CAST(joining_date AS DATE) END,
                         DATE '2024-01-01') AS joining_date
FROM damaged""",
)
ORACLE["clean_roster"] = _with(
    _ROSTER,
    _DAMAGED,
    _KEPT,
    _CLEANED,
    query=f"SELECT * REPLACE ({_round('salary', 4)} AS salary) FROM clean_tenured",
)

# --- metrics -----------------------------------------------------------------------------------

ORACLE["headcount_by_dept"] = _with(
    _ROSTER, query="SELECT department, count(*) AS headcount FROM roster GROUP BY department"
)
ORACLE["salary_by_dept"] = _with(
    _ROSTER, query=f"SELECT department, {_sum('salary')} AS total FROM roster GROUP BY department"
)
for _key, _group, _value in (
    ("avg_salary_by_dept", "department", "salary"),
    ("avg_score_by_dept", "department", "performance_score"),
    ("avg_salary_by_designation", "designation", "salary"),
    ("avg_score_by_designation", "designation", "performance_score"),
):
    ORACLE[_key] = _with(
        _ROSTER, query=f"SELECT {_group}, {_mean(_value)} AS average FROM roster GROUP BY {_group}"
    )
ORACLE["score_distribution"] = _with(
    _ROSTER,
    _DAMAGED,
    query=f"""
SELECT performance_score, count(*) AS headcount,
       {_round("count(*) * CAST(100 AS DOUBLE) / (SELECT count(performance_score) FROM damaged)", 1)}
         AS share_percent
FROM damaged WHERE performance_score IS NOT NULL GROUP BY performance_score""",
)
ORACLE["high_performers_by_dept"] = _with(
    _ROSTER,
    query=f"""
SELECT department, count(*) - {_HIGH} AS core_performers, {_HIGH} AS high_performers
FROM roster GROUP BY department""",
)


def _correlations(source: str, names: list[str]) -> str:
    parts = []
    for x in names:
        for y in names:
            r = f"corr(CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))"
            parts.append(
                f"SELECT '{x}' AS x, '{y}' AS y, CASE WHEN isfinite(r) THEN {_round('r', 6)} END AS r "
                f"FROM (SELECT {r} AS r FROM {source}) AS c"
            )
    return "\nUNION ALL ".join(parts)


ORACLE["correlation_matrix"] = _with(
    _ROSTER,
    _TENURED,
    query=_correlations("tenured", ["salary", "performance_score", "tenure_years"]),
)
ORACLE["correlation_matrix_with_nulls"] = _with(
    _ROSTER,
    _DAMAGED,
    ' flat AS (SELECT *, CAST(1 AS DOUBLE) AS "constant" FROM damaged)',
    query=_correlations("flat", ["salary", "performance_score", '"constant"']).replace(
        "'\"constant\"'", "'constant'"
    ),
)
ORACLE["distinct_departments"] = _with(_ROSTER, query="SELECT DISTINCT department FROM roster")
ORACLE["departments_by_appearance"] = _with(
    _ROSTER, query="SELECT department, min(ordinal) AS first_seen FROM roster GROUP BY department"
)
ORACLE["dashboard_tiles"] = _with(
    _ROSTER,
    query=f"""
SELECT count(*) AS active_headcount, {_mean("salary")} AS average_monthly_salary,
       {_sum("salary")} AS total_monthly_expense,
       {_round(f"CAST({_HIGH} AS DOUBLE) / count(*) * 100")} AS high_performers_percent
FROM roster""",
)

# --- distributions and growth ------------------------------------------------------------------


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""
SELECT e.bin, e.lower_edge, e.upper_edge, count(t.x) AS count
FROM (SELECT CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / {bins}.0::DOUBLE) AS lower_edge,
             CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {bins}.0::DOUBLE) END
               AS upper_edge
      FROM (SELECT min({value}) AS lo, max({value}) AS hi FROM {source}) AS s,
           (SELECT unnest(generate_series(0, {bins - 1})) AS i) AS g) AS e
LEFT JOIN (SELECT {value} AS x FROM {source}) AS t
  ON t.x >= e.lower_edge AND (t.x < e.upper_edge OR (e.bin = {bins - 1} AND t.x <= e.upper_edge))
GROUP BY e.bin, e.lower_edge, e.upper_edge"""


ORACLE["salary_histogram"] = _with(_ROSTER, query=_histogram("roster", "salary", 15))
ORACLE["tenure_histogram"] = _with(_ROSTER, _TENURED, query=_histogram("tenured", "tenure_years", 10))


def _boxes(source: str, group: str, value: str) -> str:
    return f"""
quartiles AS (
  SELECT {group} AS g, count(*) AS n, quantile_cont({value}, 0.25) AS q1,
         quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q3
  FROM {source} GROUP BY {group}
),
fenced AS (
  SELECT q.*, s.{value} AS x, s.{value} >= q.q1 - 1.5 * (q.q3 - q.q1) AS low_ok,
         s.{value} <= q.q3 + 1.5 * (q.q3 - q.q1) AS high_ok
  FROM {source} AS s JOIN quartiles AS q ON s.{group} = q.g
)"""


def _box_query(group: str) -> str:
    return f"""
SELECT g AS {group}, n, {_round("q1", 6)} AS q1, {_round("median", 6)} AS median,
       {_round("q3", 6)} AS q3,
       {_round("least(min(x) FILTER (WHERE low_ok), q1)", 6)} AS whisker_low,
       {_round("greatest(max(x) FILTER (WHERE high_ok), q3)", 6)} AS whisker_high,
       count(*) FILTER (WHERE NOT (low_ok AND high_ok)) AS outliers
FROM fenced GROUP BY g, n, q1, median, q3"""


ORACLE["salary_box_stats"] = _with(
    _ROSTER, _boxes("roster", "department", "salary"), query=_box_query("department")
)
ORACLE["event_box_stats"] = _with(
    _boxes("events", "event_type", "value"), query=_box_query("event_type")
)


def _quartiles(value: str, scale: str, group: str = "") -> str:
    columns = ", ".join(
        _round(f"quantile_cont({value}, {p}) * {scale}", 3) + f" AS {name}"
        for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))
    )
    before, after = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"SELECT {before}count({value}) AS n, {columns} FROM events{after}"


ORACLE["quantiles_narrow"] = _quartiles("(value * 1e-9)", "1e9", "event_type")
ORACLE["quantiles_of_times"] = _quartiles("epoch(ts)", "1")
ORACLE["salary_outliers"] = _with(
    _boxes("events", "event_type", "value"),
    query="""
SELECT e.event_id, e.event_type, e.value FROM events AS e JOIN quartiles AS q ON e.event_type = q.g
WHERE e.value < q.q1 - 1.5 * (q.q3 - q.q1) OR e.value > q.q3 + 1.5 * (q.q3 - q.q1)""",
)
ORACLE["salary_density"] = _with(
    _ROSTER,
    """
groups AS (
  SELECT department, count(*) AS n, min(salary) AS lo, max(salary) AS hi,
         stddev_samp(salary) * pow(count(*), -0.2) AS h
  FROM roster GROUP BY department
),
grid AS (
  SELECT g.*, i AS point, lo + i * ((hi - lo) / 99) AS x_at
  FROM groups AS g, (SELECT unnest(generate_series(0, 99)) AS i) AS s
)""",
    query=f"""
SELECT g.department, CAST(g.point AS INTEGER) AS point, {_round("g.x_at", 4)} AS at,
       {_round("sum(exp(-0.5 * pow((g.x_at - r.salary) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())) * 1e6", 6)}
         AS density_per_million
FROM grid AS g JOIN roster AS r ON r.department = g.department
GROUP BY g.department, g.point, g.x_at, g.n, g.h""",
)
ORACLE["salary_violin_stats"] = _with(
    _ROSTER,
    query=f"""
SELECT department, count(*) AS n, {_round("avg(salary)", 4)} AS mean,
       {_round("median(salary)", 4)} AS median, min(salary) AS lowest, max(salary) AS highest
FROM roster GROUP BY department""",
)
ORACLE["cumulative_headcount"] = _with(
    _ROSTER,
    query="""
SELECT joining_date, joined,
       CAST(sum(joined) OVER (ORDER BY joining_date) AS BIGINT) AS cumulative_headcount
FROM (SELECT joining_date, count(*) AS joined FROM roster GROUP BY joining_date) AS d""",
)
ORACLE["cumulative_headcount_rows"] = _with(
    _ROSTER,
    query="""
SELECT employee_id, joining_date,
       row_number() OVER (ORDER BY joining_date, employee_id) AS cumulative_headcount
FROM roster""",
)

# --- payload flattening ------------------------------------------------------------------------

ORACLE["json_flatten"] = _with(
    _USERS, _FLAT, query=f"SELECT {_BASE}, event_id FROM flat_checked WHERE reasons = ''"
)
ORACLE["stream_json_flatten"] = ORACLE["json_flatten"]
ORACLE["json_flatten_rejects"] = _with(
    _USERS, _FLAT, query="SELECT event_id, reasons FROM flat_checked WHERE reasons <> ''"
)
