"""Independent SQL for every registered query, for DuckDB on the same Parquet tables."""

from __future__ import annotations

# Tables of verification.views

_PEOPLE = """
days as (select distinct o_custkey, cast(o_orderdate as date) as d from orders),
firsts as (select o_custkey, min(d) as hire_date from days group by o_custkey),
nexts as (
  select days.o_custkey, min(d) as next_date from days join firsts using (o_custkey)
  where d > hire_date group by days.o_custkey),
people as (
  select customer.*, nation.*, region.*, hire_date,
         case when c_acctbal < 1000 then next_date end as term_date
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
  left join firsts on firsts.o_custkey = c_custkey left join nexts on nexts.o_custkey = c_custkey
  where c_mktsegment <> 'BUILDING')"""

_EMPLOYEE = f"""{_PEOPLE},
employee as (
  select c_custkey as id, cast(c_custkey as varchar) as client_employee_id, c_name as first_name,
         c_mktsegment as last_name, hire_date, term_date, term_date is null as active_status,
         case when c_acctbal >= 0 then cast(c_nationkey as bigint) end as department_id,
         n_regionkey as organization_id, cast(c_custkey * 2 as varchar) as manager_employee_id,
         c_acctbal as years_of_experience, cast(null as varchar) as job_title,
         cast(null as varchar) as city
  from people),
department as (select n_nationkey as id, n_name as name from nation)"""

_SHIFTS = """
shifts as (
  select event_id, user_id, event_type, value, props, ts as punch_in,
         ts + to_seconds(cast(floor(value * 60) as bigint)) as punch_out,
         case when event_type <> 'error' then cast(date_trunc('hour', ts) as timestamp) end as planned_start,
         case when event_type <> 'error'
              then cast(date_trunc('hour', ts) as timestamp) + interval 1 hour end as planned_end
  from events)"""


def _flags(start: str, end: str, into: str, out: str) -> str:
    planned = f"{start} is not null and {end} is not null"
    return f"""
  coalesce({planned} and {into} > {start} + interval 5 minute, false) as is_late_arrival,
  coalesce({planned} and {out} < {end} - interval 5 minute, false) as is_early_departure,
  coalesce({planned} and {out} > {end} + interval 5 minute, false) as is_overtime,
  not ({planned}) as is_unscheduled"""


_TIMESHEET = f"""{_SHIFTS},
timesheet as (
  select event_id as id, cast(user_id as varchar) as client_employee_id, event_type as pay_code,
         cast(punch_in as date) as punch_apply_date,
         case when event_type <> 'signup' then cast(round(value * 100) as bigint) end as hundredths,
         {_flags("planned_start", "planned_end", "punch_in", "punch_out")}
  from shifts)"""

_BLANK = "('nan', 'nat', 'none', 'null', '')"


def _clean(text: str) -> str:
    trimmed = f"trim({text}, chr(9) || chr(10) || chr(13) || ' ')"
    return f"case when lower({trimmed}) not in {_BLANK} then {trimmed} end"


_RAW_EMPLOYEE = f"""{_PEOPLE},
raw_employee as (
  select c_custkey,
    cast(c_custkey as varchar) as client_employee_id,
    c_name as first_name,
    case n_regionkey when 2 then 'M' end as middle_name,
    c_mktsegment as last_name,
    case when n_regionkey <> 4 then n_name end as job_title,
    r_name as organization_id,
    case when c_acctbal >= -500 then r_name || ' ' || c_mktsegment end as organization_name,
    c_mktsegment as department_id,
    case when not c_acctbal > 9500 then n_name end as department_name,
    hire_date,
    -- written day first, so it is read month first wherever the day can be a month
    case when day(hire_date) <= 12 then make_date(year(hire_date), day(hire_date), month(hire_date))
         else hire_date end as job_start_date,
    case when not c_acctbal < -900 then term_date end as term_date,
    case when n_regionkey not in (0, 1) then c_acctbal end as years_of_experience,
    case when abs(c_acctbal) < 1000 then cast(round(c_acctbal * 100) as bigint) end as weekly_hundredths,
    coalesce(n_regionkey in (0, 1), false) as is_per_deim,
    term_date is null as active_status,
    cast(c_custkey * 2 as varchar) as manager_raw,
    'employee_' || lower(r_name) || '.csv' as source_file
  from people),
coded as (
  select *, case when organization_name is not null then organization_id end as organization_code,
    case when organization_name is not null and department_name is not null
         then department_id end as department_code
  from raw_employee),
organization as (
  select organization_code as code, organization_name as name from coded
  where organization_code is not null
  qualify row_number() over (
    partition by organization_code order by source_file, client_employee_id, organization_name) = 1),
department as (
  select organization_code, department_code as code, department_name as name from coded
  where department_code is not null
  qualify row_number() over (
    partition by organization_code, department_code
    order by source_file, client_employee_id, department_name) = 1)"""

_RAW_TIMESHEET = f"""{_SHIFTS},
raw_timesheet as (
  select event_id as id, event_type as pay_code, props as punch_out_comment,
    case when event_type = 'purchase' or value >= 1 then cast(user_id as varchar) end as client_employee_id,
    case when event_type <> 'signup' then value end as hours,
    case when event_type in ('view', 'click') then date_trunc('second', punch_in) else punch_in end as punch_in,
    case when event_type in ('view', 'click') then date_trunc('second', punch_out) else punch_out end as punch_out,
    planned_start, planned_end, 'timesheet_' || event_type || '.csv' as source_file
  from shifts)"""


# Exact rounding on integers


def _half_up(num: str, den: str) -> str:
    size = f"((2 * abs({num}) + ({den})) // (2 * ({den})))"
    return f"(case when ({den}) = 0 then null when ({num}) < 0 then -{size} else {size} end)"


def _places(num: str, den: str) -> str:
    return f"cast({_half_up(num, den)} as double) / 100"


def _rate(part: str, whole: str) -> str:
    return _places(f"10000 * ({part})", whole)


_HEADCOUNT = f"""with {_EMPLOYEE},
calendar as (
  select cast(unnest(generate_series(
    (select min(hire_date) from employee), date '2002-01-01', interval 1 day)) as date) as snapshot_date),
headcount as (
  select snapshot_date, count(e.id) as active_count from calendar left join employee e
    on e.hire_date <= snapshot_date and (e.term_date is null or e.term_date > snapshot_date)
  group by snapshot_date)"""

_TURNOVER = f"""{_HEADCOUNT},
left_in as (
  select year(term_date) as y, month(term_date) as m, count(*) as terminations
  from employee where term_date is not null group by all),
average as (
  select year(snapshot_date) as y, month(snapshot_date) as m,
         {_half_up("100 * sum(active_count)", "count(*)")} as h
  from headcount group by all),
turnover as (
  select cast(y as bigint) as year, cast(m as bigint) as month, terminations,
         cast(h as double) / 100 as avg_headcount,
         {_places("1000000 * terminations", "h")} as turnover_rate_pct
  from left_in join average using (y, m))"""

_TENURE = f"""with {_EMPLOYEE},
tenure as (
  select d.name as department_name, e.client_employee_id,
    cast(round(round((coalesce(term_date, date '2002-01-01') - hire_date) / 365.25, 2) * 100) as bigint) as years
  from employee e left join department d on e.department_id = d.id where hire_date is not null),
by_department as (
  select department_name, count(client_employee_id) as employee_count,
    {_places("sum(years)", "count(*)")} as avg_tenure_years,
    min(years) / 100 as min_tenure_years, max(years) / 100 as max_tenure_years
  from tenure group by department_name)"""

_ATTRITION = f"""with {_EMPLOYEE},
flagged as (
  select d.name as department_name,
    coalesce(term_date <= hire_date + interval 6 month, false) as early
  from employee e left join department d on e.department_id = d.id where hire_date is not null),
attrition as (
  select department_name, count(*) as total_hires,
    count(*) filter (where early) as early_attrition_count,
    {_rate("count(*) filter (where early)", "count(*)")} as early_attrition_rate_pct
  from flagged group by department_name)"""

_JOINED = f"""with {_EMPLOYEE}, {_TIMESHEET},
joined as (
  select t.*, e.first_name, e.last_name, d.name as department_name
  from timesheet t join employee e on t.client_employee_id = e.client_employee_id
  left join department d on e.department_id = d.id)"""

_WHO = "client_employee_id, first_name, last_name, department_name"

_ATTENDANCE = f"""{_JOINED},
attendance as (
  select client_employee_id, department_name, count(*) as total_shifts,
    count(*) filter (where is_late_arrival) as late_arrival_count,
    count(*) filter (where is_early_departure) as early_departure_count,
    count(*) filter (where is_overtime) as overtime_count,
    {_rate("count(*) filter (where is_late_arrival)", "count(*)")} as late_arrival_rate_pct
  from joined group by client_employee_id, department_name)"""

_ROLLING = f"""{_JOINED},
daily as (
  select client_employee_id, first_name, last_name, punch_apply_date, cast(sum(hundredths) as bigint) as h
  from joined where hundredths is not null group by all),
summed as (
  select *, sum(h) over w as total, count(*) over w as n from daily
  window w as (partition by client_employee_id order by punch_apply_date
               rows between 6 preceding and current row)),
rolling as (
  select client_employee_id, first_name, last_name, punch_apply_date, h / 100 as hours_worked,
         {_places("total", "n")} as rolling_avg_7d
  from summed)"""


def _flag_report(flag: str, stem: str, where: str = "", extra: str = "") -> str:
    return f"""{_JOINED}
select {_WHO}, count(*) as total_shifts, count(*) filter (where {flag}) as {stem}_count, {extra}
  {_rate(f"count(*) filter (where {flag})", "count(*)")} as {stem}_rate_pct
from joined {where} group by {_WHO} having count(*) filter (where {flag}) > 0"""


# Conformed tables

_SILVER_EMPLOYEE = f"""with {_RAW_EMPLOYEE},
silver_employee as (
  select c.client_employee_id, first_name, middle_name, last_name, job_title, job_start_date,
    hire_date, term_date, is_per_deim, active_status,
    cast(weekly_hundredths as double) / 100 as scheduled_weekly_hour, years_of_experience,
    o.name as organization_name, d.name as department_name,
    case when manager_raw in (select client_employee_id from raw_employee) then manager_raw end as manager_employee_id
  from coded c left join organization o on o.code = c.organization_code
  left join department d on d.organization_code = c.organization_code and d.code = c.department_code)"""

_SPLIT = f"""{_SILVER_EMPLOYEE}, {_RAW_TIMESHEET}, known as (
  select r.*, coalesce(client_employee_id in (select client_employee_id from raw_employee), false) as accepted
  from raw_timesheet r)"""


def _stamp(name: str) -> str:
    return f"strftime({name}, '%Y-%m-%d %H:%M:%S.%f')"


_CHECKED = f"""with {_EMPLOYEE}, {_TIMESHEET},
accepted as (select * from timesheet where client_employee_id in (select client_employee_id from employee)),
orphans as (
  select (select count(*) from timesheet) as raw,
         (select count(*) from timesheet) - (select count(*) from accepted) as rejected),
rated as (select *, {_rate("rejected", "raw")} as rate from orphans)"""


def _count_check(name: str, table: str, condition: str, text: str, limit: int = 0) -> str:
    return f"""select '{name}' as "check", case when count(*) <= {limit} then 'PASS' else 'FAIL' end as status,
  cast(count(*) as double) as observed, cast({limit} as double) as threshold,
  count(*) || ' {text}' as details
from {table} where {condition}"""


_ORPHAN = """select 'orphan_rate_check' as "check",
  case when rate < 99.9 then 'PASS' else 'FAIL' end as status, rate as observed, 99.9::double as threshold"""


_ORPHAN_DETAILS = "rejected || ' of ' || raw || ' rows rejected' as details"


def _quality() -> str:
    checks = [
        _count_check(f"null_check_employee_{c}", "employee", f"{c} is null", f"rows without {c} in employee")
        for c in ("client_employee_id", "hire_date", "first_name")
    ]
    for column, source in (
        ("client_employee_id", "client_employee_id"),
        ("punch_apply_date", "punch_apply_date"),
        ("hours_worked", "hundredths"),
    ):
        text = f"rows without {column} in timesheet"
        checks.append(_count_check(f"null_check_timesheet_{column}", "accepted", f"{source} is null", text))
    checks += [
        _count_check(
            "duplicate_check_employee_id",
            "(select client_employee_id, count(*) as n from employee group by client_employee_id)",
            "n > 1",
            "employee ids occur more than once",
        ),
        _count_check("date_logic_check_hire_date", "employee", "hire_date >= term_date",
                     "employees hired on or after their term date"),
        _count_check("hours_worked_check", "accepted", "hundredths < 0 or hundredths > 2400",
                     "shifts with hours outside 0 to 24"),
        _count_check("attendance_flag_check", "accepted", "is_late_arrival and is_early_departure",
                     "shifts both late and left early", 2),
        f"{_ORPHAN}, {_ORPHAN_DETAILS} from rated",
    ]
    return f"{_CHECKED} " + " union all ".join(checks)


def _rule(table: str, column: str, rule: str, count: str) -> str:
    return (
        f"select '{table}' as table_name, '{column}' as column_name, '{rule}' as rule, "
        f"cast(({count}) as bigint) as violations"
    )


# Columns that the derived tables fill; the others are null in every row.
_FILLED = {
    "organization": "id code name",
    "department": "id code name organization_id",
    "employee": "id client_employee_id first_name last_name active_status organization_id department_id "
    "manager_employee_id",
    "timesheet": "id client_employee_id pay_code punch_apply_date",
}
_SOURCES = {"organization": "org", "department": "dep", "employee": "employee", "timesheet": "timesheet"}


def _counted(table: str, rules: str) -> list[str]:
    """Counts of row and key rules, given as ``column:rule`` words."""

    def value(column: str) -> str:
        return column if column in _FILLED[table].split() else "cast(null as varchar)"

    rows, source = [], _SOURCES[table]
    for column, rule in (entry.split(":") for entry in rules.split()):
        if rule == "not_null":
            count = f"select count(*) from {source} where {value(column)} is null"
        elif rule == "unique":
            keys = " and ".join(f"{value(k)} is not null" for k in column.split(","))
            count = (
                f"select count(*) from (select {column} from {source} where {keys} "
                f"group by {column} having count(*) > 1)"
            )
        else:
            limit = rule.removeprefix("max_length_")
            count = f"select count(*) from {source} where length({value(column)}) > {limit}"
        rows.append(_rule(table, column, rule, count))
    return rows


def _dangling(table: str, column: str, parent: str, key: str = "id") -> str:
    known = f"select {key} from {_SOURCES[parent]}"
    return _rule(table, column, "reference", f"select count(*) from {_SOURCES[table]} where {column} not in ({known})")


def _contracts() -> str:
    rows = _counted(
        "organization",
        "id:not_null code:not_null name:not_null code:max_length_50 name:max_length_255 id:unique code:unique",
    )
    rows += _counted(
        "department",
        "id:not_null code:not_null name:not_null organization_id:not_null code:max_length_50 "
        "name:max_length_255 id:unique code,organization_id:unique",
    )
    rows += _counted(
        "employee",
        "id:not_null client_employee_id:not_null active_status:not_null client_employee_id:max_length_50 "
        "first_name:max_length_100 middle_name:max_length_100 last_name:max_length_100 "
        "preferred_name:max_length_100 job_code:max_length_50 job_title:max_length_255 "
        "fte_status:max_length_50 clinical_level:max_length_100 termination_reason:max_length_255 "
        "work_email:max_length_255 city:max_length_100 state:max_length_100 zip:max_length_20 "
        "country:max_length_100 cell_phone:max_length_50 work_phone:max_length_50 "
        "manager_employee_id:max_length_50 manager_employee_name:max_length_255 id:unique "
        "client_employee_id:unique",
    )
    rows += _counted(
        "timesheet",
        "id:not_null client_employee_id:not_null punch_apply_date:not_null "
        "client_employee_id:max_length_50 department_id:max_length_50 department_name:max_length_255 "
        "home_department_id:max_length_50 home_department_name:max_length_255 pay_code:max_length_100 "
        "punch_in_comment:max_length_100 punch_out_comment:max_length_100 id:unique",
    )
    rows += [
        _dangling("department", "organization_id", "organization"),
        _dangling("employee", "organization_id", "organization"),
        _dangling("employee", "department_id", "department"),
        _dangling("employee", "manager_employee_id", "employee", "client_employee_id"),
        _dangling("timesheet", "client_employee_id", "employee", "client_employee_id"),
        _rule("employee", "scheduled_weekly_hour", "fixed_point_5_2",
              "select count(*) from people where abs(c_acctbal) >= 1000"),
        _rule("timesheet", "hours_worked", "fixed_point_6_2",
              "select count(*) from shifts where event_type <> 'signup' and abs(round(value, 2)) >= 10000"),
    ]
    tables = """org as (select r_regionkey as id, r_name as code, r_name as name from region),
dep as (select n_nationkey as id, n_name as code, n_name as name, n_regionkey as organization_id from nation)"""
    return f"with {_EMPLOYEE}, {_TIMESHEET}, {tables} " + " union all ".join(rows)


_EMPLOYEE_ROW = (
    "select id, client_employee_id, first_name, hire_date, term_date, active_status, "
    "department_id, years_of_experience from employee"
)
_TIMESHEET_ROW = "select id, client_employee_id, pay_code, punch_apply_date, is_late_arrival from timesheet"

_INSERTS = f"""with {_EMPLOYEE},
batch as (
  select c_custkey as change_seq, cast(c_custkey as varchar) as client_employee_id, c_name as first_name,
         cast(null as date) as hire_date from customer
  union all
  select s_suppkey + 1000000000, cast(s_suppkey as varchar), s_name, date '2002-01-01' from supplier),
numbered as (
  select *, row_number() over (partition by client_employee_id order by change_seq) as n,
         client_employee_id in (select client_employee_id from employee) as present
  from batch)"""

_UPDATES = f"""with {_EMPLOYEE},
last_set as (
  select o_custkey,
    max(case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_orderkey end) as title_seq,
    max(case when o_orderpriority in ('2-HIGH', '3-MEDIUM') then o_orderkey end) as city_seq,
    max(case when o_orderpriority = '4-NOT SPECIFIED' then o_orderkey end) as term_seq
  from orders group by o_custkey)"""


_CHECKED_UPDATES = f"""with {_EMPLOYEE},
written as (
  select o_orderkey as change_seq, o_custkey as id, o_orderstatus,
    case o_orderpriority when '1-URGENT' then 'scheduled_weekly_hour' when '2-HIGH' then 'department_id'
      when '3-MEDIUM' then 'active_status' else 'zip' end as field,
    case when o_orderpriority = '1-URGENT' then cast(round(o_totalprice) as bigint) end as hundredths
  from orders),
judged as (
  select *, case
    when field = 'scheduled_weekly_hour' and hundredths > 99999 then 'scheduled_weekly_hour: INVALID_VALUE'
    when field = 'department_id' and change_seq % 40 not in (select n_nationkey from nation)
      then 'department_id: UNKNOWN_REFERENCE'
    when field = 'active_status' and o_orderstatus = 'P' then 'active_status: INVALID_VALUE'
    when field = 'active_status' and o_orderstatus <> 'O' then 'active_status: VALUE_REQUIRED' end as reason
  from written)"""


def statements() -> dict[str, str]:
    """SQL per query key."""
    sql = {
        "kpi_headcount": f"{_HEADCOUNT} select * from headcount",
        "kpi_turnover": f"{_TURNOVER} select * from turnover",
        "kpi_tenure_by_department": f"{_TENURE} select * from by_department",
        "kpi_early_attrition": f"{_ATTRITION} select * from attrition",
        "kpi_attendance": f"{_ATTENDANCE} select * from attendance",
        "kpi_rolling_hours": f"{_ROLLING} select * from rolling",
        "kpi_late_arrivals": _flag_report("is_late_arrival", "late_arrival"),
        "kpi_early_departures": _flag_report("is_early_departure", "early_departure"),
        "kpi_overtime": _flag_report(
            "is_overtime",
            "overtime",
            "where hundredths is not null",
            "sum(case when is_overtime then hundredths else 0 end) / 100 as total_overtime_hours,",
        ),
        "kpi_working_hours": f"""{_JOINED},
daily as (
  select {_WHO}, punch_apply_date, sum(hundredths) as h from joined
  where hundredths is not null group by {_WHO}, punch_apply_date)
select {_WHO}, count(punch_apply_date) as total_days_worked, sum(h) / 100 as total_hours,
  {_places("sum(h)", "count(*)")} as avg_hours_per_day,
  {_places("5 * sum(h)", "count(*)")} as avg_hours_per_week
from daily group by {_WHO}""",
        "served_headcount": f"""{_HEADCOUNT}
select cast(snapshot_date as varchar) as snapshot_date, active_count from headcount""",
        "served_tenure": f"{_TENURE} select department_name, employee_count, avg_tenure_years from by_department",
        "chart_attendance_feed": f"""{_ATTENDANCE}
select client_employee_id, late_arrival_count, early_departure_count, overtime_count from attendance""",
    }
    sql |= {
        "served_turnover": sql["kpi_turnover"],
        "served_attendance": sql["kpi_late_arrivals"],
        "served_early_attrition": sql["kpi_early_attrition"],
        "chart_headcount_feed": sql["kpi_headcount"],
        "chart_tenure_feed": sql["served_tenure"],
    }
    sql |= {
        "null_token_normalize": """select c_custkey, case c_nationkey when 20 then ' NULL' when 21 then 'Na'
  when 22 then 'NONE' when 23 then '0' when 24 then c_name end as value from customer""",
        "clean_string": f"""select c_custkey, {_clean('''case c_mktsegment when 'BUILDING' then ' NaN' || chr(9)
  when 'MACHINERY' then 'None ' when 'FURNITURE' then ' ' || chr(9) || c_name || chr(10) || ' '
  else ' ' || c_mktsegment || ' ' end''')} as value from customer""",
        "parse_date": """with dated as (select o_orderkey, o_orderstatus, o_orderpriority, cast(o_orderdate as date) as d from orders)
select o_orderkey, case o_orderpriority when '5-LOW' then null
  when '2-HIGH' then coalesce(
    cast(try_strptime(strftime(d, '%d/%m/%Y'), '%m/%d/%Y') as date),
    cast(try_strptime(strftime(d, '%d/%m/%Y'), '%d/%m/%Y') as date))
  else d end as value from dated""",
        "parse_datetime": f"with {_RAW_TIMESHEET} select id as event_id, {_stamp('punch_in')} as value from raw_timesheet",
        "parse_number": f"""with written as (
  select c_custkey, case n_regionkey when 2 then cast(c_acctbal as varchar) || '5'
    when 0 then 'none' when 1 then 'none' else cast(c_acctbal as varchar) end as text
  from customer join nation on c_nationkey = n_nationkey),
exact as (select c_custkey, try_cast(text as double) as as_double, try_cast(text as decimal(18, 4)) as x from written),
rounded as (
  select *, {_half_up("cast(x * 10000 as bigint)", "100")} as h from exact)
select c_custkey, as_double, case when abs(h) < 100000 then cast(h as double) / 100 end as as_decimal,
  coalesce(abs(h) >= 100000, false) as overflow from rounded""",
        "parse_bool": "select c_custkey, c_nationkey in (0, 1, 2) as value from customer",
        "nan_to_null": """select event_id, case when event_type not in ('click', 'view', 'error') then value end as value
from events""",
        "attendance_flags": f"""with {_SHIFTS}
select event_id, {_flags("planned_start", "planned_end", "punch_in", "punch_out")} from shifts""",
        "dense_keys": f"""with {_RAW_EMPLOYEE}, keys as (
  select 'organization_key' as table_name, organization_code as one, '' as two, min(c_custkey) as seen
  from coded where organization_code is not null group by organization_code
  union all
  select 'department_key', organization_code, department_code, min(c_custkey) from coded
  where organization_code is not null and department_code is not null group by organization_code, department_code
  union all
  select 'employee_key', client_employee_id, '', min(c_custkey) from coded group by client_employee_id)
select table_name, case when two = '' then one else one || '|' || two end as business_key,
  row_number() over (partition by table_name order by seen >= 100, one, two) as id from keys""",
        "dim_organization": f"with {_RAW_EMPLOYEE} select code, name from organization",
        "dim_department": f"with {_RAW_EMPLOYEE} select organization_code, code, name from department",
        "silver_employee": f"{_SILVER_EMPLOYEE} select * from silver_employee",
        "resolve_manager": f"""with {_EMPLOYEE}
select client_employee_id, case when manager_employee_id in (select client_employee_id from employee)
  then manager_employee_id end as manager_employee_id from employee""",
        "silver_timesheet": f"""{_SPLIT}
select id, client_employee_id, pay_code, cast(punch_in as date) as punch_apply_date,
  cast(null as varchar) as punch_in_comment, punch_out_comment,
  {_stamp("punch_in")} as punch_in_datetime, {_stamp("punch_out")} as punch_out_datetime,
  {_stamp("planned_start")} as scheduled_start_datetime, {_stamp("planned_end")} as scheduled_end_datetime,
  hours as hours_worked,
  {_flags("planned_start", "planned_end", "punch_in", "punch_out")}, source_file
from known where accepted""",
        "rejected_timesheet": f"""{_SPLIT}
select id, client_employee_id, cast(hours as varchar) as hours_worked, source_file,
  'MISSING_EMPLOYEE_RECORD' as reason from known where not accepted""",
        "contract_violations": _contracts(),
        "duplicate_line_numbers": "with l as (select * from lineitem) "
        + _rule("lineitem", "l_orderkey", "not_null", "select count(*) from l where l_orderkey is null")
        + " union all "
        + _rule(
            "lineitem",
            "l_orderkey,l_linenumber",
            "unique",
            "select count(*) from (select 1 from l group by l_orderkey, l_linenumber having count(*) > 1)",
        ),
        "quality_checks": _quality(),
        "orphan_rate": f"{_CHECKED} {_ORPHAN}, {_ORPHAN_DETAILS} from rated",
        "employees_list": f"with {_EMPLOYEE} {_EMPLOYEE_ROW} where active_status",
        "employees_of_department": f"with {_EMPLOYEE} {_EMPLOYEE_ROW} where department_id = 3",
        "employee_by_id": f"with {_EMPLOYEE} {_EMPLOYEE_ROW} where id = 2",
        "timesheet_by_id": f"with {_TIMESHEET} {_TIMESHEET_ROW} where id = 42",
        "timesheets_filter": f"""with {_TIMESHEET} {_TIMESHEET_ROW}
where punch_apply_date between date '2024-01-08' and date '2024-01-21'""",
        "timesheet_pages": f"""with {_TIMESHEET}, placed as (
  select id, row_number() over (order by punch_apply_date, id) - 1 as n from timesheet
  where punch_apply_date between date '2024-01-08' and date '2024-01-21')
select cast(n // 500 + 1 as integer) as page, cast(n % 500 + 1 as integer) as place, id from placed""",
        "active_in_months": f"""with {_EMPLOYEE}, months as (
  select cast(b as date) as lo, last_day(cast(b as date)) as hi
  from range(date '1992-01-01', date '2002-01-01', interval 1 month) m(b)
), active as (
  select client_employee_id, hire_date, least(coalesce(term_date - 1, date '2002-01-01'), date '2002-01-01') as last
  from employee)
select lo as begin, hi as end, client_employee_id, greatest(lo, hire_date) as first_day, least(hi, last) as last_day
from months join active on hire_date <= hi and lo <= last and hire_date <= last""",
        "timesheets_of_employee": f"""with {_TIMESHEET} {_TIMESHEET_ROW}
where client_employee_id = '2' and punch_apply_date >= date '2024-01-08'""",
        "apply_employee_inserts": f"""{_INSERTS}
select client_employee_id, first_name, hire_date, active_status from employee
union all
select client_employee_id, first_name, hire_date, true from numbered where n = 1 and not present""",
        "rejected_employee_inserts": f"""{_INSERTS}
select change_seq, client_employee_id, 'EMPLOYEE_EXISTS' as reason from numbered where n > 1 or present""",
        "apply_employee_updates": f"""{_UPDATES}
select client_employee_id, first_name,
  case when title_seq is not null then a.o_orderpriority else job_title end as job_title,
  case when city_seq is not null then nullif(b.o_orderstatus, 'F') else city end as city, hire_date,
  case when term_seq is not null then cast(c.o_orderdate as date) else term_date end as term_date
from employee left join last_set on o_custkey = id
left join orders a on a.o_orderkey = title_seq left join orders b on b.o_orderkey = city_seq
left join orders c on c.o_orderkey = term_seq""",
        "rejected_employee_updates": f"""{_UPDATES}
select o_orderkey as change_seq, o_custkey as id, 'EMPLOYEE_NOT_FOUND' as reason from orders
where o_custkey not in (select id from employee)""",
        "apply_employee_terminations": f"""with {_EMPLOYEE}, gone as (select s_suppkey from supplier)
select client_employee_id, hire_date,
  case when s_suppkey is not null then date '2002-01-01' else term_date end as term_date,
  case when s_suppkey is not null then false else active_status end as active_status
from employee left join gone on s_suppkey = id""",
    }
    sql["rows_per_source_file"] = """select 'timesheet_' || event_type || '.csv' as source_file, count(*) as rows
from events group by event_type"""
    hire = "strftime(hire_date, '{}')"
    sql["land_employees"] = f"""with {_PEOPLE}
select case c_mktsegment when 'HOUSEHOLD' then ' ' || c_custkey || chr(9) else cast(c_custkey as varchar) end as client_employee_id,
  case n_regionkey when 1 then ' nan ' when 2 then ' M ' end as middle_name,
  chr(9) || c_mktsegment as last_name, cast(null as varchar) as preferred_name,
  case when n_regionkey <> 4 then n_name end as job_title,
  case when c_acctbal >= -500 then r_name || ' ' || c_mktsegment end as organization_name,
  case when not c_acctbal > 9500 then n_name end as department_name,
  case c_mktsegment when 'HOUSEHOLD' then {hire.format("%Y-%m-%d")}
    when 'MACHINERY' then {hire.format("%m/%d/%Y")} when 'FURNITURE' then {hire.format("%Y%m%d")}
    else {hire.format("%Y-%m-%d")} || ' 00:00:00' end as hire_date,
  case when c_acctbal < -900 then 'not a date' else strftime(term_date, '%Y-%m-%d') end as term_date,
  ' ' || c_acctbal as scheduled_weekly_hour,
  case n_regionkey when 0 then 'abc' when 1 then null else cast(c_acctbal as varchar) end as years_of_experience,
  case when term_date is null then '1' else ' False ' end as active_status
from people"""
    sql["land_timesheets"] = f"""with {_SHIFTS}
select case when event_type = 'purchase' then ' ' || user_id
    when value >= 1 then cast(user_id as varchar) end as client_employee_id,
  event_type as pay_code, case when event_type <> 'signup' then cast(value as varchar) end as hours_worked,
  cast(null as varchar) as punch_in_comment, props as punch_out_comment,
  cast(punch_in as date) as punch_day, planned_start is null as no_plan, false as no_file
from shifts"""
    gold = f"""{_TURNOVER}, {_TENURE.removeprefix(f"with {_EMPLOYEE},")},
{_ATTRITION.removeprefix(f"with {_EMPLOYEE},")}, {_ATTENDANCE.removeprefix(f"with {_EMPLOYEE},")},
{_ROLLING.removeprefix(f"{_JOINED},")}"""
    measures = {
        "kpi_headcount": ("headcount", "active_count"),
        "kpi_turnover": ("turnover", "turnover_rate_pct"),
        "kpi_tenure_by_department": ("by_department", "avg_tenure_years"),
        "kpi_attendance": ("attendance", "late_arrival_rate_pct"),
        "kpi_rolling_hours": ("rolling", "rolling_avg_7d"),
        "kpi_early_attrition": ("attrition", "early_attrition_rate_pct"),
    }
    sql["warehouse_roundtrip"] = f"{gold} " + " union all ".join(
        f"""select '{name}' as table_name, count(*) as rows,
  cast(sum(cast(round({measure} * 100) as bigint)) as bigint) as checksum from {source}"""
        for name, (source, measure) in measures.items()
    )
    sql["refresh_row_counts"] = _refresh_counts()
    sql["parse_named_dates"] = """with dated as (select o_orderkey, cast(o_orderdate as date) as d from orders)
select o_orderkey, case o_orderkey % 7 when 6 then null
  when 3 then case when day(d) <= 12 then make_date(year(d), day(d), month(d)) else d end
  else d end as value from dated"""
    sql["refused_employee_changes"] = f"""{_CHECKED_UPDATES}
select change_seq, id, reason from judged where reason is not null
union all select change_seq, id, 'EMPLOYEE_NOT_FOUND' from judged
where reason is null and id not in (select id from employee)"""
    sql["stored_employee_changes"] = f"""{_CHECKED_UPDATES}, lasts as (
  select id, max(case when field = 'zip' then change_seq end) as zip_seq,
    max(case when field = 'department_id' then change_seq end) as department_seq,
    max(case when field = 'active_status' then change_seq end) as status_seq,
    max(case when field = 'scheduled_weekly_hour' then change_seq end) as weekly_seq
  from judged where reason is null group by id)
select client_employee_id, cast(zip_seq as varchar) as zip,
  coalesce(department_seq % 40, department_id) as department_id,
  case when status_seq is not null then true else active_status end as active_status,
  coalesce(j.hundredths, cast(case when abs(years_of_experience) < 999
    then round(years_of_experience * 100) end as bigint)) as weekly_hundredths
from employee e left join lasts l on l.id = e.id left join judged j on j.change_seq = weekly_seq"""
    sql["malformed_lines"] = """with kinds as (
  select o_orderkey, case o_orderkey % 7 when 0 then 'TOO_MANY_FIELDS' when 1 then 'BROKEN_QUOTE'
    when 2 then 'SHORT' when 3 then 'BREAKS' when 4 then 'ANY_CHARACTER' else 'WHOLE' end as kind from orders)
select kind, count(*) as lines, cast(sum(o_orderkey) as bigint) as checksum from kinds group by kind"""
    known = "select n_nationkey from nation where n_regionkey < 3"
    sql["contract_breaches"] = " union all ".join(
        [
            _rule("customer", "c_custkey", "not_null", "select count(*) from customer where c_custkey is null"),
            _rule("customer", "name", "not_null", "select count(*) from customer where not c_acctbal > 0"),
            _rule("customer", "c_custkey", "unique", _repeated("customer", "c_custkey")),
            _rule("customer", "c_nationkey,c_mktsegment", "unique", _repeated("customer", "c_nationkey, c_mktsegment")),
            _rule("customer", "c_nationkey", "reference",
                  f"select count(*) from customer where c_nationkey not in ({known})"),
            _rule("customer", "c_mktsegment", "max_length_8",
                  "select count(*) from customer where length(c_mktsegment) > 8"),
            _rule("customer", "name", "max_length_255",
                  "select count(*) from customer where c_acctbal > 0 and length(c_name) > 255"),
            _rule("customer", "balance", "fixed_point_5_2",
                  "select count(*) from customer where abs(c_acctbal) >= 1000"),
        ]
    )
    return sql


def _repeated(table: str, key: str) -> str:
    return f"select count(*) from (select {key} from {table} group by {key} having count(*) > 1)"


def _refresh_counts() -> str:
    """Table sizes of a refresh; sizes of gold tables follow from their keys."""
    sized = f"""{_SPLIT}, hired as (select * from silver_employee where hire_date is not null),
spans as (select min(hire_date) as lo, date '2002-01-01' as hi from hired)"""
    counts = {
        "bronze.raw_employee": "select count(*) from raw_employee",
        "bronze.raw_timesheet": "select count(*) from raw_timesheet",
        "bronze.rejected_timesheet": "select count(*) from known where not accepted",
        "silver.organization": "select count(*) from organization",
        "silver.department": "select count(*) from department",
        "silver.employee": "select count(*) from silver_employee",
        "silver.timesheet": "select count(*) from known where accepted",
        "gold.kpi_headcount": "select date_diff('day', lo, hi) + 1 from spans",
        "gold.kpi_turnover": """select count(distinct date_trunc('month', term_date)) from silver_employee, spans
          where date_trunc('month', term_date) between date_trunc('month', lo) and date_trunc('month', hi)""",
        "gold.kpi_tenure_by_department": "select count(distinct coalesce(department_name, '?')) from hired",
        "gold.kpi_attendance": "select count(distinct client_employee_id) from known where accepted",
        "gold.kpi_rolling_hours": """select count(distinct (client_employee_id, cast(punch_in as date)))
          from known where accepted and hours is not null""",
        "gold.kpi_early_attrition": "select count(distinct coalesce(department_name, '?')) from hired",
    }
    counts |= {"bronze.malformed_line": "0"}
    counts |= {f"silver.{t}_key": counts[f"silver.{t}"] for t in ("organization", "department", "employee")}
    counts |= {t.replace("gold.", "export."): count for t, count in counts.items() if t.startswith("gold.")}
    hours = "select sum(cast(round(hours * 100) as bigint)) from known where accepted and hours is not null"
    late = _flags("planned_start", "planned_end", "punch_in", "punch_out")
    attendance = f"""select count(*) * 1000 + count(*) filter (where is_late_arrival)
      from (select {late} from known where accepted)"""
    sums = {
        "silver.employee": "select sum(date_diff('day', date '1970-01-01', cast(hire_date as date))) from silver_employee",
        "silver.timesheet": hours,
        "gold.kpi_attendance": attendance, "export.kpi_attendance": attendance,
        "gold.kpi_rolling_hours": hours, "export.kpi_rolling_hours": hours,
    }
    return f"{sized} " + " union all ".join(
        f"""select '{table}' as table_name, cast(({count}) as bigint) as rows,
  cast(({sums.get(table, 'null')}) as bigint) as checksum"""
        for table, count in counts.items()
    )
