"""The registered queries as DuckDB SQL, in the row-by-row form of their definition.

Sessions and uptime number every single event here, and addresses meet
reservations in a plain nested join: another road to the same rows.
"""

from __future__ import annotations

from labmeter.catalog.queries import (
    BUCKETS,
    EMPLOYEE_FILTERS,
    HOSTS,
    LOW,
    ODD,
    OVERRIDES,
    RANGE_HIGH,
    RANGE_LOW,
    USAGE_FILTERS,
)
from labmeter.sources.samples import NOW as CLOCK
from labmeter.sources.samples import ODD_LABS, ODD_OPERATION, ODD_RESERVATIONS

NOW = f"TIMESTAMP '{CLOCK}'"
SHOWN = "'%Y/%m/%d %H:%M:%S'"


def _list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# Common table expressions, each with the ones it needs -------------------------

CTE: dict[str, tuple[list[str], str]] = {
    "labs": ([], """
        SELECT user_id,
               lab || CASE WHEN user_id % 2 = 0 THEN '-Persistent-(' ELSE '-(' END || owner || ')-'
                   || strftime(start_ts, '%Y-%m-%d-%H:%M:%S') || ':000001' AS vm_name,
               lab, owner || '@example.com' AS email,
               '10.240.' || (user_id % 7) || '.' || user_id AS rdp, start_ts,
               start_ts + to_days(CAST(5 + user_id % 40 AS INTEGER)) AS end_ts
        FROM (SELECT user_id, 'Lab ' || (user_id % 5) AS lab, 'user' || (user_id % 30) AS owner,
                     CAST(date_trunc('second', min(ts)) AS TIMESTAMP) AS start_ts
              FROM events GROUP BY user_id)"""),
    "lab_events": (["labs"], """
        SELECT e.event_id, l.vm_name, l.rdp, e.event_type,
               CAST(date_trunc('second', e.ts) AS TIMESTAMP) AS ts
        FROM events e JOIN labs l ON e.user_id = l.user_id"""),
    "logins": (["lab_events"],
               "SELECT vm_name, ts AS login_ts FROM lab_events WHERE event_type = 'click'"),
    "logouts": (["lab_events"],
                "SELECT vm_name, ts AS logout_ts FROM lab_events WHERE event_type = 'view'"),
    "power_log": (["lab_events"], """
        SELECT vm_name, ts AS log_ts,
               CASE event_type WHEN 'signup' THEN 'Powered-On' WHEN 'purchase' THEN 'Suspended'
                               ELSE 'Deleted' END AS operation
        FROM lab_events WHERE event_type IN ('signup', 'purchase', 'error')"""),
    "power_ops": (["lab_events"], """
        SELECT vm_name, ts, CASE event_type WHEN 'signup' THEN 0 WHEN 'purchase' THEN 1
                                            ELSE 2 END AS op
        FROM lab_events WHERE event_type IN ('signup', 'purchase', 'error')"""),
    "employees": ([], """
        SELECT 'user' || c_custkey || '@example.com' AS email, c_name AS full_name,
               r_name AS region, n_name AS location, 'Manager ' || (c_nationkey % 7) AS manager,
               'Unit ' || (c_nationkey % 3) AS business_unit, c_mktsegment AS department,
               'Title ' || (c_custkey % 4) AS business_title,
               CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS ase
        FROM customer JOIN nation ON c_nationkey = n_nationkey
                      JOIN region ON n_regionkey = r_regionkey"""),
    "reservations": ([], """
        SELECT 'vm-' || o_orderkey AS vm_name, 'user' || o_custkey || '@example.com' AS email,
               o_orderpriority AS lab, o_orderdate AS start_ts,
               o_orderdate + to_days(CAST(1 + o_orderkey % 30 AS INTEGER)) AS end_ts
        FROM orders"""),
    "coded": (["logins", "logouts", "power_log"], """
        SELECT vm_name, login_ts AS ts, 'Login' AS operation, 0 AS op_code FROM logins
        UNION ALL SELECT vm_name, logout_ts, 'Logout', 1 FROM logouts
        UNION ALL SELECT vm_name, log_ts, operation,
                         CASE lower(operation) WHEN 'created' THEN 2 WHEN 'powered-on' THEN 3
                                               WHEN 'suspended' THEN 4 ELSE 5 END FROM power_log"""),
    "open_logins": (["logins", "logouts"], """
        SELECT vm_name, login_ts AS dt, 'in' AS action FROM logins
        UNION ALL SELECT vm_name, logout_ts, 'out' FROM logouts"""),
    "closed_logins": (["open_logins", "logins", "labs"], f"""
        SELECT * FROM open_logins
        UNION ALL SELECT DISTINCT g.vm_name, {NOW}, 'out'
        FROM logins g JOIN labs l ON g.vm_name = l.vm_name WHERE l.end_ts >= {NOW}"""),
    "open_power": (["power_log"], """
        SELECT vm_name, log_ts AS dt,
               CASE WHEN operation IN ('Powered-On', 'Created') THEN 'in' ELSE 'out' END AS action
        FROM power_log"""),
    "closed_power": (["open_power", "labs"], f"""
        SELECT * FROM open_power
        UNION ALL SELECT DISTINCT p.vm_name, {NOW}, 'out'
        FROM open_power p JOIN labs l ON p.vm_name = l.vm_name WHERE l.end_ts >= {NOW}"""),
    "ratio_logins": (["logins", "logouts", "labs"], f"""
        SELECT vm_name, login_ts AS dt, 'in' AS action FROM logins
        UNION ALL SELECT vm_name, logout_ts, 'out' FROM logouts WHERE vm_name LIKE '%-Persistent-%'
        UNION ALL SELECT DISTINCT g.vm_name, {NOW}, 'out'
        FROM logins g JOIN labs l ON g.vm_name = l.vm_name
        WHERE l.end_ts >= {NOW} AND g.vm_name LIKE '%-Persistent-%'"""),
    "last_deleted": (["power_log"], """
        SELECT vm_name, max(log_ts) AS deleted_ts FROM power_log
        WHERE operation = 'Deleted' GROUP BY vm_name"""),
    "addressed": (["lab_events"], r"""
        SELECT event_id, ts, CASE event_type WHEN 'click' THEN 'in' ELSE 'out' END AS action,
               regexp_extract('IPv4 Address : ' || rdp,
                              'IPv4.+\s(10.24\d{1}\.\d{1,3}\.\d{1,3})', 1) AS address
        FROM lab_events WHERE event_type IN ('click', 'view')"""),
    "numbered_ops": (["power_ops"], """
        SELECT *, sum(CASE WHEN op = 0 THEN 1 ELSE 0 END) OVER w AS g,
               row_number() OVER w AS place
        FROM power_ops
        WINDOW w AS (PARTITION BY vm_name ORDER BY ts, op = 0, op ROWS UNBOUNDED PRECEDING)"""),
    "ranked_ops": (["numbered_ops"], """
        SELECT *, row_number() OVER (PARTITION BY vm_name, g ORDER BY place) AS nth
        FROM numbered_ops WHERE g > 0"""),
    "intervals": (["ranked_ops"], """
        SELECT vm_name, min(ts) FILTER (op = 0) AS power_on,
               min(ts) FILTER (nth = 2) AS power_off
        FROM ranked_ops GROUP BY vm_name, g
        UNION ALL SELECT vm_name, NULL, ts FROM ranked_ops WHERE nth > 2 AND op = 1"""),
}


def _sessions(name: str, source: str) -> None:
    """Number the rows of `source`, pair them per number, and total the pairs."""
    CTE[f"{name}_numbered"] = ([source], f"""
        SELECT *, CAST(sum(CASE WHEN action = 'in' THEN 1 ELSE 0 END) OVER (
                   PARTITION BY vm_name ORDER BY dt, CASE action WHEN 'out' THEN 0 ELSE 1 END
                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session
        FROM {source}""")
    CTE[f"{name}_pairs"] = ([f"{name}_numbered"], f"""
        SELECT vm_name, session, max(dt) FILTER (action = 'in') AS login_ts,
               min(dt) FILTER (action = 'out') AS logout_ts
        FROM {name}_numbered GROUP BY vm_name, session""")
    for unit in ("second", "minute"):
        CTE[f"{name}_{unit}s"] = ([f"{name}_pairs"], f"""
            SELECT vm_name, CAST(sum(date_sub('{unit}', login_ts, logout_ts)) AS BIGINT) AS total
            FROM {name}_pairs GROUP BY vm_name""")


for _name, _source in {
    "login": "closed_logins", "raw_login": "open_logins", "power": "closed_power",
    "raw_power": "open_power", "ratio": "ratio_logins",
}.items():
    _sessions(_name, _source)


def _with(body: str, *needs: str) -> str:
    """`body` with its table expressions in order of need."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in CTE[name][0]:
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in ordered) + "\n" + body


# Expressions ----------------------------------------------------------------------


def _created_text(vm: str) -> str:
    return f"array_to_string(string_split({vm}, '-')[-4:], '-')"


def _datetime(text: str) -> str:
    return f"try_strptime(array_to_string(string_split({text}, ':')[1:3], ':'), '%Y-%m-%d-%H:%M:%S')"


def _owner(vm: str) -> str:
    return f"split_part(split_part({vm}, '-(', -1), ')-', 1)"


def _kind(vm: str) -> str:
    return f"CASE WHEN {vm} LIKE '%-Persistent-%' THEN 'Customized' ELSE 'On-Demand' END"


def _state(end: str, other: str = "Deleted") -> str:
    return f"CASE WHEN {end} >= {NOW} THEN 'Active' ELSE '{other}' END"


def _until_now(end: str) -> str:
    return f"CASE WHEN {NOW} < {end} THEN {NOW} ELSE {end} END"


def _duration(seconds: str, last: str = " seconds") -> str:
    return (f"CAST({seconds} // 86400 AS VARCHAR) || ' days ' || ({seconds} % 86400 // 3600) || "
            f"' hours ' || ({seconds} % 3600 // 60) || ' minutes ' || ({seconds} % 60) || '{last}'")


def _elapsed(ts: str) -> str:
    gap = f"abs(date_sub('second', {ts}, {NOW}))"
    return (f"CAST({gap} // 86400 AS VARCHAR) || ':' || ({gap} % 86400 // 3600) || ':' || "
            f"({gap} % 3600 // 60) || ':' || ({gap} % 60)")


def _pct(x: str, y: str) -> str:
    tenths = f"((2000 * abs({x}) + abs({y})) // (2 * abs(nullif({y}, 0))))"
    sign = f"CASE WHEN (({x}) < 0) <> (({y}) < 0) AND {tenths} > 0 THEN '-' ELSE '' END"
    return f"{sign} || CAST({tenths} // 10 AS VARCHAR) || '.' || ({tenths} % 10) || '%'"


def _usage_where(filters: dict[str, list[str]]) -> str:
    return (f"l.lab IN {_list(filters['labs'])} AND "
            f"split_part(l.email, '@', 1) IN {_list(filters['owners'])} AND "
            f"{_state('l.end_ts')} IN {_list(filters['states'])}")


# Reports --------------------------------------------------------------------------


def _usage_persistent(where: str) -> str:
    return _with(f"""
        SELECT l.vm_name, {_owner('l.vm_name')} AS owner, l.lab,
               {_created_text('l.vm_name')} AS created_text, {_state('l.end_ts')} AS state,
               {_duration('life', 'seconds')} AS total_duration,
               {_pct('p.total', 'life')} AS powered_on_pct,
               {_pct('coalesce(g.total, 0)', 'p.total')} AS login_powered_on_pct
        FROM (SELECT a.*, date_sub('second', {_datetime(_created_text('a.vm_name'))},
                                   {_until_now('coalesce(d.deleted_ts, a.end_ts)')}) AS life
              FROM labs a LEFT JOIN last_deleted d ON a.vm_name = d.vm_name
              WHERE a.vm_name LIKE '%-Persistent-%') l
        JOIN power_seconds p ON p.vm_name = l.vm_name
        LEFT JOIN login_seconds g ON g.vm_name = l.vm_name
        WHERE {where}""", "labs", "last_deleted", "power_seconds", "login_seconds")


def _usage_regular() -> str:
    life = f"date_sub('second', l.start_ts, {_until_now('l.end_ts')})"
    return _with(f"""
        SELECT l.vm_name, {_owner('l.vm_name')} AS owner, l.lab,
               {_created_text('l.vm_name')} AS created_text, l.start_ts,
               {_state('l.end_ts')} AS state, {_duration(life)} AS total_duration,
               {_pct('g.total', life)} AS active_pct
        FROM labs l JOIN login_seconds g ON g.vm_name = l.vm_name
        WHERE l.vm_name NOT LIKE '%-Persistent-%' AND {_usage_where(USAGE_FILTERS)}""",
                 "labs", "login_seconds")


def _labs_joined(columns: str, flag: str) -> str:
    f = EMPLOYEE_FILTERS
    return _with(f"""
        SELECT {columns}
        FROM labs l LEFT JOIN employees e ON e.email = l.email
        WHERE e.region IN {_list(f['regions'])} AND l.lab IN {_list(f['labs'])}
          AND e.manager IN {_list(f['managers'])}
          AND {_state('l.end_ts')} IN {_list(f['states'])}
          AND {_kind('l.vm_name')} IN {_list(f['kinds'])} AND {flag}""", "labs", "employees")


_DELETED = f"""CASE WHEN l.end_ts >= {NOW} THEN NULL ELSE l.end_ts END AS deleted_ts,
               CASE WHEN l.end_ts >= {NOW} THEN ''
                    ELSE strftime(l.end_ts, '%Y-%m-%d %H:%M:%S') END AS deleted_text,
               {_state('l.end_ts')} AS state, {_kind('l.vm_name')} AS kind"""

_RANGED = (f"start_ts BETWEEN make_timestamp({RANGE_LOW}::BIGINT * 1000000) "
           f"AND make_timestamp({RANGE_HIGH}::BIGINT * 1000000)")


def _pivot(all_time: bool) -> str:
    """One grouped subquery per bucket and measure, as the report was first written."""
    columns, joins = [], []
    for name, labs in BUCKETS.items():
        member = f"lab IN {_list(labs)}"
        last = member if all_time else f"{member} AND {_RANGED}"
        columns.append(f"coalesce({name}_c.n, 0) AS {name}_count")
        columns.append(f"coalesce(strftime({name}_l.t, {SHOWN}), '') AS {name}_last")
        joins.append(f"LEFT JOIN (SELECT email, count(*) AS n FROM reservations "
                     f"WHERE {member} AND {_RANGED} GROUP BY email) {name}_c "
                     f"ON {name}_c.email = base.email")
        joins.append(f"LEFT JOIN (SELECT email, max(start_ts) AS t FROM reservations "
                     f"WHERE {last} GROUP BY email) {name}_l ON {name}_l.email = base.email")
    if all_time:
        return _with(f"""
            SELECT DISTINCT ON (full_name, manager, region, location, base.email)
                   full_name, manager, region, location, coalesce(total.n, 0) AS total_count,
                   {', '.join(columns)}
            FROM (SELECT e.*, r.email AS reserved_by FROM employees e
                  LEFT JOIN (SELECT DISTINCT email FROM reservations) r ON r.email = e.email) who
            LEFT JOIN (SELECT DISTINCT email FROM reservations) base ON base.email = who.reserved_by
            LEFT JOIN (SELECT email, count(*) AS n FROM reservations WHERE {_RANGED}
                       GROUP BY email) total ON total.email = base.email
            {' '.join(joins)}""", "reservations", "employees")
    return _with(f"""
        SELECT full_name, manager, region, location, department,
               CASE WHEN ase THEN 'YES' ELSE 'NO' END AS ase, base.n AS total_count,
               {', '.join(columns)}
        FROM (SELECT email, count(*) AS n FROM reservations WHERE {_RANGED} GROUP BY email) base
        LEFT JOIN employees e ON e.email = base.email
        {' '.join(joins)}""", "reservations", "employees")


def _changes(only_deleted: bool) -> str:
    reserve = _datetime("split_part(l.vm_name, ')-', -1)")
    source = "(SELECT * FROM power_log WHERE operation = 'Deleted')" if only_deleted else "power_log"
    operation = "" if only_deleted else "g.operation,"
    return f"""
        SELECT * FROM (
            SELECT l.vm_name, l.lab, l.email, l.rdp, l.start_ts, l.end_ts, {operation}
                   {reserve} AS reserve_time, {_kind('l.vm_name')} AS lab_type, e.full_name,
                   e.business_title, e.region, e.location, e.manager, e.business_unit,
                   e.department, e.ase, coalesce(g.log_ts, {reserve}) AS modified
            FROM labs l LEFT JOIN employees e ON e.email = l.email
            LEFT JOIN {source} g ON g.vm_name = l.vm_name)
        WHERE modified > TIMESTAMP '{LOW}' AND modified < {NOW}"""


def _attributed(covered: str, fixed: bool) -> str:
    """Every event with its best lab: latest start, then name."""
    name = "NULL"
    for part, value in OVERRIDES.items() if fixed else ():
        name = f"CASE WHEN contains(a.address, '{part}') THEN '{value}' ELSE {name} END"
    return f"""
        SELECT event_id, ts, action, address, coalesce(any_value(fixed_name),
               arg_min(lab_name, struct_pack(a := -epoch(start_ts), b := lab_name))) AS vm_name,
               CASE WHEN any_value(fixed_name) IS NOT NULL THEN 1 ELSE count(lab_name) END
               AS match_count
        FROM (SELECT a.event_id, a.ts, a.action, a.address, {name} AS fixed_name,
                     l.vm_name AS lab_name, l.start_ts
              FROM addressed a LEFT JOIN labs l ON {covered})
        GROUP BY event_id, ts, action, address"""


_CONTAINS = "contains(a.address, l.rdp) AND a.ts BETWEEN l.start_ts AND l.end_ts"
_EXACT = "a.address = l.rdp AND a.ts BETWEEN l.start_ts AND l.end_ts"
_AT_NOW = f"contains(a.address, l.rdp) AND {NOW} BETWEEN l.start_ts AND l.end_ts"

_HOST_CASES = " ".join(
    f"WHEN starts_with(address, '{prefix}') THEN '{host}'" for prefix, host in HOSTS.items()
)
_BUCKET_CASES = " ".join(
    f"WHEN lab IN {_list(labs)} THEN '{name}'" for name, labs in BUCKETS.items()
)

ORACLES: dict[str, str] = {
    "scan_reservations": _with("SELECT * EXCLUDE (user_id) FROM labs", "labs"),
    "scan_power_log": _with("SELECT * FROM power_log", "power_log"),
    "scan_employees": _with("SELECT * FROM employees", "employees"),
    "vm_fields": _with(f"""
        SELECT vm_name, {_owner('vm_name')} AS owner, split_part(vm_name, '-', 1) AS lab_prefix,
               {_created_text('vm_name')} AS created_text,
               {_datetime(_created_text('vm_name'))} AS created_ts,
               {_datetime("split_part(vm_name, ')-', -1)")} AS reserved_ts
        FROM labs""", "labs"),
    "lab_kind": _with(f"""
        SELECT vm_name, {_kind('vm_name')} AS kind,
               vm_name ILIKE '%-persistent-%' AS persistent FROM labs""", "labs"),
    "lab_status": _with(f"""
        SELECT vm_name, end_ts, {_state('end_ts')} AS state,
               {_state('end_ts', 'Inactive')} AS activity FROM labs""", "labs"),
    "op_codes": _with("SELECT * FROM coded", "coded"),
    "ops_to_log": _with("""
        SELECT vm_name, ts AS log_ts, CASE op WHEN 0 THEN 'Powered-On' WHEN 1 THEN 'Suspended'
                                             WHEN 2 THEN 'Deleted' END AS operation
        FROM (SELECT * FROM power_ops
              UNION ALL SELECT vm_name, start_ts, 3 FROM labs WHERE vm_name LIKE '%-Persistent-%')
        WHERE op IN (0, 1, 2)""", "power_ops", "labs"),
    "flag_filter": _with("""
        SELECT email, ase, 0 AS mode FROM employees WHERE ase = false
        UNION ALL SELECT email, ase, 1 FROM employees WHERE ase = true
        UNION ALL SELECT email, ase, 2 FROM employees
        WHERE ase IN (SELECT ase FROM employees)""", "employees"),
    "reservations_in_range": _with(
        f"SELECT * FROM reservations WHERE {_RANGED}", "reservations"),
    "duration_text": _with(f"""
        SELECT vm_name, seconds, {_duration('seconds')} AS spaced,
               {_duration('seconds', 'seconds')} AS compact
        FROM (SELECT vm_name, date_sub('second', start_ts, {_until_now('end_ts')}) AS seconds
              FROM labs)""", "labs"),
    "elapsed_text": _with(f"""
        SELECT vm_name, {_elapsed('start_ts')} AS since_start, {_elapsed('end_ts')} AS from_end
        FROM labs""", "labs"),
    "elapsed_breakdown": _with(f"""
        SELECT vm_name, start_ts AS departure, {_until_now('end_ts')} AS arrival,
               {_duration(f"date_sub('second', start_ts, {_until_now('end_ts')})")} AS difference
        FROM labs""", "labs"),
    "pct_text": _with(f"""
        SELECT vm_name, {_pct('n_login', 'n')} AS login_pct,
               {_pct('n_login', 'n_created')} AS undefined_pct,
               {_pct('(n_created - n_login)', 'n')} AS negative_pct
        FROM (SELECT vm_name, count(*) FILTER (op_code = 0) AS n_login,
                     count(*) FILTER (op_code = 2) AS n_created, count(*) AS n
              FROM coded GROUP BY vm_name)""", "coded"),
    "extract_address": _with("SELECT event_id, address FROM addressed", "addressed"),
    "after_marker": _with("""
        SELECT event_id, CASE WHEN length(tail) >= 9 THEN '10.24' || left(tail, 9) END AS address
        FROM (SELECT event_id, regexp_extract('eth0 u/u ' || rdp || '/24 LAN', '10.24(.*)$', 1)
                     AS tail
              FROM lab_events WHERE event_type IN ('click', 'view'))""", "lab_events"),
    "lab_buckets": _with(f"""
        SELECT vm_name, lab, CASE {_BUCKET_CASES} END AS bucket FROM reservations""",
        "reservations"),
    "closing_events": _with(f"""
        SELECT DISTINCT g.vm_name, {NOW} AS dt, 'out' AS action
        FROM logins g JOIN labs l ON g.vm_name = l.vm_name WHERE l.end_ts >= {NOW}""",
        "logins", "labs"),
    "session_numbers": _with("SELECT * FROM login_numbered", "login_numbered"),
    "session_pairs": _with("""
        SELECT vm_name, login_ts, logout_ts, date_sub('second', login_ts, logout_ts) AS seconds
        FROM login_pairs""", "login_pairs"),
    "login_totals": _with(
        "SELECT vm_name, total AS total_seconds FROM login_seconds", "login_seconds"),
    "login_totals_filled": _with("""
        SELECT vm_name, CAST(max(total) AS BIGINT) AS total_seconds
        FROM (SELECT * FROM raw_login_seconds UNION SELECT DISTINCT vm_name, 0 FROM power_log)
        GROUP BY vm_name""", "raw_login_seconds", "power_log"),
    "uptime_totals": _with(
        "SELECT vm_name, total AS total_seconds FROM power_seconds", "power_seconds"),
    "uptime_intervals": _with("SELECT * FROM intervals", "intervals"),
    "latest_interval": _with("""
        SELECT vm_name, power_on, power_off
        FROM (SELECT *, row_number() OVER (PARTITION BY vm_name
                     ORDER BY power_on DESC, power_off DESC NULLS LAST) AS place
              FROM intervals WHERE power_on IS NOT NULL)
        WHERE place = 1""", "intervals"),
    "creation_ops": _with("""
        SELECT vm_name, start_ts AS ts, 3 AS op FROM labs
        WHERE vm_name LIKE '%-Persistent-%'""", "labs"),
    "first_last_seen": _with("""
        SELECT vm_name, min(dt) FILTER (action = 'in') AS login_time,
               max(dt) FILTER (action = 'out') AS logout_time
        FROM open_logins GROUP BY vm_name""", "open_logins"),
    "effective_end": _with(f"""
        SELECT l.vm_name, {_created_text('l.vm_name')} AS created_text,
               CASE WHEN l.end_ts >= {NOW} THEN l.end_ts
                    ELSE (SELECT deleted_ts FROM last_deleted d WHERE d.vm_name = l.vm_name)
               END AS end_ts,
               {_state('l.end_ts')} AS state, l.lab, l.email
        FROM labs l WHERE l.vm_name LIKE '%-Persistent-%'""", "labs", "last_deleted"),
    "attribute_events": _with(_attributed(_CONTAINS, True), "addressed", "labs"),
    "attribute_indexed": _with(_attributed(_CONTAINS, True), "addressed", "labs"),
    "attribute_events_exact": _with(_attributed(_EXACT, False), "addressed", "labs"),
    "attribute_events_now": _with(_attributed(_AT_NOW, False), "addressed", "labs"),
    "rejected_events": _with(f"""
        SELECT * EXCLUDE (vm_name) FROM ({_attributed(_AT_NOW, False)})
        WHERE match_count = 0""", "addressed", "labs"),
    "lookup_first": _with(f"""
        SELECT event_id, ts, action, address, source, lab_name AS vm_name, match_count
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                            ORDER BY source, start_ts DESC, lab_name) AS place,
                     count(*) OVER (PARTITION BY event_id, source) AS match_count
              FROM (SELECT a.*, l.vm_name AS lab_name, l.start_ts,
                           CASE WHEN l.vm_name LIKE '%-Persistent-%' THEN 0 ELSE 1 END AS source
                    FROM addressed a JOIN labs l ON {_CONTAINS}))
        WHERE place = 1""", "addressed", "labs"),
    "route_by_prefix": _with(f"""
        SELECT * FROM (SELECT *, CASE {_HOST_CASES} END AS host FROM addressed)
        WHERE host IS NOT NULL""", "addressed"),
    "route_events": _with(f"""
        SELECT vm_name, ts, CASE action WHEN 'in' THEN 'Logins' ELSE 'Logouts' END AS target
        FROM ({_attributed(_CONTAINS, True)}) WHERE vm_name IS NOT NULL""", "addressed", "labs"),
    "orphan_events": _with(f"""
        SELECT p.* FROM power_log p WHERE NOT EXISTS (
            SELECT 1 FROM labs l WHERE l.vm_name = p.vm_name AND l.end_ts >= {NOW})""",
        "power_log", "labs"),
    "usage_persistent": _usage_persistent(_usage_where(USAGE_FILTERS)),
    "usage_persistent_all": _usage_persistent("true"),
    "usage_regular": _usage_regular(),
    "usage_ratio_minutes": _with(f"""
        SELECT p.vm_name, 'Active' AS active, {_pct('g.total', 'p.total')} AS percent
        FROM power_minutes p JOIN ratio_minutes g ON g.vm_name = p.vm_name
        JOIN labs l ON l.vm_name = p.vm_name WHERE l.end_ts >= {NOW}""",
        "power_minutes", "ratio_minutes", "labs"),
    "event_timeline": _with(f"""
        SELECT {_owner('c.vm_name')} AS owner, split_part(c.vm_name, '-', 1) AS lab,
               {_state('l.end_ts')} AS state, {_kind('l.vm_name')} AS kind,
               {_created_text('c.vm_name')} AS created_text,
               strftime(c.ts, {SHOWN}) AS timestamp, c.operation, c.op_code
        FROM coded c JOIN labs l ON l.vm_name = c.vm_name
        WHERE l.lab IN ('Lab 0', 'Lab 1') AND l.vm_name LIKE '%-Persistent-%'""",
        "coded", "labs"),
    "session_list": _with(f"""
        SELECT p.vm_name, strftime(p.login_ts, {SHOWN}) AS login_time,
               strftime(p.logout_ts, {SHOWN}) AS logout_time
        FROM (SELECT * FROM raw_login_pairs UNION ALL SELECT * FROM raw_power_pairs) p
        JOIN labs l ON l.vm_name = p.vm_name WHERE l.lab IN ('Lab 0', 'Lab 1')""",
        "raw_login_pairs", "raw_power_pairs", "labs"),
    "labs_by_user": _labs_joined(
        f"e.full_name, l.lab, {_created_text('l.vm_name')} AS created_text, {_DELETED}, "
        'e.region, e.location, e.manager, e.business_unit AS "group"', "e.ase IS NOT NULL"),
    "labs_by_region": _labs_joined(
        f"e.region, e.location, l.start_ts, {_DELETED}", "e.ase = false"),
    "reservation_summary": _with(f"""
        SELECT full_name, manager, region, location, department, lab, r.email,
               count(r.vm_name) AS reservations_count,
               strftime(max(start_ts), {SHOWN}) AS last_reservation,
               CASE WHEN ase THEN 'YES' ELSE 'NO' END AS ase
        FROM reservations r LEFT JOIN employees e ON e.email = r.email WHERE {_RANGED}
        GROUP BY full_name, lab, manager, region, location, department, r.email, e.ase""",
        "reservations", "employees"),
    "reservation_pivot": _pivot(False),
    "reservation_pivot_all": _pivot(True),
    "extract_changes_all": _with(_changes(False), "labs", "employees", "power_log"),
    "extract_changes_deleted": _with(_changes(True), "labs", "employees", "power_log"),
    "latest_changes": _with(f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY vm_name ORDER BY modified DESC) AS place
            FROM ({_changes(True)}))
        WHERE place = 1""", "labs", "employees", "power_log"),
}

ORACLES |= {f"{name}_stored": ORACLES[name] for name in ("session_pairs", "uptime_intervals")}
ORACLES |= {f"{name}_cells": ORACLES[name] for name in ("reservation_pivot", "reservation_pivot_all")}
ORACLES["upserted_changes"] = ORACLES["latest_changes"]


# The odd tables -------------------------------------------------------------------


def _odd_view(name: str, columns: str, changed: dict[str, str]) -> str:
    shown = ", ".join(f"{changed.get(c, c)} AS {c}" for c in columns.split())
    return f"SELECT {shown} FROM ({CTE[name][1]})"


ODD_VIEWS = {
    "labs": _odd_view("labs", "user_id vm_name lab email rdp start_ts end_ts", ODD_LABS),
    "power_log": f"""
        SELECT vm_name, ts AS log_ts, {ODD_OPERATION} AS operation
        FROM lab_events WHERE event_type IN ('signup', 'purchase', 'error')""",
    "reservations": f"""
        SELECT * EXCLUDE (res_no) REPLACE ({", ".join(f"{e} AS {c}" for c, e in ODD_RESERVATIONS.items())})
        FROM (SELECT *, CAST(substr(vm_name, 4) AS INTEGER) AS res_no FROM ({CTE["reservations"][1]}))""",
}
FOLDED = {
    "operation IN ('Powered-On', 'Created')": "lower(operation) IN ('powered-on', 'created')",
    "operation = 'Deleted'": "lower(operation) = 'deleted'",
    "department, lab, r.email": "department, min(lab) AS lab, r.email",
    "WHERE lab IN": "WHERE upper(lab) IN",
    "GROUP BY full_name, lab,": "GROUP BY full_name, lower(lab),",
}


def _odd(sql: str) -> str:
    """A query over the odd views, comparing operations and labs without regard to case. Names keep one spelling
    there: that is what events in any case have to come to."""
    for name, body in ODD_VIEWS.items():
        sql = sql.replace(CTE[name][1], body)
    for exact, folded in FOLDED.items():
        sql = sql.replace(exact, folded)
    return sql


ORACLES |= {f"{build.__name__}_odd": _odd(ORACLES[build.__name__]) for build in ODD}
