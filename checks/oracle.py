"""The same results in DuckDB SQL, written against the given tables only."""

from __future__ import annotations

from checks.queries import AS_OF
from registra.plans import synth
from registra.plans.ontology import BANK as BANK_ONTOLOGY
from registra.plans.ontology import declarations
from registra.plans.triples import BANK_IRI, SKILLS_IRI, TYPE, XSD

# --- stand-in tables -----------------------------------------------------------------


def _comma(column: str) -> str:
    return f"replace(CAST(CAST({column} AS DECIMAL(12,2)) AS VARCHAR), '.', ',')"


def _comma_or_blank(column: str) -> str:
    return f"CASE WHEN l_linenumber = 1 THEN '' ELSE {_comma(column)} END"


LOGS = f"""
logs AS (
  SELECT CAST(l_suppkey % 10 AS INTEGER) AS courseid,
         CAST(o_custkey AS INTEGER) AS userid,
         CAST(week(l_shipdate) AS INTEGER) AS num_week,
         CASE WHEN l_discount <> 0 THEN CASE WHEN l_quantity < 3 THEN 0 ELSE CAST(l_quantity AS INTEGER) END END AS s_all,
         {_comma('l_extendedprice')} AS s_all_avg,
         l_linenumber AS s_course_viewed,
         {_comma_or_blank('l_discount')} AS s_course_viewed_avg,
         CAST(l_partkey % 5 AS INTEGER) AS s_q_attempt_viewed,
         {_comma_or_blank('l_tax')} AS s_q_attempt_viewed_avg,
         CAST(l_orderkey % 7 AS INTEGER) AS s_a_course_module_viewed,
         {_comma_or_blank('l_quantity')} AS s_a_course_module_viewed_avg,
         CAST(l_partkey % 3 AS INTEGER) AS s_a_submission_status_viewed,
         {_comma_or_blank('l_quantity')} AS s_a_submission_status_viewed_avg,
         CASE WHEN l_linenumber = 7 THEN 'pass' WHEN l_linenumber <> 6 THEN substr(o_orderpriority, 1, 1) END AS namer_level,
         o_orderstatus AS name_vatt,
         CASE WHEN l_tax <> 0.08 THEN s_nationkey + 3 END AS depart,
         CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '3' END AS name_osno,
         l_returnflag AS name_formopril,
         CASE l_linestatus WHEN 'F' THEN '1' ELSE '2' END AS leveled,
         CAST(month(l_shipdate) AS INTEGER) AS num_sem,
         CAST(month(l_shipdate) % 4 + 1 AS INTEGER) AS kurs,
         strftime(l_shipdate, '%Y-%m-%d') AS date_vatt
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
),
departments AS (SELECT n_nationkey AS id, n_name AS name FROM nation)
"""

SKILLS = """
skill_rows AS (
  SELECT CAST(o_custkey AS INTEGER) AS employee_id, 'person ' || o_custkey AS full_name, p_size + 1 AS knowledge_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
person AS (SELECT DISTINCT employee_id, full_name FROM skill_rows),
knowledge AS (SELECT DISTINCT p_size AS knowledge_id, 'size ' || p_size AS knowledge_name FROM part),
competencies AS (SELECT DISTINCT p_brand AS competency_id, upper(p_brand) AS competency_name FROM part),
positions AS (SELECT DISTINCT p_type AS position_id, lower(p_type) AS position_name FROM part),
ck AS (
  SELECT DISTINCT p_brand AS competency_id, p_size AS knowledge_id FROM part
  QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_retailprice DESC, p_partkey DESC) = 1
),
pc AS (
  SELECT p_type AS position_id, p_brand AS competency_id FROM part
  QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice DESC, p_partkey DESC) = 1
  UNION
  SELECT p_type, p_brand FROM part
  QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_retailprice, p_partkey) = 1
),
extra_pc AS (
  SELECT p_type AS position_id, p_brand AS competency_id FROM part
  QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_size DESC, p_partkey DESC) = 1
),
new_pc AS (SELECT * FROM pc UNION SELECT * FROM extra_pc),
held AS (SELECT DISTINCT employee_id, knowledge_id FROM skill_rows SEMI JOIN knowledge USING (knowledge_id))
"""


def _division(name: str, held: str, required: str, goal: str, item: str) -> str:
    return f"""
{name} AS (
  SELECT h.employee_id, r.{goal} FROM {held} h JOIN {required} r USING ({item})
  GROUP BY h.employee_id, r.{goal}
  HAVING count(*) = (SELECT count(*) FROM {required} x WHERE x.{goal} = r.{goal})
)"""


GRANTS = SKILLS + "," + _division("got", "held", "ck", "competency_id", "knowledge_id") + "," + _division(
    "fit", "got", "pc", "position_id", "competency_id"
)
NEW_FIT = _division("new_fit", "got", "new_pc", "position_id", "competency_id")


def _digest_number(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


BANK = f"""
clients AS (
  SELECT CAST(c_custkey AS INTEGER) AS client_id, c_name AS last_name, c_mktsegment AS first_name,
         'nation ' || c_nationkey AS patronymic, DATE '1950-01-01' + CAST(c_custkey % 18000 AS INTEGER) AS birth_date,
         lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS passport_series, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS passport_number,
         'nation ' || c_nationkey || chr(10) || 'house ' || c_custkey AS address, '+' || c_custkey AS phone,
         lower(c_mktsegment) || c_custkey || '@example.org' AS email
  FROM customer
),
accounts AS (
  SELECT o_orderkey AS account_id, lpad(CAST(o_orderkey AS VARCHAR), 20, '0') AS account_number, o_orderstatus AS account_type,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' ELSE 'RUB' END AS currency,
         CAST(o_orderdate AS DATE) AS open_date, CAST(o_totalprice AS DECIMAL(14,2)) AS balance,
         CAST(o_custkey AS INTEGER) AS client_id
  FROM orders
),
transactions AS (
  SELECT {_digest_number("concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(14,2)), strftime(l_shipdate, '%Y-%m-%d'))")} AS transaction_id,
         CAST(l_shipdate AS DATE) AS transaction_date, CAST(l_extendedprice AS DECIMAL(14,2)) AS amount,
         CASE l_returnflag WHEN 'A' THEN 'credit entry' ELSE 'DEBIT entry' END AS transaction_type,
         l_orderkey AS account_id, 'line ' || l_linenumber AS description
  FROM lineitem
),
credit_rows AS (
  SELECT o_orderkey AS credit_id, CAST(o_custkey AS INTEGER) AS client_id, CAST(floor(o_totalprice) AS BIGINT) AS amount,
         CAST(o_orderkey % 161 + 90 AS DOUBLE) / 10 AS interest_rate,
         [6, 12, 24, 36, 60, 120, 360][CAST(o_orderkey % 7 AS INTEGER) + 1] AS term_months, CAST(o_orderdate AS DATE) AS issue_date
  FROM orders
),
credits AS (
  SELECT *, round(amount * ((interest_rate / 12 / 100) * pow(1 + interest_rate / 12 / 100, term_months)
                            / (pow(1 + interest_rate / 12 / 100, term_months) - 1)), 2) AS monthly_payment
  FROM credit_rows
)
"""

ORACLES: dict[str, str] = {}


def _add(ctes: str, **named: str) -> None:
    for name, body in named.items():
        more, _, select = body.rpartition("\n--\n")
        ORACLES[name] = f"WITH {ctes}{',' + more if more else ''}\n{select}"


# --- logs: sources, constraints, scalar work -----------------------------------------


def _exact(total: str, count: str) -> str:
    """Whole numbers >= 0: the quotient to two digits, half away from zero."""
    total, count = f"CAST({total} AS HUGEINT)", f"CAST({count} AS HUGEINT)"
    return f"CAST((200 * {total} + {count}) // (2 * nullif({count}, 0)) AS DOUBLE) / 100"


def _avg(column: str) -> str:
    return _exact(f"sum({column})", f"count({column})")


AVERAGES = [
    "s_all_avg",
    "s_course_viewed_avg",
    "s_q_attempt_viewed_avg",
    "s_a_course_module_viewed_avg",
    "s_a_submission_status_viewed_avg",
]
ALL_COLUMNS = """courseid, userid, num_week, s_all, s_all_avg, s_course_viewed, s_course_viewed_avg, s_q_attempt_viewed,
  s_q_attempt_viewed_avg, s_a_course_module_viewed, s_a_course_module_viewed_avg, s_a_submission_status_viewed,
  s_a_submission_status_viewed_avg, namer_level, name_vatt, depart, name_osno, name_formopril, leveled, num_sem, kurs, date_vatt"""
FIXED = ", ".join(f"replace({c}, ',', '.') AS {c}" for c in AVERAGES)
FIRST_10 = "ORDER BY " + ", ".join(f"{c.strip()} ASC NULLS LAST" for c in ALL_COLUMNS.split(",")) + " LIMIT 10"

LEVEL_PLACE = "CASE leveled WHEN '1' THEN 1 WHEN '2' THEN 2 ELSE 3 END"
BASE_PLACE = "CASE name_osno WHEN '1' THEN 1 WHEN '2' THEN 2 ELSE 3 END"
LEVEL_LABEL = "CASE leveled WHEN '1' THEN 'бакалавриат' WHEN '2' THEN 'магистратура' ELSE 'иное' END"
BASE_LABEL = "CASE name_osno WHEN '1' THEN 'бюджет' WHEN '2' THEN 'контракт' ELSE 'иное' END"
PAYMENT = "CASE name_osno WHEN '1' THEN 'бюджет' WHEN '2' THEN 'контракт' ELSE name_osno END"
CATEGORY = "CASE WHEN quartile = 1 THEN 'низкая' WHEN quartile IN (2, 3) THEN 'средняя' WHEN quartile = 4 THEN 'высокая' END"
V2_GRADE = "namer_level IN ('2', '3', '4', '5')"
V1_GRADE = "regexp_full_match(namer_level, '[0-9]+')"

_add(
    LOGS,
    s_csv_user_logs="SELECT * FROM logs",
    s_csv_departments="SELECT id, name FROM departments",
    s_row_counts="SELECT 'user_logs' AS table_name, count(*) AS n_rows FROM logs UNION ALL SELECT 'departments', count(*) FROM departments",
    c_pk_violations="""SELECT userid, courseid, num_week, count(*) AS n_rows FROM logs GROUP BY ALL
        HAVING count(*) > 1 OR userid IS NULL OR courseid IS NULL OR num_week IS NULL""",
    c_not_null="SELECT userid, courseid, num_week, depart, namer_level FROM logs WHERE depart IS NULL OR namer_level IS NULL",
    c_grade_domain=f"""SELECT userid, courseid, max(CAST(namer_level AS INTEGER)) AS final_grade FROM logs WHERE {V1_GRADE}
        GROUP BY ALL HAVING max(CAST(namer_level AS INTEGER)) NOT IN (2, 3, 4, 5)""",
    c_fk_orphans="SELECT depart, count(*) AS n_rows FROM logs WHERE depart NOT IN (SELECT id FROM departments) GROUP BY depart",
    q_preview10=f"SELECT * FROM logs {FIRST_10}",
    q_decimal_fix_preview=f"SELECT * REPLACE ({FIXED}) FROM logs {FIRST_10}",
    t_random_sample=f"SELECT * FROM logs ORDER BY md5(concat_ws('|', '42', {ALL_COLUMNS})) LIMIT 5",
    f_numeric_grade=f"SELECT userid, courseid, num_week, namer_level FROM logs WHERE {V1_GRADE}",
    x_dirty_rows=f"SELECT userid, courseid, num_week, {', '.join(AVERAGES)} FROM logs WHERE "
    + " OR ".join(f"{c} LIKE '%,%'" for c in AVERAGES),
    x_decimal_comma=f"SELECT userid, courseid, num_week, {FIXED} FROM logs",
    x_string_to_real="SELECT userid, courseid, num_week, "
    + ", ".join(f"CAST(CAST(nullif(replace({c}, ',', '.'), '') AS REAL) AS DOUBLE) AS {c}" for c in AVERAGES)
    + " FROM logs",
    x_education_labels=f"""SELECT userid, courseid, leveled, name_osno, {LEVEL_LABEL} AS education_level,
        {BASE_LABEL} AS education_base, {PAYMENT} AS payment_type FROM logs""",
    x_exact_round=f"SELECT userid, courseid, {_avg('s_all')} AS avg_events, {_avg('s_course_viewed')} AS avg_views FROM logs GROUP BY ALL",
)

# --- portal questions ----------------------------------------------------------------

_COURSE_DEPARTMENTS = "cd AS (SELECT DISTINCT courseid, name AS department_name FROM logs JOIN departments ON depart = id)\n--\n"


def _top_by_grade(grade: str, out: str) -> str:
    return f"""SELECT name AS department_name, count(DISTINCT userid) AS {out} FROM logs JOIN departments ON depart = id
        WHERE namer_level = '{grade}' GROUP BY name ORDER BY {out} DESC, name LIMIT 1"""


_BY_BASIS = f"""SELECT {PAYMENT} AS payment_type, num_week AS week_num, {_avg('s_all')} AS avg_total_activity,
    {_avg('s_course_viewed')} AS avg_course_views, {_avg('s_q_attempt_viewed')} AS avg_attempt_views FROM logs"""

_add(
    LOGS,
    q_department_count="SELECT count(DISTINCT depart) AS departments FROM logs",
    q_courses_per_department="""SELECT name AS department_name, count(DISTINCT courseid) AS courses
        FROM logs JOIN departments ON depart = id GROUP BY name""",
    q_top_department="""SELECT name AS department_name, count(DISTINCT courseid) AS courses
        FROM logs JOIN departments ON depart = id GROUP BY name ORDER BY courses DESC, name LIMIT 1""",
    u_course_departments=_COURSE_DEPARTMENTS + "SELECT * FROM cd",
    q_shared_course_count=_COURSE_DEPARTMENTS
    + "SELECT count(*) AS shared_courses FROM (SELECT courseid FROM cd GROUP BY courseid HAVING count(*) > 1)",
    q_shared_courses=_COURSE_DEPARTMENTS
    + """SELECT courseid, string_agg(department_name, ', ' ORDER BY department_name) AS departments
        FROM cd GROUP BY courseid HAVING count(*) > 1""",
    q_students_per_grade=f"SELECT namer_level, count(DISTINCT userid) AS student_count FROM logs WHERE {V2_GRADE} GROUP BY namer_level",
    q_most_active_student="SELECT userid FROM logs GROUP BY userid ORDER BY max(s_all) DESC NULLS FIRST, userid LIMIT 1",
    q_weekly_avg_events=f"SELECT num_week, {_avg('s_all')} AS avg_all_events FROM logs GROUP BY num_week",
    q_top_excellent_department=_top_by_grade("5", "excellent_student_count"),
    q_top_failing_department=_top_by_grade("2", "bad_student_count"),
    q_activity_by_basis_week=f"{_BY_BASIS} GROUP BY ALL",
    q_peak_week_by_basis=f"""{_BY_BASIS} WHERE num_week = (SELECT num_week FROM logs GROUP BY num_week
        ORDER BY {_avg('s_all')} DESC NULLS LAST, num_week LIMIT 1) GROUP BY ALL""",
    q_avg_clean="SELECT round(avg(CAST(replace(s_all_avg, ',', '.') AS REAL)), 4) AS total_average_activity FROM logs",
    j_logs_with_department="SELECT userid, courseid, name AS department_name FROM logs JOIN departments ON depart = id",
)

# --- marts ---------------------------------------------------------------------------

COUNTERS = {
    "total_events": "s_all",
    "total_course_views": "s_course_viewed",
    "total_quiz_views": "s_q_attempt_viewed",
    "total_module_views": "s_a_course_module_viewed",
    "total_submissions": "s_a_submission_status_viewed",
}
SUMS = ", ".join(f"CAST(sum(coalesce({c}, 0)) AS BIGINT) AS {out}" for out, c in COUNTERS.items())
BASICS = """max(depart) AS department_id, max(num_sem) AS semester, max(kurs) AS course_year,
    max(CAST(namer_level AS INTEGER)) AS final_grade"""
PAIR = "userid, courseid"


def _stages(p: str, logs: str, v1: bool) -> str:
    """CTEs with prefix p: graded totals, week counts, peak week, latest attributes, and all of a pair."""
    activity = "s_all DESC NULLS FIRST" if v1 else "coalesce(s_all, 0) DESC"
    return f"""
{p}_graded AS (SELECT {PAIR}, {BASICS}, {SUMS} FROM {logs} WHERE {V1_GRADE if v1 else V2_GRADE} GROUP BY ALL),
{p}_weeks AS (SELECT {PAIR}, count(DISTINCT num_week) AS total_weeks,
    count(DISTINCT CASE WHEN s_all > 0 THEN num_week END) AS active_weeks FROM {logs} GROUP BY ALL),
{p}_peak AS (SELECT {PAIR}, num_week AS peak_activity_week FROM {logs}
    QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY {activity}, num_week ASC NULLS LAST) = 1),
{p}_latest AS (SELECT {PAIR}, num_week, leveled, name_osno, depart FROM {logs}
    QUALIFY row_number() OVER (PARTITION BY {PAIR} ORDER BY num_week DESC NULLS FIRST, {LEVEL_PLACE}, {BASE_PLACE},
        depart ASC NULLS LAST, leveled ASC NULLS LAST, name_osno ASC NULLS LAST) = 1),
{p}_pairs AS (
    SELECT w.userid AS student_id, w.courseid AS course_id, g.userid IS NOT NULL AS graded, g.* EXCLUDE (userid, courseid),
           total_weeks, active_weeks, peak_activity_week, name AS department_name, {LEVEL_LABEL} AS education_level,
           {BASE_LABEL} AS education_base
    FROM {p}_weeks w LEFT JOIN {p}_graded g USING ({PAIR}) JOIN {p}_peak USING ({PAIR}) JOIN {p}_latest l USING ({PAIR})
         LEFT JOIN departments ON l.depart = id)"""


def _with_category(rows: str) -> str:
    return f"""SELECT * EXCLUDE (quartile), {CATEGORY} AS activity_category FROM (
        SELECT *, ntile(4) OVER (ORDER BY total_events, student_id, course_id) AS quartile FROM {rows})"""


_RATIOS = f"""{_exact('total_events', 'total_weeks')} AS avg_weekly_events,
    {_exact('active_weeks', 'total_weeks')} AS consistency_score"""


def _new_mart(p: str) -> str:
    return f"{p}_mart AS (SELECT * EXCLUDE (graded, total_weeks, active_weeks), {_RATIOS} FROM {p}_pairs WHERE graded)"


def _performance(v1: bool) -> str:
    return f"{_stages('n', 'logs', v1)}, {_new_mart('n')}\n--\n{_with_category('n_mart')}"


def _refresh(v1: bool) -> str:
    basics = ["department_id", "semester", "course_year", "final_grade"]
    refreshed = list(COUNTERS) if v1 else [*basics, *COUNTERS]
    derived = ["department_name", "education_level", "education_base", "peak_activity_week"]
    cells = []
    for c in [*basics, *COUNTERS]:
        when = "n.graded" if c in refreshed else "n.graded AND o.student_id IS NULL"
        cells.append(f"CASE WHEN {when} THEN n.{c} ELSE o.{c} END AS {c}")
    cells += [f"CASE WHEN n.student_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in derived]
    return f"""
early AS (SELECT * FROM logs WHERE coalesce(num_week <= 26, TRUE)), late AS (SELECT * FROM logs WHERE num_week > 26),
{_stages('o', 'early', v1)}, {_new_mart('o')}, {_stages('n', 'late', v1)},
merged AS (SELECT coalesce(o.student_id, n.student_id) AS student_id, coalesce(o.course_id, n.course_id) AS course_id,
        {', '.join(cells)}, n.student_id IS NOT NULL AS in_logs, n.total_weeks, n.active_weeks,
        o.avg_weekly_events AS old_average, o.consistency_score AS old_score
    FROM o_mart o FULL JOIN n_pairs n ON o.student_id = n.student_id AND o.course_id = n.course_id
    WHERE o.student_id IS NOT NULL OR n.graded),
mart AS (SELECT * EXCLUDE (in_logs, total_weeks, active_weeks, old_average, old_score),
        CASE WHEN in_logs THEN {_exact('total_events', 'total_weeks')} ELSE old_average END AS avg_weekly_events,
        CASE WHEN in_logs THEN {_exact('active_weeks', 'total_weeks')} ELSE old_score END AS consistency_score
    FROM merged)
--
{_with_category('mart')}"""


def _small_mart(name: str, where: str) -> str:
    return f"""{name} AS (SELECT userid AS student_id, courseid AS course_id, max(depart) AS department_id, max(num_sem) AS semester,
        max(kurs) AS course_year, CAST(max(namer_level) AS INTEGER) AS final_grade
    FROM logs WHERE namer_level IS NOT NULL AND {where} GROUP BY ALL HAVING max(namer_level) IN ('2', '3', '4', '5'))"""


def _first_stage(name: str, where: str) -> str:
    return f"""{name} AS (SELECT userid AS student_id, courseid AS course_id, {BASICS}, {SUMS}
    FROM logs WHERE {V1_GRADE} AND {where} GROUP BY ALL)"""


_NEW_COUNTERS = ", ".join(f"coalesce(n.{c}, o.{c}) AS {c}" for c in COUNTERS)
_OLD_BASICS = ", ".join(
    f"CASE WHEN o.student_id IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}"
    for c in ("department_id", "semester", "course_year", "final_grade")
)

_add(
    LOGS,
    m_activity_totals=f"SELECT {PAIR}, {SUMS} FROM logs WHERE {V2_GRADE} GROUP BY ALL",
    m_week_stats=f"{_stages('n', 'logs', False)}\n--\nSELECT {PAIR}, total_weeks, active_weeks FROM n_weeks",
    w_peak_week=f"{_stages('n', 'logs', False)}\n--\nSELECT * FROM n_peak",
    w_peak_week_v1=f"{_stages('n', 'logs', True)}\n--\nSELECT * FROM n_peak",
    w_latest_attributes=f"{_stages('n', 'logs', False)}\n--\nSELECT * FROM n_latest",
    w_engagement_quartile=f"""{_stages('n', 'logs', False)}
--
SELECT *, {CATEGORY} AS activity_category FROM (
        SELECT {PAIR}, total_events, CAST(ntile(4) OVER (ORDER BY total_events, {PAIR}) AS INTEGER) AS quartile FROM n_graded)""",
    m_analytics_student=_small_mart("mart", "TRUE") + "\n--\nSELECT * FROM mart",
    u_upsert_all=_small_mart("o", "coalesce(num_week <= 26, TRUE)")
    + ","
    + _small_mart("n", "num_week > 26")
    + "\n--\nSELECT * FROM n UNION ALL SELECT * FROM o ANTI JOIN n USING (student_id, course_id)",
    u_upsert_counters=_first_stage("o", "coalesce(num_week <= 26, TRUE)")
    + ","
    + _first_stage("n", "num_week > 26")
    + f"\n--\nSELECT student_id, course_id, {_OLD_BASICS}, {_NEW_COUNTERS} FROM o FULL JOIN n USING (student_id, course_id)",
    m_student_performance=_performance(False),
    m_performance_arrivals=_performance(False),
    m_student_performance_v1=_performance(True),
    m_performance_refresh=_refresh(False),
    m_performance_refresh_v1=_refresh(True),
)

# --- skills --------------------------------------------------------------------------


def _listing(competencies: str, positions: str) -> str:
    return f"""SELECT employee_id, 'competency' AS kind, competency_id AS name FROM {competencies}
        UNION ALL SELECT employee_id, 'position', position_id FROM {positions}"""


def _gap(held: str, required: str, goal: str, item: str) -> str:
    return f"""SELECT employee_id, {goal}, {item} FROM person, {required}
        WHERE NOT EXISTS (SELECT 1 FROM {held} h WHERE h.employee_id = person.employee_id AND h.{item} = {required}.{item})"""


_add(
    SKILLS,
    s_csv_skills="SELECT * FROM skill_rows",
    o_skill_counts="SELECT employee_id, full_name, knowledge_id, count(*) AS n_rows FROM skill_rows GROUP BY ALL",
    u_dedupe_skills="SELECT DISTINCT * FROM skill_rows",
    o_unknown_ids="""SELECT 'skills' AS table_name, 'knowledge_id' AS column_name, CAST(knowledge_id AS VARCHAR) AS unknown_id,
        count(*) AS n_rows FROM skill_rows ANTI JOIN knowledge USING (knowledge_id) GROUP BY ALL""",
    o_missing_knowledge=_gap("held", "ck", "competency_id", "knowledge_id"),
    o_requirements="""SELECT 'competency' AS kind, competency_name AS name, knowledge_name AS required_name
        FROM competencies LEFT JOIN ck USING (competency_id) LEFT JOIN knowledge USING (knowledge_id)
        UNION ALL SELECT 'position', position_name, competency_name
        FROM positions LEFT JOIN pc USING (position_id) LEFT JOIN competencies USING (competency_id)""",
    o_skill_profile="""SELECT employee_id, full_name, coalesce(string_agg(CAST(knowledge_id AS VARCHAR), ',' ORDER BY knowledge_id), '')
        AS knowledge_ids FROM person LEFT JOIN held USING (employee_id) GROUP BY ALL""",
    o_add_requirements="SELECT * FROM new_pc",
)

_SKILL_FACTS = f"""
facts AS (
  SELECT 'знание_' || knowledge_id AS s, 'type' AS p, 'Знание' AS o, true AS link FROM knowledge
  UNION ALL SELECT 'знание_' || knowledge_id, 'название', knowledge_name, false FROM knowledge
  UNION ALL SELECT 'компетенция_' || competency_id, 'type', 'Компетенция', true FROM competencies
  UNION ALL SELECT 'компетенция_' || competency_id, 'название', competency_name, false FROM competencies
  UNION ALL SELECT 'должность_' || position_id, 'type', 'Должность', true FROM positions
  UNION ALL SELECT 'должность_' || position_id, 'название', position_name, false FROM positions
  UNION ALL SELECT 'сотрудник_' || employee_id, 'type', 'Специалист', true FROM person
  UNION ALL SELECT 'сотрудник_' || employee_id, 'имя_сотрудника', full_name, false FROM person
  UNION ALL SELECT 'компетенция_' || competency_id, 'требует_знание', 'знание_' || knowledge_id, true FROM ck
  UNION ALL SELECT 'должность_' || position_id, 'требует_компетенцию', 'компетенция_' || competency_id, true FROM pc
  UNION ALL SELECT 'сотрудник_' || employee_id, 'обладает_знанием', 'знание_' || knowledge_id, true FROM held
  UNION ALL SELECT 'сотрудник_' || employee_id, 'обладает_компетенцией', 'компетенция_' || competency_id, true FROM got
  UNION ALL SELECT 'сотрудник_' || employee_id, 'может_занимать_должность', 'должность_' || position_id, true FROM fit
)"""


def _triples(iri: str, extra: str = "'string'") -> str:
    return f"""triples AS (SELECT '{iri}' || s AS subject, CASE WHEN p = 'type' THEN '{TYPE}' ELSE '{iri}' || p END AS predicate,
        CASE WHEN link THEN '{iri}' || o ELSE o END AS object, CASE WHEN link THEN 'iri' ELSE 'literal' END AS object_kind,
        CASE WHEN NOT link THEN '{XSD}' || {extra} END AS datatype FROM facts WHERE o IS NOT NULL)"""


_SKILL_TRIPLES = f"{_SKILL_FACTS}, {_triples(SKILLS_IRI)}\n--\n"

_add(
    GRANTS,
    o_competencies="SELECT * FROM got",
    o_positions="SELECT * FROM fit",
    o_missing_competencies=_gap("got", "pc", "position_id", "competency_id"),
    o_full_profile="""all_links AS (
        SELECT employee_id, 'knowledge' AS kind, knowledge_name AS name FROM held JOIN knowledge USING (knowledge_id)
        UNION ALL SELECT employee_id, 'competency', competency_name FROM got JOIN competencies USING (competency_id)
        UNION ALL SELECT employee_id, 'position', position_name FROM fit JOIN positions USING (position_id))
--
SELECT employee_id, full_name, kind, name FROM person LEFT JOIN all_links USING (employee_id)""",
    o_whatif_requirements=f"""{NEW_FIT}
--
SELECT employee_id, position_id, 'keep' AS mode FROM (SELECT * FROM fit UNION SELECT * FROM new_fit)
        UNION ALL SELECT employee_id, position_id, 'recompute' FROM new_fit""",
    o_position_violations="""SELECT DISTINCT employee_id, position_id FROM fit JOIN new_pc USING (position_id)
        ANTI JOIN got USING (employee_id, competency_id)""",
    o_whatif_skills=f"""more AS (SELECT * FROM held UNION SELECT employee_id, knowledge_id - 1 FROM skill_rows),
{_division('more_got', 'more', 'ck', 'competency_id', 'knowledge_id')},
{_division('more_fit', 'more_got', 'pc', 'position_id', 'competency_id')}
--
{_listing('more_got', 'more_fit')}""",
    o_new_person="""newest AS (SELECT CAST(max(employee_id) + 1 AS INTEGER) AS employee_id FROM person)
--
SELECT employee_id, 'competency' AS kind, competency_id AS name FROM newest, competencies
        UNION ALL SELECT employee_id, 'position', position_id FROM newest, positions""",
    o_triples=_SKILL_TRIPLES + "SELECT * FROM triples",
    o_read_graph=_SKILL_TRIPLES + "SELECT * FROM triples",
    o_read_individuals=_SKILL_TRIPLES + "SELECT * FROM triples",
    o_ntriples=_SKILL_TRIPLES
    + """SELECT '<' || subject || '> <' || predicate || '> '
        || CASE object_kind WHEN 'iri' THEN '<' || object || '>' ELSE '"' || object || '"^^<' || datatype || '>' END || ' .' AS value
        FROM triples""",
)

# --- bank ----------------------------------------------------------------------------

_FIRST_3 = """first_3 AS (SELECT *, CAST(row_number() OVER (PARTITION BY account_id ORDER BY transaction_id) AS INTEGER) AS place
    FROM transactions QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY transaction_id) <= 3)"""
_NAME = "last_name || ' ' || first_name || ' ' || patronymic"


def _report(chosen: str) -> str:
    return f"""{_FIRST_3}, chosen AS ({chosen}), owned AS (SELECT * FROM accounts SEMI JOIN chosen USING (client_id)),
sections AS (
  SELECT client_id, 'client' AS section, NULL::BIGINT AS account_id, NULL::BIGINT AS item_id, NULL::INTEGER AS place, {_NAME} AS title,
         NULL::VARCHAR AS kind, NULL::VARCHAR AS day, NULL::DOUBLE AS amount, NULL::VARCHAR AS currency, NULL::DOUBLE AS rate,
         NULL::DOUBLE AS payment FROM chosen
  UNION ALL SELECT client_id, 'account', account_id, NULL, NULL, account_number, account_type, NULL, CAST(balance AS DOUBLE), currency, NULL, NULL FROM owned
  UNION ALL SELECT client_id, 'no_accounts', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM chosen ANTI JOIN owned USING (client_id)
  UNION ALL SELECT client_id, 'transaction', account_id, transaction_id, place, NULL,
         upper(substr(transaction_type, 1, 1)) || lower(substr(transaction_type, 2)), strftime(transaction_date, '%Y-%m-%d'),
         CAST(amount AS DOUBLE), currency, NULL, NULL FROM first_3 JOIN owned USING (account_id)
  UNION ALL SELECT client_id, 'no_transactions', account_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
         FROM owned ANTI JOIN transactions USING (account_id)
  UNION ALL SELECT client_id, 'credit', NULL, credit_id, NULL, NULL, NULL, NULL, CAST(amount AS DOUBLE), NULL, interest_rate, monthly_payment
         FROM credits SEMI JOIN chosen USING (client_id)
  UNION ALL SELECT client_id, 'no_credits', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM chosen ANTI JOIN credits USING (client_id)
  UNION ALL SELECT client_id, 'transactions', account_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM owned SEMI JOIN transactions USING (account_id)
  UNION ALL SELECT client_id, 'credits', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM chosen SEMI JOIN credits USING (client_id)
),
report AS (SELECT *, CASE WHEN section = 'client' THEN 0 WHEN section IN ('credits', 'credit', 'no_credits') THEN 2 ELSE 1 END AS block,
  CASE WHEN section IN ('account', 'credits') THEN 0 WHEN section = 'transactions' THEN 1 ELSE 2 END AS step FROM sections)
--
"""


_EDGES = """edges AS (
  SELECT 'Клиент' AS source_kind, CAST(client_id AS BIGINT) AS source_id, 'владеет_счетом' AS predicate, 'Счет' AS target_kind,
         account_id AS target_id FROM accounts SEMI JOIN clients USING (client_id)
  UNION ALL SELECT 'Клиент', client_id, 'имеет_кредит', 'Кредит', credit_id FROM credits SEMI JOIN clients USING (client_id)
  UNION ALL SELECT 'Транзакция', transaction_id, 'относится_к_счету', 'Счет', account_id FROM transactions SEMI JOIN accounts USING (account_id)
)"""


def _entity(table: str, cls: str, key: str, values: dict[str, str], decimals: tuple[str, ...] = (), whole: tuple[str, ...] = ()) -> str:
    subject = f"'{cls}_' || {key}"
    parts = [f"SELECT {subject} AS s, 'type' AS p, '{cls}' AS o, true AS link, NULL AS kind FROM {table}"]
    for name, value in values.items():
        kind = "decimal" if name in decimals else "integer" if name in whole else "string"
        parts.append(f"SELECT {subject}, '{name}', CAST({value} AS VARCHAR), false, '{kind}' FROM {table}")
    return "\n  UNION ALL ".join(parts)


_BANK_FACTS = "facts AS (\n  " + "\n  UNION ALL ".join(
    [
        _entity("clients", "Клиент", "client_id", {
            "фио": _NAME, "дата_рождения": "strftime(birth_date, '%Y-%m-%d')",
            "паспортные_данные": "passport_series || ' ' || passport_number", "адрес": "address", "телефон": "phone", "email": "email",
        }),
        _entity("accounts", "Счет", "account_id", {
            "номер_счета": "account_number", "тип_счета": "account_type", "валюта": "currency",
            "дата_открытия": "strftime(open_date, '%Y-%m-%d')", "остаток": "balance",
        }, decimals=("остаток",)),
        _entity("transactions", "Транзакция", "transaction_id", {
            "дата_транзакции": "strftime(transaction_date, '%Y-%m-%d')", "сумма_транзакции": "amount",
            "тип_транзакции": "transaction_type", "описание": "description",
        }, decimals=("сумма_транзакции",)),
        _entity("credits", "Кредит", "credit_id", {
            "сумма_кредита": "CAST(amount AS DECIMAL(14,2))", "процентная_ставка": "CAST(interest_rate AS DECIMAL(5,1))",
            "срок_в_месяцах": "term_months", "дата_выдачи": "strftime(issue_date, '%Y-%m-%d')",
            "ежемесячный_платеж": "CAST(monthly_payment AS DECIMAL(14,2))",
        }, decimals=("сумма_кредита", "процентная_ставка", "ежемесячный_платеж"), whole=("срок_в_месяцах",)),
        "SELECT source_kind || '_' || source_id, predicate, target_kind || '_' || target_id, true, NULL FROM edges",
    ]
) + ")"
_DECLARED = ", ".join(f"('<{s}> <{p}> <{o}> .')" for s, p, o in declarations(BANK_ONTOLOGY))
_BANK_TRIPLES = f"{_EDGES}, {_BANK_FACTS}, {_triples(BANK_IRI, 'kind')}\n--\n"

_add(
    BANK,
    s_csv_roundtrip="""SELECT account_id, account_number, account_type, currency, strftime(open_date, '%Y-%m-%d') AS open_date,
        CAST(balance AS DOUBLE) AS balance, client_id FROM accounts""",
    b_annuity="SELECT * REPLACE (strftime(issue_date, '%Y-%m-%d') AS issue_date) FROM credits",
    b_client_attrs=f"""SELECT client_id, {_NAME} AS full_name, passport_series || ' ' || passport_number AS passport,
        replace(address, chr(10), ', ') AS address_line, strftime(birth_date + 6570, '%Y-%m-%d') AS of_age FROM clients""",
    b_first_transactions=_FIRST_3
    + "\n--\nSELECT * REPLACE (strftime(transaction_date, '%Y-%m-%d') AS transaction_date, CAST(amount AS DOUBLE) AS amount) FROM first_3",
    b_client_report_flat=_report("SELECT * FROM clients") + "SELECT * FROM report",
    b_client_report=_report("SELECT * FROM clients ORDER BY client_id LIMIT 5")
    + """SELECT client_id, block, account_id, step, item_id, CASE section
          WHEN 'transactions' THEN '    Транзакции (показаны первые 3):' WHEN 'credits' THEN '  Кредиты:'
          WHEN 'client' THEN 'Клиент: ' || title WHEN 'no_accounts' THEN '  Счета: нет'
          WHEN 'account' THEN printf('  Счет: %s (%s) | Остаток: %.2f %s', title, kind, amount, currency)
          WHEN 'transaction' THEN printf('      - %s | %s: %.2f %s', day, kind, amount, currency)
          WHEN 'no_transactions' THEN '    Транзакции: нет'
          WHEN 'credit' THEN printf('    - Сумма: %.2f руб. | Ставка: %.1f%% | Платеж: %.2f руб./мес.', amount, rate, payment)
          ELSE '  Кредиты: нет' END AS line FROM report""",
    b_summary=" UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("clients", "accounts", "transactions", "credits")
    ),
    o_bank_edges=_EDGES + "\n--\nSELECT * FROM edges",
    o_bank_triples=_BANK_TRIPLES + "SELECT * FROM triples",
    o_bank_graph=_BANK_TRIPLES
    + f"""SELECT '<' || subject || '> <' || predicate || '> '
        || CASE object_kind WHEN 'iri' THEN '<' || object || '>' ELSE '"' || replace(object, chr(10), '\\n') || '"^^<' || datatype || '>' END || ' .' AS value
        FROM triples
        UNION ALL SELECT v FROM (VALUES {_DECLARED}) t(v)""",
    o_declared_class_graph=f"""counts AS (
        SELECT 'Клиент' AS c, count(*) AS n FROM clients UNION ALL SELECT 'Счет', count(*) FROM accounts
        UNION ALL SELECT 'Транзакция', count(*) FROM transactions UNION ALL SELECT 'Кредит', count(*) FROM credits),
    declared AS (SELECT * FROM (VALUES (1, 'владеет_счетом', 'Клиент', 'Счет'), (2, 'имеет_кредит', 'Клиент', 'Кредит'),
        (3, 'относится_к_счету', 'Транзакция', 'Счет')) t(place, p, d, r))
--
SELECT '{BANK_IRI}' || s AS source, '{BANK_IRI}' || t AS target, '{BANK_IRI}' || l AS label, n AS n_rows
        FROM (
            SELECT d AS s, r AS t, arg_max(p, place) AS l FROM declared GROUP BY d, r
            UNION ALL SELECT c, NULL, NULL FROM counts WHERE c NOT IN (SELECT d FROM declared)
        ) g JOIN counts ON s = c""",
    o_class_graph=_EDGES
    + f"""
--
SELECT '{BANK_IRI}' || source_kind AS source, '{BANK_IRI}' || target_kind AS target, '{BANK_IRI}' || max(predicate) AS label
        FROM edges GROUP BY source_kind, target_kind
        UNION ALL SELECT '{BANK_IRI}' || c, NULL, NULL FROM (VALUES ('Клиент'), ('Счет'), ('Транзакция'), ('Кредит')) t(c)
        WHERE c NOT IN (SELECT source_kind FROM edges)""",
)
_SEGMENTS = """WITH rows AS (SELECT DISTINCT c_nationkey, CASE WHEN length(c_mktsegment) = 9 THEN c_mktsegment ELSE lower(c_mktsegment) END AS label
        FROM customer)"""
ORACLES["a_text_maximum"] = f"""{_SEGMENTS}
        SELECT c_nationkey, last(label ORDER BY label) AS binary_last, last(label ORDER BY label COLLATE NOCASE, label) AS no_case_last
        FROM rows GROUP BY c_nationkey"""
ORACLES["t_text_order"] = f"""{_SEGMENTS}
        SELECT c_nationkey, label, row_number() OVER (PARTITION BY c_nationkey ORDER BY label) AS binary_place,
               row_number() OVER (PARTITION BY c_nationkey ORDER BY label COLLATE NOCASE, label) AS no_case_place
        FROM rows"""
ORACLES["s_list_tables"] = " UNION ALL ".join(
    f"SELECT 'given_{t}' AS table_name, count(*) AS n_rows FROM {t}"
    for t in ("customer", "lineitem", "nation", "orders", "part", "supplier")
)

# --- generators ----------------------------------------------------------------------

TODAY = f"DATE '{AS_OF}'"


def _draw(what: str, key: str) -> str:
    return _digest_number(f"concat_ws('|', '{synth.SEED}', '{what}', {key})")


def _between(what: str, key: str, low, high) -> str:
    return f"({low} + {_draw(what, key)} % ({high} - {low} + 1))"


def _list(values: list) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


def _pick(what: str, key: str, values: list) -> str:
    return f"{_list(values)}[CAST({_draw(what, key)} % {len(values)} AS INTEGER) + 1]"


def _weighted(what: str, key: str, values: list, chances: list[int]) -> str:
    spread = [v for v, n in zip(values, chances) for _ in range(n)]
    return f"{_list(spread)}[CAST({_draw(what, key)} % 100 AS INTEGER) + 1]"


def _day(what: str, key: str, first: str, last: str = TODAY) -> str:
    return f"({first} + CAST({_draw(what, key)} % (date_diff('day', {first}, {last}) + 1) AS INTEGER))"


def _years_ago(n: int) -> str:
    return f"CAST({TODAY} - INTERVAL {n} YEAR AS DATE)"


def _cycle(key: str, words: list[str]) -> str:
    n = len(words)
    return f"""{_list(words)}[CAST(({key} - 1) % {n} AS INTEGER) + 1]
        || CASE WHEN ({key} - 1) // {n} = 0 THEN '' ELSE ' ' || (({key} - 1) // {n} + 1) END"""


def _person(what: str, youngest: int, oldest: int) -> str:
    return f"""{_pick(what + '.last', 'id', synth.LAST_NAMES)} AS last_name, {_pick(what + '.first', 'id', synth.FIRST_NAMES)} AS first_name,
    {_pick(what + '.patronymic', 'id', synth.PATRONYMICS)} AS patronymic,
    {_day(what + '.birth', 'id', _years_ago(oldest + 1) + ' + 1', _years_ago(youngest))} AS birth_date,
    'г. ' || {_pick(what + '.city', 'id', synth.CITIES)} || ', ул. ' || {_pick(what + '.street', 'id', synth.STREETS)}
      || ', д. ' || {_between(what + '.house', 'id', 1, 150)} AS address,
    '+7 9' || lpad(CAST({_between(what + '.phone', 'id', 0, 999999999)} AS VARCHAR), 9, '0') AS phone,
    '{what}' || id || '@example.org' AS email"""


_STAFF = f"""
people AS (SELECT id, {_person('employee', 18, 70)} FROM (SELECT c_custkey + 1 AS id FROM customer)),
sizes AS (SELECT (SELECT count(*) FROM supplier) AS n_departments, (SELECT count(*) FROM part) AS n_positions),
staff AS (
  SELECT CAST(id AS INTEGER) AS employee_id, last_name, first_name, patronymic, birth_date, {_pick('employee.gender', 'id', synth.GENDERS)} AS gender,
         address, phone, email, {_day('employee.hire', 'id', '(birth_date + 6570)')} AS hire_date,
         {_weighted('employee.status', 'id', synth.STATUSES, synth.STATUS_CHANCES)} AS status,
         CAST({_between('employee.department', 'id', 1, 'n_departments')} AS INTEGER) AS department_id,
         CAST({_between('employee.position', 'id', 1, 'n_positions')} AS INTEGER) AS position_id,
         CAST({_between('employee.salary', 'id', 40000, 150000)} AS INTEGER) AS salary
  FROM people, sizes
)"""
_CLIENTS = f"""
clients AS (
  SELECT CAST(id AS INTEGER) AS client_id, last_name, first_name, patronymic, birth_date,
         CAST({_between('client.series1', 'id', 10, 99)} AS VARCHAR) || {_between('client.series2', 'id', 10, 99)} AS passport_series,
         CAST({_between('client.passport', 'id', 100000, 999999)} AS VARCHAR) AS passport_number,
         'ГУ МВД России по ' || {_pick('client.region', 'id', synth.REGIONS)} AS passport_issued_by, address, phone, email
  FROM (SELECT id, {_person('client', 18, 80)} FROM (SELECT c_custkey + 1 AS id FROM customer))
)"""
_ACCOUNTS = f"""{_CLIENTS},
account_ids AS (
  SELECT client_id, birth_date, row_number() OVER (ORDER BY client_id, i) AS account_id
  FROM (SELECT client_id, birth_date, unnest(range(1, {_between('account.n', 'client_id', 1, 3)} + 1)) AS i FROM clients)
),
accounts AS (
  SELECT account_id, lpad(CAST({_draw('account.number', 'account_id')} AS VARCHAR), 20, '0') AS account_number,
         {_pick('account.type', 'account_id', synth.ACCOUNT_TYPES)} AS account_type,
         {_weighted('account.currency', 'account_id', synth.CURRENCIES, synth.CURRENCY_CHANCES)} AS currency,
         {_day('account.open', 'account_id', '(birth_date + 6570)')} AS open_date,
         CAST({_between('account.balance', 'account_id', 0, 150000000)} AS DOUBLE) / 100 AS balance, client_id
  FROM account_ids
)"""
_TRANSACTIONS = f"""{_ACCOUNTS},
transaction_ids AS (
  SELECT account_id, open_date, row_number() OVER (ORDER BY account_id, i) AS transaction_id
  FROM (SELECT account_id, open_date, unnest(range(1, {_between('transaction.n', 'account_id', 10, 50)} + 1)) AS i FROM accounts)
),
transactions AS (
  SELECT transaction_id, {_day('transaction.day', 'transaction_id', 'open_date')} AS transaction_date,
         CAST({_between('transaction.amount', 'transaction_id', 10000, 15000000)} AS DOUBLE) / 100 AS amount,
         {_weighted('transaction.type', 'transaction_id', [synth.CREDITED, synth.DEBITED], [30, 70])} AS transaction_type, account_id
  FROM transaction_ids
)"""
_DESCRIPTION = f"""CASE transaction_type
    WHEN '{synth.CREDITED}' THEN {_pick('transaction.description', 'transaction_id', synth.DESCRIPTIONS[synth.CREDITED])}
    ELSE {_pick('transaction.description', 'transaction_id', synth.DESCRIPTIONS[synth.DEBITED])} END"""


def _text_days(*columns: str) -> str:
    return "* REPLACE (" + ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" for c in columns) + ")"


ORACLES |= {
    "g_hr_departments": f"""SELECT CAST(id AS INTEGER) AS department_id, {_cycle('id', synth.JOBS)} || ' отдел' AS name,
        {_pick('department.city', 'id', synth.CITIES)} AS location FROM (SELECT s_suppkey + 1 AS id FROM supplier)""",
    "g_hr_positions": f"""SELECT CAST(id AS INTEGER) AS position_id, {_cycle('id', synth.JOBS)} AS name,
        CAST({_between('position.min', 'id', 30000, 60000)} AS INTEGER) AS min_salary,
        CAST({_between('position.min', 'id', 30000, 60000)} + {_between('position.span', 'id', 20000, 80000)} AS INTEGER) AS max_salary
        FROM (SELECT p_partkey + 1 AS id FROM part)""",
    "g_hr_employees": f"WITH {_STAFF} SELECT {_text_days('birth_date', 'hire_date')} FROM staff",
    "g_salary_history": f"""WITH {_STAFF},
counted AS (SELECT *, {_weighted('history.changes', 'employee_id', synth.SALARY_CHANGES, synth.SALARY_CHANGE_CHANCES)} AS changes FROM staff),
steps AS (SELECT *, unnest(range(1, changes + 1)) AS i FROM counted),
days AS (SELECT employee_id, 0 AS place, hire_date AS day FROM counted UNION ALL
    SELECT employee_id, row_number() OVER (PARTITION BY employee_id ORDER BY day), day
    FROM (SELECT employee_id, {_day('history.day', 'employee_id, i', 'hire_date')} AS day FROM steps)),
pay AS (SELECT employee_id, changes AS place, salary AS pay FROM counted UNION ALL
    SELECT employee_id, row_number() OVER (PARTITION BY employee_id ORDER BY pay) - 1, pay
    FROM (SELECT employee_id, {_between('history.salary', 'employee_id, i', 30000, 'salary')} AS pay FROM steps))
SELECT row_number() OVER (ORDER BY employee_id, place) AS history_id, employee_id, strftime(day, '%Y-%m-%d') AS change_date,
    CAST(pay AS INTEGER) AS new_salary FROM days JOIN pay USING (employee_id, place)""",
    "g_clients": f"WITH {_CLIENTS} SELECT {_text_days('birth_date')} FROM clients",
    "g_accounts": f"WITH {_ACCOUNTS} SELECT {_text_days('open_date')} FROM accounts",
    "g_transactions": f"WITH {_TRANSACTIONS} SELECT {_text_days('transaction_date')}, {_DESCRIPTION} AS description FROM transactions",
    "g_credits": f"""WITH {_CLIENTS},
ranked AS (SELECT *, row_number() OVER (ORDER BY {_draw('credit.owner', 'client_id')}, client_id) AS credit_id, count(*) OVER () AS n FROM clients),
chosen AS (SELECT credit_id, client_id, {_between('credit.amount', 'client_id', 50000, 5000000)} AS amount,
    CAST({_between('credit.rate', 'client_id', 90, 250)} AS DOUBLE) / 10 AS interest_rate, {_pick('credit.term', 'client_id', synth.TERMS)} AS term_months,
    strftime({_day('credit.issue', 'client_id', '(birth_date + 6570)')}, '%Y-%m-%d') AS issue_date FROM ranked WHERE credit_id * 5 <= n)
SELECT *, round(amount * ((interest_rate / 12 / 100) * pow(1 + interest_rate / 12 / 100, term_months)
    / (pow(1 + interest_rate / 12 / 100, term_months) - 1)), 2) AS monthly_payment FROM chosen""",
}
for _name in ("m_analytics_student", "u_upsert_all", "m_student_performance", "m_performance_arrivals", "m_student_performance_v1",
              "m_performance_refresh", "m_performance_refresh_v1"):
    ORACLES[_name] = f"SELECT *, '2024-01-01 00:00:00' AS last_update FROM ({ORACLES[_name]})"

_NOTED = {
    "departments": ("g_hr_departments", "department_id", "name"),
    "positions": ("g_hr_positions", "position_id", "name"),
    "employees": ("g_hr_employees", "employee_id", "address"),
    "salary_history": ("g_salary_history", "history_id", "new_salary"),
    "clients": ("g_clients", "client_id", "passport_issued_by"),
    "accounts": ("g_accounts", "account_id", "account_number"),
    "transactions": ("g_transactions", "transaction_id", "transaction_type"),
    "credits": ("g_credits", "credit_id", "term_months"),
}
ORACLES["s_csv_generated"] = " UNION ALL ".join(
    f"""SELECT '{table}' AS table_name, CAST({key} AS BIGINT) AS id, '  ' || {text} || chr(10) || ' "x" ' AS note FROM ({ORACLES[query]})"""
    for table, (query, key, text) in _NOTED.items()
)
