"""Declared schemas. Nothing in the package infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


INT, LONG, TEXT, DATE = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
MONEY = T.DecimalType(14, 2)

# The weekly averages arrive as text with a decimal comma.
AVERAGE_COLUMNS = [
    "s_all_avg",
    "s_course_viewed_avg",
    "s_q_attempt_viewed_avg",
    "s_a_course_module_viewed_avg",
    "s_a_submission_status_viewed_avg",
]

USER_LOGS = _fields(
    courseid=INT,
    userid=INT,
    num_week=INT,
    s_all=INT,
    s_all_avg=TEXT,
    s_course_viewed=INT,
    s_course_viewed_avg=TEXT,
    s_q_attempt_viewed=INT,
    s_q_attempt_viewed_avg=TEXT,
    s_a_course_module_viewed=INT,
    s_a_course_module_viewed_avg=TEXT,
    s_a_submission_status_viewed=INT,
    s_a_submission_status_viewed_avg=TEXT,
    namer_level=TEXT,
    name_vatt=TEXT,
    depart=INT,
    name_osno=TEXT,
    name_formopril=TEXT,
    leveled=TEXT,
    num_sem=INT,
    kurs=INT,
    date_vatt=TEXT,
)

DEPARTMENTS = _fields(id=INT, name=TEXT)

ANALYTICS_STUDENT = _fields(
    student_id=INT,
    course_id=INT,
    department_id=INT,
    semester=INT,
    course_year=INT,
    final_grade=INT,
    last_update=T.TimestampType(),
)

STUDENT_PERFORMANCE = _fields(
    student_id=INT,
    course_id=INT,
    department_id=INT,
    department_name=TEXT,
    education_level=TEXT,
    education_base=TEXT,
    semester=INT,
    course_year=INT,
    final_grade=INT,
    total_events=LONG,
    avg_weekly_events=T.DecimalType(10, 2),
    total_course_views=LONG,
    total_quiz_views=LONG,
    total_module_views=LONG,
    total_submissions=LONG,
    peak_activity_week=INT,
    consistency_score=T.DecimalType(5, 2),
    activity_category=TEXT,
    last_update=T.TimestampType(),
)

KNOWLEDGE = _fields(knowledge_id=INT, knowledge_name=TEXT)
COMPETENCIES = _fields(competency_id=INT, competency_name=TEXT)
POSITIONS = _fields(position_id=INT, position_name=TEXT)
COMPETENCY_KNOWLEDGE = _fields(competency_id=INT, knowledge_id=INT)
POSITION_COMPETENCY = _fields(position_id=INT, competency_id=INT)
EMPLOYEE_SKILLS = _fields(employee_id=INT, full_name=TEXT, knowledge_id=INT)

SKILL_TABLES = {
    "knowledge": KNOWLEDGE,
    "competencies": COMPETENCIES,
    "competency_knowledge": COMPETENCY_KNOWLEDGE,
    "positions": POSITIONS,
    "position_competency": POSITION_COMPETENCY,
    "employees": EMPLOYEE_SKILLS,
}

CLIENTS = _fields(
    client_id=INT,
    last_name=TEXT,
    first_name=TEXT,
    patronymic=TEXT,
    birth_date=DATE,
    passport_series=TEXT,
    passport_number=TEXT,
    passport_issued_by=TEXT,
    address=TEXT,
    phone=TEXT,
    email=TEXT,
)
ACCOUNTS = _fields(
    account_id=LONG,
    account_number=TEXT,
    account_type=TEXT,
    currency=TEXT,
    open_date=DATE,
    balance=MONEY,
    client_id=INT,
)
TRANSACTIONS = _fields(
    transaction_id=LONG,
    transaction_date=DATE,
    amount=MONEY,
    transaction_type=TEXT,
    account_id=LONG,
    description=TEXT,
)
CREDITS = _fields(
    credit_id=LONG,
    client_id=INT,
    amount=LONG,
    interest_rate=T.DoubleType(),
    term_months=INT,
    issue_date=DATE,
    monthly_payment=T.DoubleType(),
)
