"""Every registered query: name -> function of (spark, folder of Parquet tables)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registra import schemas, standin
from registra.functions import labels, numbers, texts
from registra.operators import quality, ranking
from registra.operators.upsert import upsert
from registra.plans import bank, jobs, marts, ontology, portal, skills, synth, triples
from registra.sources import rdf, shared, sinks, tables

AS_OF = date(2024, 1, 1)
RUN_TIME = datetime(2024, 1, 1)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def plain(df: DataFrame) -> DataFrame:
    """Numbers, booleans and text only, so that results compare across engines."""

    def cell(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(column, "yyyy-MM-dd").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        return column

    return df.select(*[cell(f) for f in df.schema.fields])


def query(function):
    QUERIES[function.__name__] = lambda spark, folder: plain(function(spark, folder))
    return function


def over_logs(**named) -> None:
    """Queries that need the logs only."""
    for name, build in named.items():
        QUERIES[name] = lambda spark, folder, build=build: plain(build(standin.user_logs(spark, folder)))


def over_logs_and_departments(**named) -> None:
    for name, build in named.items():
        QUERIES[name] = lambda spark, folder, build=build: plain(
            build(standin.user_logs(spark, folder), standin.departments(spark, folder))
        )


def over_skills(**named) -> None:
    for name, build in named.items():
        QUERIES[name] = lambda spark, folder, build=build: plain(build(standin.skill_base(spark, folder)))


def over_bank(**named) -> None:
    for name, build in named.items():
        QUERIES[name] = lambda spark, folder, build=build: plain(build(standin.bank_tables(spark, folder)))


# --- sources and sinks ---------------------------------------------------------------


def _through_csv(spark: SparkSession, df: DataFrame, schema: T.StructType) -> DataFrame:
    path = shared.new_path(spark, "csv")
    sinks.write_csv(df.select(schema.fieldNames()), path)
    return tables.read_csv_table(spark, path, schema)


@query
def s_csv_user_logs(spark, folder):
    return _through_csv(spark, standin.user_logs(spark, folder), schemas.USER_LOGS)


@query
def s_csv_departments(spark, folder):
    return _through_csv(spark, standin.departments(spark, folder), schemas.DEPARTMENTS)


@query
def s_csv_skills(spark, folder):
    return _through_csv(spark, standin.skill_base(spark, folder).skills, schemas.EMPLOYEE_SKILLS)


@query
def s_csv_roundtrip(spark, folder):
    return _through_csv(spark, standin.bank_tables(spark, folder).accounts, schemas.ACCOUNTS)


def _registered_tables(spark, folder) -> dict[str, DataFrame]:
    given = ["customer", "lineitem", "nation", "orders", "part", "supplier"]
    for name in given:
        standin.table(spark, folder, name).createOrReplaceTempView(f"given_{name}")
    return {name: spark.table(name) for name in tables.list_tables(spark) if name.startswith("given_")}


@query
def s_list_tables(spark, folder):
    return tables.row_counts(_registered_tables(spark, folder))


@query
def s_row_counts(spark, folder):
    return tables.row_counts(
        {"user_logs": standin.user_logs(spark, folder), "departments": standin.departments(spark, folder)}
    )


# --- constraints ---------------------------------------------------------------------

over_logs(
    c_pk_violations=lambda logs: quality.key_violations(logs, ["userid", "courseid", "num_week"]),
    c_not_null=lambda logs: quality.null_rows(logs, ["depart", "namer_level"]).select(
        "userid", "courseid", "num_week", "depart", "namer_level"
    ),
    c_grade_domain=lambda logs: quality.outside_domain(
        marts.pair_activity(logs, marts.graded_digits(F.col("namer_level"))).filter("graded_rows > 0"),
        "final_grade",
        [2, 3, 4, 5],
    ).select("userid", "courseid", "final_grade"),
)
over_logs_and_departments(c_fk_orphans=lambda logs, deps: quality.orphans(logs, "depart", deps, "id"))

# --- projections, filters, scalar functions ------------------------------------------


def _ordered(df: DataFrame) -> DataFrame:
    """A preview shows any rows; a check needs the same ones every time."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in df.columns])


over_logs(
    q_preview10=lambda logs: portal.preview(_ordered(logs)),
    q_decimal_fix_preview=lambda logs: portal.preview(portal.decimal_comma_fixed(_ordered(logs))),
    t_random_sample=portal.random_rows,
    f_numeric_grade=lambda logs: logs.filter(numbers.digits_only(F.col("namer_level"))).select(
        "userid", "courseid", "num_week", "namer_level"
    ),
    x_dirty_rows=lambda logs: portal.dirty_rows(logs).select("userid", "courseid", "num_week", *schemas.AVERAGE_COLUMNS),
    x_decimal_comma=lambda logs: portal.decimal_comma_fixed(logs).select(
        "userid", "courseid", "num_week", *schemas.AVERAGE_COLUMNS
    ),
    x_string_to_real=lambda logs: portal.averages_as_numbers(logs).select(
        "userid", "courseid", "num_week", *schemas.AVERAGE_COLUMNS
    ),
    x_education_labels=lambda logs: logs.select(
        "userid",
        "courseid",
        "leveled",
        "name_osno",
        labels.education_level(labels.code_position(F.col("leveled"))).alias("education_level"),
        labels.education_base(labels.code_position(F.col("name_osno"))).alias("education_base"),
        labels.payment_type(F.col("name_osno")).alias("payment_type"),
    ),
    x_exact_round=lambda logs: logs.groupBy("userid", "courseid").agg(
        numbers.exact_average(F.col("s_all")).alias("avg_events"),
        numbers.exact_average(F.col("s_course_viewed")).alias("avg_views"),
    ),
)

# --- portal questions ----------------------------------------------------------------

over_logs(
    q_department_count=portal.department_count,
    q_students_per_grade=portal.students_per_grade,
    q_most_active_student=lambda logs: portal.most_active_student(logs).select("userid"),
    q_weekly_avg_events=portal.weekly_average_events,
    q_activity_by_basis_week=portal.activity_by_basis_week,
    q_peak_week_by_basis=portal.peak_week_by_basis,
    q_avg_clean=lambda logs: portal.average_of(logs).select(
        F.round("total_average_activity", 4).alias("total_average_activity")
    ),
)
over_logs_and_departments(
    j_logs_with_department=lambda logs, deps: portal.with_department(logs, deps).select(
        "userid", "courseid", "department_name"
    ),
    q_courses_per_department=portal.courses_per_department,
    q_top_department=portal.top_department,
    u_course_departments=portal.course_departments,
    q_shared_course_count=portal.shared_course_count,
    q_shared_courses=portal.shared_courses,
    q_top_excellent_department=portal.top_excellent_department,
    q_top_failing_department=portal.top_failing_department,
)

# --- text order ------------------------------------------------------------------------


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """Labels in capitals and in small letters, as codes come from different hands."""
    capitals = F.length("c_mktsegment") == 9
    label = F.when(capitals, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment"))
    return standin.table(spark, folder, "customer").select("c_nationkey", label.alias("label"))


@query
def a_text_maximum(spark, folder):
    rows = _segments(spark, folder)
    return texts.largest(rows, ["c_nationkey"], "label", out="binary_last").join(
        texts.largest(rows, ["c_nationkey"], "label", texts.NO_CASE, "no_case_last"), "c_nationkey"
    )


@query
def t_text_order(spark, folder):
    rows = _segments(spark, folder)
    return texts.placed(rows, ["c_nationkey"], "label", out="binary_place").join(
        texts.placed(rows, ["c_nationkey"], "label", texts.NO_CASE, "no_case_place"), ["c_nationkey", "label"]
    )


# --- marts ---------------------------------------------------------------------------


def _activity(logs: DataFrame, **options) -> DataFrame:
    return marts.pair_activity(logs, marts.graded_2_to_5(F.col("namer_level")), **options)


def _quartiles(logs: DataFrame) -> DataFrame:
    totals = _activity(logs).filter("graded_rows > 0").select("userid", "courseid", "total_events")
    order = {name: F.col(name) for name in ("total_events", "userid", "courseid")}
    return ranking.global_ntile(shared.written(totals, "totals"), 4, order, "quartile").withColumn(
        "activity_category", labels.activity_category(F.col("quartile"))
    )


def _early(logs: DataFrame) -> DataFrame:
    """The weeks up to 26, and rows without a week."""
    return logs.filter("coalesce(num_week <= 26, TRUE)")


def _late(logs: DataFrame) -> DataFrame:
    return logs.filter("num_week > 26")


def _first_stage(logs: DataFrame) -> DataFrame:
    """The rows that the first stage of the v1 mart inserts."""
    return (
        marts.pair_activity(logs, marts.graded_digits(F.col("namer_level")))
        .filter("graded_rows > 0")
        .select(F.col("userid").alias("student_id"), F.col("courseid").alias("course_id"), *marts.BASICS, *marts.COUNTERS)
    )


over_logs(
    m_activity_totals=lambda logs: _activity(logs).filter("graded_rows > 0").select("userid", "courseid", *marts.COUNTERS),
    m_week_stats=lambda logs: _activity(logs).select("userid", "courseid", "total_weeks", "active_weeks"),
    w_peak_week=lambda logs: _activity(logs).select("userid", "courseid", "peak_activity_week"),
    w_peak_week_v1=lambda logs: _activity(logs, null_activity_first=True).select("userid", "courseid", "peak_activity_week"),
    w_latest_attributes=portal.latest_attributes,
    w_engagement_quartile=_quartiles,
    m_analytics_student=lambda logs: marts.analytics_student(logs, as_of=RUN_TIME),
    u_upsert_all=lambda logs: marts.analytics_student(
        _late(logs), marts.analytics_student(_early(logs), as_of=RUN_TIME), RUN_TIME
    ),
    u_upsert_counters=lambda logs: upsert(
        _first_stage(_early(logs)), _first_stage(_late(logs)), marts.KEY, list(marts.COUNTERS)
    ),
)


def _performance(logs, deps, variant="v2", existing=None):
    return marts.student_performance(logs, deps, existing, RUN_TIME, variant)


def _refreshed(logs, deps, variant):
    before = marts.student_performance(_early(logs), deps, None, RUN_TIME, variant)
    return _performance(_late(logs), deps, variant, existing=before)


def _after_arrivals(logs, deps):
    """The job itself, three times: a mart of the early logs, the late ones on top, and these once more."""
    spark = logs.sparkSession
    folder = shared.new_path(spark, "mart")
    name = f"arrivals_{folder.rpartition('-')[2]}.performance"
    for batch, arrived in ((0, _early(logs)), (1, _late(logs)), (1, _late(logs))):
        jobs.run_arrivals(arrived, batch, f"{folder}/state", deps, folder, RUN_TIME, name=name, buckets=8)
    return sinks.current_mart(spark, name)


over_logs_and_departments(
    m_student_performance=_performance,
    m_performance_arrivals=_after_arrivals,
    m_student_performance_v1=lambda logs, deps: _performance(logs, deps, "v1"),
    m_performance_refresh=lambda logs, deps: _refreshed(logs, deps, "v2"),
    m_performance_refresh_v1=lambda logs, deps: _refreshed(logs, deps, "v1"),
)

# --- skills --------------------------------------------------------------------------


def _grants(base: skills.SkillBase) -> DataFrame:
    """Competencies and positions in one listing."""
    found = skills.infer(base)
    competencies = found.competencies.select(
        "employee_id", F.lit("competency").alias("kind"), F.col("competency_id").alias("name")
    )
    return competencies.unionByName(
        found.positions.select(
            "employee_id", F.lit("position").alias("kind"), F.col("position_id").alias("name")
        )
    )


over_skills(
    u_dedupe_skills=skills.distinct_skills,
    o_skill_counts=skills.skill_counts,
    o_unknown_ids=skills.unknown_ids,
    o_competencies=skills.competencies_of,
    o_positions=skills.positions_of,
    o_missing_knowledge=skills.missing_knowledge,
    o_missing_competencies=skills.missing_competencies,
    o_requirements=skills.requirements,
    o_skill_profile=lambda base: skills.skill_profile(base).select(
        "employee_id", "full_name", F.array_join(F.col("ids").cast("array<string>"), ",").alias("knowledge_ids")
    ),
    o_full_profile=skills.full_profile,
    o_triples=triples.skill_triples,
)


@query
def o_add_requirements(spark, folder):
    base = standin.skill_base(spark, folder)
    return skills.with_requirements(base, standin.extra_requirements(spark, folder)).position_competency


@query
def o_whatif_requirements(spark, folder):
    base, extra = standin.skill_base(spark, folder), standin.extra_requirements(spark, folder)
    granted = shared.written(skills.competencies_of(base), "competencies")
    return reduce(
        DataFrame.unionByName,
        [
            skills.positions_after(base, extra, mode, granted).withColumn("mode", F.lit(mode))
            for mode in ("keep", "recompute")
        ],
    )


@query
def o_position_violations(spark, folder):
    base, extra = standin.skill_base(spark, folder), standin.extra_requirements(spark, folder)
    changed = skills.with_requirements(base, extra)
    granted = shared.written(skills.competencies_of(base), "competencies")
    kept = skills.positions_after(base, extra, "keep", granted)
    return skills.position_violations(kept, granted, changed.position_competency)


@query
def o_whatif_skills(spark, folder):
    base = standin.skill_base(spark, folder)
    return _grants(skills.with_skills(base, standin.extra_skills(spark, folder)))


@query
def o_new_person(spark, folder):
    base = skills.with_new_person(standin.skill_base(spark, folder), "new person")
    newest = base.skills.filter("full_name = 'new person'")
    return _grants(replace(base, skills=newest))


def _skills_through(spark, folder, write, read):
    path = shared.new_path(spark, "graph")
    write(triples.skill_triples(standin.skill_base(spark, folder)), path)
    return read(path)


@query
def o_read_graph(spark, folder):
    names = (triples.SKILLS_IRI, triples.SKILLS_OBJECT_PROPERTIES, triples.SKILLS_DATA_PROPERTIES)
    return _skills_through(
        spark,
        folder,
        lambda rows, path: rdf.write_rdf_xml(rows, path, *names),
        lambda path: rdf.read_rdf_xml(spark, path, *names, row_tags=("rdf:Description",)),
    )


@query
def o_read_individuals(spark, folder):
    """The same graph through named individuals with names relative to the ontology."""
    names = (triples.SKILLS_IRI, triples.SKILLS_OBJECT_PROPERTIES, triples.SKILLS_DATA_PROPERTIES)
    return _skills_through(
        spark,
        folder,
        lambda rows, path: rdf.write_rdf_xml(rows, path, *names, row_tag="owl:NamedIndividual", relative=True),
        lambda path: rdf.read_rdf_xml(spark, path, *names),
    )


@query
def o_ntriples(spark, folder):
    return _skills_through(spark, folder, rdf.write_ntriples, spark.read.text)


# --- bank ----------------------------------------------------------------------------


def _bank_parts(b: standin.Bank) -> tuple[DataFrame, ...]:
    return b.clients, b.accounts, b.transactions, b.credits


over_bank(
    b_annuity=lambda b: b.credits,
    b_client_attrs=lambda b: bank.client_attributes(b.clients),
    b_first_transactions=lambda b: bank.first_transactions(b.transactions),
    b_client_report=lambda b: bank.first_clients_report(*_bank_parts(b)),
    b_client_report_flat=lambda b: bank.report_rows(*_bank_parts(b)),
    b_summary=lambda b: bank.summary(*_bank_parts(b)),
    o_bank_edges=lambda b: triples.bank_edges(*_bank_parts(b)),
    o_bank_triples=lambda b: triples.bank_triples(*_bank_parts(b)),
    o_class_graph=lambda b: triples.class_graph_rows(
        *triples.schema_of_edges(triples.bank_edges(*_bank_parts(b)), triples.bank_classes(*_bank_parts(b)))
    ),
)


@query
def o_bank_graph(spark, folder):
    """Declarations and individuals as one file of lines."""
    path = shared.new_path(spark, "graph")
    individuals = triples.bank_triples(*_bank_parts(standin.bank_tables(spark, folder)))
    rdf.write_ntriples(ontology.schema_triples(spark, ontology.BANK).unionByName(individuals), path)
    return spark.read.text(path)


@query
def o_declared_class_graph(spark, folder):
    """The class graph of an OWL file, and how many individuals its classes have."""
    path = shared.new_path(spark, "owl")
    ontology.write_schema(spark, ontology.BANK, path)
    graph = triples.class_graph_rows(*rdf.read_class_schema(spark, f"{path}/*", triples.BANK_IRI))
    parts = zip(("Клиент", "Счет", "Транзакция", "Кредит"), _bank_parts(standin.bank_tables(spark, folder)), strict=True)
    counts = tables.row_counts({triples.BANK_IRI + cls: df for cls, df in parts})
    return graph.join(counts.withColumnRenamed("table_name", "source"), "source")

# --- generators, one row of ids per row of a given table -----------------------------


def _ids(spark, folder, name, key) -> DataFrame:
    return standin.table(spark, folder, name).select((F.col(key) + 1).cast("bigint").alias("id"))


def _staff(spark, folder) -> DataFrame:
    departments, positions = _ids(spark, folder, "supplier", "s_suppkey"), _ids(spark, folder, "part", "p_partkey")
    return synth.hr_employees(_ids(spark, folder, "customer", "c_custkey"), departments, positions, AS_OF)


def _clients(spark, folder) -> DataFrame:
    return synth.bank_clients(_ids(spark, folder, "customer", "c_custkey"), AS_OF)


@query
def g_hr_departments(spark, folder):
    return synth.hr_departments(_ids(spark, folder, "supplier", "s_suppkey"))


@query
def g_hr_positions(spark, folder):
    return synth.hr_positions(_ids(spark, folder, "part", "p_partkey"))


@query
def g_hr_employees(spark, folder):
    return _staff(spark, folder)


@query
def g_salary_history(spark, folder):
    return synth.salary_history(_staff(spark, folder), AS_OF)


@query
def g_clients(spark, folder):
    return _clients(spark, folder)


@query
def g_accounts(spark, folder):
    return synth.bank_accounts(_clients(spark, folder), AS_OF)


@query
def g_transactions(spark, folder):
    return synth.bank_transactions(synth.bank_accounts(_clients(spark, folder), AS_OF), AS_OF)


@query
def g_credits(spark, folder):
    return synth.bank_credits(_clients(spark, folder), AS_OF)


@query
def s_csv_generated(spark, folder):
    """All eight generated tables through CSV, each with a text that has blanks at its ends and a line break."""
    clients = _clients(spark, folder)
    accounts = synth.bank_accounts(clients, AS_OF)
    made = {
        "departments": (g_hr_departments(spark, folder), "department_id", "name"),
        "positions": (g_hr_positions(spark, folder), "position_id", "name"),
        "employees": (_staff(spark, folder), "employee_id", "address"),
        "salary_history": (g_salary_history(spark, folder), "history_id", "new_salary"),
        "clients": (clients, "client_id", "passport_issued_by"),
        "accounts": (accounts, "account_id", "account_number"),
        "transactions": (synth.bank_transactions(accounts, AS_OF), "transaction_id", "transaction_type"),
        "credits": (synth.bank_credits(clients, AS_OF), "credit_id", "term_months"),
    }
    path, read = shared.new_path(spark, "csv"), []
    for name, (df, key, text) in made.items():
        odd = df.withColumn("note", F.concat(F.lit("  "), F.col(text).cast("string"), F.lit('\n "x" ')))
        sinks.write_csv(odd, f"{path}/{name}")
        back = tables.read_csv_table(spark, f"{path}/{name}", odd.schema, multi_line=True)
        read.append(back.select(F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("id"), "note"))
    return reduce(DataFrame.unionByName, read)
