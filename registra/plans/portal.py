"""Questions over the weekly portal logs.

Department names are joined after the logs have been reduced to the few columns and
distinct combinations a question needs, so the join never sees raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registra.functions import labels, numbers
from registra.operators import ranking
from registra.schemas import AVERAGE_COLUMNS

GRADES = ["2", "3", "4", "5"]


def decimal_comma_fixed(logs: DataFrame) -> DataFrame:
    return logs.withColumns({c: numbers.comma_to_point(F.col(c)) for c in AVERAGE_COLUMNS})


def dirty_rows(logs: DataFrame) -> DataFrame:
    return logs.filter(numbers.has_comma(AVERAGE_COLUMNS))


def averages_as_numbers(logs: DataFrame, strict: bool = True) -> DataFrame:
    """Decimal comma fixed, then single precision. Only s_all_avg may not be blank."""
    fixed = decimal_comma_fixed(logs)
    return fixed.withColumns(
        {
            c: numbers.text_to_real(F.col(c), blank_is_null=c != "s_all_avg", strict=strict)
            for c in AVERAGE_COLUMNS
        }
    )


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows: only as much is read as they need."""
    return df.limit(n)


def random_rows(df: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """n rows by a seeded digest of the whole row: the same draw on any cluster."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in df.columns])
    return df.withColumn("_draw", F.md5(text)).orderBy("_draw").limit(n).drop("_draw")


def average_of(logs: DataFrame, column: str = "s_all_avg") -> DataFrame:
    return averages_as_numbers(logs).agg(F.avg(column).alias("total_average_activity"))


def with_department(logs: DataFrame, departments: DataFrame, how: str = "inner") -> DataFrame:
    """Logs with department_name; `inner` drops rows without a known department."""
    names = departments.select(F.col("id").alias("depart"), F.col("name").alias("department_name"))
    return logs.join(names, "depart", how)


def department_count(logs: DataFrame) -> DataFrame:
    """Distinct department ids in the logs, known or not."""
    return logs.agg(F.countDistinct("depart").alias("departments"))


def courses_per_department(logs: DataFrame, departments: DataFrame) -> DataFrame:
    """Distinct courses per department name; ids that share a name count as one."""
    used = logs.select("depart", "courseid").distinct()
    return (
        with_department(used, departments)
        .groupBy("department_name")
        .agg(F.countDistinct("courseid").alias("courses"))
    )


def top_department(logs: DataFrame, departments: DataFrame) -> DataFrame:
    ranked = courses_per_department(logs, departments)
    return ranked.orderBy(F.desc("courses"), F.asc_nulls_last("department_name")).limit(1)


def course_departments(logs: DataFrame, departments: DataFrame) -> DataFrame:
    """Distinct (courseid, department_name)."""
    used = logs.select("courseid", "depart").filter("courseid IS NOT NULL AND depart IS NOT NULL").distinct()
    return with_department(used, departments).select("courseid", "department_name").distinct()


def shared_courses(logs: DataFrame, departments: DataFrame) -> DataFrame:
    """Courses taught by several departments, with the ordered list of their names.

    The list holds distinct names, so the department table bounds its length.
    """
    return (
        course_departments(logs, departments)
        .groupBy("courseid")
        .agg(
            F.count("department_name").alias("_names"),
            F.array_join(F.array_sort(F.collect_list("department_name")), ", ").alias("departments"),
        )
        .filter("_names > 1")
        .select("courseid", "departments")
        .orderBy("courseid")
    )


def shared_course_count(logs: DataFrame, departments: DataFrame) -> DataFrame:
    several = (
        course_departments(logs, departments)
        .groupBy("courseid")
        .agg(F.count("department_name").alias("names"))
        .filter("names > 1")
    )
    return several.agg(F.count(F.lit(1)).alias("shared_courses"))


def students_per_grade(logs: DataFrame) -> DataFrame:
    """Distinct students per grade; one student may count under several grades."""
    return (
        logs.filter(F.col("namer_level").isin(GRADES))
        .groupBy("namer_level")
        .agg(F.countDistinct("userid").alias("student_count"))
        .orderBy("namer_level")
    )


def most_active_student(logs: DataFrame) -> DataFrame:
    """The student with the largest single s_all; a student without any value comes first."""
    return (
        logs.groupBy("userid")
        .agg(F.max("s_all").alias("max_events"))
        .orderBy(F.desc_nulls_first("max_events"), F.asc_nulls_last("userid"))
        .limit(1)
    )


def weekly_average_events(logs: DataFrame) -> DataFrame:
    return (
        logs.groupBy("num_week")
        .agg(numbers.exact_average(F.col("s_all")).alias("avg_all_events"))
        .orderBy(F.asc_nulls_last("num_week"))
    )


def _top_department_by_grade(logs: DataFrame, departments: DataFrame, grade: str, out: str) -> DataFrame:
    students = logs.filter(F.col("namer_level") == grade).select("depart", "userid").distinct()
    return (
        with_department(students, departments)
        .groupBy("department_name")
        .agg(F.countDistinct("userid").alias(out))
        .orderBy(F.desc(out), F.asc_nulls_last("department_name"))
        .limit(1)
    )


def top_excellent_department(logs: DataFrame, departments: DataFrame) -> DataFrame:
    return _top_department_by_grade(logs, departments, "5", "excellent_student_count")


def top_failing_department(logs: DataFrame, departments: DataFrame) -> DataFrame:
    return _top_department_by_grade(logs, departments, "2", "bad_student_count")


_MEASURES = {
    "avg_total_activity": "s_all",
    "avg_course_views": "s_course_viewed",
    "avg_attempt_views": "s_q_attempt_viewed",
}


def activity_by_basis_week(logs: DataFrame) -> DataFrame:
    """Three weekly averages per payment type, for all weeks."""
    return (
        logs.groupBy(labels.payment_type(F.col("name_osno")).alias("payment_type"), F.col("num_week").alias("week_num"))
        .agg(*[numbers.exact_average(F.col(c)).alias(out) for out, c in _MEASURES.items()])
        .orderBy(F.asc_nulls_last("week_num"), F.asc_nulls_last("payment_type"))
    )


def peak_week_by_basis(logs: DataFrame) -> DataFrame:
    """The same averages, only for the week with the highest overall average.

    One pass: the overall average of a week is put together from the sums of its payment
    types, and the rank filter leaves one week per task before the rows meet. One row per week and
    payment type then meets in one place: as many as there are weeks, not logs.
    """
    sums = logs.filter("num_week IS NOT NULL").groupBy(
        labels.payment_type(F.col("name_osno")).alias("payment_type"), F.col("num_week").alias("week_num")
    ).agg(
        *[F.sum(c).alias(f"{c}_sum") for c in _MEASURES.values()],
        *[F.count(c).alias(f"{c}_count") for c in _MEASURES.values()],
    )
    week = W.partitionBy("week_num")
    overall = numbers.exact_ratio(F.sum("s_all_sum").over(week), F.sum("s_all_count").over(week))
    best = W.orderBy(F.desc_nulls_last("overall"), F.asc("week_num"))
    return (
        sums.withColumn("overall", overall)
        .withColumn("place", F.rank().over(best))
        .filter("place = 1")
        .select(
            "payment_type",
            "week_num",
            *[numbers.exact_ratio(F.col(f"{c}_sum"), F.col(f"{c}_count")).alias(out) for out, c in _MEASURES.items()],
        )
        .orderBy(F.asc_nulls_last("payment_type"))
    )


def latest_attributes(logs: DataFrame) -> DataFrame:
    """Level, basis and department of the latest week per (userid, courseid).

    A NULL week counts as latest. Among rows of one week the smaller label position
    wins, then the smaller department.
    """
    order = [
        *ranking.descending_nulls_first(F.col("num_week")),
        labels.code_position(F.col("leveled")),
        labels.code_position(F.col("name_osno")),
        *ranking.ascending_nulls_last(F.col("depart")),
        *ranking.ascending_nulls_last(F.col("leveled")),
        *ranking.ascending_nulls_last(F.col("name_osno")),
    ]
    return ranking.first_per_key(logs, ["userid", "courseid"], order, ["num_week", "leveled", "name_osno", "depart"])
