"""The student marts: one row per (student, course).

All per-pair values come from one scan and two hash aggregations. The first groups by
(userid, courseid, block of 64 weeks): totals, the set of weeks as a 64-bit mask, and
"first row by some order" as the largest packed number. Every buffer is a plain number,
so Spark reduces rows in each task before the shuffle with a hash aggregate, and a pair
that holds much of the table is no hot spot. The second merges the blocks of a pair;
weeks of a year lie in one block, so it moves about one row per pair.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra import schemas
from registra.functions import labels, numbers
from registra.operators import quality, ranking
from registra.operators.upsert import upsert
from registra.plans.portal import GRADES
from registra.sources.shared import written

KEY = ["student_id", "course_id"]
PAIR = ["userid", "courseid"]
COUNTERS = {
    "total_events": "s_all",
    "total_course_views": "s_course_viewed",
    "total_quiz_views": "s_q_attempt_viewed",
    "total_module_views": "s_a_course_module_viewed",
    "total_submissions": "s_a_submission_status_viewed",
}
BASICS = ["department_id", "semester", "course_year", "final_grade"]

# Weeks of a block, and the bits of a week's place in it.
_BLOCK, _BLOCK_BITS = 64, 6
# One more than the largest int.
_INT_END = 1 << 31
# Attributes of a row as one number: level position (2 bits), basis position (2 bits),
# department moved to 0 and up, NULL last (33 bits).
_DEPART_BITS = 33
_ATTRIBUTE_BITS = _DEPART_BITS + 4
_LAST_ATTRIBUTES = (1 << _ATTRIBUTE_BITS) - 1
_NO_DEPART = 2 * _INT_END


def graded_2_to_5(grade: Column) -> Column:
    return F.coalesce(grade.isin(GRADES), F.lit(False))


def graded_digits(grade: Column) -> Column:
    return F.coalesce(numbers.digits_only(grade), F.lit(False))


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _week_blocks(logs: DataFrame, graded: Column, null_activity_first: bool) -> DataFrame:
    """One row per (userid, courseid, block of 64 weeks)."""
    slot = F.col("num_week").bitwiseAND(_BLOCK - 1)
    week_bit = F.call_function("shiftleft", _long(1), slot)
    place = F.coalesce(slot, F.lit(0)).cast("bigint")
    # A NULL activity either ranks above every number or as 0.
    activity = F.coalesce(F.col("s_all").cast("bigint"), _long(_INT_END if null_activity_first else 0))
    codes = labels.code_position(F.col("leveled")) * 4 + labels.code_position(F.col("name_osno"))
    depart = F.coalesce(F.col("depart").cast("bigint") + _INT_END, _long(_NO_DEPART))
    attributes = F.shiftleft(codes.cast("bigint"), _DEPART_BITS) + depart

    def of_graded(value: Column) -> Column:
        return F.when(F.col("graded"), value)

    # Worked out once per row, as most of the aggregates use it.
    return logs.withColumn("graded", graded).groupBy(*PAIR, F.shiftright("num_week", _BLOCK_BITS).alias("block")).agg(
        F.count(of_graded(F.lit(1))).alias("graded_rows"),
        *[F.sum(of_graded(F.coalesce(F.col(c), F.lit(0)))).alias(out) for out, c in COUNTERS.items()],
        F.max(of_graded(F.col("depart"))).alias("department_id"),
        F.max(of_graded(F.col("num_sem"))).alias("semester"),
        F.max(of_graded(F.col("kurs"))).alias("course_year"),
        F.max(of_graded(F.col("namer_level").cast("int"))).alias("final_grade"),
        F.bit_or(week_bit).alias("weeks"),
        F.bit_or(F.when(F.col("s_all") > 0, week_bit)).alias("active_weeks"),
        # largest activity, then the earliest week
        F.max(F.shiftleft(activity, _BLOCK_BITS) + (_BLOCK - 1 - place)).alias("peak"),
        # latest week, then the smallest attributes
        F.max(F.shiftleft(place, _ATTRIBUTE_BITS) + (_LAST_ATTRIBUTES - attributes)).alias("latest"),
    )


def merged_blocks(blocks: DataFrame) -> DataFrame:
    """One row per (userid, courseid, block) from the blocks of any number of batches of logs."""
    largest = [*BASICS, "peak", "latest"]
    return blocks.groupBy(*PAIR, "block").agg(
        *[F.sum(c).alias(c) for c in ("graded_rows", *COUNTERS)],
        *[F.max(c).alias(c) for c in largest],
        *[F.bit_or(c).alias(c) for c in ("weeks", "active_weeks")],
    )


def week_blocks(logs: DataFrame, variant: str = "v2") -> DataFrame:
    """What a batch of logs adds to the state of the performance mart.

    Sums, maxima and sets of weeks only, so the blocks of several batches merge to those of
    all their logs, in any order.
    """
    return _week_blocks(logs, *_rules(variant))


def _rules(variant: str) -> tuple[Column, bool]:
    """Which rows are graded, and whether a NULL activity wins the peak week."""
    if variant not in ("v1", "v2"):
        raise ValueError(f"unknown variant {variant!r}")
    graded = graded_digits if variant == "v1" else graded_2_to_5
    return graded(F.col("namer_level")), variant == "v1"


def pair_activity(logs: DataFrame, graded: Column, null_activity_first: bool = False) -> DataFrame:
    """Everything the performance mart knows about a (userid, courseid).

    Totals, grade and the maxima use the graded rows only (NULL or 0 without any); weeks,
    peak week and the latest attributes use all rows of the pair. s_all is documented as
    a running count, yet the mart adds it up.
    """
    return _pairs(_week_blocks(logs, graded, null_activity_first))


def _pairs(blocks: DataFrame) -> DataFrame:
    block_start = F.shiftleft(F.col("block").cast("bigint"), _BLOCK_BITS)
    peak_week = (block_start + (_BLOCK - 1) - F.col("peak").bitwiseAND(_BLOCK - 1)).cast("int")
    peak_activity = F.shiftright("peak", _BLOCK_BITS)
    # A NULL week loses against any week of the same activity, and is later than any week.
    week_or_last = F.coalesce(peak_week.cast("bigint"), _long(_INT_END))
    peak_order = peak_activity.cast("decimal(20,0)") * (4 * _INT_END) - week_or_last
    latest_week = F.coalesce(block_start + F.shiftright("latest", _ATTRIBUTE_BITS), _long(_INT_END))
    attributes = _LAST_ATTRIBUTES - F.col("latest").bitwiseAND(_long(_LAST_ATTRIBUTES))
    codes = F.shiftright("attributes", _DEPART_BITS)
    depart = F.col("attributes").bitwiseAND(_long((1 << _DEPART_BITS) - 1))
    return (
        blocks.groupBy(*PAIR)
        .agg(
            F.sum("graded_rows").alias("graded_rows"),
            *[F.sum(c).alias(c) for c in COUNTERS],
            *[F.max(c).alias(c) for c in BASICS],
            F.sum(F.coalesce(F.bit_count("weeks"), F.lit(0))).alias("total_weeks"),
            F.sum(F.coalesce(F.bit_count("active_weeks"), F.lit(0))).alias("active_weeks"),
            F.max_by(peak_week, peak_order).alias("peak_activity_week"),
            F.max_by(attributes, latest_week).alias("attributes"),
        )
        .withColumns(
            {
                "level_position": F.shiftright(codes, 2),
                "base_position": codes.bitwiseAND(3),
                "latest_depart": F.when(depart < _NO_DEPART, depart - _INT_END).cast("int"),
            }
        )
        .drop("attributes")
    )


def _performance_batch(blocks: DataFrame, departments: DataFrame) -> DataFrame:
    """Pairs with labels, named like the mart. The department name is that of the
    latest row, while department_id is the maximum: the two can differ."""
    names = departments.select(F.col("id").alias("latest_depart"), F.col("name").alias("department_name"))
    return (
        _pairs(blocks)
        .join(names, "latest_depart", "left")
        .select(
            F.col("userid").alias("student_id"),
            F.col("courseid").alias("course_id"),
            "graded_rows",
            "total_weeks",
            "active_weeks",
            *BASICS,
            *COUNTERS,
            "department_name",
            labels.education_level(F.col("level_position")).alias("education_level"),
            labels.education_base(F.col("base_position")).alias("education_base"),
            "peak_activity_week",
        )
    )


def _averages(total_events: Column) -> dict[str, Column]:
    # ANSI casts: a value that does not fit the declared width fails the job.
    return {
        "avg_weekly_events": numbers.exact_ratio(total_events, F.col("total_weeks")).cast("decimal(10,2)"),
        "consistency_score": numbers.exact_ratio(F.col("active_weeks"), F.col("total_weeks")).cast("decimal(5,2)"),
    }


#: What the quartiles are cut by.
ACTIVITY_ORDER = ("total_events", *KEY)


def _with_categories(rows: DataFrame) -> DataFrame:
    quartiles = ranking.global_ntile(written(rows, "mart"), 4, {c: F.col(c) for c in ACTIVITY_ORDER}, "quartile")
    return quartiles.withColumn("activity_category", labels.activity_category(F.col("quartile")))


def performance_view(cuts: list[tuple[int, ...]], now: int | None) -> list[str]:
    """The mart's columns as SQL over its stored rows: the category by the quartiles' cuts, and `now` (microseconds) for the time
    of the last update, if that is the same for all rows."""
    place = "named_struct(" + ", ".join(f"'{c}', CAST({c} AS BIGINT)" for c in ACTIVITY_ORDER) + ")"

    def at(cut: tuple[int, ...]) -> str:
        return "named_struct(" + ", ".join(f"'{c}', CAST('{v}' AS BIGINT)" for c, v in zip(ACTIVITY_ORDER, cut)) + ")"

    quartile = " + ".join(["1", *[f"IF({place} >= {at(cut)}, 1, 0)" for cut in cuts]])
    category = f"CASE {quartile} WHEN 1 THEN '{labels.LOW}' WHEN 4 THEN '{labels.HIGH}' ELSE '{labels.MEDIUM}' END"
    own = {"activity_category": category}
    if now is not None:
        own["last_update"] = f"timestamp_micros({now})"
    return [f"{own[c]} AS {c}" if c in own else c for c in schemas.STUDENT_PERFORMANCE.fieldNames()]


def _run_time(as_of: datetime | None) -> Column:
    return F.lit(as_of) if as_of is not None else F.current_timestamp()


def _refresh(existing: DataFrame, batch: DataFrame, refreshed: list[str], touch_all: bool, now: Column) -> DataFrame:
    """The mart after one run, before the categories.

    A graded pair is inserted, or refreshes the listed columns of its row. Any pair in
    the logs, graded or not, then updates labels, averages and peak week of its row.
    Rows without logs stay as they are.
    """
    derived = ["department_name", "education_level", "education_base", "peak_activity_week"]
    old = existing.select(*KEY, F.struct(*existing.columns).alias("old"))
    new = batch.select(*KEY, F.struct(*[c for c in batch.columns if c not in KEY]).alias("new"))
    joined = old.join(new, KEY, "full_outer")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    graded = F.coalesce(F.col("new.graded_rows") > 0, F.lit(False))

    def carried(name: str) -> Column:
        take_new = graded if name in refreshed else graded & ~has_old
        return F.when(take_new, F.col(f"new.{name}")).otherwise(F.col(f"old.{name}"))

    columns = {c: carried(c) for c in [*BASICS, *COUNTERS]}
    columns |= {c: F.when(has_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in derived}
    columns |= {
        "total_weeks": F.col("new.total_weeks"),
        "active_weeks": F.col("new.active_weeks"),
        "old_average": F.col("old.avg_weekly_events"),
        "old_score": F.col("old.consistency_score"),
        "last_update": now if touch_all else F.when(graded, now).otherwise(F.col("old.last_update")),
    }
    rows = joined.filter(has_old | graded).select(*KEY, has_new.alias("in_logs"), *[v.alias(k) for k, v in columns.items()])
    kept = {"avg_weekly_events": F.col("old_average"), "consistency_score": F.col("old_score")}
    fresh = _averages(F.col("total_events"))
    return rows.withColumns({c: F.when(F.col("in_logs"), fresh[c]).otherwise(kept[c]) for c in kept})


def student_performance(
    logs: DataFrame,
    departments: DataFrame,
    existing: DataFrame | None = None,
    as_of: datetime | None = None,
    variant: str = "v2",
) -> DataFrame:
    """The performance mart after a run over the logs, complete with rows of `existing`.

    v2: grades 2-5, every column of a known pair is refreshed, peak week by COALESCE(s_all, 0)
    and the earliest week. v1: any all-digit grade, a known pair refreshes its counters
    only, a NULL s_all wins the peak week.
    """
    return _performance(week_blocks(logs, variant), departments, existing, as_of, variant)


def performance_of_state(
    state: DataFrame,
    departments: DataFrame,
    existing: DataFrame | None = None,
    as_of: datetime | None = None,
    variant: str = "v2",
) -> DataFrame:
    """The performance mart from the week blocks of all batches so far, as from all their logs."""
    return _performance(merged_blocks(state), departments, existing, as_of, variant)


def performance_rows(
    blocks: DataFrame, departments: DataFrame, existing: DataFrame | None, as_of: datetime | None, variant: str
) -> DataFrame:
    """The rows of the performance mart after a run, all but the category, which depends on all of them."""
    first = variant == "v1"
    batch = _performance_batch(blocks, departments)
    now = _run_time(as_of)
    if existing is None:
        rows = batch.filter("graded_rows > 0").withColumns({**_averages(F.col("total_events")), "last_update": now})
    else:
        refreshed = list(COUNTERS) if first else [*BASICS, *COUNTERS]
        rows = _refresh(existing, batch, refreshed, touch_all=not first, now=now)
    needed = rows.select(*[c for c in schemas.STUDENT_PERFORMANCE.fieldNames() if c != "activity_category"])
    return quality.with_defaults(needed, {c: F.lit(0).cast("bigint") for c in COUNTERS})


def _performance(
    blocks: DataFrame, departments: DataFrame, existing: DataFrame | None, as_of: datetime | None, variant: str
) -> DataFrame:
    rows = performance_rows(blocks, departments, existing, as_of, variant)
    return _with_categories(rows).select(*schemas.STUDENT_PERFORMANCE.fieldNames())


def _grade_place(grade: Column) -> Column:
    """Place of a text grade in text order: odd for '2', '3', '4', '5' themselves, even between.

    The maximum of these numbers tells whether the maximum text is one of the four
    grades, and numbers aggregate by hash where texts need a sort.
    """
    place = F.when(grade > "5", 8)
    for number, text in ((7, "5"), (5, "4"), (3, "3"), (1, "2")):
        place = place.when(grade == text, number).when(grade > text, number + 1)
    return place.when(grade.isNotNull(), 0)


def student_grades(logs: DataFrame) -> DataFrame:
    """One run's rows of the small mart: the largest grade *as text* must be 2-5, so a pair
    with any text grade above '5' is left out."""
    place = F.col("place")
    return (
        logs.filter("namer_level IS NOT NULL")
        .groupBy(*PAIR)
        .agg(
            F.max("depart").alias("department_id"),
            F.max("num_sem").alias("semester"),
            F.max("kurs").alias("course_year"),
            F.max(_grade_place(F.col("namer_level"))).alias("place"),
        )
        .filter(place.isin(1, 3, 5, 7))
        .select(
            F.col("userid").alias("student_id"),
            F.col("courseid").alias("course_id"),
            "department_id",
            "semester",
            "course_year",
            ((place + 3) / 2).cast("int").alias("final_grade"),
        )
    )


def analytics_student(logs: DataFrame, existing: DataFrame | None = None, as_of: datetime | None = None) -> DataFrame:
    """The small mart after a run over the logs: known pairs are replaced, others stay."""
    rows = student_grades(logs).withColumn("last_update", _run_time(as_of).cast("timestamp"))
    return rows if existing is None else upsert(existing, rows, KEY)


def mart_checks(grades: list[int] | None = None) -> dict:
    """Constraints of the mart tables, for `sinks.publish`: of the small mart with its `grades`, else of
    the performance mart, whose counters are declared as 32-bit numbers."""
    checks = {"primary key": lambda df: quality.key_violations(df, KEY)}
    if grades is None:
        checks["counter width"] = lambda df: quality.outside_range(df, list(COUNTERS), -_INT_END, _INT_END - 1)
    else:
        checks["grade domain"] = lambda df: quality.outside_domain(df, "final_grade", grades)
    return checks
