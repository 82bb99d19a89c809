"""Hand-made logs for the corner cases of the marts."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from registra import schemas
from registra.operators.upsert import upsert
from registra.plans import jobs, marts, portal
from registra.sources import sinks

T0, T1 = datetime(2024, 1, 1), datetime(2024, 2, 1)
BASE = dict.fromkeys(schemas.USER_LOGS.fieldNames())


def log(user, week, grade="5", s_all=1, course=1, **more):
    return {**BASE, "userid": user, "courseid": course, "num_week": week, "namer_level": grade, "s_all": s_all, **more}


def logs_of(spark, *entries):
    return spark.createDataFrame([tuple(e[c] for c in BASE) for e in entries], schemas.USER_LOGS)


@pytest.fixture
def deps(spark):
    return spark.createDataFrame([(3, "three"), (9, "nine")], schemas.DEPARTMENTS)


def mart(spark, deps, *entries, variant="v2", existing=None, as_of=T0):
    df = marts.student_performance(logs_of(spark, *entries), deps, existing, as_of, variant)
    assert df.columns == schemas.STUDENT_PERFORMANCE.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in schemas.STUDENT_PERFORMANCE]
    return {r.student_id: r for r in df.collect()}


def small(spark, *entries):
    return {r.student_id: r for r in marts.analytics_student(logs_of(spark, *entries), as_of=T0).collect()}


def test_text_and_digit_grade(spark, deps):
    entries = [log(1, 1, "5"), log(1, 2, "pass")]
    assert small(spark, *entries) == {}
    assert mart(spark, deps, *entries)[1].final_grade == 5
    assert mart(spark, deps, *entries, variant="v1")[1].final_grade == 5


def test_text_below_the_grade_does_not_hide_it(spark):
    got = small(spark, log(1, 1, "4"), log(1, 2, "10"), log(2, 1, "3"), log(2, 2, "35"), log(3, 1, None), log(4, 1, ""), log(4, 1, "2"))
    assert {k: r.final_grade for k, r in got.items()} == {1: 4, 4: 2}


def test_grade_out_of_range(spark, deps):
    assert mart(spark, deps, log(1, 1, "1")) == {} and small(spark, log(1, 1, "1")) == {}
    assert mart(spark, deps, log(1, 1, "1"), variant="v1")[1].final_grade == 1
    assert mart(spark, deps, log(1, 1, "5\n"), variant="v1") == {}


def test_peak_week_with_null_activity_and_ties(spark, deps):
    entries = [log(1, 1, s_all=None), log(1, 2, s_all=7), log(2, 9, s_all=9), log(2, 3, s_all=9), log(3, None, s_all=4), log(3, 60, s_all=4)]
    v1, v2 = mart(spark, deps, *entries, variant="v1"), mart(spark, deps, *entries)
    assert (v1[1].peak_activity_week, v2[1].peak_activity_week) == (1, 2)
    assert v2[2].peak_activity_week == 3
    assert v2[3].peak_activity_week == 60


def test_any_week_number_counts(spark, deps):
    weeks = [-1, 0, 63, 64, 64, 127, 128, 2_000_000_000, None]
    entries = [log(1, w, s_all=i) for i, w in enumerate(weeks)]
    activity = marts.pair_activity(logs_of(spark, *entries), F.lit(True)).first()
    assert (activity.total_weeks, activity.active_weeks, activity.peak_activity_week) == (7, 6, None)
    assert mart(spark, deps, *entries)[1].avg_weekly_events == Decimal("5.14")


def test_zero_activity_and_graded_weeks(spark, deps):
    row = mart(spark, deps, log(1, 1, s_all=0), log(1, 2, s_all=4))[1]
    assert (row.consistency_score, row.avg_weekly_events) == (Decimal("0.50"), Decimal("2.00"))
    row = mart(spark, deps, log(1, 1, "4", 10), log(1, 2, None, 50))[1]
    assert (row.total_events, row.avg_weekly_events, row.peak_activity_week) == (10, Decimal("5.00"), 2)


def test_department_moves_and_unknown_codes(spark, deps):
    row = mart(spark, deps, log(1, 1, depart=9, leveled="1", name_osno="1"), log(1, 2, depart=3, leveled="3"))[1]
    assert (row.department_id, row.department_name, row.education_level, row.education_base) == (9, "three", "иное", "иное")
    row = mart(spark, deps, log(1, None, depart=9, leveled="2"), log(1, 2, depart=3, leveled="1"))[1]
    assert (row.department_name, row.education_level) == ("nine", "магистратура")
    assert mart(spark, deps, log(1, 1, depart=99))[1].department_name is None


def test_packed_attributes_agree_with_the_plain_operator(spark):
    entries = [
        log(u, w, depart=d, leveled=l, name_osno=o)
        for u in range(1, 8)
        for w, d, l, o in [(u % 3, 3, "1", "2"), (2, -5, "2", None), (2, None, "2", "1"), (u, 2_147_483_647, "1", "1"), (u, -2_147_483_648, "1", "1")]
    ]
    logs = logs_of(spark, *entries)
    plain = {r.userid: r.depart for r in portal.latest_attributes(logs).collect()}
    packed = {r.userid: r.latest_depart for r in marts.pair_activity(logs, F.lit(True)).collect()}
    assert plain == packed


def test_quartile_sizes(spark, deps):
    order = {"низкая": 1, "средняя": 2, "высокая": 4}
    five = mart(spark, deps, *[log(u, 1, s_all=u) for u in range(1, 6)])
    assert [order[five[u].activity_category] for u in range(1, 6)] == [1, 1, 2, 2, 4]
    three = mart(spark, deps, *[log(u, 1, s_all=5) for u in range(1, 4)])
    assert [order[three[u].activity_category] for u in range(1, 4)] == [1, 2, 2]


def test_too_wide_average_fails(spark, deps):
    with pytest.raises(ArithmeticException):
        mart(spark, deps, log(1, 1, s_all=2_000_000_000))


def test_refresh_updates_what_each_variant_updates(spark, deps):
    first = [log(1, 1, "4", 10, depart=3, kurs=1), log(2, 1, "4", 20, depart=3), log(3, 1, "4", 30, depart=3)]
    second = [log(1, 2, "5", 7, depart=9, kurs=2), log(2, 2, None, 5, depart=9), log(4, 2, "3", 1, depart=9)]
    for variant in ("v1", "v2"):
        before = marts.student_performance(logs_of(spark, *first), deps, None, T0, variant)
        after = mart(spark, deps, *second, variant=variant, existing=before, as_of=T1)
        assert set(after) == {1, 2, 3, 4}
        # a graded pair: counters always, the rest only in v2
        assert after[1].total_events == 7
        assert (after[1].final_grade, after[1].department_id, after[1].course_year) == ((4, 3, 1) if variant == "v1" else (5, 9, 2))
        # an ungraded pair in the logs: labels and averages move, counters stay
        assert (after[2].total_events, after[2].department_name, after[2].avg_weekly_events) == (20, "nine", Decimal("20.00"))
        assert after[2].peak_activity_week == 2 and after[2].department_id == 3
        # a pair without logs stays
        assert (after[3].total_events, after[3].peak_activity_week) == (30, 1)
        stamps = {u: after[u].last_update for u in after}
        assert stamps == ({1: T1, 2: T0, 3: T0, 4: T1} if variant == "v1" else dict.fromkeys(after, T1))


def test_running_twice_changes_nothing(spark, deps):
    entries = [log(u, w, str(2 + u % 4), u * w, depart=3 + 6 * (u % 2)) for u in range(1, 12) for w in (1, 2, 3)]
    once = marts.student_performance(logs_of(spark, *entries), deps, None, T0)
    assert mart(spark, deps, *entries, existing=once) == {r.student_id: r for r in once.collect()}


def test_arrivals_give_the_mart_of_all_logs(spark, deps, tmp_path):
    early = [log(u, w, "4", u, depart=3) for u in range(1, 7) for w in (1, 70)]
    late = [log(1, 2, "5", 9, depart=9), log(2, 2, None, 3), log(8, 2, "3", 1)]
    complete = logs_of(spark, *early, *late)
    for variant in ("v1", "v2"):
        state = str(tmp_path / variant)
        jobs.add_batch(logs_of(spark, *early), state, 0, variant)
        for _ in range(2):  # a batch that comes again counts once
            jobs.add_batch(logs_of(spark, *late), state, 1, variant)
        after = marts.performance_of_state(jobs.read_state(spark, state), deps, None, T0, variant)
        assert sorted(after.collect()) == sorted(marts.student_performance(complete, deps, None, T0, variant).collect())


def test_state_holds_no_logs(spark, deps, tmp_path):
    jobs.add_batch(logs_of(spark, *[log(1, w, "4", 1) for w in range(1, 60)]), str(tmp_path / "s"), 0)
    assert jobs.read_state(spark, str(tmp_path / "s")).count() == 1


def test_hot_pair(spark, deps):
    """A third of all rows belong to one pair."""
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("userid"),
        F.lit(1).alias("courseid"),
        (F.col("id") % 53 + 1).cast("int").alias("num_week"),
        F.lit(2).alias("s_all"),
        F.lit("5").alias("namer_level"),
    )
    logs = hot.select(*[F.col(c) if c in hot.columns else F.lit(None).cast(f.dataType).alias(c) for c, f in zip(BASE, schemas.USER_LOGS)])
    row = marts.student_performance(logs, deps, as_of=T0).filter("student_id = 1").first()
    assert row.total_events == 2 * (10_000 + 1) and row.consistency_score == 1


def test_upsert_laws(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k int, name string, n int")
    new = spark.createDataFrame([(2, None, 20), (3, "c", 30)], "k int, name string, n int")

    def run(*args):
        return sorted(map(tuple, upsert(*args).collect()))

    assert run(old, new, ["k"]) == [(1, "a", 1), (2, None, 20), (3, "c", 30)]
    assert run(old, new, ["k"], ["n"]) == [(1, "a", 1), (2, "b", 20), (3, "c", 30)]
    assert run(upsert(old, new, ["k"]), new, ["k"]) == run(old, new, ["k"])


def test_jobs_publish_whole_checked_versions(spark, deps, tmp_path):
    folder = str(tmp_path)
    first = logs_of(spark, log(1, 1, "4"), log(2, 1, "5"))
    assert jobs.run_small_mart(first, folder, T0, name="dmr_test.small") == 2
    assert jobs.run_small_mart(logs_of(spark, log(2, 2, "3"), log(3, 2, "2")), folder, T1, name="dmr_test.small") == 3
    grades = {r.student_id: r.final_grade for r in sinks.current_mart(spark, "dmr_test.small").collect()}
    assert grades == {1: 4, 2: 3, 3: 2}
    assert jobs.run_performance_mart(first, deps, folder, T0, name="dmr_test.performance") == 2

    twice = sinks.current_mart(spark, "dmr_test.small").unionAll(sinks.current_mart(spark, "dmr_test.small"))
    with pytest.raises(ValueError, match="primary key"):
        sinks.publish(twice, "dmr_test.small", folder, marts.mart_checks())
    assert sinks.current_mart(spark, "dmr_test.small").count() == 3
    assert sinks.current_mart(spark, "dmr_test.nothing") is None


def test_old_and_refused_versions_go_with_their_files(spark, deps, tmp_path):
    first = logs_of(spark, log(1, 1, "4"), log(2, 1, "5"))
    for _ in range(4):
        jobs.run_small_mart(first, str(tmp_path), T0, name="dmr_kept.small")
    assert len(sinks.versions(spark, "dmr_kept", "small")) == 2
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("small__")]) == 2
    twice = sinks.current_mart(spark, "dmr_kept.small").unionAll(sinks.current_mart(spark, "dmr_kept.small"))
    with pytest.raises(ValueError, match="primary key"):
        sinks.publish(twice, "dmr_kept.small", str(tmp_path), marts.mart_checks(grades=[2, 3, 4, 5]))
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("small__")]) == 2
    assert sinks.current_mart(spark, "dmr_kept.small").count() == 2


def test_a_view_of_the_session_is_no_mart(spark):
    spark.range(3).createOrReplaceTempView("just_a_view")
    assert sinks.current_mart(spark, "default.just_a_view") is None


def test_counters_beyond_32_bits_stop_the_publish(spark, deps, tmp_path):
    # Two rows of one week: the average passes its width, the sum does not.
    wide = logs_of(spark, *[log(1, w, "4", 90_000_000) for w in range(1, 31)])
    assert jobs.run_performance_mart(logs_of(spark, log(1, 1, "4")), deps, str(tmp_path), T0, name="dmr_wide.performance") == 1
    with pytest.raises(ValueError, match="counter width"):
        jobs.run_performance_mart(wide, deps, str(tmp_path), T0, name="dmr_wide.performance")
    assert sinks.current_mart(spark, "dmr_wide.performance").first().total_events != 90_000_000 * 30
