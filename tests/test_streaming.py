from datetime import datetime

from registra import schemas
from registra.plans import marts
from registra.sources import sinks, tables
from registra.streaming.arrivals import follow_logs

HEADER = ",".join(schemas.USER_LOGS.fieldNames())


def line(course, user, week, s_all, grade):
    return f'{course},{user},{week},{s_all},"1,5",1,"1,0",1,"1,0",1,"1,0",1,"1,0",{grade},,3,1,,1,1,1,'


def test_mart_follows_arriving_files(spark, tmp_path):
    logs, mart, checkpoint = (str(tmp_path / n) for n in ("logs", "mart", "checkpoint"))
    (tmp_path / "logs").mkdir()
    deps = spark.createDataFrame([(3, "three")], schemas.DEPARTMENTS)
    now = datetime(2024, 1, 1)

    def arrive(name, *lines):
        (tmp_path / "logs" / name).write_text("\n".join([HEADER, *lines]) + "\n")
        follow_logs(spark, logs, deps, mart, checkpoint, name="dmr_stream.performance", as_of=now).awaitTermination()
        published = sinks.current_mart(spark, "dmr_stream.performance")
        complete = marts.student_performance(tables.read_user_logs(spark, logs), deps, None, now)
        assert sorted(published.collect()) == sorted(complete.collect())
        return published.count()

    assert arrive("a.csv", line(1, 1, 1, 10, 4), line(1, 2, 1, 20, 5)) == 2
    # a late row for a known pair, a new pair, and one without a grade
    assert arrive("b.csv", line(1, 1, 2, 30, 5), line(1, 3, 2, 5, 3), line(1, 4, 2, 5, "")) == 3
