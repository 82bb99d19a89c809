from registra.functions import texts


def test_orders_differ_where_they_should(spark):
    words = ["b", "A", "a", "B", "é", "f", "Z", None, "b"]
    rows = spark.createDataFrame([(1, w) for w in words] + [(2, None)], "k int, w string")

    def order(collation):
        found = texts.placed(rows.filter("w IS NOT NULL"), ["k"], "w", collation).orderBy("place").collect()
        assert [r.place for r in found] == list(range(1, 8))
        return [r.w for r in found]

    assert order(texts.BINARY) == ["A", "B", "Z", "a", "b", "f", "é"]
    assert order(texts.NO_CASE) == ["A", "a", "B", "b", "f", "Z", "é"]
    assert order(texts.UNICODE) == ["a", "A", "b", "B", "é", "f", "Z"]


def test_largest_text_by_each_order(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "Z"), (1, "z"), (1, None), (2, None), (3, "A"), (3, "a")], "k int, w string")

    def largest(collation):
        return {r.k: r.largest for r in texts.largest(rows, ["k"], "w", collation).collect()}

    assert largest(texts.BINARY) == {1: "z", 2: None, 3: "a"}
    assert largest(texts.NO_CASE) == {1: "z", 2: None, 3: "a"}
    assert largest(texts.UNICODE) == {1: "Z", 2: None, 3: "A"}
    assert texts.largest(rows.limit(0), ["k"], "w").count() == 0
