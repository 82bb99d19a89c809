"""Small tables that hold every awkward case."""

LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(20_000))
CLASHING = [
    "start", "length", "sequence_id", "offset", "ids", "pack_group", "piece_id", "digest", "text_digest", "stays", "keep_id",
    "group_size", "kept", "copies", "copy", "blob", "spans", "rep", "score", "quality_score", "scored_text", "node", "bands",
    "label", "class_id", "id", "bucket", "center", "n", "rate", "p_0", "rated_id", "n_copies", "word", "domain", "shard", "which",
]

ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away.", "en", "a", 58),
    (2, "The  quick\tbrown fox jumps over the lazy dog and runs away.", "en", "a", 59),
    (3, None, "en", None, None),
    (4, "", None, "b", 0),
    (5, " \n\t ", "de", "b", 4),
    (6, LONG, "en", "a", len(LONG)),
    (7, "Über die Brücke, straße é ñ \U0001f600 漢字", "de", "c", 30),
    (7, "Über die Brücke, straße é ñ \U0001f600 漢字", "de", "c", 30),
    (7, "another text under the same number", "en", "c", 34),
    (None, "no number at all but some words here", "en", "c", 36),
    (None, None, None, None, None),
    (8, "one", "en", "a", 3),
    (9, "password = hunter2secret, mail me@example.org or +49 170 1234567", "en", "a", 64),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, clashing=False, rows=ROWS):
    """The awkward documents, on request with further columns named like the operators' own."""
    if not clashing:
        return spark.createDataFrame(rows, SCHEMA)
    more = ", ".join(f"{name} string" for name in CLASHING)
    return spark.createDataFrame([(*row, *["x"] * len(CLASHING)) for row in rows], f"{SCHEMA}, {more}")


def labels(spark, rows=((1, 1, 0), (2, 1, 0), (5, 0, 0), (6, 1, 0), (None, 1, 0), (7, None, 0), (99, 0, 1))):
    return spark.createDataFrame(list(rows), "doc_id bigint, quality int, toxic int")
