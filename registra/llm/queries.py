"""The registered queries of this subpackage, and the same results in SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm import exact, fingerprints, mixing, near, packing, periodic, pieces, private, quality, secrets, token_files, tries, unigram
from registra.llm.common import new_path, table, whole_text

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
UNIGRAM_MODEL = PIECE_MODEL  # its entries and scores, read as a unigram model
WINDOW = 2048
# Shares of tokens by language.
TARGETS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}
# In the pipeline every document stays; a rare language's come as often as its share asks for.
RATES = {"least": 1.0}


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), WORD_TOKENIZER, WINDOW, end_id=1)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.classify(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), TARGETS)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact.group_rows(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram.count_tokens(table(spark, sf_dir, "documents"), UNIGRAM_MODEL)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the corpus, the documents up to the middle of the ids and then all: the second scan reads unseen blobs only."""
    docs, ledger = table(spark, sf_dir, "documents"), new_path(spark, "blob-ledger")
    ends = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    secrets.scan(docs.filter(F.col("doc_id") <= ((ends["low"] or 0) + (ends["high"] or 0)) // 2), ledger, version=1)
    return secrets.report(secrets.scan(docs, ledger, version=2))


def op7_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return private.report(private.find(docs, private.fit(docs)))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    asked = docs.select("doc_id", quality.held_out(docs).alias("held_out"), "text")
    scored = quality.with_score(asked, quality.fit(docs, table(spark, sf_dir, "labels")), "score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, WORD_TOKENIZER, end_id=2, vocabulary=49_408)
    return token_files.read_digests(spark, path)


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; a tenth of the documents, by crc32 of the decimal doc_id, become periodic from some word on.

    NULL text counts as empty; a row without doc_id or without words keeps its text.
    """
    key = F.crc32(docs["doc_id"].cast("string"))
    turn = F.floor(key / 10)
    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text"), (key % 10 == 0).alias("chosen"), turn.alias("turn"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = rows.withColumn("words", F.when(F.col("chosen"), words)).withColumn("n", F.size("words"))
    first = F.when(F.col("n") > 0, F.pmod("turn", F.col("n"))).otherwise(0).cast("int")
    period = 1 + F.floor((F.col("n") - F.col("first")) / (3 + F.pmod("turn", F.lit(8))))
    rows = rows.withColumn("first", first).withColumn("period", period.cast("int"))
    rest = F.col("n") - F.col("first")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("first") + 1, F.col("period")), F.ceil(rest / F.col("period")).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("first")), F.slice(again, F.lit(1), rest)), " ")
    return rows.select("doc_id", F.when(F.col("chosen") & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_repeats(table(spark, sf_dir, "documents")))
    # length / period of any two runs compared exactly
    before = (
        "(a, b) -> CASE WHEN CAST(a.length AS DECIMAL(38, 0)) * b.period > CAST(b.length AS DECIMAL(38, 0)) * a.period THEN -1"
        " WHEN CAST(a.length AS DECIMAL(38, 0)) * b.period < CAST(b.length AS DECIMAL(38, 0)) * a.period THEN 1"
        " WHEN a.start != b.start THEN IF(a.start < b.start, -1, 1) ELSE IF(a.period < b.period, -1, IF(a.period > b.period, 1, 0)) END"
    )
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = found.withColumn("best", F.expr(f"get(array_sort(runs, {before}), 0)"))
    return best.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("(1000 * best.length) DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_packing,
        op2_near_dedup,
        op3_mixing,
        op4_exact_dedup,
        op5_token_counts,
        op6_secrets,
        op7_private,
        op8_quality,
        op9_fingerprints,
        op10_token_files,
        op11_periodic_runs,
        op12_sentencepiece,
        op13_conversation_trie,
    )
}

ORACLES: dict[str, str] = {
    "op4_exact_dedup": r"""
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               text_sha256
        FROM (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        WINDOW same AS (PARTITION BY text_sha256)
    """,
    "op13_conversation_trie": r"""
        WITH RECURSIVE turns AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, sha256(coalesce(text, '')) AS digest, turn,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place
            FROM conversations WHERE conv_id IS NOT NULL
        ),
        counts AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
        own AS (
            SELECT c.conv_id, c.n, c.conv_id - c.conv_id % 5 AS base,
                   xor(4294967295::UBIGINT, list_reduce(
                       list_concat([4294967295::UBIGINT], list_transform(string_split(c.conv_id::VARCHAR, ''), lambda d: ascii(d)::UBIGINT)),
                       lambda crc, byte: list_reduce(
                           list_concat([xor(crc, byte)], list_transform(range(8), lambda i: 0::UBIGINT)),
                           lambda x, i: xor(x >> 1, (x & 1::UBIGINT) * 3988292384::UBIGINT)))) % 9 AS h
            FROM counts c
        ),
        rebuilt AS (
            SELECT o.conv_id, t.place - o.h + least(o.h, coalesce(b.n, 0)) AS d, t.role, t.text
            FROM own o JOIN turns t ON t.conv_id = o.conv_id AND t.place > o.h LEFT JOIN counts b ON b.conv_id = o.base
            UNION ALL
            SELECT o.conv_id, t.place, t.role, t.text FROM own o JOIN turns t ON t.conv_id = o.base AND t.place <= o.h
        ),
        paths AS (  -- a prefix is the chain of its turns' digests
            SELECT conv_id, 0::BIGINT AS d, sha256('') AS prefix, 0::BIGINT AS size FROM counts
            UNION ALL
            SELECT p.conv_id, r.d, sha256(p.prefix || length(r.role) || ':' || r.role || r.text), strlen(r.text)
            FROM paths p JOIN rebuilt r ON r.conv_id = p.conv_id AND r.d = p.d + 1
        ),
        nodes AS (
            SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved FROM paths GROUP BY d, prefix
        ),
        linked AS (
            SELECT n.*, up.conv_id AS parent_conv_id
            FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.d = n.d - 1 LEFT JOIN nodes up ON up.d = p.d AND up.prefix = p.prefix
        ),
        children AS (SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL),
        under AS (  -- every node with its ancestors and itself
            SELECT up.d, up.prefix, n.saved, (c.n IS NULL)::BIGINT AS leaf
            FROM nodes n LEFT JOIN children c ON c.conv_id = n.conv_id AND c.d = n.d
            JOIN paths up ON up.conv_id = n.conv_id AND up.d <= n.d
        ),
        totals AS (SELECT d, prefix, sum(saved)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM under GROUP BY d, prefix),
        ends AS (
            SELECT d, prefix, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
            FROM paths p WHERE d = (SELECT max(q.d) FROM paths q WHERE q.conv_id = p.conv_id) GROUP BY d, prefix
        )
        SELECT l.conv_id, l.d AS depth, l.parent_conv_id, l.n_convs, coalesce(c.n, 0) AS n_children, t.n_leaves, t.saved_tokens,
               coalesce(e.ends_sha256, sha256('')) AS ends_sha256
        FROM linked l JOIN totals t USING (d, prefix) LEFT JOIN ends e USING (d, prefix)
        LEFT JOIN children c ON c.conv_id = l.conv_id AND c.d = l.d
    """,
}
