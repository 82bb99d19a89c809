"""Secret scans over a ledger of blobs.

A text's address is the SHA-256 of its bytes. The ledger is a Parquet folder with a row for each
(blob, rule_version) ever scanned: blob, rule_version, spans. Beside it a second folder records every version of
the documents: which path (doc_id) held which blob in which version. A version is looked up in the ledger
by address; only blobs that these rules have not seen are read, once each however
many documents hold them, and added. Findings then go back to every document that has
the blob: `scan` gives those of its own version, `history` those of every version recorded, by any rules.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.llm.common import by_hot_key, parts, whole_text, written

KINDS = ("assign", "access", "hex")
# The patterns and least lengths of the rules.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

RULE_VERSION = hashlib.sha256(repr((ASSIGN, ACCESS, HEX, LEAST)).encode()).hexdigest()[:16]

_ASSIGN = re.compile(ASSIGN, re.ASCII)
_ACCESS = re.compile(ACCESS)
# A run of hex digits is one match however it is found; short runs are passed over at their start.
_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST['hex']},}}")

LEDGER = "blob binary, rule_version string, spans array<struct<kind:int,start:int,end:int>>"


def find(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by start, then kind, in code points; no spans in an empty text."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(0, *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(1, *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    spans += [(2, *m.span()) for m in _HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], s[0]))


PATHS = "doc_id bigint, blob binary, n_rows bigint, version bigint"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; none if nothing was ever written there."""
    return _read(spark, path, LEDGER)


def read_versions(spark: SparkSession, ledger: str) -> DataFrame:
    """doc_id, blob, n_rows, version: what every recorded version held; none if there is none."""
    return _read(spark, f"{ledger.rstrip('/')}.paths", PATHS)


def history(spark: SparkSession, ledger: str, rule_version: str = RULE_VERSION) -> DataFrame:
    """doc_id, version, n_rows, blob, spans: findings of all paths of all versions, old ones too.

    Blobs that these rules have not been run on have NULL spans: their texts may be gone.
    """
    held = written(read_versions(spark, ledger), "versions")
    counts = held.groupBy("blob").agg(F.count(F.lit(1)).alias("n_paths"))
    known = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version).dropDuplicates(["blob"])
    findings = written(counts.join(known, "blob", "left").select("blob", "n_paths", "spans"), "findings")
    return by_hot_key(held, findings, "blob", "n_paths", max(1, held.count())).select("doc_id", "version", "n_rows", "blob", "spans")


def scan(docs: DataFrame, ledger: str, rule_version: str = RULE_VERSION, version: int | None = None) -> DataFrame:
    """A row per document of the snapshot: doc_id, blob, spans. The ledger grows by the unseen blobs.

    With a number, the snapshot is recorded as that version of the documents; a version that comes again replaces
    its own record. NULL text is the empty blob. Rows that repeat share their blob's findings. Other columns are not looked at; an
    empty snapshot gives no rows and leaves the ledger as it was.
    """
    spark = docs.sparkSession
    doc_id = docs["doc_id"].cast("bigint").alias("doc_id")
    address = F.unhex(F.sha2(whole_text(docs), 256)).alias("blob")
    paths = written(docs.select(doc_id, address), "paths")
    if version is not None:
        held = paths.groupBy("doc_id", "blob").agg(F.count(F.lit(1)).alias("n_rows"))
        held.write.mode("overwrite").parquet(f"{ledger.rstrip('/')}.paths/version={version}")
    blobs = written(paths.groupBy("blob").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n_paths")), "blobs")
    seen = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version)
    unseen = blobs.join(seen, "blob", "left_anti").select("blob", "rep")
    texts = docs.select(doc_id, address, whole_text(docs).alias("text"))
    rows = texts.join(unseen, (texts["doc_id"].eqNullSafe(unseen["rep"])) & (texts["blob"] == unseen["blob"])).select(texts["blob"], "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            for part in parts(batch, 1, 4_000_000):
                found = [[dict(zip(("kind", "start", "end"), s, strict=True)) for s in find(t)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([rule_version] * len(found)), pa.array(found, pa.list_(span))],
                    names=["blob", "rule_version", "spans"],
                )

    rows.mapInArrow(work, LEDGER).dropDuplicates(["blob"]).write.mode("append").parquet(ledger)
    known = read_ledger(spark, ledger).filter(F.col("rule_version") == rule_version).dropDuplicates(["blob"])
    findings = written(blobs.join(known, "blob").select("blob", "n_paths", "spans"), "findings")
    return by_hot_key(paths, findings, "blob", "n_paths", paths.count()).select("doc_id", "blob", "spans")


def report(scanned: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end, comma-joined).

    A row for each of `scanned`; a text without findings, also an empty or NULL one, has zeros and empty lists.
    """
    names = F.array(*[F.lit(k) for k in KINDS])
    of_kind = lambda k: lambda s: s["kind"] == k
    listed = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    counts = [F.size(F.filter("spans", of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return scanned.select("doc_id", *counts, F.sha2(listed, 256).alias("base_sha256"), listed.alias("spans"))
