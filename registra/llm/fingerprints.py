"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes decides where a chunk ends: at block size 2^k, wherever its
lowest k bits are zero, so the chunk ends of a size are among those of every smaller one. Each chunk
gives one character of the signature; of equal chunks in a row three count. The block size follows from the length,
so that about 64 chunks of the whole text are to be expected at most; it grows as long as there are over 96 and
falls as long as there are under 16. Nothing is cut off. A fingerprint is

    k : signature at block size 2^k : signature at 2^(k+1)

Two fingerprints are compared where their block sizes meet (k equal or one apart): likeness is
1 - d / (m + n) for signatures of m and n characters and d insertions and deletions, the
better of the two where both meet; 0 if the signatures have no seven characters in a row in common, as
chance alone makes signatures alike to some degree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from registra.llm.common import mix64, parts, whole_text, written

WINDOW = 7
CHUNKS, MOST, FEWEST = 64, 96, 16
ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype="u1")
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_ROLL = [pow(0x01000193, i + 1, 1 << 32) for i in range(WINDOW)]


class _Powers:
    """Powers of a number modulo 2^64, as far as a text has needed them."""

    def __init__(self, base: int):
        self.base, self.known = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.known) < n:
            top = np.uint64(pow(self.base, len(self.known), 1 << 64))
            self.known = np.concatenate([self.known, self.known * top])
        return self.known[:n]


_powers, _inverses = _Powers(_BASE), _Powers(_INVERSE)


def _levels(data: np.ndarray) -> np.ndarray:
    """For each byte, how many low bits of the rolling hash there are zero."""
    rolling = np.zeros(len(data), dtype=np.uint32)
    wide = data.astype(np.uint32) + np.uint32(1)
    for i, factor in enumerate(_ROLL):
        rolling[i:] += wide[: max(0, len(wide) - i)] * np.uint32(factor)
    rolling = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    rolling ^= rolling >> np.uint32(12)
    lowest = rolling & (~rolling + np.uint32(1))
    # float32 holds a power of two exactly; its exponent is the number of zeros. 0 counts as 31.
    return np.where(lowest == 0, 31, (lowest.astype(np.float32).view(np.uint32) >> np.uint32(23)).astype(np.int64) - 127)


def fingerprint(text: str) -> str:
    """The fingerprint of a whole text; `0::` for an empty one."""
    data = np.frombuffer(text.encode(), dtype="u1")
    if not len(data):
        return "0::"
    levels = _levels(data)[:-1]  # the last byte ends a chunk anyway
    # Chunk hashes are sums of byte * base^place, moved back to place 0.
    sums = np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers.upto(len(data)))
    shift = _inverses.upto(len(data))

    def signature(level: int) -> str:
        last = np.append(np.flatnonzero(levels >= level), len(data) - 1)
        first = np.concatenate([[0], last[:-1] + 1])
        before = np.where(first > 0, sums[np.maximum(first - 1, 0)], np.uint64(0))
        chunks = mix64((sums[last] - before) * shift[first] + (last - first).astype(np.uint64))
        again = chunks[1:] == chunks[:-1]
        fourth = again[2:] & again[1:-1] & again[:-2]
        chunks = chunks[np.concatenate([np.ones(min(3, len(chunks)), dtype=bool), ~fourth])]
        return ALPHABET[(chunks >> np.uint64(58)).astype(np.int64)].tobytes().decode()

    k = max(0, (len(data) - 1).bit_length() - CHUNKS.bit_length() + 1)
    own = signature(k)
    while len(own) > MOST:
        k, own = k + 1, signature(k + 1)
    while len(own) < FEWEST and k and len(lower := signature(k - 1)) <= MOST:
        k, own = k - 1, lower
    return f"{k}:{own}:{signature(k + 1)}"


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over `a`."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | 1 << i
    state = full = (1 << len(a)) - 1
    for ch in b:
        match = state & places.get(ch, 0)
        state = ((state + match) | (state - match)) & full
    return len(a) - state.bit_count()


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = min(WINDOW, len(a), len(b))
    if run < WINDOW or not {a[i : i + run] for i in range(len(a) - run + 1)} & {b[i : i + run] for i in range(len(b) - run + 1)}:
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; 1 for equal fingerprints, 0 where no block sizes meet."""
    if a == b:
        return 1.0
    (ka, a1, a2), (kb, b1, b2) = (x.split(":") for x in (a, b))
    ka, kb = int(ka), int(kb)
    if not (a1 and b1) or abs(ka - kb) > 1:
        return 0.0
    if ka == kb:
        return max(_alike(a1, b1), _alike(a2, b2))
    return _alike(a1, b2) if ka > kb else _alike(a2, b1)


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by the start of the following one, as far as that goes."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _finished(doc_id: int | None, text: str, mark: str, following: str, next_mark: str) -> tuple:
    changed = edited(text, following)
    changed_mark = mark if changed == text else fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), digest, mark, changed_mark, likeness(mark, changed_mark), likeness(mark, next_mark)


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_SCHEMA = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _frame(rows: list[tuple], ends: list[tuple]) -> pa.RecordBatch:
    """Finished rows, and documents at an end of their partition: (partition, which, doc_id, text, mark)."""
    n, m = len(rows), len(ends)
    columns = [pa.array([r[i] for r in rows] + [None] * m, kind) for i, kind in enumerate(_KINDS)]
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string())
    columns += [pa.array([None] * n + [e[i] for e in ends], kind) for i, kind in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=[*COLUMNS, "part", "which", "end_id", "end_text", "end_mark"])


def with_next(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, where the next document is that of the next larger doc_id and the
    last one is followed by the first.

    Texts are whole, NULL counts as empty; NULL doc_ids come first, rows of one doc_id in the order of
    a hash of their texts, so that they are dealt over many tasks; a single document follows itself; no rows give no rows; other columns are not
    looked at. Texts are moved once, into ranges of doc_id that are read in order. Only the
    first and last document of each range wait for their neighbours in other ranges.
    """
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text"))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, before = TaskContext.get().partitionId(), None
        for batch in batches:
            for part in parts(batch, 1, 4_000_000):
                rows, ends = [], []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    mark = before[2] if before and before[1] == text else fingerprint(text)
                    if before is None:
                        ends.append((number, "first", doc_id, text, mark))
                    else:
                        rows.append(_finished(*before, text, mark))
                    before = doc_id, text, mark
                yield _frame(rows, ends)
        if before is not None:
            yield _frame([], [(number, "last", *before)])

    walked = written(
        texts.withColumn("key", F.xxhash64("text"))
        .repartitionByRange("doc_id", "key")
        .sortWithinPartitions("doc_id", "key", "text")
        .select("doc_id", "text")
        .mapInArrow(walk, f"{_SCHEMA}, part bigint, which string, end_id bigint, end_text string, end_mark string"),
        "walked",
    )
    ends = walked.filter(F.col("which").isNotNull())
    # One row per range that has documents.
    order = Window.orderBy("part")
    ranges = ends.filter("which = 'first'").select("part", F.lead("part").over(order).alias("next"), F.min("part").over(Window.partitionBy()).alias("lowest"))
    follows = ranges.select("part", F.coalesce("next", "lowest").alias("next"))
    firsts = ends.filter("which = 'first'").select(F.col("part").alias("next"), F.col("end_text").alias("f_text"), F.col("end_mark").alias("f_mark"))
    lasts = ends.filter("which = 'last'").select("part", "end_id", "end_text", "end_mark").join(follows, "part").join(firsts, "next")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_finished(*row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_KINDS)], names=list(COLUMNS))

    closed = lasts.select("end_id", "end_text", "end_mark", "f_text", "f_mark").mapInArrow(finish, _SCHEMA)
    return walked.filter(F.col("which").isNull()).select(*COLUMNS).unionByName(closed)
