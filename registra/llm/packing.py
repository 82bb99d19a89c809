"""Packing token sequences: best-fit decreasing with a segment tree over remaining capacity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import encoder, give_back, parts, whole_text, written


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree that counts them."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(window + 1)]

    def push(self, capacity: int, sequence: int) -> None:
        self.held[capacity].append(sequence)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def pop_tightest(self, need: int) -> tuple[int, int] | None:
        """Take the open window with the least capacity of `need` or more: (capacity, sequence)."""
        count, node = self.count, need + self.leaves
        while not count[node]:
            while node & 1:  # no leaf to the right below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node <<= 1
            if not count[node]:
                node += 1
        capacity = node - self.leaves
        while node:
            count[node] -= 1
            node >>= 1
        return capacity, self.held[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of every piece; pieces are at most `window` long, equal ones in order."""
    sequences, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    windows, opened = OpenWindows(window), 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = windows.pop_tightest(length)
        if found is None:
            found, opened = (window, opened), opened + 1
        capacity, sequence = found
        sequences[piece], offsets[piece] = sequence, window - capacity
        if capacity > length:
            windows.push(capacity - length, sequence)
    return sequences, offsets


def token_pieces(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """Every document's ids and `end_id`, cut into full windows and a rest.

    piece_id (distinct), doc_id, start, length, doc_tokens, ids (binary, little-endian
    unsigned 32-bit). NULL text counts as empty: one piece that holds `end_id`. Write the
    rows before using them twice: piece_id depends on the partitions.
    """
    tail = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        next_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in parts(batch, 1, 3_000_000):
                rows = []
                for doc_id, own in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), strict=True):
                    ids = own + tail
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((next_id, doc_id, start, len(piece) // 4, total, piece))
                        next_id += 1
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(columns[5], pa.binary())],
                    names=["piece_id", "doc_id", "start", "length", "doc_tokens", "ids"],
                )
                del rows, columns
        give_back()

    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text"))
    return texts.mapInArrow(cut, "piece_id bigint, doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary")


def pack(pieces: DataFrame, window: int, per_group: int = 50_000) -> DataFrame:
    """The pieces with sequence_id and offset, no sequence longer than `window`.

    `pieces` is a written table with distinct piece_id and a length of 1 to `window`. They are
    dealt by a hash of piece_id into groups of about `per_group`, whatever the number of rows;
    each group is packed on its own, and tens of thousands of pieces fill their windows nearly
    as well as all of them would. Equal lengths are placed in order of piece_id. sequence_id
    is distinct over all groups. No pieces give no rows.
    """
    groups = max(1, -(-pieces.count() // per_group))
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset", "pack_group")]
    dealt = pieces.select(*names, F.pmod(F.xxhash64("piece_id"), F.lit(groups)).alias("pack_group"))

    def place(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("piece_id", ignore_index=True)
        sequence, offset = best_fit_decreasing(group["length"].to_numpy(), window)
        group["sequence_id"] = sequence * groups + group["pack_group"]
        group["offset"] = offset
        return group.drop(columns="pack_group")

    kept = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)
    return dealt.groupBy("pack_group").applyInPandas(place, f"{kept}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer: str, window: int, end_id: int) -> DataFrame:
    """Where every id of every document goes: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset. NULL text counts as empty and gives `end_id` alone; NULL doc_ids stay NULL; rows that
    repeat a document, or have no doc_id, are documents of their own; other columns are not looked at; no rows give no rows."""
    pieces = token_pieces(docs, tokenizer, window, end_id)
    digests = written(pieces.select("piece_id", "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), "pieces")
    return pack(digests, window).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame, packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary).

    `pieces` has the ids, `packed` the places, joined by piece_id. A sequence holds at most a
    window of ids, so its pieces meet in one row.
    """
    placed = packed.select("piece_id", "sequence_id", "offset").join(pieces.select("piece_id", "ids"), "piece_id")
    listed = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    joined = F.aggregate("pieces", F.lit(b""), lambda all_ids, piece: F.concat(all_ids, piece["ids"]))
    return listed.select("sequence_id", joined.alias("ids"))
