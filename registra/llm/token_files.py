"""Token ids in binary files: every document a zstandard frame under one shared dictionary.

A folder of token files holds

- `dictionary/`: one file, the trained dictionary and a line feed (none trained: empty),
- `data/`: files in ascending order of doc_id. Each is a row of records, every record followed
  by a line feed: a head, one frame per document, and a foot. Head: the magic `RTOK1`, then a
  JSON object (number of the file, width of an id in bytes, end id, SHA-256 of the dictionary).
  A frame is the zstandard form of the document's ids, little-endian unsigned numbers of that
  width. Foot: n doc_ids (int64), n byte offsets (int64), n frame lengths (int64), n token
  counts (int64), n bytes that are 1 where doc_id is NULL; then n as int64, and the magic.

So one document is read with one seek: the foot gives its offset and length, and the
dictionary opens the frame. Spark's text writer writes the records (a cast from binary to string keeps
bytes as they are), so files appear only when their task commits, on any file system that Spark
knows; its binaryFile reader reads them back.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from registra.llm.common import encoder, hash_sample, map_texts, whole_text, written

MAGIC = b"RTOK1"
FOOT_BYTES = 4 * 8 + 1  # per document


def _serialised(ids: bytes, end_id: int, width: int) -> bytes:
    numbers = np.append(np.frombuffer(ids, dtype="<u4"), np.uint32(end_id))
    return numbers.astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, tokenizer: str, end_id: int, width: int, sample_docs: int, size: int, sample_bytes: int = 32 << 20) -> bytes:
    """A zstandard dictionary of at most `size` bytes from the id arrays of `sample_docs` documents.

    The sample are the documents whose content hash is smallest, so it does not depend on order
    or partitions. Tasks encode them and cut their arrays into slices of 16 kB; the slices with the smallest hash, at most
    `sample_bytes` in all, meet in the one task that trains. Tables too
    small to train on give an empty dictionary; frames then stand alone.
    """
    texts = docs.select("doc_id", whole_text(docs).alias("text"))
    sample = hash_sample(texts, docs.count(), sample_docs).select(F.lit(0).alias("n"), "text")
    piece = 16384

    def cut(texts: list[str]) -> Iterator[tuple]:
        for ids in encoder(tokenizer).encode(texts):
            data = _serialised(ids, end_id, width)
            yield ([data[i : i + piece] for i in range(0, len(data), piece)],)

    cuts = map_texts(sample, cut, [("slices", pa.list_(pa.binary()))], "slices array<binary>")
    slices = cuts.select(F.explode("slices").alias("slice")).select("slice", F.xxhash64("slice").alias("key"))
    # Every slice but a document's last is full, so the number bounds the bytes.
    slices = slices.orderBy("key", "slice").limit(sample_bytes // piece)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = [slice_ for batch in batches for slice_ in batch.column(0).to_pylist()]
        try:
            trained = zstandard.train_dictionary(size, sorted(given)).as_bytes()
        except (zstandard.ZstdError, ValueError):  # too few samples
            trained = b""
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([trained], pa.binary())})

    row = slices.select("slice").coalesce(1).mapInArrow(train, "dictionary binary").first()  # none without partitions
    return bytes(row["dictionary"]) if row else b""


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    vocabulary: int = 1 << 16,
    file_mb: float = 16,
    level: int = 3,
    sample_docs: int = 1024,
    dictionary_bytes: int = 112_640,
) -> None:
    """Encode every whole text (NULL: empty), append `end_id`, write the files of this module.

    doc_id NULL comes first; rows with one doc_id stand in the order of a hash of their frames, maybe in several files. Other
    columns of `docs` are not looked at. The dictionary is learnt from a bounded sample
    (`sample_docs`), which touches the size of the files only. Ids are kept in 2 bytes where the
    `vocabulary` allows it. No rows give a folder without frames.
    """
    spark = docs.sparkSession
    width = 2 if max(vocabulary - 1, end_id) < 1 << 16 else 4
    dictionary = train_dictionary(docs, tokenizer, end_id, width, sample_docs, dictionary_bytes)
    spark.createDataFrame([(bytearray(dictionary),)], "d binary").coalesce(1).select(F.col("d").cast("string")).write.text(
        f"{path}/dictionary"
    )

    def compress(texts: list[str]) -> Iterator[tuple]:
        encode = encoder(tokenizer).encode
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=level, dict_data=shared).compress
        for ids in encode(texts):
            data = _serialised(ids, end_id, width)
            frame = pack(data)
            yield len(data) // width, len(frame), frame

    encoded = written(
        map_texts(
            docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text")),
            compress,
            [("n_tokens", pa.int64()), ("frame_bytes", pa.int64()), ("frame", pa.binary())],
            "n_tokens bigint, frame_bytes bigint, frame binary",
            chars=8_000_000,
        ),
        "frames",
    )
    total = encoded.agg(F.sum("frame_bytes").alias("total")).first()["total"] or 0
    files = max(1, math.ceil(total / (file_mb * (1 << 20))))
    head = {"width": width, "end_id": end_id, "dictionary": hashlib.sha256(dictionary).hexdigest()}

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, nulls, lengths, counts = [], [], [], []
        first = MAGIC + json.dumps({"file": TaskContext.get().partitionId()} | head).encode()
        yield pa.RecordBatch.from_pydict({"value": pa.array([first], pa.binary())})
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(2)], names=["value"])
            ids += batch.column(0).to_pylist()
            counts += batch.column(1).to_pylist()
            lengths += batch.column(3).to_pylist()
        nulls = np.array([i is None for i in ids], dtype="u1")
        numbers = np.array([i or 0 for i in ids], dtype="<i8")
        sizes = np.array(lengths, dtype="<i8")
        offsets = len(first) + 1 + np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]).astype("<i8")[: len(ids)]
        foot = b"".join(x.tobytes() for x in (numbers, offsets.astype("<i8"), sizes, np.array(counts, dtype="<i8"), nulls))
        foot += len(ids).to_bytes(8, "little") + MAGIC
        yield pa.RecordBatch.from_pydict({"value": pa.array([foot], pa.binary())})

    (
        encoded.withColumn("key", F.xxhash64("frame"))
        .repartitionByRange(files, "doc_id", "key")
        .sortWithinPartitions("doc_id", "key", "frame")
        .select("doc_id", "n_tokens", "frame", "frame_bytes")
        .mapInArrow(records, "value binary")
        .select(F.col("value").cast("string"))
        .write.text(f"{path}/data")
    )


def read_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/dictionary").select("content").first()
    return bytes(row["content"])[:-1] if row else b""


def parse_file(content: memoryview) -> tuple[dict, dict[str, np.ndarray]]:
    """Head and index of one data file, without a copy of it."""
    if bytes(content[: len(MAGIC)]) != MAGIC or bytes(content[-len(MAGIC) - 1 : -1]) != MAGIC:
        raise ValueError("not a token file, or cut off")
    first = bytes(content[len(MAGIC) : 4096])
    head = json.loads(first[: first.index(b"\n")])
    stop = len(content) - 1 - len(MAGIC) - 8
    n = int.from_bytes(content[stop : stop + 8], "little")
    at, index = stop - n * FOOT_BYTES, {}
    for name in ("doc_id", "offset", "length", "n_tokens"):
        index[name] = np.frombuffer(content, dtype="<i8", count=n, offset=at)
        at += 8 * n
    index["null"] = np.frombuffer(content, dtype="u1", count=n, offset=at)
    return head, index


def read_token_files(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Documents from the files: file, doc_id, place (within the file), file_start (ids of the
    file before it), n_tokens, ids (binary, little-endian unsigned 32-bit).

    With `doc_ids` only these documents' frames are opened, by the offset index; rows that share a doc_id all
    come, rows without one never. Otherwise NULL doc_ids come too. An empty text is a frame of the end id alone; a folder of no
    documents gives no rows. A dictionary other than the one the files were written with is refused.
    """
    dictionary = read_dictionary(spark, path)
    digest = hashlib.sha256(dictionary).hexdigest()
    wanted = None if doc_ids is None else np.array(sorted(doc_ids), dtype="i8")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        unpack = zstandard.ZstdDecompressor(dict_data=shared).decompress
        for batch in batches:
            for i in range(batch.num_rows):
                content = batch.column(0)[i].as_buffer()
                head, index = parse_file(memoryview(content))
                if head["dictionary"] != digest:
                    raise ValueError("the files were written with another dictionary")
                starts = np.cumsum(index["n_tokens"]) - index["n_tokens"]
                places = np.arange(len(starts))
                if wanted is not None:
                    places = places[np.isin(index["doc_id"], wanted) & (index["null"] == 0)]
                for block in np.array_split(places, max(1, -(-int(index["n_tokens"][places].sum()) // 2_000_000))):
                    ids = []
                    for k in block:
                        frame = content.slice(int(index["offset"][k]), int(index["length"][k]))
                        ids.append(np.frombuffer(unpack(frame), dtype=f"<u{head['width']}").astype("<u4").tobytes())
                    yield pa.RecordBatch.from_pydict(
                        {
                            "file": pa.array([head["file"]] * len(block), pa.int64()),
                            "doc_id": pa.array(index["doc_id"][block], pa.int64(), mask=index["null"][block].astype(bool)),
                            "place": pa.array(block, pa.int64()),
                            "file_start": pa.array(starts[block], pa.int64()),
                            "n_tokens": pa.array(index["n_tokens"][block], pa.int64()),
                            "ids": pa.array(ids, pa.binary()),
                        }
                    )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data").select("content")
    return files.mapInArrow(decode, "file bigint, doc_id bigint, place bigint, file_start bigint, n_tokens bigint, ids binary")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 of every document.

    Files follow each other in order of doc_id, so a start is the sum of the files before (one
    row per file is summed up in one place) and the start within the file.
    """
    rows = written(
        read_token_files(spark, path).select("file", "doc_id", "file_start", "n_tokens", F.crc32("ids").alias("ids_crc32")),
        "token-digests",
    )
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("file").agg(F.sum("n_tokens").alias("tokens"))
    bases = files.select("file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base"))
    return rows.join(bases, "file").select(
        "doc_id", (F.col("base") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"
    )
