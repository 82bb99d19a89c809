"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from os.path import commonprefix
from string import punctuation
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registra.sources.shared import new_path, written

__all__ = [
    "WordEncoder",
    "by_hot_key",
    "encoder",
    "give_back",
    "hash_sample",
    "map_texts",
    "mix64",
    "new_path",
    "of_text",
    "table",
    "unused",
    "whole_text",
    "written",
]

# A key with more than this share of the rows is hot; there are fewer than 1000 of them.
HOT_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(df: DataFrame, column: str = "text") -> Column:
    """The text of a row; NULL counts as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until no column of the frame is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def by_hot_key(rows: DataFrame, classes: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Rows with the class of their key, no matter how many rows share one key.

    `classes` is a written table with one row per key; `size` is the key's number of rows,
    of `total`. Keys that hold over a thousandth of all rows are fewer than a thousand, so
    their classes are broadcast and their rows stay where they are; the others are joined.
    """
    hot = classes.filter(F.col(size) * HOT_SHARE > total)
    rest = classes.filter(F.col(size) * HOT_SHARE <= total)
    cold_rows = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(cold_rows.join(rest, key))


def hash_sample(rows: DataFrame, among: int, sample: int, spread: int = 64) -> DataFrame:
    """At most `sample` rows, those with the smallest content hash: the same at any order and partitioning.

    `among` is the number of rows. Only hashes below a bound that leaves about `spread` times the
    sample are compared, so a task sends few of them; the rows themselves are fetched by the hashes found.
    """
    key = F.xxhash64(*rows.columns)
    share = min(1.0, spread * sample / max(1, among))
    bound = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    found = rows.select(key.alias("key")).filter(F.col("key") <= bound).distinct().orderBy("key").limit(sample)
    return rows.filter(key.isin([row["key"] for row in found.collect()])).limit(sample)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back() -> None:
    """Return freed memory of this worker to the system, where the C library can: an idle worker keeps little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def map_texts(
    df: DataFrame, work: Callable[[list[str]], Iterable[tuple]], fields: list[tuple[str, pa.DataType]], schema: str, chars: int = 4_000_000
) -> DataFrame:
    """Each row's first columns as they are, then what `work` makes of its last, the text.

    `work` gets the texts of about `chars` characters at once and gives a tuple per text.
    """
    kept = df.columns[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch, batch.num_columns - 1, chars):
                made = list(work(part.column(part.num_columns - 1).to_pylist()))
                columns = [pa.array([row[i] for row in made], kind) for i, (_, kind) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(kept))] + columns, names=kept + [name for name, _ in fields]
                )
                del made, columns
        give_back()

    head = "".join(f"`{name}` {df.schema[name].dataType.simpleString()}, " for name in kept)
    return df.mapInArrow(run, head + schema)


def parts(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `size` bytes of one text or binary column, a row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(first, last - first)
        first = last


def of_text(work: Callable[[list[str]], Iterable], kind: pa.DataType, sql: str, size: int = 4_000_000) -> Callable[[Column], Column]:
    """A column made of a text column alone, so no other column of the row leaves the JVM.

    `work` gets the texts of about `size` bytes at once and gives a value per text.
    """

    @F.arrow_udf(sql)
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for array in arrays:
            batch = pa.RecordBatch.from_arrays([array], names=["text"])
            made = [value for part in parts(batch, 0, size) for value in work(part.column(0).to_pylist())]
            yield pa.array(made, kind)
        give_back()

    return run


def _letter_ends() -> np.ndarray:
    """Whether a byte ends a Latin letter or a digit, by 256 times the byte before it plus itself.

    Lower case of two characters may end in one that is no letter; such letters do not count."""
    ends = np.zeros((256, 256), dtype=bool)
    for own in (c.encode() for c in map(chr, range(0x180)) if c.isalnum() and len(c.lower()) == 1):
        ends[own[0] if own[1:] else slice(None), own[-1]] = True
    return ends.ravel()


class WordEncoder:
    """Ids of whole texts by the tokenizers library, one call per distinct piece of text.

    Only for tokenizers that drop white space and never look across it: a text's ids are
    then those of its pieces between blanks, one after the other. Pieces met before are found by Arrow, a whole slice of text at
    once; Python sees the others only. `words` and `ids` (little-endian unsigned 32-bit numbers) hold what is remembered. Where
    that is more than `limit` pieces or `memory` bytes, those asked for last stay, up to half of either.

    As the library does by default, the strings of special tokens are cut out of the raw text first, and are
    these tokens; what stands between them is encoded on its own.

    For lower-casing tokenizers (`lower`) texts are lower-cased first where that changes no id:
    where text and lower case are both in normal form C and no capital sigma stands in it, whose
    lower case depends on its place. Such a tokenizer splits before any mark that follows a Latin letter or a digit, so pieces
    end there too. A word of Latin letters passes such a tokenizer's normaliser and splitter as
    it is, so its byte-level form goes straight to the library's model, which takes a third of the time.
    """

    #: In a byte-level vocabulary visible bytes stand for themselves, the others, in order,
    #: for the characters from 256 on.
    HIDDEN = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 256 and b != 173)]
    BYTE_NAMES = {b: 256 + i for i, b in enumerate(HIDDEN)}
    MARKS = np.isin(np.arange(256), list(punctuation.encode()))
    ENDS = _letter_ends()
    #: Bytes a remembered piece takes besides its text and ids: two offsets and the call it was asked for last.
    ENTRY = 24

    def __init__(self, path: str, limit: int = 600_000, lower: bool = True, memory: int = 100_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        # A piece holds no special token; one that lower case turns into its string is ordinary text.
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        special = {t.content: struct.pack("<I", i) for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special = special
        self.cuts = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.mark = commonprefix(list(special))  # a text without it needs no search
        self.limit, self.memory, self.lower = limit, memory, lower
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.last, self.calls, self.used = np.zeros(0, dtype=np.int64), 0, 0

    def ask(self, piece: str) -> bytes:
        if self.lower and piece.isalpha() and piece.islower() and (piece.isascii() or max(piece) < "\u0180"):
            named = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.BYTE_NAMES)
            ids = [token.id for token in self.model.tokenize(named)]
        else:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def prepared(self, text: str) -> str:
        """The text in lower case where that changes no id."""
        if self.lower:
            low = text.lower()
            if text.isascii() or ("\u03a3" not in text and is_normalized("NFC", text) and is_normalized("NFC", low)):
                return low
        return text

    def pieces(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The pieces of all texts, one after the other, and where each text's begin, with the end of the last.

        A piece begins at a byte that is no blank after a blank, at the start of a text, and at a mark that follows a letter."""
        whole = pa.array([self.prepared(text) for text in texts], pa.large_string())
        offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64, count=len(texts) + 1)
        data = np.frombuffer(whole.buffers()[2] or b"", dtype=np.uint8)[: offsets[-1]]
        kept = (data != ord(" ")) & (data != ord("\n"))
        first = np.append(False, ~kept)
        first[offsets] = True
        if self.lower:
            marks = np.flatnonzero(self.MARKS[data])
            first[marks[self.ENDS[256 * data[marks - 2].astype(np.int64) + data[marks - 1]]]] = True
        at = np.flatnonzero(first[:-1] & kept)
        lengths = np.add.reduceat(kept, at, dtype=np.int64) if len(at) else at
        ends = np.append(0, np.cumsum(lengths))
        words = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(data[kept]))
        return words, np.searchsorted(at, offsets)

    def known(self, words: pa.Array) -> pa.Array:
        """The ids of each piece. What is not remembered is asked for, once each, and remembered."""
        at = pc.index_in(words, value_set=self.words)
        new = at.is_null()
        fresh = words.filter(new).dictionary_encode()
        asked = pa.array([self.ask(piece) for piece in fresh.dictionary.to_pylist()], pa.large_binary())
        places = at.fill_null(0).to_numpy().astype(np.int64)
        places[new.to_numpy(zero_copy_only=False)] = fresh.indices.to_numpy() + len(self.words)
        held, ids = pa.concat_arrays([self.words, fresh.dictionary]), pa.concat_arrays([self.ids, asked])
        last, self.calls = np.append(self.last, np.zeros(len(asked), dtype=np.int64)), self.calls + 1
        last[places] = self.calls
        found = ids.take(pa.array(places))
        sizes = self.ENTRY + pc.binary_length(held).to_numpy() + pc.binary_length(ids).to_numpy()
        if len(held) > self.limit or sizes.sum() > self.memory:
            stay = np.argsort(-last, kind="stable")[: self.limit // 2]
            stay = stay[np.cumsum(sizes[stay]) <= self.memory // 2]
            held, ids, last, sizes = held.take(pa.array(stay)), ids.take(pa.array(stay)), last[stay], sizes[stay]
        self.words, self.ids, self.last, self.used = held, ids, last, int(sizes.sum())
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. numpy cuts the texts, Arrow looks their pieces up and puts the ids in place."""
        if not texts:
            return []
        held = [i for i, text in enumerate(texts) if self.mark in text and self.cuts.search(text)] if self.cuts else []
        if held:
            cut = [self.cuts.split(texts[i]) for i in held]  # in turn ordinary text and a special token's string
            inside = set(held)
            plain = self.encode(["" if i in inside else t for i, t in enumerate(texts)] + [t for own in cut for t in own[::2]])
            out, rest = plain[: len(texts)], iter(plain[len(texts) :])
            for i, own in zip(held, cut, strict=True):
                out[i] = b"".join(self.special[t] if k % 2 else next(rest) for k, t in enumerate(own))
            return out
        words, bounds = self.pieces(texts)
        found = self.known(words)
        ends = np.frombuffer(found.buffers()[1], dtype=np.int64, count=len(words) + 1)[bounds].tolist()
        ids = memoryview(found.buffers()[2] or b"")
        return [ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """This worker's encoder of a tokenizer file; it lives as long as the worker."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
