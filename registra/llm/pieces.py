"""SentencePiece encoding that keeps offsets, and decoding.

A model file brings a compiled character map: a double-array trie over UTF-8 keys and their replacements.
At every place of a text the longest key is replaced; a character that starts no key stays. For every byte of
the normalised text the place in the original is recorded, so a piece, which is a range of normalised bytes, is
projected to the range of original bytes it stands for. As in the library, the bytes of a character that is in no piece are
pieces of their own; the last of them stands for the character, the others for nothing.

The library's model merges the normalised text into pieces. In a BPE model none of whose pieces holds a blank
mark after another character, a merge never crosses the start of a run of marks, and a line feed that is in no
piece stands alone. Such texts are cut there and each distinct unit is merged once.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from registra.llm.common import map_texts, whole_text

MARK = "▁"
BPE = 2  # TrainerSpec.model_type
USER_DEFINED, BYTE = 4, 6  # SentencePiece.type


def fields(message: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """Number, value and raw bytes of every field of a protocol buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = message[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(message):
        first = at
        tag, at = varint(at)
        if tag & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if tag & 7 == 2 else ({1: 8, 5: 4}[tag & 7], at)
            value, at = message[at : at + size], at + size
        yield tag >> 3, value, message[first:at]


class CharacterMap:
    """The compiled character map of a model: longest keys in a double-array trie."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, dtype="<u4", count=size // 4, offset=4).tolist() if size else []
        self.replacements = compiled[4 + size :]
        self.joins_blanks = self._joins_blanks()

    @staticmethod
    def _offset(unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    def _joins_blanks(self) -> bool:
        """Whether a key of several bytes holds a blank: a walk over the trie, a byte of all keys at a time."""
        units = np.array(self.units, dtype=np.int64)
        nodes, blank = self._offset(units[:1]), np.zeros(len(units[:1]), dtype=bool)
        length = 0
        while len(nodes):
            length += 1
            at = nodes[:, None] ^ np.arange(1, 256)
            there = at < len(units)
            there &= (units[np.minimum(at, len(units) - 1)] & 0x800000FF) == np.arange(1, 256)
            row, byte = np.nonzero(there)
            at = at[row, byte]
            blank = blank[row] | (byte == ord(" ") - 1)
            if length > 1 and (blank & (units[at] >> 8 & 1 == 1)).any():
                return True
            nodes = at ^ self._offset(units[at])
        return False

    def longest(self, data: bytes, at: int) -> tuple[bytes, int] | None:
        """The replacement of the longest key that starts at a place, and the key's length."""
        if not self.units:
            return None
        node, found = self._offset(self.units[0]), None
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = (self.units[node] & 0x7FFFFFFF, i + 1 - at)
        if found is None:
            return None
        start, length = found
        return self.replacements[start : self.replacements.index(0, start)], length


class PieceEncoder:
    """Ids, original spans and decoded texts of a SentencePiece model.

    Each distinct unit of a call is merged once. Past about `memory` bytes the memory of mapped words starts anew.
    """

    def __init__(self, model: bytes, memory: int = 64_000_000):
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        parts = list(fields(model))
        trainer, normaliser = (dict((n, v) for n, v, _ in fields(next((v for n, v, _ in parts if n == k), b""))) for k in (2, 3))
        self.map = CharacterMap(normaliser.get(2, b""))
        self.prefix, self.squeeze, self.escape = (bool(normaliser.get(k, 1)) for k in (3, 4, 5))
        self.suffix = bool(trainer.get(24, 0))  # treat_whitespace_as_suffix
        # The same model without any normalisation: it merges what has been normalised here.
        plain = b"\x1a" + bytes([6]) + b"\x18\x00\x20\x00\x28\x00"
        self.merger = sentencepiece.SentencePieceProcessor(model_proto=b"".join(raw for n, _, raw in parts if n != 3) + plain)
        names, kinds = [], []
        for number, value, _ in parts:
            if number == 1:
                piece = dict((n, v) for n, v, _ in fields(value))
                names.append(piece.get(1, b""))
                kinds.append(piece.get(3, 1))
        kinds = np.array(kinds)
        self.is_byte = kinds == BYTE
        self.sizes = np.where(self.is_byte, 1, [len(x) for x in names])
        self.byte = np.array([int(x[3:5], 16) if b else 0 for x, b in zip(names, self.is_byte, strict=True)])
        self.unknown = self.library.unk_id()
        own = sorted((x.decode() for x, k in zip(names, kinds, strict=True) if k == USER_DEFINED), key=lambda x: -len(x.encode()))
        self.symbols = re.compile("|".join(map(re.escape, own)).encode()) if own else None
        texts = [x.decode() for x, k in zip(names, kinds, strict=True) if k not in (2, 3, BYTE)]
        whole = trainer.get(3, 1) != BPE or any(MARK in x.lstrip(MARK) for x in texts)
        rest = "[^▁]" if any("\n" in x for x in texts) else "[^▁\n]"
        self.units = None if whole else re.compile(f"▁+{rest}*|\n|{rest}+")
        self.plain = not (self.map.units or self.symbols or self.squeeze or self.suffix) and self.prefix and self.escape
        self.memory = memory
        self.words: dict[bytes, list[tuple[bytes, int]]] = {}
        self.word_bytes = 0

    def _steps(self, data: bytes) -> list[tuple[bytes, int]]:
        """What each replaced key or single character becomes, and its length in the original."""
        steps, at = [], 0
        while at < len(data):
            symbol = self.symbols.match(data, at) if self.symbols else None
            found = (symbol.group(), symbol.end() - at) if symbol else self.map.longest(data, at)
            if found is None:
                lead = data[at]
                size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = (data[at : at + size], size)
            steps.append(found)
            at += found[1]
        return steps

    def _all_steps(self, data: bytes) -> Iterator[tuple[bytes, int]]:
        if self.symbols or self.map.joins_blanks:
            yield from self._steps(data)
            return
        for word in re.findall(rb" |[^ ]+", data):
            steps = self.words.get(word)
            if steps is None:
                if self.word_bytes > self.memory:
                    self.words, self.word_bytes = {}, 0
                steps = self.words[word] = self._steps(word)
                self.word_bytes += 200 + 80 * len(word)
            yield from steps

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the place in the original's bytes."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, dtype=np.int64)
        if self.plain:
            blanks = np.frombuffer(data, dtype="u1") == 32
            places = np.repeat(np.arange(len(data)), 1 + 2 * blanks)
            return MARK + text.replace(" ", MARK), np.concatenate([[0, 0, 0], places, [len(data)]])
        blank = MARK.encode() if self.escape else b" "
        steps, consumed = list(self._all_steps(data)), 0
        first = 0
        while self.squeeze and first < len(steps) and steps[first][0] == b" ":
            consumed, first = consumed + steps[first][1], first + 1
        if first == len(steps):
            return "", np.array([consumed])
        out, places = [], []

        def put(piece: bytes) -> None:
            piece = piece.replace(b" ", blank)
            out.append(piece)
            places.extend([consumed] * len(piece))

        if self.prefix and not self.suffix:
            put(b" ")
        after_blank = self.squeeze
        for made, length in steps[first:]:
            if after_blank:
                made = made.lstrip(b" ")
            if made:
                put(made)
                after_blank = self.squeeze and made.endswith(b" ")
            consumed += length
        done = b"".join(out)
        while self.squeeze and done.endswith(blank):
            done = done[: -len(blank)]
            consumed = places[len(done)]
        del places[len(done) :]
        if self.prefix and self.suffix:
            out.clear()
            put(b" ")
            done += blank
        return done.decode(), np.array([*places, consumed])

    def _merged(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all units one after the other, begin and end of each in its unit's bytes, and the number in each unit."""
        ids = self.merger.encode(units, num_threads=1)
        counts = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=counts.sum())
        sizes = self.sizes[flat]
        if (flat == self.unknown).any():
            pieces = [p for x in self.merger.encode(units, out_type=str, num_threads=1) for p in x]
            sizes = np.where(flat == self.unknown, [len(p.encode()) for p in pieces], sizes)
        ends = np.cumsum(sizes)
        start = np.repeat(np.concatenate([[0], ends])[np.cumsum(counts) - counts], counts)
        begin, end = ends - sizes - start, ends - start
        at = np.flatnonzero(self.is_byte[flat])
        if len(at):
            value = self.byte[flat[at]]
            lead = (value & 0xC0) != 0x80
            char = np.flatnonzero(lead)[np.cumsum(lead) - 1]  # the character's first byte, among these
            size = (1 + (value >= 0xC0).astype(int) + (value >= 0xE0) + (value >= 0xF0))[char]
            begin[at] = begin[at[char]]
            end[at] = np.where(np.arange(len(at)) == char + size - 1, begin[at] + size, begin[at])
        return flat, begin, end, counts

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of each text, and where each piece begins and ends in the text's UTF-8 bytes."""
        normalised = [self.normalise(t) for t in texts]
        cut = [self.units.findall(t) if self.units else [t] * bool(t) for t, _ in normalised]
        coded = pa.array(list(chain.from_iterable(cut)), pa.large_string()).dictionary_encode()
        unit = coded.indices.to_numpy()
        ids, begin, end, counts = self._merged(coded.dictionary.to_pylist())
        size = pc.binary_length(coded.dictionary).to_numpy()[unit]
        # All places one after the other: where each text's, and each unit's, begin.
        places = np.concatenate([p for _, p in normalised]) if texts else np.zeros(0, dtype=np.int64)
        text_start = np.cumsum([0] + [len(p) for _, p in normalised])[:-1]
        n_units = np.array([len(x) for x in cut], dtype=np.int64)
        before = np.cumsum(size) - size
        first = np.cumsum(n_units) - n_units
        own = np.repeat(text_start - np.concatenate([before, [0]])[first] * (n_units > 0), n_units)
        each = counts[unit]
        pick = np.repeat((np.cumsum(counts) - counts)[unit] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        base = np.repeat(before + own, each)
        ids, begin, end = ids[pick], places[base + begin[pick]], places[base + end[pick]]
        bounds = np.concatenate([[0], np.cumsum(each)])[np.concatenate([first, [len(unit)]])]
        return [(ids[a:b], begin[a:b], end[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


_encoders: dict[bytes, PieceEncoder] = {}


def piece_encoder(model: bytes) -> PieceEncoder:
    """This worker's encoder of a model; it lives as long as the worker."""
    key = hashlib.sha256(model).digest()
    if key not in _encoders:
        _encoders[key] = PieceEncoder(model)
    return _encoders[key]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text"))


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """A row per document: doc_id, ids, begins, ends (of each piece in the text's UTF-8 bytes) and the decoded text.

    The model file is read by the driver and goes with the tasks. Whole texts are encoded; NULL counts as empty, and an
    empty text has no pieces. Rows that repeat a doc_id, or have none, are rows of their own;
    other columns are not looked at. No rows give no rows.
    """
    model = _read(model_file)

    def work(texts: list[str]) -> Iterator[tuple]:
        encoder = piece_encoder(model)
        for ids, begin, end in encoder.encode(texts):
            yield ids.astype("<i4"), begin, end, encoder.library.decode(ids.tolist())

    kinds = [("ids", pa.list_(pa.int32())), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("decoded", pa.string())]
    return map_texts(_texts(docs), work, kinds, "ids array<int>, begins array<bigint>, ends array<bigint>, decoded string", 1_000_000)


def digests(docs: DataFrame, model_file: str) -> DataFrame:
    """What `encode` finds as numbers of a fixed size: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 and spans_sha256 (of the begins, then the ends, as little-endian 64-bit numbers)."""
    model = _read(model_file)

    def work(texts: list[str]) -> Iterator[tuple]:
        encoder = piece_encoder(model)
        names = [str(i) for i in range(len(encoder.sizes))]
        for ids, begin, end in encoder.encode(texts):
            listed = ids.tolist()
            spans = hashlib.sha256(begin.astype("<i8").tobytes() + end.astype("<i8").tobytes()).hexdigest()
            joined = ",".join([names[i] for i in listed])
            decoded = encoder.library.decode(listed)
            yield len(listed), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), spans

    kinds = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("spans_sha256", pa.string())]
    return map_texts(_texts(docs), work, kinds, "n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string")


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()
