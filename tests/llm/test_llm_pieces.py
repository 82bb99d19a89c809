"""SentencePiece with offsets against the library, with its own and with other character maps."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from edge_tables import LONG, ROWS, documents

from registra.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "aAbß zé  \n▁漢\U0001f600ﬁＡ①́ \t<0x41>"


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def model_with(rule, prefix, squeeze, escape):
    """The public model behind one of the library's compiled character maps."""
    spec = sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_normalizer_spec()
    compiled = next(v for n, v, _ in pieces.fields(spec) if n == 2)
    spec = b"\x12" + varint(len(compiled)) + compiled + bytes([0x18, prefix, 0x20, squeeze, 0x28, escape])
    with open(MODEL, "rb") as file:
        rest = b"".join(raw for n, _, raw in pieces.fields(file.read()) if n != 3)
    return rest + b"\x1a" + varint(len(spec)) + spec


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(LETTERS, k=rng.randint(0, 24))) for _ in range(n)] + ["", " ", "▁", "\n\n  a", LONG[:3000]]


def same_as_library(model, given):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    for text, (ids, begin, end) in zip(given, pieces.PieceEncoder(model).encode(given), strict=True):
        found = library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in found], text
        assert list(zip(begin.tolist(), end.tolist(), strict=True)) == [(p.begin, p.end) for p in found], text


def test_ids_and_spans_equal_the_library():
    with open(MODEL, "rb") as file:
        same_as_library(file.read(), texts(4000, 1))


@pytest.mark.parametrize("flags", [(1, 1, 1), (0, 0, 1), (1, 0, 1), (0, 1, 1), (1, 1, 0)])
def test_other_character_maps_equal_the_library(flags):
    same_as_library(model_with("nmt_nfkc_cf", *flags), texts(800, sum(flags)))


@pytest.mark.parametrize("clashing", [False, True])
def test_documents(spark, clashing):
    docs = documents(spark, clashing)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    wanted, digests = [], []
    for doc_id, text, *_ in ROWS:
        ids = library.encode(text or "")
        decoded = library.decode(ids)
        wanted.append((doc_id, ids, decoded))
        digests.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), decoded))))
    order = lambda rows: sorted(rows, key=str)
    found = pieces.encode(docs, MODEL).collect()
    assert order((r["doc_id"], r["ids"], r["decoded"]) for r in found) == order(wanted)
    for row in found:  # pieces cover the text without gaps
        assert row["begins"][:1] in ([], [0]) and row["begins"][1:] == row["ends"][:-1]
    found = pieces.digests(docs, MODEL).collect()
    assert order(tuple(r)[:4] for r in found) == order(digests)
    assert pieces.digests(docs.limit(0), MODEL).collect() == []
