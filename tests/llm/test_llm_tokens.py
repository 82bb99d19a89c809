import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from edge_tables import LONG, ROWS, documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from registra.llm import packing, token_files, unigram
from registra.llm.common import WordEncoder, written

PATH = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = "öüß aAbB zZ\n\t.,!?'’\"sStT0129éÉêẞİıΣσςÅ̱̊Hh́ \x1c\x85漢字<|endoftext|>Kﬁ\U0001f600▁"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text, end_id):
    return np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id], dtype="<u4")


def test_pieces_between_blanks_give_the_ids_of_whole_texts(tokenizer):
    rng, small = random.Random(5), WordEncoder(PATH, limit=20)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 16))) for _ in range(5000)] + [LONG, ""]
    for text, ids in zip(texts, small.encode(texts), strict=True):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text
    assert small.encode([]) == [] and small.encode([""]) == [b""]


def test_strings_of_special_tokens_are_these_tokens(tokenizer):
    rng, small = random.Random(6), WordEncoder(PATH, memory=5000)
    words = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "<", " ", "\n", "hi", "Σ", "e", "\u0301", "'s", "x"]
    texts = ["".join(rng.choices(words, k=rng.randint(0, 9))) for _ in range(4000)]
    assert tokenizer.encode("hi <|endoftext|> x", add_special_tokens=False).ids == [1883, 49407, 343]
    for text, ids in zip(texts, small.encode(texts), strict=True):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text
    assert small.used < 5000


def test_pieces_end_before_marks_that_follow_a_letter(tokenizer):
    own = WordEncoder(PATH)
    texts = [f"x{chr(c)}{m}{chr(c)}'s{m}" for c in range(0x20, 0x250) for m in "!'(),-./:<=>?@[_|~\u0301\u0338"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids == np.array(tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text
    own = WordEncoder(PATH)
    own.encode(["Straße, straße. été! été\n(été) 4.0"])
    assert sorted(own.words.to_pylist()) == sorted(["straße", ",", ".", "été", "!", "(été", ")", "4", ".0"])


def asking(own):
    """The pieces that an encoder asks the library for, as they come."""
    asked, ask = [], own.ask
    own.ask = lambda piece: asked.append(piece) or ask(piece)
    return asked


def test_known_pieces_take_little_memory_and_are_not_asked_again():
    words = ["".join(chr(97 + n // 26**k % 26) for k in range(4)) for n in range(10_000)]
    own = WordEncoder(PATH, memory=1_000_000)
    asked = asking(own)
    once = own.encode([" ".join(words)])
    assert sorted(asked) == sorted(words)
    assert own.encode([" ".join(words)]) == once and len(asked) == len(words)


def test_pieces_asked_for_last_stay():
    own = WordEncoder(PATH, limit=8)
    asked = asking(own)
    for text in ("a b c d", "e f g h", "a b", "i j"):
        own.encode([text])
    assert own.words.to_pylist() == ["i", "j", "a", "b"] and len(asked) == 10
    own.encode(["a b i j", "a"])
    assert len(asked) == 10


@pytest.mark.parametrize("clashing", [False, True])
def test_token_files_give_back_every_id(spark, tmp_path, tokenizer, clashing):
    docs = documents(spark, clashing)
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, PATH, end_id=2, vocabulary=49_408)
    found = {}
    for row in token_files.read_token_files(spark, path).collect():
        found.setdefault(row["doc_id"], []).append(bytes(row["ids"]))
    wanted = {}
    for doc_id, text, *_ in ROWS:
        wanted.setdefault(doc_id, []).append(ids_of(tokenizer, text, 2).tobytes())
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}
    digests = token_files.read_digests(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in digests] == sorted((r[0] for r in ROWS), key=lambda x: (x is not None, x or 0))
    assert [r["start"] for r in digests] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in digests])[:-1]]).tolist()
    assert sorted(r["ids_crc32"] for r in digests) == sorted(zlib.crc32(x) for v in wanted.values() for x in v)


def test_many_files_keep_the_order_and_single_documents_are_found(spark, tmp_path, tokenizer):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("abc de. ", k=rng.randint(0, 900))), "en", "s", 0) for i in range(400)]
    docs, path = documents(spark, rows=rows).repartition(7), str(tmp_path / "files")
    token_files.write_token_files(docs, path, PATH, end_id=2, vocabulary=49_408, file_mb=0.02, sample_docs=200, dictionary_bytes=4096)
    assert len(list((tmp_path / "files" / "data").glob("part-*"))) > 3
    assert token_files.read_dictionary(spark, path)
    digests = token_files.read_digests(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in digests] == list(range(400))
    some = token_files.read_token_files(spark, path, doc_ids=[3, 250, 999]).collect()
    assert {r["doc_id"]: bytes(r["ids"]) for r in some} == {i: ids_of(tokenizer, rows[i][1], 2).tobytes() for i in (3, 250)}


@pytest.mark.parametrize("number", [5, None])
def test_rows_of_one_number_are_dealt_over_many_files(spark, tmp_path, tokenizer, number):
    rng = random.Random(2)
    rows = [(number, "".join(rng.choices("abc de. ", k=rng.randint(0, 300))), "en", "s", 0) for _ in range(2000)] + [(9, "last", "en", "s", 0)]
    path = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, rows=rows).repartition(5), path, PATH, end_id=2, file_mb=0.02, sample_docs=100, dictionary_bytes=2048)
    sizes = [p.stat().st_size for p in (tmp_path / "files" / "data").glob("part-*")]
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
    digests = token_files.read_digests(spark, path).orderBy("start").collect()
    assert [r["start"] for r in digests] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in digests])[:-1]]).tolist()
    assert digests[-1]["doc_id"] == 9
    assert sorted(r["ids_crc32"] for r in digests) == sorted(zlib.crc32(ids_of(tokenizer, r[1], 2).tobytes()) for r in rows)


def test_long_documents_of_the_sample_are_cut_and_bounded(spark):
    rows = [(i, LONG + str(i), "en", "s", 0) for i in range(12)]
    whole = token_files.train_dictionary(documents(spark, rows=rows), PATH, 2, 2, 12, 4096)
    assert whole == token_files.train_dictionary(documents(spark, rows=rows).repartition(6), PATH, 2, 2, 12, 4096) and len(whole) <= 4096
    assert token_files.train_dictionary(documents(spark, rows=rows), PATH, 2, 2, 12, 4096, sample_bytes=16384) == b""


def test_another_dictionary_is_refused(spark, tmp_path):
    docs, path = documents(spark), str(tmp_path / "files")
    token_files.write_token_files(docs, path, PATH, end_id=2)
    other = spark.createDataFrame([(bytearray(b"other"),)], "d binary").select(F.col("d").cast("string"))
    other.write.mode("overwrite").text(f"{path}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_files.read_token_files(spark, path).collect()


def test_wide_ids_take_four_bytes(spark, tmp_path, tokenizer):
    docs, path = documents(spark, rows=ROWS[:1]), str(tmp_path / "files")
    token_files.write_token_files(docs, path, PATH, end_id=70_000)
    row = token_files.read_token_files(spark, path).first()
    assert np.frombuffer(row["ids"], dtype="<u4").tolist() == ids_of(tokenizer, ROWS[0][1], 70_000).tolist()


def test_no_documents_no_frames(spark, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, rows=[]), path, PATH, end_id=2)
    assert token_files.read_digests(spark, path).count() == 0


def tightest_fit(lengths, window):
    """Best fit decreasing by looking at every open window."""
    free, placed = [], {}
    for piece in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [s for s in range(len(free)) if free[s] >= lengths[piece]]
        if not fits:
            free.append(window)
            fits = [len(free) - 1]
        chosen = min(fits, key=lambda s: free[s])
        placed[piece] = (window - free[chosen], free[chosen])
        free[chosen] -= lengths[piece]
    return placed, sorted(free)


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(3)
    for window in (1, 2, 7, 64, 100):
        for _ in range(20):
            lengths = [rng.randint(1, window) for _ in range(rng.randint(0, 80))]
            sequence, offset = packing.best_fit_decreasing(np.array(lengths, dtype=np.int64), window)
            _, free = tightest_fit(lengths, window)
            used = {}
            for s, o, n in sorted(zip(sequence.tolist(), offset.tolist(), lengths, strict=True)):
                assert used.get(s, 0) == o
                used[s] = o + n
            assert sorted(window - n for n in used.values()) == free


@pytest.mark.parametrize("clashing", [False, True])
def test_packed_pieces_cover_every_id_once(spark, tokenizer, clashing):
    docs = documents(spark, clashing)
    pieces = written(packing.token_pieces(docs, PATH, 64, end_id=1), "pieces-test")
    packed = packing.pack(pieces, 64, per_group=100).collect()
    by_sequence = {}
    for row in packed:
        by_sequence.setdefault(row["sequence_id"], []).append(row)
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == np.concatenate([[0], np.cumsum([r["length"] for r in rows])[:-1]]).tolist()
        assert sum(r["length"] for r in rows) <= 64
    total = sum(len(ids_of(tokenizer, r[1], 1)) for r in ROWS)
    assert sum(r["length"] for r in packed) == total
    assert total / (64 * len(by_sequence)) > 0.97
    ids = {r["piece_id"]: bytes(r["ids"]) for r in packed}
    glued = packing.sequences(pieces, packing.pack(pieces, 64, per_group=100)).collect()
    assert {r["sequence_id"]: bytes(r["ids"]) for r in glued} == {
        s: b"".join(ids[r["piece_id"]] for r in rows) for s, rows in by_sequence.items()
    }
    long = sorted((r for r in packed if r["doc_id"] == 6), key=lambda r: r["start"])
    assert b"".join(bytes(r["ids"]) for r in long) == ids_of(tokenizer, LONG, 1).tobytes()


def test_packing_nothing(spark):
    assert packing.pack_documents(documents(spark, rows=[]), PATH, 64, 1).count() == 0


@pytest.fixture(scope="module")
def unigram_tokenizer():
    tokenizer = Tokenizer(models.Unigram(unigram.vocabulary(MODEL), unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tokenizer


def test_counts_equal_the_library(unigram_tokenizer):
    rng, counter = random.Random(2), unigram.counter(MODEL)
    samples = [r[1] or "" for r in ROWS] + ["", " ", "▁", "a  b", "<unk> <s> <0x0A>", "\n\n", "x" * 200]
    samples += ["".join(rng.choices(ALPHABET, k=rng.randint(0, 24))) for _ in range(4000)]
    for text in samples:
        assert counter.count(text)[1] == len(unigram_tokenizer.encode(text, add_special_tokens=False).ids), text


def test_ties_go_to_the_entry_that_starts_first():
    entries = [(f"<0x{b:02X}>", -50.0) for b in range(256)] + [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("▁a", -2.0), ("ab", -2.0), ("▁ab", -3.0)]
    own = unigram.PieceCounter(entries)
    tokenizer = Tokenizer(models.Unigram(entries, unk_id=0, byte_fallback=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    for text in ("a", "ab", "aab", "abab", "b", "ba", "a ab b", "aé", "éé a"):
        assert own.count(text)[1] == len(tokenizer.encode(text, add_special_tokens=False).ids), text
    assert own.count("ab") == (-3.0, 1)


def test_every_byte_needs_an_entry():
    with pytest.raises(ValueError, match="every byte"):
        unigram.PieceCounter([("a", -1.0)])


def test_vocabulary_is_the_model_file():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert len(unigram.vocabulary(MODEL)) == model.get_piece_size()


@pytest.mark.parametrize("clashing", [False, True])
def test_token_counts_row_by_row(spark, unigram_tokenizer, clashing):
    rows = unigram.count_tokens(documents(spark, clashing), MODEL).collect()
    wanted = sorted((r[0] or -1, len(unigram_tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS)
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in rows) == wanted
    assert unigram.count_tokens(documents(spark, rows=[]), MODEL).count() == 0
