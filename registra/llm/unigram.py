"""Token counts by a unigram model, without its tokens: Aho-Corasick matches under a Viterbi pass.

The tokenizer is the unigram model of the tokenizers library with byte fallback behind its
Metaspace splitter: a blank becomes the mark U+2581, a text starts with one, every mark starts a new word,
and words are cut on their own. An automaton finds all vocabulary entries that end at a place;
the pass keeps the best score and the number of pieces on the way there, nothing else. Ties go
as in the library: of equal scores the entry that starts first wins. A character that is no
entry by itself may be stepped over at the worst score less 10 and costs as many pieces as its UTF-8
form has bytes; so does every character of a run of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from registra.llm.common import map_texts, whole_text

MARK = "▁"
UNKNOWN_PENALTY = 10.0


def vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Entries and scores of a SentencePiece model, in order of their ids."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class PieceCounter(dict):
    """(score, pieces) of words; past `limit` words the memory starts anew."""

    def __init__(self, entries: list[tuple[str, float]], limit: int = 400_000, longest: int = 64):
        super().__init__()
        missing = {f"<0x{b:02X}>" for b in range(256)} - {piece for piece, _ in entries}
        if missing:
            raise ValueError("byte fallback needs an entry for every byte")
        self.automaton = ahocorasick.Automaton()
        for piece, score in entries:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in entries) - UNKNOWN_PENALTY
        # A line feed that is part of no entry is always stepped over, so it parts a word.
        self.parts_lines = not any("\n" in piece for piece, _ in entries)
        self.limit, self.longest = limit, longest

    def __missing__(self, word: str) -> tuple[float, int]:
        result = self.viterbi(word)
        if len(word) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[word] = result
        return result

    def viterbi(self, word: str) -> tuple[float, int]:
        n = len(word)
        score, pieces, single = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        reached = [False] * (n + 1)
        reached[0] = True
        done = 0  # places up to here are final
        for end, (length, gain) in self.automaton.iter(word):
            end += 1
            while done < end - 1:
                done += 1
                self._step_over(word, done, score, pieces, single, reached)
            start = end - length
            single[end] |= length == 1
            total = score[start] + gain
            if not reached[end] or total > score[end]:
                score[end], pieces[end], reached[end] = total, pieces[start] + 1, True
        while done < n:
            done += 1
            self._step_over(word, done, score, pieces, single, reached)
        return score[n], pieces[n]

    def _step_over(self, word: str, end: int, score: list, pieces: list, single: list, reached: list) -> None:
        """The way over an unknown character, once all entries that end here have been seen."""
        if not single[end]:
            total = score[end - 1] + self.unknown
            if not reached[end] or total > score[end]:
                score[end], pieces[end] = total, pieces[end - 1] + len(word[end - 1].encode())
                reached[end] = True

    def count(self, text: str) -> tuple[float, int]:
        """Best score and number of pieces of a whole text."""
        if not text:
            return 0.0, 0
        marked = text.replace(" ", MARK)
        words = marked.split(MARK)
        words = words[1:] if marked[0] == MARK else words
        score, pieces = 0.0, 0
        for word in words:
            if self.parts_lines and "\n" in word:
                first, *rest = word.split("\n")
                for part in [MARK + first, *filter(None, rest)]:
                    gain, more = self[part]
                    score, pieces = score + gain, pieces + more
                score, pieces = score + len(rest) * self.unknown, pieces + len(rest)
            else:
                gain, more = self[MARK + word]
                score, pieces = score + gain, pieces + more
        return score, pieces


_counters: dict[str, PieceCounter] = {}


def counter(model_file: str) -> PieceCounter:
    """This worker's counter of a model file; it lives as long as the worker."""
    if model_file not in _counters:
        _counters[model_file] = PieceCounter(vocabulary(model_file))
    return _counters[model_file]


def count_tokens(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, score of every whole text, row by row.

    NULL text counts as empty and has no tokens and score 0; rows that repeat count again; other columns are
    not looked at; no rows give no rows.
    """

    def work(texts: list[str]) -> Iterator[tuple]:
        count = counter(model_file).count
        for text in texts:
            score, pieces = count(text)
            yield pieces, score

    return map_texts(
        docs.select("doc_id", whole_text(docs).alias("text")),
        work,
        [("n_tokens", pa.int64()), ("score", pa.float64())],
        "n_tokens bigint, score double",
    )
