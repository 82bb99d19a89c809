"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. A line's own features and those of the lines before and after it give its
log-odds, four transition weights tie it to its neighbours. Forward and backward passes give each line's
probability to be good; a document's score is their mean, weighted by the lines' lengths.
Training takes a document's label for all its lines and climbs the conditional likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import map_texts, of_text, unused, whole_text

OWN = 12  # features of a line itself, without its neighbours'
FEATURES = 1 + 3 * OWN + 2

_LOWER, _UPPER, _DIGIT, _SPACE, _MARK, _SYMBOL, _FIRST, _REST = range(8)


def _classes() -> np.ndarray:
    kinds = np.full(256, _SYMBOL, dtype="u1")
    kinds[ord("a") : ord("z") + 1] = _LOWER
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    kinds[np.frombuffer(b".,;:'\"-()?", dtype="u1")] = _MARK
    kinds[128:192] = _REST
    kinds[192:] = _FIRST
    return kinds


_KIND = _classes()


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts, the lines' lengths, and the number of lines per text.

    A text has at least one line; an empty line has length 1, its line feed.
    """
    counts, words, distinct, again, shouted = [], [], [], [], []
    for text in texts:
        seen: set[str] = set()
        lines = text.split("\n")
        counts.append(len(lines))
        for line in lines:
            own = line.split()
            words.append(len(own))
            distinct.append(len(set(own)))
            again.append(line in seen and bool(own))
            seen.add(line)
    data = np.frombuffer(("\n".join(texts) + "\n").encode(), dtype="u1")
    kinds = _KIND[data]
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    per_kind = np.stack([np.add.reduceat((kinds == k).astype(np.int32), starts) for k in range(8)], axis=1).astype(float)
    size = (ends - starts + 1) - per_kind[:, _REST]  # code points, with the line feed
    words, distinct = np.array(words, dtype=float), np.array(distinct, dtype=float)
    letters = np.maximum(per_kind[:, _LOWER] + per_kind[:, _UPPER] + per_kind[:, _FIRST], 1)
    solid = np.maximum(size - per_kind[:, _SPACE], 1)
    own = np.stack(
        [
            per_kind[:, _UPPER] / letters,
            np.minimum(per_kind[:, _SYMBOL] / solid * 10, 3),
            np.minimum(per_kind[:, _MARK] / solid * 10, 3),
            per_kind[:, _DIGIT] / solid,
            per_kind[:, _FIRST] / solid,
            np.log1p(words) / 4,
            np.log(np.maximum(words, 1) / np.maximum(distinct, 1)),
            np.minimum(solid / np.maximum(words, 1), 30) / 10,
            np.array(again, dtype=float),
            (words == 0).astype(float),
            (per_kind[:, _SYMBOL] > 0).astype(float),
            ((per_kind[:, _UPPER] > per_kind[:, _LOWER]) & (words > 0)).astype(float),
        ],
        axis=1,
    )
    first = np.zeros(len(own), dtype=bool)
    last = np.zeros(len(own), dtype=bool)
    stops = np.cumsum(counts)
    first[stops - counts], last[stops - 1] = True, True
    before = np.where(first[:, None], 0, np.roll(own, 1, axis=0))
    after = np.where(last[:, None], 0, np.roll(own, -1, axis=0))
    edges = np.stack([first, last], axis=1).astype(float)
    return np.concatenate([np.ones((len(own), 1)), own, before, after, edges], axis=1), size, np.array(counts)


@dataclass(frozen=True)
class LineModel:
    """weights: log-odds of a good line per feature; moves[i, j]: from state i to j, 1 is good."""

    weights: np.ndarray
    moves: np.ndarray

    def passes(self, odds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward and backward log-odds of good against bad for every line, and the lines' places
        by step: the documents still running at a step are the longest ones, taken together."""
        order = np.argsort(-counts, kind="stable")
        starts = (np.cumsum(counts) - counts)[order]
        sizes = counts[order]
        t = self.moves
        ahead, back = odds.copy(), np.zeros_like(odds)
        most = int(sizes[0]) if len(sizes) else 0
        running = np.searchsorted(-sizes, -np.arange(1, most + 1), "right")  # documents of at least so many lines
        for step in range(1, most):
            at = starts[: running[step]] + step
            x = ahead[at - 1]
            ahead[at] = odds[at] + np.logaddexp(x + t[1, 1], t[0, 1]) - np.logaddexp(x + t[1, 0], t[0, 0])
        for step in range(most - 2, -1, -1):
            at = starts[: running[step + 1]] + step
            y = back[at + 1] + odds[at + 1]
            back[at] = np.logaddexp(t[1, 1] + y, t[1, 0]) - np.logaddexp(t[0, 1] + y, t[0, 0])
        return ahead, back, order

    def good(self, features: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Each line's probability to be good, given all lines of its document."""
        ahead, back, _ = self.passes(features @ self.weights, counts)
        return 0.5 * (1 + np.tanh((ahead + back) / 2))

    def scores(self, texts: list[str]) -> np.ndarray:
        """Length-weighted mean of the lines' probabilities, per text."""
        features, size, counts = line_features(texts)
        good = self.good(features, counts)
        starts = np.cumsum(counts) - counts
        return np.clip(np.add.reduceat(good * size, starts) / np.add.reduceat(size, starts), 0.0, 1.0)


def train(features: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.15, ridge: float = 1e-3) -> LineModel:
    """Climb the mean conditional log-likelihood per line by Adam; no documents give even odds."""
    weights, moves = np.zeros(features.shape[1]), np.zeros((2, 2))
    if not len(counts):
        return LineModel(weights, moves)
    lines = np.repeat(labels, counts).astype(float)
    linked = np.ones(len(lines), dtype=bool)
    linked[np.cumsum(counts) - 1] = False  # has a next line in its document
    at = np.flatnonzero(linked)
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (lines[at].astype(int), lines[at + 1].astype(int)), 1)
    n = len(lines)
    values = np.concatenate([weights, moves.ravel()])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, rounds + 1):
        model = LineModel(values[:-4], values[-4:].reshape(2, 2))
        odds = features @ model.weights
        ahead, back, _ = model.passes(odds, counts)
        good = 0.5 * (1 + np.tanh((ahead + back) / 2))
        slope = features.T @ (lines - good)
        x, y = ahead[at], odds[at + 1] + back[at + 1]
        pairs = np.stack([np.full(len(at), model.moves[0, 0]), y + model.moves[0, 1], x + model.moves[1, 0], x + y + model.moves[1, 1]], axis=1)
        pairs = np.exp(pairs - pairs.max(axis=1, keepdims=True)) if len(at) else pairs
        expected = (pairs / pairs.sum(axis=1, keepdims=True)).sum(axis=0) if len(at) else np.zeros(4)
        gradient = np.concatenate([slope, seen_moves.ravel() - expected]) / n - ridge * values
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        values = values + rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return LineModel(values[:-4], values[-4:].reshape(2, 2))


def held_out(df: DataFrame) -> Column:
    """Whether crc32 of the doc_id as text leaves 2 when divided by 4; NULL counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(df["doc_id"].cast("string"), F.lit(""))), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, sample: int = 3000, most_lines: int = 256) -> LineModel:
    """The model of the labelled documents that are not held out.

    At most `sample` of them, those whose doc_id has the smallest hash, and of these the ones
    of at most `most_lines` lines; only the numbers of their lines reach the driver. Labels
    other than 0 and 1 do not count; of contradicting labels the lower one does.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(labels))
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").cast("bigint").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").filter(F.length("text") - F.length(F.replace("text", F.lit("\n"))) < most_lines)

    def work(texts: list[str]) -> Iterator[tuple]:
        features, _, counts = line_features(texts)
        for block in np.split(features, np.cumsum(counts)[:-1]):
            yield (block.astype("<f4").tobytes(),)

    found = map_texts(rows.select("doc_id", "quality", "text"), work, [("lines", pa.binary())], "lines binary", 1_000_000).toPandas()
    found = found.sort_values(["doc_id", "lines"], ignore_index=True)  # the same order, and so the same model, each time
    blocks = [np.frombuffer(x, dtype="<f4").reshape(-1, FEATURES) for x in found["lines"]]
    features = np.concatenate(blocks).astype(float) if blocks else np.zeros((0, FEATURES))
    return train(features, np.array([len(b) for b in blocks], dtype=int), found["quality"].to_numpy(dtype=int))


def with_score(docs: DataFrame, model: LineModel, column: str) -> DataFrame:
    """All columns of `docs`, and the score of the whole text as `column`, which must be none of them.

    NULL text counts as empty, an empty text is one empty line; long texts are scored whole; rows that repeat are
    scored alike; no rows give no rows. Only texts and scores pass between the JVM and Python.
    """
    score = of_text(lambda texts: map(float, model.scores(texts)), pa.float64(), "double", 1_000_000)
    return docs.withColumn(column, score(whole_text(docs)))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of `docs`, with all their columns, that score `threshold` or more.

    As for `fit` and `with_score`: NULL and empty texts get a score like any other, a score equal to the threshold stays, rows
    that repeat stay or go together, columns may have any names. Without labels every text scores one half.
    """
    column = unused(docs, "quality_score")
    scored = with_score(docs, fit(docs, labels), column)
    return scored.filter(F.col(column) >= threshold).drop(column)
