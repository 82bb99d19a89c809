"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q, at least max(24, 3 q) long, that no neighbouring word extends.
Texts are cut into dyadic blocks: for every B = 2^k from 8 on, one block at every multiple of B. A run has room
for an aligned block of B words whose copy q words on is in the run too, for B = 8 if q <= 8 and otherwise for the largest
B <= q, since 2 B - 1 <= length - q. So the copy starts in the window of 2 B - 1 places after the block's start.

Occurrences of a block are an interval of the suffix array, known from the ranks that prefix doubling
gives words of length B. A wavelet matrix over the suffix array answers the smallest occurrence at or
after a place (range successor). Occurrences in the window more than B / 2 apart are at most three, and
their distances are candidate periods. Closer ones, p apart, are a progression: all lie in one stretch [s, e) of
period p, whose last one is known from e, and the search goes on after it. The block's own stretch is [s', e');
either its start or its end lies inside a run of longer period q, and the same end of the copy's stretch is q words on,
so s - s' and e - e' are candidates. Of a block whose first successor is p words on, p is one too.

Every candidate is extended from its block in both directions, by the ranks of dyadic lengths. Extensions that are
long enough are runs; of equal stretches the smallest candidate is the period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from registra.llm.common import map_texts, mix64, whole_text

LEAST, TIMES = 24, 3  # a run has at least 24 words and 3 periods
FIRST = 3  # the smallest blocks have 2^3 words


class WaveletMatrix:
    """Order statistics of any interval of a sequence of distinct numbers below its length."""

    def __init__(self, values: np.ndarray):
        self.levels: list[np.ndarray] = []  # per bit, from the highest: zeros among the first i values
        self.bits = max(1, int(len(values) - 1).bit_length()) if len(values) else 1
        for bit in range(self.bits - 1, -1, -1):
            zero = (values >> bit & 1) == 0
            self.levels.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            values = np.concatenate([values[zero], values[~zero]])

    def smaller(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of the places low to high are below the bound, which is at most the length."""
        count = np.zeros(len(low), dtype=np.int64)
        beyond = bound >> self.bits > 0
        for i, zeros in enumerate(self.levels):
            one = (bound >> (self.bits - 1 - i) & 1) == 1
            a, b = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            count += np.where(one, b - a, 0)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return np.where(beyond, -1, count)

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest value, from 0, of the places low to high."""
        value = np.zeros(len(low), dtype=np.int64)
        for i, zeros in enumerate(self.levels):
            a, b = zeros[low].astype(np.int64), zeros[high].astype(np.int64)
            one = n >= b - a
            n = np.where(one, n - (b - a), n)
            value += one.astype(np.int64) << (self.bits - 1 - i)
            low, high = np.where(one, zeros[-1] + low - a, a), np.where(one, zeros[-1] + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of the places low to high that is `least` or more; -1 where none is."""
        before = self.smaller(low, high, least)
        there = (before >= 0) & (before < high - low)
        out = np.full(len(low), -1, dtype=np.int64)
        out[there] = self.nth(low[there], high[there], before[there])
        return out


class Index:
    """Ranks of all dyadic lengths and the suffix array of several texts, none of whose words is equal to another text's."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        """Word numbers, and for each place the end of its text."""
        n = len(words)
        self.n, self.ends = n, ends
        self.ranks: list[np.ndarray] = []
        key = words.astype(np.int64)
        self.suffixes = np.zeros(0, dtype=np.int64)
        while n:
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
            first = np.flatnonzero(new)
            rank = np.empty(n, dtype=np.int32)
            rank[order] = first[np.cumsum(new) - 1]  # the place of the first suffix that starts so
            self.ranks.append(rank)
            if len(first) == n:
                self.suffixes = order
                break
            step = 1 << (len(self.ranks) - 1)
            then = np.zeros(n, dtype=np.int64)  # 0 past the end of the text
            inside = np.arange(n) + step < ends
            then[inside] = rank[np.flatnonzero(inside) + step].astype(np.int64) + 1
            key = rank.astype(np.int64) * (n + 1) + then
        self.matrix = WaveletMatrix(self.suffixes)

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from place a on equal those from place b on, a < b in one text."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            step, rank = 1 << level, self.ranks[level]
            fits = b + step <= self.ends[np.minimum(b, self.n - 1)]
            fits &= b < self.n
            at = np.flatnonzero(fits)
            at = at[rank[a[at]] == rank[b[at]]]
            a[at], b[at], out[at] = a[at] + step, b[at] + step, out[at] + step
        return out

    def same_before(self, a: np.ndarray, b: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """How many words before place a equal those before place b, a < b; `starts` of their text."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), dtype=np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            step, rank = 1 << level, self.ranks[level]
            at = np.flatnonzero(a - step >= starts)
            at = at[rank[a[at] - step] == rank[b[at] - step]]
            a[at], b[at], out[at] = a[at] - step, b[at] - step, out[at] + step
        return out

    def stretch(self, at: np.ndarray, period: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The widest [start, end) around a place and its copy one period on that keeps the period.

        A place past the end of the text, one period on, has nothing to agree with there.
        """
        inside = at + period < self.ends[at]
        other = np.where(inside, at + period, at)
        ahead, back = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        k = np.flatnonzero(inside)
        ahead[k] = self.same(at[k], other[k])
        back[k] = self.same_before(at[k], other[k], starts[k])
        return at - back, np.where(inside, other + ahead, at)


def candidates(index: Index, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and candidate periods: every run holds a place that is given with the run's period."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for level in range(FIRST, len(index.ranks)):
        size, rank = 1 << level, index.ranks[level]
        counts = np.bincount(rank, minlength=index.n)
        block = np.arange(0, index.n, size)
        block = block[(block + size <= index.ends[block]) & (counts[rank[block]] > 1)]
        low = rank[block].astype(np.int64)
        high, limit = low + counts[rank[block]], np.minimum(block + 2 * size, index.ends[block])
        text_start = starts[block]
        here = index.matrix.successor(low, high, block + 1)
        nearest = True
        while len(block):
            at = np.flatnonzero((here >= 0) & (here < limit))
            block, low, high, limit, text_start, here = (x[at] for x in (block, low, high, limit, text_start, here))
            if not len(block):
                break
            found.append((block, here - block))
            if nearest:  # the block's own progression
                close = here - block <= size // 2
                last = here.copy()
                k = np.flatnonzero(close)
                period = here[k] - block[k]
                _, end = index.stretch(block[k], period, text_start[k])
                last[k] = block[k] + (end - size - block[k]) // period * period
                here = np.where(close, last, here)
                nearest = False
                here = index.matrix.successor(low, high, np.where(close, here + 1, here))
                continue
            following = index.matrix.successor(low, high, here + 1)
            k = np.flatnonzero((following >= 0) & (following - here <= size // 2))
            if len(k):
                period = following[k] - here[k]
                s, e = index.stretch(here[k], period, text_start[k])
                own_s, own_e = index.stretch(block[k], period, text_start[k])
                found += [(block[k], s - own_s), (block[k], e - own_e)]
                last = here[k] + (e - size - here[k]) // period * period
                following[k] = index.matrix.successor(low[k], high[k], last + 1)
            here = following
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    at, period = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = period > 0
    pairs = np.unique(np.stack([at[keep], period[keep]]), axis=1)
    return pairs[0], pairs[1]


def runs_of(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs, ascending, of texts in one row; start and end of each place's text are given."""
    index = Index(words, ends)
    at, period = candidates(index, starts)
    s, e = index.stretch(at, period, starts[at] if len(at) else at)
    long = e - s >= np.maximum(LEAST, TIMES * period)
    s, e, period = s[long], e[long], period[long]
    order = np.lexsort((period, e, s))
    s, e, period = s[order], e[order], period[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, period = s[new], e[new], period[new]
    order = np.lexsort((period, s))
    return s[order], e[order], period[order]


def _repeating(numbers: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """Which texts have two equal stretches of 8 words; others have no run. Hashes may name too many, never too few."""
    width = 1 << FIRST
    hashed, n = mix64(numbers.astype(np.uint64)), len(numbers) - width + 1
    if n <= 0:
        return np.zeros(texts, dtype=bool)
    total = np.zeros(n, dtype=np.uint64)
    factor = 0x9E3779B97F4A7C15
    for i in range(width):
        total += hashed[i : i + n] * np.uint64(factor)
        factor = factor * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
    inside = np.flatnonzero(text[:n] == text[width - 1 :])
    key = mix64(total[inside] ^ mix64(text[inside].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    again = np.flatnonzero(key[order][1:] == key[order][:-1])
    out = np.zeros(texts, dtype=bool)
    out[text[inside[order[again]]]] = True
    return out


def find(texts: list[str]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """Number of words, runs (start, length, period) by start and period, and the collapsed text of each text.

    In a collapsed text a word is left out if any run holds it after that run's first period; words
    are joined by one blank.
    """
    words = [t.encode().split() for t in texts]  # at the ASCII blanks
    counts = np.array([len(w) for w in words], dtype=np.int64)
    flat = [w for own, n in zip(words, counts, strict=True) if n >= LEAST for w in own]
    long = np.flatnonzero(counts >= LEAST)
    numbers = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(long)), counts[long])
    asked = _repeating(numbers, text, len(long))
    keep = asked[text]
    numbers, text, long = numbers[keep], (np.cumsum(asked) - 1)[text[keep]], long[asked]
    size = counts[long]
    first = np.cumsum(size) - size
    # Words of different texts differ.
    key = text * (numbers.max(initial=0) + 1) + numbers
    start, end, period = runs_of(key, first[text], (first + size)[text])
    of_text = np.searchsorted(first, start, "right") - 1
    found: dict[int, list[tuple[int, int, int]]] = {}
    for t, a, b, q in zip(of_text.tolist(), start.tolist(), end.tolist(), period.tolist(), strict=True):
        a0 = int(first[t])
        found.setdefault(int(long[t]), []).append((a - a0, b - a, q))
    for i, own in enumerate(words):
        runs = found.get(i, [])
        if runs:
            change = np.zeros(len(own) + 1, dtype=np.int64)
            for a, length, q in runs:
                change[a + q] += 1
                change[a + length] -= 1
            own = [own[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
        yield int(counts[i]), runs, b" ".join(own).decode()


def find_runs(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_words, runs (start, length, period in words) and the collapsed text.

    Whole texts are searched; NULL counts as empty and has no words and no runs. Words are parted by blanks, tabs and line ends.
    Rows that repeat a doc_id, or have none, are rows of their own; other columns are not looked at. No rows give no rows.
    A text in which no stretch of eight words repeats costs its words and their hashes; any other about 8 bytes
    a word for every doubling of its longest repeated stretch.
    """

    def work(texts: list[str]) -> Iterator[tuple]:
        for n, runs, collapsed in find(texts):
            yield n, [{"start": a, "length": m, "period": q} for a, m, q in runs], collapsed

    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return map_texts(
        docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text")),
        work,
        [("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())],
        "n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    )
