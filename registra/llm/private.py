"""Personal data: patterns, and a semi-Markov conditional random field over candidate spans.

Patterns find e-mail addresses, IP addresses, card and phone numbers; what they find always stays. The
field reads the parts of a text where such data can be: runs of neighbouring chunks that hold a digit or
an at sign. A region is cut into units (runs of letters and digits, single other characters);
a segment is an entity of one type over at most 32 units, or one unit outside. An entity is
scored by features of its whole span, so boundaries and types are chosen together by dynamic
programming. It is trained on regions whose segmentation the patterns give, and
finds spans that look like them as a whole, though no pattern takes them.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import hash_sample, map_texts, whole_text

KINDS = ("email", "ip", "card", "phone")
# The patterns.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

MOST_UNITS = 32  # of an entity
_HINT = re.compile(r"[0-9@]")
_UNIT = re.compile(r"[A-Za-z0-9]+|[^A-Za-z0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, from their at signs."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        rest = _DOMAIN.match(text, at) if start < at else None
        if rest:
            yield start, rest.end()
            done = rest.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns' matches, by kind, then start, in code points."""
    spans = [(0, *span) for span in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return spans
    spans += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                spans.append((3, *m.span()))
    return spans


def regions(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each run of neighbouring chunks that hold a digit or an at sign.

    Chunks end at blanks and line ends; a run goes on over one blank.
    """
    start = end = -1
    for hint in _HINT.finditer(text):
        at = hint.start()
        if at < end:
            continue
        first = at
        while first > max(end, 0) and not text[first - 1].isspace():
            first -= 1
        last = at + 1
        while last < len(text) and not text[last].isspace():
            last += 1
        if end >= 0 and first == end + 1 and text[end] == " ":
            end = last
            continue
        if end >= 0:
            yield start, end
        start, end = first, last
    if end >= 0:
        yield start, end


FEATURES = 22


def _features(span: str, before: str, after: str) -> list[float]:
    """What a whole span looks like; `before` and `after` are the characters at its sides."""
    digits = "".join(ch for ch in span if "0" <= ch <= "9")
    n, signs = len(digits), span.count("@")
    letters = sum(ch.isalpha() for ch in span)
    local, _, domain = span.partition("@")
    dots = span.split(".")
    numeric = len(dots) == 4 and all(p.isdigit() and len(p) <= 3 for p in dots)
    loose = sum(ch in " -().+" for ch in span)
    return [
        1.0,
        float(n < 8),
        float(8 <= n <= 15),
        float(16 <= n <= 19),
        float(n > 19),
        float(signs == 1),
        float(signs > 1),
        float(bool(local) and "." in domain[1:-1] and not domain.startswith(".")),
        float(span[0] == "+"),
        float("+" in span[1:]),
        float(16 <= n <= 19 and luhn(digits)),
        float(numeric),
        float(numeric and all(int(p) <= 255 for p in dots)),
        float(span[0].isalnum()),
        float(span[-1].isalnum()),
        float(letters > 0),
        float(n > 0 and letters == 0 and n + loose == len(span)),
        float(" " in span),
        float(before.isalnum()),
        float(after.isalnum()),
        float(before in "+.-@_%"),
        len(span) / 20,
    ]


@dataclass(frozen=True)
class Region:
    """A region's units and its candidate entities: unit places, features and spans."""

    offset: int
    units: list[tuple[int, int]]
    candidates: list[tuple[int, int]]  # first unit, unit after the last
    features: np.ndarray


def read_region(text: str, start: int, end: int) -> Region:
    """Candidates begin with a letter, digit or plus sign and end with a letter or digit. They hold one
    at sign and no blank, or no letter and seven digits (four between three dots)."""
    units = [(start + m.start(), start + m.end()) for m in _UNIT.finditer(text[start:end])]
    counts = np.cumsum([0] + [sum("0" <= ch <= "9" for ch in text[a:b]) for a, b in units])
    marks = np.cumsum([0] + [text[a] == "@" for a, _ in units])
    dots = np.cumsum([0] + [text[a] == "." for a, _ in units])
    blanks = np.cumsum([0] + [text[a] == " " for a, _ in units])
    letters = np.cumsum([0] + [any(ch.isalpha() for ch in text[a:b]) for a, b in units])
    counts, marks, dots, blanks, letters = (x.tolist() for x in (counts, marks, dots, blanks, letters))
    candidates, features = [], []
    for i, (a, _) in enumerate(units):
        if not (text[a].isalnum() or text[a] == "+"):
            continue
        for j in range(i + 1, min(i + MOST_UNITS, len(units)) + 1):
            b = units[j - 1][1]
            digits, signs = counts[j] - counts[i], marks[j] - marks[i]
            if signs > 1:
                break
            if not text[b - 1].isalnum():
                continue
            if signs:
                fits = blanks[j] == blanks[i]
            else:
                fits = letters[j] == letters[i] and (digits >= 7 or (digits >= 4 and dots[j] - dots[i] == 3))
            if fits:
                candidates.append((i, j))
                features.append(_features(text[a:b], text[a - 1 : a], text[b : b + 1]))
    return Region(start, units, candidates, np.array(features, dtype=float).reshape(-1, FEATURES))


@dataclass(frozen=True)
class SpanModel:
    """weights[kind] of an entity's features; a unit outside scores 0."""

    weights: np.ndarray

    def segment(self, region: Region) -> list[tuple[int, int, int]]:
        """The best segmentation's entities: (kind, start, end)."""
        if not region.candidates:
            return []
        scores = region.features @ self.weights.T
        kinds, best = scores.argmax(axis=1), scores.max(axis=1)
        n = len(region.units)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j) in enumerate(region.candidates):
            ending[j].append(k)
        total, back = [0.0] * (n + 1), [-1] * (n + 1)
        for j in range(1, n + 1):
            total[j] = total[j - 1]
            for k in ending[j]:
                if (value := total[region.candidates[k][0]] + best[k]) > total[j]:
                    total[j], back[j] = value, k
        found, j = [], n
        while j > 0:
            if (k := back[j]) < 0:
                j -= 1
                continue
            i, _ = region.candidates[k]
            found.append((int(kinds[k]), region.units[i][0], region.units[j - 1][1]))
            j = i
        return found[::-1]

    def expected(self, region: Region) -> np.ndarray:
        """Expected features per kind over all segmentations, by forward and backward sums."""
        n = len(region.units)
        scores = region.features @ self.weights.T
        merged = np.logaddexp.reduce(scores, axis=1)
        ahead, back = np.zeros(n + 1), np.zeros(n + 1)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        starting: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j) in enumerate(region.candidates):
            ending[j].append(k)
            starting[i].append(k)
        first = np.array([i for i, _ in region.candidates])
        last = np.array([j for _, j in region.candidates])
        for j in range(1, n + 1):
            ahead[j] = np.logaddexp.reduce(np.append(ahead[first[ending[j]]] + merged[ending[j]], ahead[j - 1])) if ending[j] else ahead[j - 1]
        for i in range(n - 1, -1, -1):
            back[i] = np.logaddexp.reduce(np.append(back[last[starting[i]]] + merged[starting[i]], back[i + 1])) if starting[i] else back[i + 1]
        chances = np.exp(ahead[first][:, None] + scores + back[last][:, None] - ahead[n])
        return chances.T @ region.features

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """The patterns' matches, and the field's entities that overlap none of them; by kind, then start."""
        base = base_spans(text)
        taken = sorted((s, e) for _, s, e in base)
        reach = list(accumulate((e for _, e in taken), max))  # the furthest end so far
        more = []
        for start, end in regions(text):
            for kind, s, e in self.segment(read_region(text, start, end)):
                before = bisect_left(taken, (e,))  # those that start before the entity ends
                if not before or reach[before - 1] <= s:
                    more.append((kind, s, e))
        return sorted(base + more)


def train(samples: list[str], rounds: int = 12, rate: float = 0.3, ridge: float = 0.01) -> SpanModel:
    """Climb the conditional likelihood of the patterns' segmentations by Adagrad.

    Only regions that hold a pattern's match, whole units from end to end, or candidates
    without any match are learnt from. No samples give a model that adds nothing.
    """
    weights = np.zeros((len(KINDS), FEATURES))
    weights[:, 0] = -4.0
    lessons = []
    for text in samples:
        base = base_spans(text)
        for start, end in regions(text):
            region = read_region(text, start, end)
            if not region.candidates:
                continue
            place = {(region.units[i][0], region.units[j - 1][1]): k for k, (i, j) in enumerate(region.candidates)}
            own = [(kind, s, e) for kind, s, e in base if start <= s and e <= end]
            if all((s, e) in place for _, s, e in own):
                gold = np.zeros_like(weights)
                for kind, s, e in own:
                    gold[kind] += region.features[place[s, e]]
                lessons.append((region, gold))
    grown = np.full_like(weights, 1e-6)
    for _ in range(rounds):
        for region, gold in lessons:
            gradient = gold - SpanModel(weights).expected(region) - ridge * weights / len(lessons)
            grown += gradient**2
            weights = weights + rate * gradient / np.sqrt(grown)
    return SpanModel(weights)


def fit(docs: DataFrame, sample: int = 200, most_chars: int = 4000) -> SpanModel:
    """The model learnt from at most `sample` documents of at most `most_chars` characters that hold an
    at sign, a plus sign before a digit, or four digits in a row: those whose content hash is smallest."""
    texts = docs.select("doc_id", whole_text(docs).alias("text"))
    hinted = texts.filter((F.length("text") <= most_chars) & F.col("text").rlike(r"@|\+[0-9]|[0-9]{4}"))
    chosen = hash_sample(hinted, hinted.count(), sample).collect()
    return train(sorted(row["text"] for row in chosen))


def find(docs: DataFrame, model: SpanModel) -> DataFrame:
    """A row per document: doc_id, base and spans, both arrays of (kind, start, end).

    NULL text counts as empty and holds nothing; rows that repeat are read again; other columns are not
    looked at; no rows give no rows. Spans are by kind, then start, in code points.
    """
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    shape = "array<struct<kind:int,start:int,end:int>>"
    named = lambda spans: [dict(zip(("kind", "start", "end"), s, strict=True)) for s in spans]

    def work(texts: list[str]) -> Iterator[tuple]:
        for text in texts:
            yield named(sorted(base_spans(text))), named(model.spans(text))

    return map_texts(
        docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), whole_text(docs).alias("text")),
        work,
        [("base", span), ("spans", span)],
        f"base {shape}, spans {shape}",
    )


def report(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end, comma-joined).

    A row for each of `found`; a text without findings, also an empty or NULL one, has zeros and empty lists.
    """
    names = F.array(*[F.lit(k) for k in KINDS])
    of_kind = lambda k: lambda s: s["kind"] == k
    listed = lambda c: F.array_join(
        F.transform(c, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    counts = [F.size(F.filter("base", of_kind(k))).cast("bigint").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))
