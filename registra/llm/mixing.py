"""Mixing documents to target weights of domains, with soft membership.

A naive Bayes classifier, learnt from the documents of the labelled table, gives each document a
probability for every domain. Document i then gives r_i * n_i * p_id expected tokens to domain d, at
a rate r_i >= 0 of copies. Rates minimise the weighted squares of (expected tokens - target) over all domains by
accelerated projected gradient: a step is one aggregation of the domains' gaps, a few numbers, after which every
document moves its own rate against the gradient and back to the nearest allowed one. Everything stays in DataFrame expressions.
Every result tells the shares its rates give and whether they meet the targets. Where the targets are out of reach,
there is a warning and nothing is mixed: a compromise could multiply the corpus and still miss them.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registra.llm.common import unused, whole_text, written

# The rates are written to a table after so many steps, so that no expression grows without bound.
STEPS_AT_ONCE = 8
# Targets are met if no domain's expected share is further off.
CLOSE = 1e-3


def words(text: Column) -> Column:
    """Lower-case words between blanks, tabs and line ends; empty ones among them."""
    return F.split(F.translate(F.lower(text), "\n\r\t", "   "), " ")


@dataclass(frozen=True)
class DomainModel:
    domains: tuple[str, ...]
    priors: tuple[float, ...]  # logarithms
    table: DataFrame  # word, l_0, l_1, ...: log-likelihoods; at most `vocabulary` rows


def learn(docs: DataFrame, labels: DataFrame, domains: Iterable[str], domain: str = "lang", sample: int = 4000, vocabulary: int = 2000) -> DomainModel:
    """The classifier of `domain` from at most `sample` labelled documents, smallest hash of doc_id first.

    Its words are the `vocabulary` most frequent ones of the sample. Domains without a labelled document keep
    the smallest chance; rows of no listed domain teach nothing.
    """
    names = tuple(sorted(domains))
    chosen = labels.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs[domain].alias("domain"), whole_text(docs).alias("text"))
    rows = texts.filter(F.col("domain").isin(*names)).join(F.broadcast(chosen), "doc_id")
    rows = written(rows.select("domain", words(F.col("text")).alias("words")), "mix-sample")
    per_domain = {r["domain"]: r["n"] for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [F.count_if(F.col("domain") == d).alias(f"c_{i}") for i, d in enumerate(names)]
    each = rows.select("domain", F.explode("words").alias("word")).filter("word <> ''").groupBy("word").agg(*counts)
    total = reduce(Column.__add__, [F.col(f"c_{i}") for i in range(len(names))])
    top = written(each.orderBy(total.desc(), "word").limit(vocabulary), "mix-words")
    sums = top.agg(*[F.sum(f"c_{i}").alias(f"c_{i}") for i in range(len(names))]).first()
    likely = [
        F.ln((F.col(f"c_{i}") + 1) / F.lit(float((sums[f"c_{i}"] or 0) + vocabulary))).alias(f"l_{i}") for i in range(len(names))
    ]
    seen = sum(per_domain.values()) + len(names)
    priors = tuple(float(np.log((per_domain.get(d, 0) + 1) / seen)) for d in names)
    return DomainModel(names, priors, top.select("word", *likely))


def posteriors(docs: DataFrame, model: DomainModel, evidence: int = 8) -> DataFrame:
    """doc_id, text_key, n_rows, n_words, p_0, p_1, ...: the chance of each domain, in order of name.

    One row for each distinct (doc_id, text); n_rows says how many rows it stands for. Words are
    counted in each task before anything is moved; the words of the model are few
    and sent to every task. A text without words of the model gets the priors. All its words of the model are read, but as words of
    one text depend on each other, their mean counts as that of `evidence` independent ones, if there are more.
    """
    d = range(len(model.domains))
    keyed = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), F.xxhash64(whole_text(docs)).alias("text_key"), words(whole_text(docs)).alias("words"))
    each = keyed.select("doc_id", "text_key", F.posexplode("words").alias("place", "word"))
    sums = (
        each.join(F.broadcast(model.table), "word", "left")
        .groupBy("doc_id", "text_key")
        .agg(
            F.count_if(F.col("place") == 0).alias("n_rows"),
            F.count_if(F.col("word") != "").alias("n_words"),
            F.count("l_0").alias("hits"),
            *[F.sum(f"l_{i}").alias(f"s_{i}") for i in d],
        )
    )
    part = F.when(F.col("hits") > 0, F.least(F.col("hits"), F.col("n_rows") * evidence) / F.col("n_rows") / F.col("hits")).otherwise(0.0)
    odds = sums.select(
        "doc_id",
        "text_key",
        "n_rows",
        (F.col("n_words") / F.col("n_rows")).cast("bigint").alias("n_words"),
        *[(F.lit(model.priors[i]) + F.coalesce(F.col(f"s_{i}"), F.lit(0.0)) * part).alias(f"z_{i}") for i in d],
    )
    top = F.greatest(*[F.col(f"z_{i}") for i in d], F.lit(-1e300))
    raised = odds.select("doc_id", "text_key", "n_rows", "n_words", *[F.exp(F.col(f"z_{i}") - top).alias(f"e_{i}") for i in d])
    whole = reduce(Column.__add__, [F.col(f"e_{i}") for i in d])
    return raised.select("doc_id", "text_key", "n_rows", "n_words", *[(F.col(f"e_{i}") / whole).alias(f"p_{i}") for i in d])


def fit_rates(
    chances: DataFrame,
    targets: list[float],
    tokens: float | None = None,
    least: float = 0.0,
    most: float | None = None,
    tolerance: float = 1e-6,
    most_steps: int = 400,
    closest: bool = True,
) -> DataFrame:
    """`chances` (a written table with n_rows, n_words, p_0, ...) and the columns `rate`, share_0, ... and `met`.

    `targets` are the domains' shares, in order of name. `tokens` is the expected total; by
    default a twentieth over the least for which no domain has to shrink. Rates stay between
    `least` and `most`; with `least` = 1 no document is lost. Domains without any
    token are left out of the targets. The gaps are weighted by D^-1, D the diagonal of the domains' matrix G, and rates
    are measured by their documents' tokens, so a step of 1 over the largest eigenvalue of D^-1/2 G D^-1/2 never overshoots.
    Steps run ahead of the rates by their last move (Nesterov), which starts anew whenever the squares grow. They end
    when every domain's gap is within `tolerance` of the total, when 40 steps gain less than a
    thousandth, or after `most_steps`. No tokens at all leave every rate at `least` or 1.

    share_0, ... are the domains' parts of the expected tokens at these rates, and `met` says whether all are within
    0.001 of the targets (of the domains that have tokens) and so is their total, by part; without tokens all are NULL.
    If not, the rates are the closest ones or, without `closest`, those that nothing changes, and their shares.
    """
    d = range(len(targets))
    weight = F.col("n_rows") * F.col("n_words")
    sums = chances.agg(
        *[F.sum(weight * F.col(f"p_{i}") * F.col(f"p_{j}")).alias(f"g_{i}_{j}") for i in d for j in d if i <= j],
        *[F.sum(weight * F.col(f"p_{i}")).alias(f"s_{i}") for i in d],
    ).first()
    held = np.array([sums[f"s_{i}"] or 0.0 for i in d])
    start = max(1.0, least)
    wanted = np.where(held > 0, np.array(targets, dtype=float), 0.0)
    if not wanted.sum():
        return _told(chances.withColumn("rate", F.lit(start)), [None] * len(targets), None)
    wanted /= wanted.sum()
    total = tokens if tokens is not None else 1.05 * max(held[i] / wanted[i] for i in d if wanted[i] > 0)
    goal = wanted * total
    matrix = np.array([[sums[f"g_{min(i, j)}_{max(i, j)}"] or 0.0 for j in d] for i in d])
    scale = np.array([1 / x if x > 0 else 0.0 for x in np.diag(matrix)])
    root = np.sqrt(scale)
    step = 1 / np.linalg.eigvalsh(root[:, None] * matrix * root).max()

    def allowed(rate: Column) -> Column:
        return F.greatest(F.lit(least), rate if most is None else F.least(F.lit(most), rate))

    state = chances.withColumns({"rate": allowed(F.lit(start)), "ahead": allowed(F.lit(start))})
    names = [c for c in chances.columns if c not in ("rate", "ahead")]
    losses, momentum = [], 1.0
    for number in range(most_steps + 1):
        row = state.agg(*[F.sum(weight * F.col(c) * F.col(f"p_{i}")).alias(f"{c}_{i}") for c in ("rate", "ahead") for i in d]).first()
        given, met_ahead = (np.array([row[f"{c}_{i}"] for i in d]) for c in ("rate", "ahead"))
        losses.append(float(scale @ (given - goal) ** 2))
        stuck = len(losses) > 40 and min(losses[-40:]) > 0.999 * min(losses[:-40])
        if np.abs(given - goal).max() <= tolerance * total or stuck or number == most_steps:
            break
        if number and losses[-1] > losses[-2]:  # ahead of itself: start again from the rates
            momentum, met_ahead = 1.0, given
            state = state.withColumn("ahead", F.col("rate"))
        slope = step * scale * (met_ahead - goal)
        moved = allowed(F.col("ahead") - reduce(Column.__add__, [F.col(f"p_{i}") * F.lit(float(slope[i])) for i in d]))
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        push, momentum = (momentum - 1) / after, after
        state = state.withColumn("moved", moved).select(
            *names, F.col("moved").alias("rate"), (F.col("moved") + F.lit(float(push)) * (F.col("moved") - F.col("rate"))).alias("ahead")
        )
        if number % STEPS_AT_ONCE == STEPS_AT_ONCE - 1:
            state = written(state, "rates")
    shares = given / given.sum() if given.sum() > 0 else 0 * given
    met = bool(np.abs(shares - wanted).max() <= CLOSE and abs(given.sum() - total) <= CLOSE * total)
    if not met:
        warnings.warn(f"rates miss their targets: expected shares {shares.round(4).tolist()} for {wanted.round(4).tolist()}, {given.sum():.0f} tokens for {total:.0f}", stacklevel=2)
        if not closest:
            return _told(chances.withColumn("rate", allowed(F.lit(start))), (held / held.sum()).tolist(), met)
    return _told(state.drop("ahead"), shares.tolist(), met)


def _told(state: DataFrame, shares: list[float | None], met: bool | None) -> DataFrame:
    told = {f"share_{i}": F.lit(share).cast("double") for i, share in enumerate(shares)}
    return state.withColumns(told | {"met": F.lit(met).cast("boolean")})


def copies(rate: Column, key: list[Column], seed: int = 0) -> Column:
    """Whole copies whose expectation is the rate; the same for a key each time."""
    uniform = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate + uniform).cast("bigint")


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str = "lang", **bounds: float | None) -> DataFrame:
    """A row per document: doc_id, n_words, p_<domain> for each, rate, copies, share_<domain> for each, met.

    NULL text counts as empty, has no words and the priors' chances; NULL domains and doc_ids teach nothing;
    rows that repeat get the same rate and copies each; other columns are not looked at. `bounds` go to
    `fit_rates`: tokens, least, most. share_<domain> and met are the same in all rows: the expected shares of
    the mixture and whether the targets are met; if they cannot be, every rate is 1 (or `least`). No rows give no rows.
    """
    rates = _rates(docs, labels, targets, domain, bounds)
    names = sorted(targets)
    each = rates.withColumn("again", F.explode(F.sequence(F.lit(1).cast("bigint"), "n_rows")))
    of = lambda what: [F.col(f"{what}_{i}").alias(f"{what}_{name}") for i, name in enumerate(names)]
    return each.select("doc_id", "n_words", *of("p"), "rate", "copies", *of("share"), "met")


def _rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str, bounds: dict[str, float | None]) -> DataFrame:
    names = sorted(targets)
    model = learn(docs, labels, names, domain)
    rates = fit_rates(written(posteriors(docs, model), "chances"), [targets[n] for n in names], closest=False, **bounds)
    return rates.withColumn("copies", copies(F.col("rate"), [F.col("doc_id"), F.col("text_key")]))


def mixed_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domain: str = "lang", **bounds: float | None) -> DataFrame:
    """The rows of `docs`, with all their columns, each as often as its number of copies says.

    As for `mix`: NULL and empty texts have no words and rates like others, rows that repeat get the same number of copies each,
    columns may have any names, no rows give no rows. Where the targets are out of reach, every row comes once.
    """
    own, key, n = unused(docs, "rated_id"), unused(docs, "rated_text"), unused(docs, "n_copies")
    rates = written(_rates(docs, labels, targets, domain, bounds).select(F.col("doc_id").alias(own), F.col("text_key").alias(key), F.col("copies").alias(n)), "copies")
    keyed = F.xxhash64(whole_text(docs))
    rows = docs.join(rates, docs["doc_id"].cast("bigint").eqNullSafe(rates[own]) & (keyed == rates[key]))
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n)))
    return rows.filter(F.col(n) > 0).withColumn(unused(rows, "copy"), again).select(*[docs[f"`{c}`"] for c in docs.columns])
