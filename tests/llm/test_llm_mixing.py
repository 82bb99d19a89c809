import random

import numpy as np
import pytest
from edge_tables import ROWS, SCHEMA, documents, labels
from pyspark.sql import functions as F

import corpus_pipeline
from registra.llm import mixing
from registra.llm.common import written
from registra.llm.queries import RATES, TARGETS

WORDS = {"en": ["the", "and", "of", "house"], "de": ["der", "und", "von", "haus"], "es": ["el", "y", "de", "casa"], "fr": ["le", "et", "du", "maison"]}


def corpus(n=400, seed=21):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choices(list(WORDS), weights=[8, 3, 1, 2])[0]
        other = rng.choice(list(WORDS))
        words = [rng.choice(WORDS[lang if rng.random() < 0.85 else other]) for _ in range(rng.randint(0, 60))]
        rows.append((i, " ".join(words), lang, "s", 0))
    return rows


def all_labels(spark, rows):
    return labels(spark, [(r[0], 1, 0) for r in rows[::2]])


def test_expected_tokens_meet_the_targets(spark):
    rows = corpus()
    found = mixing.mix(documents(spark, rows=rows), all_labels(spark, rows), TARGETS, **RATES).toPandas()
    chances = found[[f"p_{d}" for d in sorted(TARGETS)]].to_numpy()
    assert np.allclose(chances.sum(axis=1), 1)
    expected = (found["rate"].to_numpy() * found["n_words"].to_numpy()) @ chances
    shares = expected / expected.sum()
    assert shares == pytest.approx([TARGETS[d] for d in sorted(TARGETS)], abs=1e-5)
    assert (found["rate"] >= 0).all()
    langs = dict((r[0], r[2]) for r in rows)
    long = found[found["n_words"] > 20]
    best = np.array(sorted(TARGETS))[long[[f"p_{d}" for d in sorted(TARGETS)]].to_numpy().argmax(axis=1)]
    assert np.mean([langs[i] == b for i, b in zip(long["doc_id"], best, strict=True)]) > 0.95


def plain_projected_gradient(weight, chances, goal, rate, steps=4000, least=0):
    """The same objective, minimised by many short steps on plain arrays."""
    gram = (chances * weight[:, None]).T @ chances
    scale = 1 / np.diag(gram)
    step = 0.5 / np.linalg.eigvalsh(np.sqrt(scale)[:, None] * gram * np.sqrt(scale)).max()
    for _ in range(steps):
        gap = (rate * weight) @ chances - goal
        rate = np.maximum(least, rate - step * chances @ (scale * gap))
    return ((rate * weight) @ chances - goal) @ np.diag(scale) @ ((rate * weight) @ chances - goal)


@pytest.mark.parametrize("targets", [[0.25, 0.25, 0.25, 0.25], [0.97, 0.01, 0.01, 0.01], [0.0, 0.5, 0.5, 0.0]])
def test_rates_minimise_the_objective(spark, targets):
    rng = np.random.default_rng(5)
    chances = rng.dirichlet([0.4, 0.4, 0.2, 0.1], 200)
    n = rng.integers(0, 50, 200)
    frame = spark.createDataFrame([(i, int(n[i]), 1, *map(float, chances[i])) for i in range(200)], "doc_id bigint, n_words bigint, n_rows bigint, p_0 double, p_1 double, p_2 double, p_3 double")
    tokens = float(n.sum())
    found = mixing.fit_rates(written(frame, "chances-test"), targets, tokens).orderBy("doc_id").toPandas()
    rate = found["rate"].to_numpy()
    assert (rate >= 0).all()
    goal = np.array(targets) * tokens
    gram = (chances * n[:, None]).T @ chances
    gap = (rate * n) @ chances - goal
    own = gap @ np.diag(1 / np.diag(gram)) @ gap
    assert own <= plain_projected_gradient(n.astype(float), chances, goal, np.ones(200)) + 1e-3 * tokens


def skewed(n=3000, seed=22):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choices(list(WORDS), weights=[90, 4, 4, 1.5])[0]
        words = [rng.choice(WORDS[lang if rng.random() < 0.95 else rng.choice(list(WORDS))]) for _ in range(rng.randint(0, 60))]
        rows.append((i, " ".join(words), lang, "s", 0))
    return rows


def test_a_rare_language_reaches_its_target(spark):
    rows = skewed()
    found = mixing.mix(documents(spark, rows=rows), all_labels(spark, rows), TARGETS, **RATES).toPandas()
    names = sorted(TARGETS)
    chances, n, rate = found[[f"p_{d}" for d in names]].to_numpy(), found["n_words"].to_numpy(dtype=float), found["rate"].to_numpy()
    assert 0.01 < (n @ chances / n.sum())[names.index("fr")] < 0.02
    expected = (rate * n) @ chances
    assert rate.min() >= 1 and rate.max() > 8
    assert expected / expected.sum() == pytest.approx([TARGETS[d] for d in names], abs=1e-3)
    assert found["met"].all()
    assert found[[f"share_{d}" for d in names]].iloc[0].to_numpy() == pytest.approx(expected / expected.sum(), abs=1e-9)
    # Brute force with the production bounds does no better.
    wanted = np.array([TARGETS[d] for d in names])
    goal = wanted * 1.05 * (n @ chances / wanted).max()
    scale = 1 / np.diag((chances * n[:, None]).T @ chances)
    gap, plain = expected - goal, plain_projected_gradient(n, chances, goal, np.ones(len(n)), least=RATES["least"])
    assert scale @ gap**2 <= plain + 1e-6 * scale @ goal**2


def test_missed_targets_are_told(spark):
    rows = skewed(600)
    with pytest.warns(UserWarning, match="miss their targets"):
        found = mixing.mix(documents(spark, rows=rows), all_labels(spark, rows), TARGETS, least=1.0, most=2.0).first()
    assert found["met"] is False and found["share_fr"] < 0.1


def test_out_of_reach_nothing_is_mixed(spark):
    rows = [(i, " ".join(WORDS["en"] * 4) + f" {i}", "en", "s", 0) for i in range(60)]
    marks = labels(spark, [(i, 1, 0) for i in range(30)])
    docs = documents(spark, rows=rows)
    with pytest.warns(UserWarning, match="miss their targets"):
        found = mixing.mix(docs, marks, TARGETS).collect()
    assert {(r["rate"], r["copies"], r["met"]) for r in found} == {(1.0, 1, False)} and found[0]["share_en"] > 0.8
    with pytest.warns(UserWarning, match="miss their targets"):
        assert sorted(r["doc_id"] for r in mixing.mixed_documents(docs, marks, TARGETS).collect()) == list(range(60))


def test_rates_without_a_floor_meet_targets_that_ask_for_less(spark):
    rows = corpus(300, 5)
    docs, marks = documents(spark, rows=rows), all_labels(spark, rows)
    n = sum(len((r[1] or "").split()) for r in rows)
    found = mixing.mix(docs, marks, TARGETS, tokens=0.5 * n).toPandas()
    chances, words = found[[f"p_{d}" for d in sorted(TARGETS)]].to_numpy(), found["n_words"].to_numpy(dtype=float)
    expected = (found["rate"].to_numpy() * words) @ chances
    assert found["met"].all() and found["rate"].min() >= 0 and found["rate"].min() < 0.5
    assert expected == pytest.approx([TARGETS[d] * 0.5 * n for d in sorted(TARGETS)], abs=1e-3 * n)


def test_copies_have_the_rate_as_mean(spark):
    frame = spark.range(20_000).select(mixing.copies(F.lit(1.3), [F.col("id")]).alias("n"))
    row = frame.agg(F.avg("n").alias("mean"), F.min("n").alias("low"), F.max("n").alias("high")).first()
    assert row["mean"] == pytest.approx(1.3, abs=0.02) and (row["low"], row["high"]) == (1, 2)


@pytest.mark.parametrize("clashing", [False, True])
def test_awkward_documents_keep_their_rows(spark, clashing):
    docs = documents(spark, clashing)
    found = mixing.mix(docs, labels(spark), TARGETS).collect()
    wanted = sorted((str(r[0]), len((r[1] or "").lower().replace("\n", " ").replace("\t", " ").split())) for r in ROWS)
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in found) == wanted
    mixed = mixing.mixed_documents(docs, labels(spark), TARGETS, **RATES)
    assert mixed.columns == docs.columns
    assert {str(r["doc_id"]) for r in mixed.collect()} == {str(r[0]) for r in ROWS}  # nothing has to shrink


def test_empty_tables(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(nothing, labels(spark), TARGETS).count() == 0
    assert mixing.mixed_documents(nothing, labels(spark, []), TARGETS).count() == 0
    assert {r["rate"] for r in mixing.mix(documents(spark, rows=ROWS[2:5]), labels(spark, []), TARGETS).collect()} == {1.0}


def test_main_path_runs_no_python(spark):
    rows = corpus(60)
    plan = mixing.mix(documents(spark, rows=rows), all_labels(spark, rows), TARGETS)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "MapInArrow", "CartesianProduct", "NestedLoop"))


def folder(spark, tmp_path, rows, marks):
    documents(spark, rows=rows).write.parquet(str(tmp_path / "documents.parquet"))
    marks.write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_pipeline_does_every_stage(spark, tmp_path):
    rng = random.Random(30)
    good = [" ".join(rng.choice(WORDS[lang]) + str(rng.randint(0, 500)) for _ in range(60)) + "." for lang in WORDS for _ in range(30)]
    bad = [" ".join(f"{rng.choice(WORDS['en']).upper()}!! $$$ ||" for _ in range(60)) for _ in range(60)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(good + bad)]
    copies = [(1000 + i, good[i], "en", "s", 0) for i in range(5)]
    near = [(2000 + i, good[10 + i].rsplit(" ", 1)[0] + " changed", "en", "s", 0) for i in range(5)]
    marks = labels(spark, [(i, int(i < len(good)), 0) for i in range(len(rows))])
    result = corpus_pipeline.run(spark, folder(spark, tmp_path, rows + copies + near, marks)).collect()
    assert {r["doc_id"] for r in result} == set(range(len(good)))
    per_sequence = {}
    for r in result:
        per_sequence[r["sequence_id"]] = per_sequence.get(r["sequence_id"], 0) + r["length"]
    assert max(per_sequence.values()) <= 2048
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "near dedup", "mixing", "packing"]


def test_pipeline_mixes_to_its_targets(spark, tmp_path, recwarn):
    rng = random.Random(31)
    size = {"en": 70, "de": 25, "es": 8, "fr": 12}
    rows = []
    for lang, n in size.items():
        for _ in range(n):
            words = [rng.choice(WORDS[lang]) if rng.random() < 0.7 else f"w{rng.randint(0, 9999)}" for _ in range(80)]
            rows.append((len(rows), " ".join(words) + ".", lang, "s", 0))
    marks = labels(spark, [(r[0], 1, 0) for r in rows])
    path = folder(spark, tmp_path, rows, marks)
    result = corpus_pipeline.run(spark, path).collect()
    assert not [w for w in recwarn if "miss their targets" in str(w.message)]
    tokens, total = {}, {}
    for r in result:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
        total[r["doc_id"]] = r["doc_tokens"]
    assert set(tokens) == {r[0] for r in rows}
    docs = documents(spark, rows=rows)
    mixed = {r["doc_id"]: r for r in mixing.mix(docs, marks, TARGETS, **RATES).collect()}
    assert {i: tokens[i] / total[i] for i in tokens} == {i: float(r["copies"]) for i, r in mixed.items()}
    langs = {r[0]: r[2] for r in rows}
    words = {lang: sum(mixed[i]["copies"] * mixed[i]["n_words"] for i in mixed if langs[i] == lang) for lang in TARGETS}
    assert all(abs(words[lang] / sum(words.values()) - share) < 0.05 for lang, share in TARGETS.items())
    assert sum(words.values()) < 3 * 80 * len(rows)
    used = {}
    for r in result:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in used.values():
        placed.sort()
        assert [o for o, _ in placed] == [sum(n for _, n in placed[:k]) for k in range(len(placed))] and sum(n for _, n in placed) <= 2048


def test_pipeline_of_nothing(spark, tmp_path):
    assert corpus_pipeline.run(spark, folder(spark, tmp_path, [], labels(spark))).count() == 0
