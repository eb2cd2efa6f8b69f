import itertools
import random
import re

import numpy as np
import pytest

from tidepool.llm.toxicity import (
    DIMS, Field, Tagger, fit_toxicity, log_ratios, messages, score_toxicity, text_words, train_field, training_windows)


def brute_marginals(emit, moves):
    weights = np.zeros((len(emit), 2))
    for path in itertools.product((0, 1), repeat=len(emit)):
        w = np.exp(sum(e for e, y in zip(emit, path, strict=True) if y)
                   + sum(moves[a][b] for a, b in zip(path, path[1:], strict=False)))
        for t, y in enumerate(path):
            weights[t, y] += w
    return np.log(weights[:, 1] / weights[:, 0])


@pytest.mark.parametrize("seed", range(10))
def test_forward_backward_equals_all_paths(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 8, 12)
    emit = rng.normal(0, 2, lengths.sum())
    moves = rng.normal(0, 1, (2, 2))
    got = log_ratios(emit, moves, lengths)
    at = 0
    for n in lengths:
        if n:
            assert np.allclose(got[at:at + n], brute_marginals(emit[at:at + n], moves))
        at += n


def test_training_learns_words_and_runs():
    rng = random.Random(2)
    windows = []
    for _ in range(400):
        labels = [0] * 12
        if rng.random() < 0.5:
            at = rng.randrange(9)
            labels[at:at + 3] = [1, 1, 1]
        windows.append(([(b"bad%d" if y else b"good%d") % rng.randint(0, 9) for y in labels], labels))
    weights, moves = train_field(windows[:300])
    tagger = Tagger(Field(weights, moves, np.zeros(4)))
    _, marginals = tagger.tag([w for w, _ in windows[300:]])
    right = [(p >= 0.5) == np.array(y, bool) for p, (_, y) in zip(marginals, windows[300:], strict=True)]
    assert np.concatenate(right).mean() > 0.99
    assert moves[1, 1] > moves[0, 1]
    ahead, back, odds = messages(np.zeros(4), moves, np.array([4]))
    assert len(ahead) == len(back) == len(odds) == 4


def corpus(rng, n):
    plain = [a + b for a in ("tor", "lin", "mar", "sel", "vud") for b in ("a", "es", "ing", "o", "ed", "um")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randint(0, len(words)), rng.choice(["grook", "Snarv" + rng.choice("abcdefgh")]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_spans(spark):
    rows, labels = corpus(random.Random(6), 600)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels[:400], "doc_id long, toxic int")
    got = {r.doc_id: r for r in score_toxicity(docs, fit_toxicity(docs, known)).collect()}
    truth = dict(labels)
    held = [got[i] for i in range(400, 600)]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 196
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    spans = [dict(rows)[r.doc_id].encode()[s.start:s.end].lower() for r in held for s in r.spans]
    assert spans and all(w == b"grook" or w.startswith(b"snarv") for w in spans)


def ordered_sample(spark, n):
    """Texts of 100 words, every other toxic; the second half of the table has its own words."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        half = "ab"[2 * i // n]
        words = [f"{half}plain{rng.randint(0, 50)}" for _ in range(100)]
        if i % 2:
            words[70] = half + "grook"
        rows.append((" ".join(words), i % 2))
    return spark.createDataFrame(rows, "_text string, _label int").coalesce(8)


def test_windows_come_from_the_whole_sample(spark):
    sample, markers = ordered_sample(spark, 16_000), {b"agrook$", b"bgrook$"}
    windows = training_windows(sample, markers, 40)
    hot = [w for words, labels in windows for w, y in zip(words, labels, strict=True) if y]
    assert len(windows) == 24_000
    assert min(hot.count(b"agrook"), hot.count(b"bgrook")) >= 4_000
    few = training_windows(sample, markers, 40, 1_000)
    late = sum(words[0].startswith(b"b") for words, _ in few)
    assert len(few) == 1_000 and 400 < late < 600
    assert few == training_windows(sample.repartition(3), markers, 40, 1_000)


def test_toxic_words_of_the_last_rows_are_learnt(spark, monkeypatch):
    from pyspark.sql import functions as F
    from tidepool.llm import toxicity
    monkeypatch.setattr(toxicity, "WINDOWS", 300)
    docs = ordered_sample(spark, 2_000).withColumn("doc_id", F.monotonically_increasing_id())
    field = fit_toxicity(docs, docs.select("doc_id", F.col("_label").alias("toxic")), text_col="_text")
    _, marginals = Tagger(field).tag([[b"bplain1", w, b"bplain2"] for w in (b"agrook", b"bgrook", b"bplain3")])
    assert marginals[0][1] > 0.5 and marginals[1][1] > 0.5 > marginals[2][1]


def test_labels_of_other_rows_do_not_matter_and_edges(spark):
    rows, labels = corpus(random.Random(7), 300)
    docs = spark.createDataFrame([*rows, (None, None), (None, ""), (5000, "tora " * 30_000), (1, "tora")],
                                 "doc_id long, text string").selectExpr("*", "1 as score", "'x' as spans")
    known = spark.createDataFrame([*labels, (None, 1), (7, None), (99999, 1)], "doc_id long, toxic int")
    got = score_toxicity(docs, fit_toxicity(docs, known)).collect()
    assert len(got) == 304
    empty = {r.score for r in got if r.doc_id is None}
    assert len(empty) == 1 and empty.pop() < 0.3
    assert [r.predicted for r in got if r.doc_id == 5000] == [0]
    field = fit_toxicity(docs, known.limit(0))
    assert {r.score for r in score_toxicity(docs.limit(3), field).collect()} == {0.5}
    assert score_toxicity(docs.limit(0), field).collect() == []
    assert field.weights.shape == (DIMS,) and text_words("É a-B".encode()) == ["É".encode(), b"a", b"b"]


def test_a_text_that_is_kept_is_sent_once(spark):
    rng = np.random.default_rng(8)
    field = Field(rng.normal(0, 2, DIMS).astype(np.float32), np.zeros((2, 2)), np.array([-1.0, 0.5, 0.3, 0.1]))
    rows = [(k, t, k * 2) for k, t in enumerate(["some words here", None, "", "Other words, and\nmore", "x"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, other long")
    plain = {r.doc_id: r for r in score_toxicity(df, field).collect()}
    kept = score_toxicity(df, field, keep=["other", "text"])
    got = {r.doc_id: r for r in kept.collect()}
    assert {k: (r.score, r.predicted, r.spans) for k, r in got.items()} == {
        k: (r.score, r.predicted, r.spans) for k, r in plain.items()}
    assert [(k, got[k].text, got[k].other) for k in sorted(got)] == rows
    assert not re.search(r"\b_text#", kept._jdf.queryExecution().analyzed().toString())
    coded = df.select("doc_id", df.text.cast("binary").alias("text"))
    assert {r.doc_id: r.score for r in score_toxicity(coded, field, keep=["text"]).collect()} == {
        k: r.score for k, r in plain.items()}
