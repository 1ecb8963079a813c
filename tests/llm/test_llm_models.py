"""The classifiers: edge cases, learning on synthetic data, held-out accuracy; and the mixture's totals."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattloom.llm import quality_model as qm
from wattloom.llm.common import table
from wattloom.llm.mixing import Rates, fit_rates, mixed, mixing_report
from wattloom.llm.queries import labelled_domains


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = qm.learn(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert np.mean((model.score(x[3000:]) >= 0.5) == y[3000:]) > 0.97


def test_one_kind_of_label_gives_the_share():
    assert np.allclose(qm.learn(np.zeros((8, len(qm.FEATURES))), np.ones(8)).score(np.ones((2, len(qm.FEATURES)))), 0.9)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = qm.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    bad = [r for r in rows if r.quality == 0]
    good = [r for r in rows if r.quality == 1]
    assert np.mean([r.predicted for r in good]) > 0.95 and np.mean([r.predicted for r in bad]) < 0.2
    assert all(0 <= r.score <= 1 for r in rows)


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "word", 0.5), (3, "long " * 60_000, 0.5), (3, "long " * 60_000, 0.5)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, None), (1, 1), (3, 0), (3, 1), (None, 1), (99, 0)], "doc_id long, quality int")
    rows = qm.quality_scores(docs, labels).collect()
    assert len(rows) == 5 and len({r.score for r in rows if r.doc_id == 3}) == 1
    assert {r.doc_id: r.held_out for r in rows}[None] is True
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert qm.keep_good(docs, labels).columns == docs.columns
    for none in (docs, docs.limit(0)):
        assert {r.score for r in qm.quality_scores(none, labels.limit(0)).collect()} <= {0.5}


def test_the_sample_is_bounded_and_leaves_the_fold_out(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    sample = qm.training_sample(labels, 500)
    assert 400 < sample.count() <= 500 and sample.where(qm.held_out()).count() == 0


WORDS = {"a": "alpha amber apple arrow".split(), "b": "beta birch brown bridge".split()}


def texts():
    return [(i, " ".join(WORDS["ab"[i % 3 == 0]][(i + j) % 4] for j in range(20 + i % 7)), "ab"[i % 3 == 0], 1) for i in range(300)]


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_mixture_meets_its_targets(spark, least):
    docs = spark.createDataFrame([*texts(), (None, None, None, 1), (500, "", "a", 1)], "doc_id long, text string, lang string, rate int")
    labelled = docs.where("doc_id % 2 = 0 or doc_id is null").select("doc_id", F.col("lang").alias("domain"))
    rows = mixing_report(docs, labelled, {"b": 3, "a": 1, "c": 0}, least).collect()
    assert len(rows) == 302
    totals = np.sum([r.n_tokens * r.rate * np.array(r.posteriors) for r in rows], axis=0)
    assert abs(totals[1] / totals.sum() - 0.75) < 0.01
    assert all(least <= r.rate <= 8 and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    assert sum(r.domain != dict((t[0], t[2]) for t in texts()).get(r.doc_id, r.domain) for r in rows) == 0
    out = mixed(docs, labelled, {"b": 3, "a": 1}, least)
    assert out.columns == docs.columns and out.count() == sum(r.copies for r in rows)


def test_rates_solve_the_bounded_problem(spark):
    """The fitted totals are no worse than those of many random rates within the bounds."""
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.4] * 3, 200)
    tokens = rng.integers(1, 100, 200)
    members = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)], "n_tokens long, posteriors array<double>")
    goal = np.array([0.5, 0.3, 0.2]) * tokens.sum()
    totals = (tokens * fit_rates(members, [0.5, 0.3, 0.2], 0.0, 2.0).of(p)) @ p
    assert np.abs(totals - goal).max() < 2e-3 * tokens.sum()
    hard = fit_rates(members, [0.98, 0.01, 0.01], 0.5, 1.2)
    assert (hard.of(p) >= 0.5).all() and (hard.of(p) <= 1.2).all()
    assert Rates([], 1.0, 2.0).of(p).tolist() == [1.0] * 200


def test_mixing_without_rows_or_labels(spark):
    docs = spark.createDataFrame(texts()[:9], "doc_id long, text string, lang string, n int")
    labels = docs.select("doc_id", F.col("lang").alias("domain"))
    assert mixing_report(docs.limit(0), labels, {"a": 1, "b": 1}).collect() == []
    rows = mixing_report(docs, labels.limit(0), {"a": 1, "b": 1}).collect()
    assert all(r.posteriors == [0.5, 0.5] and abs(r.rate - 1) < 1e-6 for r in rows)


def test_labelled_table(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    assert labelled_domains(docs, labels).count() == labels.join(docs, "doc_id").count()


@pytest.mark.parametrize("least", [0.0, 1.0])
def test_scarce_domains_reach_their_targets(spark, least):
    """Domains of 1% with targets far above eight times that."""
    rng = np.random.default_rng(2)
    kinds = rng.choice(4, 4000, p=[0.95, 0.03, 0.01, 0.01])
    p = 0.94 * np.eye(4)[kinds] + 0.06 * rng.dirichlet([1.0] * 4, 4000)
    tokens = rng.integers(50, 150, 4000)
    members = spark.createDataFrame([(int(t), q.tolist()) for t, q in zip(tokens, p)], "n_tokens long, posteriors array<double>")
    goal = np.array([0.5, 0.2, 0.15, 0.15])
    rates = fit_rates(members, goal.tolist(), least)
    totals = (tokens * rates.of(p)) @ p
    assert rates.met and np.abs(totals / totals.sum() - goal).max() < 0.005 and (rates.of(p) >= least).all()
    assert rates.of(p).max() > 8


def test_a_missed_target_is_reported(spark):
    members = spark.createDataFrame([(100, [1.0, 0.0])] * 99 + [(100, [0.0, 1.0])], "n_tokens long, posteriors array<double>")
    rates = fit_rates(members, [0.5, 0.5], 0.0, 8.0)
    assert not rates.met and abs(rates.errors[1] + 0.42) < 0.01
    docs = spark.createDataFrame(texts(), "doc_id long, text string, lang string, rate int")
    with pytest.warns(UserWarning, match="b -"):
        mixed(docs, docs.select("doc_id", F.col("lang").alias("domain")), {"a": 1, "b": 19}, most=2.0)
