"""Training goes on while the likelihood gains."""

import numpy as np

from cinetally.llm import language_model


def test_training_goes_on_until_it_hardly_gains(spark):
    rng = np.random.default_rng(4)
    texts = [[int(v) for v in (np.arange(n) // 5 + rng.integers(0, 2, n)) % 6] for n in rng.integers(20, 60, 200)]
    df = spark.createDataFrame([(t,) for t in texts], "symbols array<smallint>").coalesce(3)
    lengths, values = np.array([len(t) for t in texts]), np.concatenate(texts)
    share = np.full(6, 1 / 6)
    model = language_model.train(df, share)
    before = language_model.forward(model, lengths, values).sum()
    counts, likelihood = language_model.counts_and_likelihood(model, lengths, values)
    assert np.isclose(likelihood, before)
    model.fitted(counts, share)
    assert language_model.forward(model, lengths, values).sum() - before < 2 * language_model.LEAST_GAIN * abs(before)
    four = language_model.Model(share)
    for _ in range(4):
        four.fitted(language_model.expected_counts(four, lengths, values), share)
    assert before > language_model.forward(four, lengths, values).sum() * (1 - 1e-2)
