"""Toxicity with label sets of any base rate."""

import numpy as np
import pytest
from test_small import prose

from pressmill.llm import toxicity


@pytest.mark.parametrize("tenths", [5, 8])
def test_terms_at_high_base_rates(spark, tenths):
    draw, rows = np.random.default_rng(6), []
    for i in range(600):
        words = prose(i, 60).split()
        for k in draw.integers(60, size=3 if i % 10 < tenths else 0):
            words[k] = "grumpel" + "abcdef"[int(draw.integers(6))]
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 < tenths)) for i in range(600)], "doc_id long, toxic int")
    index = toxicity.fit(docs, labels, train=lambda c: ~toxicity.held_out(c))
    assert index.value.terms.number
    kept = {r["doc_id"] for r in toxicity.drop_toxic(docs, index).collect()}
    assert kept == {i for i in range(600) if i % 10 >= tenths}
