"""op4 learns from every labelled document, broadcast or shuffled; its percentile is exact."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventweave.llm import quality
from eventweave.llm.frames import percentile

WORDS = ["river", "stone", "window", "garden", "paper", "winter", "letter", "market"]


def _tables(spark, rows=400):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(WORDS[:6] if i % 2 else WORDS[2:], 40)) + f" n{i}" for i in range(rows)]
    docs = spark.createDataFrame([*enumerate(texts), (None, "no id"), (7, texts[7])], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(rows)], "doc_id long, quality int")
    return docs, labels, texts


def test_more_labels_than_are_broadcast_give_the_same_model(spark):
    docs, labels, _ = _tables(spark)
    few, many = quality.fit(docs, labels), quality.fit(docs, labels, broadcast_labelled=10)
    assert few.threshold == many.threshold and (few.weights == many.weights).all()


def test_every_labelled_document_counts(spark):
    docs, labels, texts = _tables(spark)
    model = quality.fit(docs, labels, broadcast_labelled=10)
    half = {r[0]: r[1] for r in labels.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(2))).collect()}

    def counts(some):
        data = [t.encode() for t in some]
        return np.bincount(quality.gram_buckets(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))[0], minlength=quality.BUCKETS)

    raw = counts([*texts, "no id", texts[7]])
    target = counts([t for i, t in [*enumerate(texts), (7, texts[7])] if i % 2 and half[i] == 0])
    prior = (raw + 1) / (raw.sum() + quality.BUCKETS)
    weight = 0.1 * target.sum()
    ratio = np.log((target + weight * prior) / (target.sum() + weight)) - np.log(prior)
    assert (model.weights == np.round(np.clip(ratio, -8, 8) / quality.UNIT)).all()


@pytest.mark.parametrize("share", [0.0, 0.001, 0.25, 0.5, 1.0])
def test_percentile_is_that_of_spark(spark, share):
    rng = np.random.default_rng(5)
    values = [float(x) for x in np.concatenate([rng.normal(size=500), np.zeros(100), [1e300, -1e300, 1e-300]])]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert percentile(df, "v", share) == df.agg(F.percentile("v", share)).first()[0]


def test_percentile_of_nothing(spark):
    assert percentile(spark.createDataFrame([], "v double"), "v", 0.5) is None
