"""Toxicity when half of the labels are toxic."""

import random

from locusmill.llm import toxicity


def test_toxic_wording_is_kept_when_half_of_the_labels_are_toxic(spark):
    rng = random.Random(8)
    plain = [f"{a}{b}" for a in ("lor", "mip", "dol", "sit") for b in ("em", "sum", "or", "amet", "ira")]
    rows, labels = [], []
    for i in range(600):
        text = rng.choices(plain, k=30)
        if i % 2 == 0:
            text[rng.randrange(30)] = rng.choice(["grumblefink", "nastywort", "vexhollow"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 2 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs.where("doc_id < 500"), spark.createDataFrame(labels, "doc_id long, toxic int").where("doc_id < 500"))
    left = {r.doc_id for r in toxicity.without_toxic(docs.where("doc_id >= 500"), model).collect()}
    assert len([i for i in left if i % 2 == 0]) <= 2 and len([i for i in left if i % 2]) >= 48
