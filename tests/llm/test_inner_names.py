"""Stages leave columns alone that are called like their inner ones."""

import pytest
from fixtures import INNER, documents
from pyspark.sql import functions as F

from larder.llm import phrases, simhash, suffixes, toxicity


def marked(spark):
    docs = documents(spark).drop("fp", "tie", "shard").where("doc_id is not null").dropDuplicates(["doc_id"])
    return docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in INNER})


STAGES = {
    "decontaminate": lambda d, s: phrases.decontaminate(d, s.createDataFrame([("i", "nothing of this kind stands in any of the documents here at all")], "item_id string, text string"), 10),
    "one_of_each": lambda d, s: simhash.one_of_each(d, 3, 3),
    "without_repeats": lambda d, s: suffixes.without_repeats(d, 200),
    "without_toxic": lambda d, s: toxicity.without_toxic(d, toxicity.fit(d, d.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic")))),
}


@pytest.mark.parametrize("name", sorted(STAGES))
def test_columns_called_like_inner_ones_keep_their_values(spark, name):
    docs = marked(spark)
    out = STAGES[name](docs, spark)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in INNER)
