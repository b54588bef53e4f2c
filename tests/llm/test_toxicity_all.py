"""Every label counts: words that only documents outside the first sample hold are learned, thresholds come from all texts kept apart."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotlens.llm import toxicity


def test_labels_beyond_the_sample_are_learned_from(spark):
    late = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) >= int(400 / 4000 * (1 << 30))  # not among the first 400
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"), F.lit("en").alias("lang"))
    word = F.when(F.col("toxic") == 0, "fine").when(late & (F.col("doc_id") % 4 == 1), "zorgle").otherwise("awful")
    docs = docs.withColumn("text", F.concat_ws(" ", F.lit("this is"), word, F.concat(F.lit("w"), F.col("doc_id").cast("string")))).repartition(4)
    model = toxicity.learn(docs.drop("toxic"), docs.select("doc_id", "toxic"), max_docs=400)
    asked = spark.createDataFrame([(1, "this is zorgle", "en"), (2, "this is fine", "en"), (3, "this is awful", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.score, r.flagged) for r in toxicity.classify(asked, model).collect()}
    assert got[1][0] > 0.5 and got[3][0] > 0.5 and got[2][0] < 0.5, got
    assert got[1][1] and not got[2][1] and set(model.thresholds) == {None, "en"}
