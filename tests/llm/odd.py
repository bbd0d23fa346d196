"""Odd inputs that every operator must take: nulls, empty and very long texts, repeated rows, clashing columns."""

from pyspark.sql import functions as F

CLASHING = ["id", "key", "d", "h", "n", "a", "b", "label", "size", "normal", "kept", "spans", "items", "sequence_id", "__gone", "bucket", "keep_id", "conv", "one"]
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
TEXTS = [
    None, "", "   \n\t ", "one", "Two words", "two words", "two  words", "...", "12 34", LONG, LONG, LONG + " tail", "<|im_end|>", "<|endoftext|> a",
    "ünï côdé 日本語 \U0001f600 text", "x" * 50_000, "a\x00b \x01 c", None, "",
]


def odd_docs(spark, texts=TEXTS):
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3] if len(texts) > 3 else "one"), (None, "no id"), (5, "another text of five")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "en")).select("*", *(F.lit("clash").alias(c) for c in CLASHING))


def empty_docs(spark):
    return odd_docs(spark).where("false")
