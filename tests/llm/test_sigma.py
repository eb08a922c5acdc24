"""Greek capitals whose lower case depends on what follows the word."""

from kalendria.llm import decontamination


def test_a_shared_span_is_found_whatever_follows_a_sigma(spark):
    span = "w1 w2 w3 w4 \u039f\u0394\u039f\u03a3{}\u0391\u039b\u03a6\u0391 w7 w8 w9 w10"
    docs = spark.createDataFrame([(1, f"some text {span.format('.')} and more")], "doc_id long, text string")
    items = spark.createDataFrame([(7, span.format(" "))], "item_id long, text string")
    got = decontamination.find_leaks(docs, items).first()
    assert list(got["item_ids"]) == ["7"]
