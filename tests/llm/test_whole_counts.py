"""What is learned comes from all rows, and plans stay small."""

from pyspark.sql import functions as F

from inkmeter.llm import imatch, pii


def test_every_candidate_fits_or_calibrates(spark):
    text = F.concat(F.lit("call 212 555 "), F.lpad((F.col("id") % 10000).cast("string"), 4, "0"), F.lit(" now"))
    docs = spark.range(24000).select(F.col("id").alias("doc_id"), F.concat(text, F.lit(" "), "id").alias("text"))
    finder = pii.Finder(pii.describe(docs))
    # Half of 24,000 candidates, by hash
    assert 11000 < finder.calibrated < 13000


def test_the_plan_does_not_grow_with_the_lexicons(spark):
    kept = spark.createDataFrame([(1,), (2,)], "term long")
    size = {}
    for n in (2, 32):
        make = imatch.Fingerprinter(kept, lexicon_bits=(4,) * n)
        df = make.columns(spark.createDataFrame([("a b",)], "text string"), "text", "print")
        assert len(df.first()["print"]) == n
        size[n] = df._jdf.queryExecution().analyzed().toString().count("filter(")
    assert size[2] == size[32]
