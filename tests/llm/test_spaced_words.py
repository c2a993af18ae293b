from test_models import toxic_rows

from ledgerloom.llm import toxicity


def test_words_of_spaced_runs_and_long_tokens(spark):
    docs, _ = toxic_rows()
    model = toxicity.log_model(toxicity.trigram_counts(spark.createDataFrame([(t,) for _, t, _ in docs], "text string")))
    r = toxicity.Restorer(model)
    far = " ".join("thehousestandsnearwater" * 30 + "moron")  # after letter 200, behind other words
    assert "moron" in r.spaced(far) and "house" in r.spaced(far)
    assert "idiot" in r.spaced("w i t h 1 d i o t") and r.spaced("x t h e y") != []
    assert r.spaced("the t h e house") == ["the"]  # a short run
    assert r.token(("-" * 12).join("idiot")) == "idiot"
    assert r.token("t" + "r" * 60 + "ash") == "trash"


def test_decoding_grows_with_length_alone(spark):
    model = toxicity.log_model(toxicity.trigram_counts(spark.createDataFrame([("the house stands near the water",)], "text string")))
    assert toxicity.decode("th3" * 20_000, model).startswith("thethethe")
