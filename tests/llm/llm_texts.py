"""Made texts for the tests."""


def sentence(rng, words=40):
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(words))


def docs_frame(spark, texts, first=0):
    return spark.createDataFrame(
        [(first + i, t) for i, t in enumerate(texts)], "doc_id bigint, text string"
    )
