"""Documents for the tests of this folder."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, shard int, doc string"


def docs_frame(spark, rows):
    """Documents with columns of names that operators use themselves."""
    full = [(i, t, *(rest or ("en",)), "s", len(t or ""), 5, "x") for i, t, *rest in rows]
    return spark.createDataFrame(full, DOCS)


def sentence(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))
