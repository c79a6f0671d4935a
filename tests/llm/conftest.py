import pytest

#: Cases that every operator must take: nulls, empty and very long texts, repeats.
TEXTS = [
    (1, "The cat sat on the mat. It was a good day.", "en", "a", 42),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, "   \n\n  ", None, "", 5),
    (5, "the cat sat on the mat. It was a good day." * 1, "en", "a", 42),
    (6, "The cat sat on the mat. It was a good day.", "en", "a", 42),
    (6, "The cat sat on the mat. It was a good day.", "en", "a", 42),
    (None, "No id here, but words all the same.", "en", "a", 35),
    (7, "word " * 60_000, "en", "c", 300_000),
    (8, "x" * 200_000, "fr", "c", 200_000),
    (9, "Élan été naïve ça où 日本語 123 ###", "fr", "b", 33),
]
#: Names that clash with columns that operators make.
CLASHES = ["id", "h", "fp", "size", "score", "n_words", "hits", "items", "text_hash", "component_id", "at", "bucket", "key", "n", "t", "shard"]


@pytest.fixture(scope="session")
def docs(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit(f"clash {c}") for c in CLASHES}).repartition(3)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def corpus(spark):
    """400 labelled documents: junk lines, slurs and two languages by fixed rules."""
    rows, labels = [], []
    for i in range(400):
        en = i % 2 == 0
        words = "the of and ring house water thing under stone river" if en else "le la et dans maison pierre eau chose sous fleuve"
        w = words.split()
        lines = [" ".join(w[(i * 7 + j * 3 + k) % 10] for k in range(8)).capitalize() + "." for j in range(4)]
        bad, toxic = i % 5 == 1, i % 5 == 2
        if bad:
            lines[1:] = ["Buy### now%%% here&&& " * 4, "| a | b | c | d |"] * 2
        if toxic:
            lines[2] = lines[2][:-1] + (" you stupid idiot." if en else " espèce vequdé.")
        rows.append((i, "\n".join(lines), "en" if en else "fr", f"s{i % 3}", 0))
        labels.append((i, 0 if bad else 1, 1 if toxic else 0))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
