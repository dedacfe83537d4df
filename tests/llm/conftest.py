import pytest


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty, blank and long texts, ties, repeated rows, clashing column names."""
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()
    long = " ".join(word[k * 7 % 20] + str(k % 311) for k in range(30_000))
    near = [f"w{k}" for k in range(120)]
    rows = [
        (0, "", "en", "a", 0), (1, None, None, None, None), (2, " \t\n ", "fr", "a", 4), (3, long, "en", "b", len(long)),
        (4, " ".join(near), "en", "a", 1), (5, " ".join([*near[:60], "other", *near[61:]]), "en", "a", 1),
        (6, " ".join(near).upper(), "de", "b", 1), (7, "Only three words", "en", None, 16), (8, "only THREE words", None, "a", 16),
        (9, "one\ntwo lines\none\n", "es", "a", 18), (9, "one\ntwo lines\none\n", "es", "a", 18), (None, "no id here, mail a.b@c.de", "en", "a", 5),
        (10, "ünï çödé 日本語 🎉 " * 40, "fr", "c", 1), (11, "12 34 *** $$$ %%%", "en", "c", 17),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("*", "1 AS key", "2 AS id", "'x' AS spans", "'y' AS `group`", "3 AS part", "4 AS block", "5 AS rule", "6 AS comp")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
