import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a documents table with further columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    def make(rows, clash=()):
        df = spark.createDataFrame([(i, t, "en", "s0", len(t or "")) for i, t in rows], DOCS).repartition(3)
        for name in clash:
            df = df.withColumn(name, F.lit("x"))
        return df

    return make


@pytest.fixture
def passages():
    """Texts that share pieces of few passages, with repeats inside a text."""
    import random

    def make(seed, n=60, alphabet="abcdefg"):
        rnd = random.Random(seed)
        pool = [[rnd.choice(alphabet) for _ in range(30)] for _ in range(6)]
        out = []
        for i in range(n):
            words = []
            for _ in range(rnd.randint(0, 6)):
                piece, x = rnd.choice(pool), rnd.randint(0, 29)
                words += piece[x : rnd.randint(x, 30)]
                if rnd.random() < 0.3:
                    words.append(rnd.choice("xyz"))
            out.append((i, " ".join(words)))
        return out + [(100, None), (101, ""), (102, "a " * 80), (103, "\ta\n" * 81), (104, " ")]

    return make
