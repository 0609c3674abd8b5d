import pytest

CLASHING = ["n", "cls", "tokens", "token", "block", "kind", "seq", "idx", "shard", "slot", "home", "copies",
            "kept", "ratio", "component", "word", "size", "key", "part", "label"]


def prose(seed: int, n: int, vocabulary: int = 4000) -> str:
    """Reproducible words of random letters."""
    import numpy as np

    rng = np.random.default_rng(seed)
    letters = np.array(list("etaoinshrdlucmfwypvbgk"))
    words = ["".join(np.random.default_rng(int(w)).choice(letters, 3 + int(w) % 7)) for w in rng.integers(0, vocabulary, n)]
    return " ".join(words)


def tricky_rows() -> list[tuple]:
    """(doc_id, text, lang, source, n_chars): nulls everywhere, empty and long
    texts, ties, repeated rows, exact and near copies."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "a", 1), (2, base, "en", "a", 1), (3, near, "en", "b", 1),
        (4, "", "en", "b", 0), (5, None, None, None, None), (6, " \t\n ", "en", None, 4), (7, "one", "en", "c", 3),
        (8, "one two three four", "en", "c", 1), (9, "ONE two\tthree\nfour", "en", "c", 1),
        (10, prose(2, 3000), "de", "hot", 1), (11, "ab" * 4000, "en", "hot", 1), (12, "word " * 500, "en", "hot", 1),
        (None, prose(3, 40), "en", "a", 1), (14, "á é中 \U0001f600 <|endoftext|> don't", "fr", "a", 1),
    ]
    rows += [(100 + i, prose(50 + i, 30 + i), "en", "hot" if i % 3 else "a", 1) for i in range(40)]
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def tricky(spark):
    return spark.createDataFrame(tricky_rows(), SCHEMA).repartition(3, "lang")


@pytest.fixture(scope="session")
def clashing(tricky):
    from pyspark.sql import functions as F

    return tricky.withColumns({c: F.lit("x") for c in CLASHING})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows():
    return tricky_rows()


@pytest.fixture(scope="session")
def write_table(tmp_path_factory):
    """Write a frame as one of the driver's tables; returns the folder."""
    def write(df, name="documents"):
        folder = str(tmp_path_factory.mktemp("tables"))
        df.write.parquet(f"{folder}/{name}.parquet")
        return folder
    return write
