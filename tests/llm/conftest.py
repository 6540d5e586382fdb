import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _row string, blob int, rank int"


def passage(n, start=0):
    words = WORDS.split()
    return " ".join(words[(start + i * i + i // 7) % len(words)] + str((start * 31 + i) % 97) for i in range(n))


def row(doc_id, text, lang="en", source="a"):
    # The last three have names that operators use inside.
    return (doc_id, text, lang, source, None if text is None else len(text), "x", 1, 2)


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, clashing names."""
    rows = [
        row(1, None),
        row(2, ""),
        row(3, " \t\n\x0b\x0c\r "),
        row(4, passage(60)),
        row(4, passage(60)),
        row(5, passage(60).upper()),
        row(6, passage(60), None, None),
        row(None, passage(40, 5)),
        row(None, None, None, None),
        row(7, passage(20_000, 3), "de", "b"),
        row(8, "one"),
        row(9, "ONE"),
        row(10, "token=abcdefgh1 é password: 'short' AKIAABCDEFGHIJKL" + "0123456789abcdef" * 3, "fr", "é"),
        row(11, "x\x00y   z\U0001f642" * 3, "fr", "b"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def stored(spark, odd, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    odd.coalesce(2).write.parquet(path)
    return spark.read.parquet(path)
