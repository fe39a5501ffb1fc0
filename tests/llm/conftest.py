import public_tokenizers
import pytest

TEXTS = [None, "", "   \n\t ", "a", "the cat sat", "the cat sat", "x" * 3000, "naïve café 日本 🎉 don't", "1 2 3 ###", "one two " * 2000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rows = [(i if i != 4 else None, t, "n", -1, 0.5, i) for i, t in enumerate(TEXTS)]
    rows.append(rows[5])
    return spark.createDataFrame(rows, "doc_id long, text string, node string, shard int, score double, size long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def tokens():
    return public_tokenizers.path
