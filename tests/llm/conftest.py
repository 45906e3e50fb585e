import public_tokenizers
import pytest

#: NULLs in every column, empty and long texts, ties, repeated rows.
EDGE = [(1, "Alpha beta gamma delta epsilon zeta eta theta."), (1, "Alpha beta gamma delta epsilon zeta eta theta."), (2, None), (3, ""),
        (None, "x y"), (None, None), (4, " \t\n "), (5, "ab " * 8000), (6, "日本語" * 3000), (7, "</s> <s> [INST] <|endoftext|>"), (2, "tie of 2")]


@pytest.fixture()
def edge(spark):
    """Edge rows with extra columns whose names the operators use inside."""
    names = ("_text_hash", "_id", "_hash", "_range", "_ghost", "text_hash", "own_id", "id", "hash")
    rows = [(i, t, "x", 1, None, *(f"{n} {k}" for n in names)) for k, (i, t) in enumerate(EDGE)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, fp string, row int, n_tokens string, " + ", ".join(f"{n} string" for n in names))


@pytest.fixture()
def nothing(edge):
    return edge.where("false")


@pytest.fixture(scope="session")
def path():
    return public_tokenizers.path


def pytest_collection_modifyitems(items):
    """This test needs one worker twice, and Spark takes idle ones in turn: it goes first, as others leave more of them than it has tasks."""
    items.sort(key=lambda item: item.name != "test_a_workers_second_task_starts_warm")
