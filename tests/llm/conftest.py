"""Small documents with every awkward case, shared by the operator tests."""

import pytest

PARA = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix potions near an old stone bridge at dawn "


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    rows = [(1, PARA * 3, "x"), (2, PARA * 3, None), (3, None, "y"), (4, "", "y"), (5, " \n\t ", "y"), (6, "one", "z"),
            (7, "one", "z"), (7, "one", "z"), (8, PARA * 3 + "and one more closing remark", None), (None, "no id here", "q"),
            (9, "mail bob@example.com or +1 (555) 123-4567 now é🙂 10.0.0.1 and 4111 1111 1111 1111", "q"), (10, "w " * 30000, "q"),
            (11, "a" * 20000, "q"), (12, "\x00\x1c  </s><|endoftext|> [INST]", None)]
    names = "doc_id long, text string, id string, kept string, a string, n long, t string, key string, c string, g string"
    return spark.createDataFrame([(i, t, s, s, s, 1, s, s, s, s) for i, t, s in rows], names).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")
