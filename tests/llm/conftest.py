import pytest

from tidemark.staging import Staging

LONG = "Word of a long text that goes on, and on. " * 1500
#: A null id, null and empty texts, ties, repeated rows, a long text, nulls elsewhere.
AWKWARD = [
    (1, "Plain words stand here for a while, in one line.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \n\t ", "de", "b"),
    (5, "Plain words stand here for a while, in one line.", "en", "b"),
    (5, "Plain words stand here for a while, in one line.", "en", "b"),
    (None, "Plain  words stand here for a while,\nin one line.", None, "c"),
    (None, None, None, None),
    (6, LONG, "en", "c"),
    (7, "ünï çödé 中文 🙂 'tis don't 12.5", "fr", None),
    (8, "x", None, "a"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use themselves.
CLASHES = "row id kept score component_id keep_id spans found doc body n _row _id _text _doc _number _gone words places".split()


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with every awkward case and columns of clashing names."""
    df = spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)
    return df.selectExpr("*", *[f"'{name}' AS `{name}`" for name in CLASHES]).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)


@pytest.fixture
def staging(spark):
    return Staging(spark)
