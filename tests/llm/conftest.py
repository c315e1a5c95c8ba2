import pytest
from pyspark.sql import functions as F

WEIRD = [
    (1, "one two three four five six\nline b\nline c\nline d", "en", "s1", 3),
    (2, "line b\nline c\nline d\nother text here", "en", "s1", 3),
    (3, None, "en", None, None),
    (4, "", None, "s2", 0),
    (5, " \n \n \n \n", "en", "s2", 0),
    (5, "a second text of one id a second text of one id", "en", "s2", 0),
    (6, "same row same row same row", "de", "", 1),
    (6, "same row same row same row", "de", "", 1),
    (None, "no id at all but some words follow here", "en", "s1", 2),
    (7, "ünï cödé # $ %   and\x1fsep 　 wide words", "fr", "é", 2),
    (8, "word " * 60000 + "end", "en", "s1", 9),
    (9, "a a a a a a a\na\na\na\na\na", "en", "s3", 1),
]
#: Names that the operators use inside.
CLASH = ("h", "th", "pos", "n", "at", "first", "sid", "size", "p", "rn", "bucket", "host", "rule", "score", "label", "features", "cell", "block", "words")


@pytest.fixture(scope="session")
def weird(spark):
    df = spark.createDataFrame(WEIRD, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    return df.withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    from tilerank.llm.common import prepare

    prepare(spark)
