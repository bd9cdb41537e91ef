"""Small tables for the tests of the language-model operators."""

import os

SF = "/root/testdata/sf0.001"
SF_LARGER = "/root/testdata/sf0.01"
HAVE_TABLES = os.path.isdir(SF)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that operators use inside.
CLASHING = "id string, k1 string, k2 string, row string, score string, kept string, ids string, hash string, node string"


def documents(spark, texts):
    """Rows (doc_id, text); the other columns are null."""
    return spark.createDataFrame([(i, t, None, None, None) for i, t in texts], SCHEMA)


def clashing(spark, texts):
    """The same with columns whose names the operators use themselves."""
    names = [part.split()[0] for part in CLASHING.split(", ")]
    return spark.createDataFrame(
        [(i, t, *(f"{n}-{i}" for n in names)) for i, t in texts], f"doc_id bigint, text string, {CLASHING}"
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
