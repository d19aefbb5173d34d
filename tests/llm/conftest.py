import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs(spark):
    """docs(rows of (doc_id, text, source)) with columns that clash with names the operators use."""
    def make(rows):
        rows = [(*r, *[None] * (3 - len(r))) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        return df.selectExpr("doc_id", "text", "source", "'en' AS lang", "length(text) AS n_chars", "1 AS score", "'x' AS stats", "0 AS key",
                             "false AS kept", "7 AS node", "9 AS _mix", "'h' AS host")
    return make


@pytest.fixture(scope="session")
def given(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")
