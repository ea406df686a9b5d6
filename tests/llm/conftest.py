import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers(spark):
    from daycast.llm.common import on_workers
    on_workers(spark)


@pytest.fixture
def docs(spark):
    """Rows of (doc_id, text), with columns whose names the operators use themselves."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string").repartition(3)
        if not extra:
            return df
        return df.selectExpr("doc_id", "text", "'kept' AS hash", "1 AS pos", "'x' AS `a.b`", "2 AS ID", "3 AS __n", "4 AS N_Lines",
                             "5 AS n_tokens", "'f' AS fingerprint", "'s' AS score", "6 AS version", "7 AS spots")

    return make
