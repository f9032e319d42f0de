import pytest


@pytest.fixture
def docs(spark):
    def make(texts, first=0):
        return spark.createDataFrame([(i + first, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")

    return make
