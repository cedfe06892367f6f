import pytest
from samples import COLUMNS, odd_rows


@pytest.fixture
def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), COLUMNS).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
