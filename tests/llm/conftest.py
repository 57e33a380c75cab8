import os
import sys

import pytest

from relaymart.llm.common import ship

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus(spark):
    """documents(rows) -> DataFrame, and the Python workers know the package."""
    ship(spark)
    return lambda rows, schema=DOCS: spark.createDataFrame(rows, schema)
