import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from conftest_llm import as_docs, hard_docs, hard_rows, prose, same_rows as _same_rows  # noqa: E402, F401


@pytest.fixture(scope="session")
def same_rows():
    return _same_rows
