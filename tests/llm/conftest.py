from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import texts  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return texts.corpus() + texts.ODD


@pytest.fixture(scope="session")
def documents(spark, rows):
    return texts.table(spark, rows)


@pytest.fixture(scope="session")
def nothing(spark):
    return texts.table(spark, [])
