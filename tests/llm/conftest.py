"""Brute-force helpers beside the tests can be imported by name; the session has a shared folder."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from fellwalk.llm.common import settle_llm  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    settle_llm(spark)
