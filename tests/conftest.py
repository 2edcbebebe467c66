"""Shared session and helpers."""

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

from fellwalk.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def raster(spark):
    """A function that turns a 2-D array into a cell table; NaN is no data."""

    def build(array, partitions=2, keep=None):
        import numpy as np

        rows = [
            (int(c), int(r), None if np.isnan(array[r, c]) else float(array[r, c]))
            for r in range(array.shape[0])
            for c in range(array.shape[1])
            if keep is None or keep[r, c]
        ]
        return spark.createDataFrame(rows, "col int, row int, z double").repartition(partitions)

    return build


def grid_of(df, value, shape):
    """The 2-D array of a cell table."""
    import numpy as np

    out = np.full(shape, np.nan)
    for r in df.collect():
        if r[value] is not None:
            out[r["row"], r["col"]] = r[value]
    return out
