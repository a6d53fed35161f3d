from __future__ import annotations

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from eigenlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def matrix_frame(spark):
    """Build ``(row_id, features, ...)`` from a NumPy matrix and extra columns."""

    def build(matrix, partitions=3, **extra):
        rows = [
            (i, [float(v) for v in row], *[column[i] for column in extra.values()])
            for i, row in enumerate(np.asarray(matrix, dtype=float))
        ]
        types = {int: "bigint", float: "double", str: "string"}
        schema = "row_id bigint, features array<double>" + "".join(
            f", {name} {types[type(column[0])]}" for name, column in extra.items()
        )
        return spark.createDataFrame(rows, schema).repartition(partitions, "row_id")

    return build


def column(df, name, order="row_id"):
    return np.array([row[name] for row in df.orderBy(order).collect()])
