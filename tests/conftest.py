import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vertexrank.session import build_session, checkpoint_dir  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("warehouse")
    s = build_session(
        "local[4]", app_name="vertexrank-tests", shuffle_partitions=2, extra={"spark.sql.warehouse.dir": f"file://{folder}"}
    )
    checkpoint_dir(s)
    yield s


@pytest.fixture
def edges(spark):
    def make(pairs, dtype="string"):
        return spark.createDataFrame(pairs, f"src {dtype}, dst {dtype}")

    return make


def as_dict(df, key="vertex", value="rank", digits=None):
    """``{vertex: rank}``; rounded only when ``digits`` is given."""
    if digits is None:
        return {r[key]: r[value] for r in df.collect()}
    return {r[key]: round(r[value], digits) for r in df.collect()}


class Approx(dict):
    """Expected ``{vertex: rank}`` compared within an absolute tolerance."""

    def __init__(self, values, tol=1e-6):
        super().__init__(values)
        self.tol = tol

    def __eq__(self, other):
        return set(self) == set(other) and all(abs(self[k] - other[k]) <= self.tol for k in self)

    __hash__ = None
