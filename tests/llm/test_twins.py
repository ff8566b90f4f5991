"""Queries of corpora next to their SQL twins."""

import pytest

from compare import compare, connect
from navspan.llm.oracles import ORACLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, sf_dir, name):
    problem, rows, _, _ = compare(spark, connect(sf_dir), sf_dir, name)
    assert problem is None and rows > 0
