"""The derived inputs hold their whole tables."""

import pytest

from tagwright.plans.views import view
from tests.oracle import SF_DIR


@pytest.mark.parametrize("name", ["token_obs", "tiles", "row_obs"])
def test_a_view_holds_every_line(spark, name):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    assert view(spark, SF_DIR, name).count() == lines.count()
