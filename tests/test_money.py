"""Sums beyond the range of a long."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.functions.money import grand_total
from tradeloom.plans.quality import amount_ranges


@pytest.fixture
def huge(spark):
    """Amounts that add up to more than 9.2e18 cents."""
    amount = F.lit(Decimal("9999999999999.99")).cast("decimal(15,2)")
    return spark.range(12_000, numPartitions=4).select(amount.alias("total_amount"), amount.alias("tax_amount"))


def test_grand_total_is_exact(huge):
    assert huge.agg(grand_total("total_amount")).first()[0] == Decimal("9999999999999.99") * 12_000


def test_ranges_of_huge_amounts(huge):
    row = amount_ranges(huge).first()
    assert row.avg_total_amount == Decimal("9999999999999.99") and row.total_records_validated == 12_000


def test_grand_total_of_nothing_is_null(huge):
    assert huge.where("false").agg(grand_total("total_amount")).first()[0] is None
