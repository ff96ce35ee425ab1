"""Queries on booked positions aggregate the lines to bars once."""

from catalog import trading_queries
from catalog.tables import Tables
from tickerloom.session import pin_semantics


def test_booked_positions_and_curves_read_stored_bars(spark):
    tables = Tables(pin_semantics(spark), "/root/testdata/sf0.001")
    lazy = {tuple(row) for row in tables.bars.collect()}
    equity, log = trading_queries.curves(tables)
    assert {tuple(row) for row in tables.bars.collect()} == lazy
    for df in (equity, log):
        assert "lineitem" not in str(df.inputFiles()) and df.count() > 0
