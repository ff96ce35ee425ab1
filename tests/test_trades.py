"""Trades, cash and equity against a plain row-by-row simulation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerloom.operators import cash, risk, trades


def market(spark):
    draw = np.random.default_rng(4)
    rows = []
    for ticker in ("A", "B", "C", "D"):
        price = 100.0
        for date in pd.date_range("2024-01-01", periods=80).date:
            price *= 1 + draw.normal(0, 0.03)
            if draw.random() < 0.8:
                tone = draw.normal(0, 0.3)
                rows.append((ticker, date, price, int(draw.random() < 0.6), float(draw.random()), int(draw.integers(0, 3)), tone))
    names = ["ticker", "date", "close", "pred_direction", "pred_confidence", "article_count", "headline_vader_compound_mean"]
    data = pd.DataFrame(rows, columns=names)
    return spark.createDataFrame(data), data.sort_values(["date", "ticker"], ignore_index=True)


def simulate(data, strategy):
    """Rows in date and ticker order, one portfolio."""
    cash, held, log, last, curve = 100000.0, {}, [], {}, {}
    for row in data.itertuples(index=False):
        last[row.ticker] = row.close
        if strategy == "sentiment_momentum":
            enter, side, sure = row.pred_confidence >= 0.6 and row.pred_direction == 1, 1, row.pred_confidence
            days = 5
        else:
            tone = row.headline_vader_compound_mean
            enter, side, sure = row.article_count >= 1 and abs(tone) >= 0.05, 1 if tone > 0 else -1, min(abs(tone) * 2, 1.0)
            days = 3
        if row.ticker in held:
            side0, quantity, price, since, cost = held[row.ticker]
            if (row.date - since).days >= days:
                pnl = side0 * (row.close - price) * quantity
                cash += cost + pnl
                log.append((row.ticker, since, row.date, pnl))
                del held[row.ticker]
        elif enter:
            quantity = min(cash * 0.02 * sure / row.close, cash * 0.1 / row.close)
            held[row.ticker] = (side, quantity, row.close, row.date, quantity * row.close)
            cash -= quantity * row.close
        curve[row.date] = cash + sum(
            q * (p + s * (last[t] - p)) for t, (s, q, p, _, _) in held.items()
        )
    return log, curve


@pytest.mark.parametrize("strategy", [trades.sentiment_momentum(), trades.news_volume(1, 0.05)])
def test_strategy_equals_simulation(spark, strategy):
    panel, data = market(spark)
    log, curve = simulate(data, strategy.name)
    taken = trades.positions(panel, strategy)
    events = trades.cash_events(taken)
    sized = trades.sized_positions(taken, events)
    ours = {(r["ticker"], r["entry_date"], r["exit_date"]): r["pnl"] for r in trades.trade_log(sized).collect()}
    assert len(log) > 20 and set(ours) == {entry[:3] for entry in log}
    for ticker, start, end, pnl in log:
        assert ours[(ticker, start, end)] == pytest.approx(pnl)
    equity = trades.equity_curve(sized, events, panel, [strategy.name])
    values = {row["date"]: row["value"] for row in equity.collect()}
    assert set(values) == set(curve)
    for date, value in curve.items():
        assert values[date] == pytest.approx(value)
    metrics = risk.performance_metrics(equity, trades.trade_log(sized)).first()
    assert metrics["num_trades"] == len(log)
    assert metrics["final_value"] == pytest.approx(curve[max(curve)])


@pytest.mark.parametrize("segment_dates,events_a_block", [(11, 25), (30, 12), (1024, 12)])
def test_cash_does_not_depend_on_blocks_and_segments(spark, segment_dates, events_a_block):
    panel, data = market(spark)
    both = [trades.sentiment_momentum(), trades.news_volume(1, 0.05)]
    taken = trades.positions(panel, both[0]).unionByName(trades.positions(panel, both[1]))
    events = cash.position_events(taken, trades.trade_return())
    rows = cash.book_events(events, 100000.0, segment_dates, events_a_block).toPandas()
    assert len(rows) == events.count()
    for strategy, own in rows.groupby("strategy"):
        now, costs = 100000.0, {}
        ordered = own.merge(
            events.where(F.col("strategy") == strategy).drop("strategy").toPandas(), on=["ticker", "date", "entry_date", "is_exit"]
        ).sort_values(["date", "ticker"])
        for row in ordered.itertuples(index=False):
            if row.is_exit:
                now += row.growth * costs.pop(row.ticker)
            else:
                costs[row.ticker] = now * row.share
                now -= costs[row.ticker]
                assert row.cost == pytest.approx(costs[row.ticker], rel=1e-11)
            assert row.cash == pytest.approx(now, rel=1e-11)


@pytest.mark.parametrize("block_rows", [1, 2, 7, 30])
def test_positions_do_not_depend_on_blocks(spark, block_rows):
    panel, data = market(spark)
    for strategy in (trades.sentiment_momentum(), trades.news_volume(1, 0.05), trades.news_volume(1, 0.0, holding_days=40)):
        whole = trades.positions(panel, strategy).collect()
        assert sorted(trades.positions(panel, strategy, block_rows).collect(), key=str) == sorted(whole, key=str)
        assert len(whole) > 3


def test_positions_equal_a_walk_along_each_ticker(spark):
    panel, data = market(spark)
    strategy = trades.news_volume(1, 0.0, holding_days=11)
    expected = []
    for ticker, rows in data.groupby("ticker"):
        since = None
        for row in rows.sort_values("date").itertuples(index=False):
            if since is not None:
                if (row.date - since).days >= 11:
                    expected.append((ticker, since, row.date))
                    since = None
            elif row.article_count >= 1:
                since = row.date
        if since is not None:
            expected.append((ticker, since, None))
    got = [(r.ticker, r.entry_date, r.exit_date) for r in trades.positions(panel, strategy).collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_no_trades_and_no_losses(spark):
    panel, _ = market(spark)
    never = trades.Strategy("never", "pred_confidence > 2", "1", "pred_confidence", 5)
    taken = trades.positions(panel, never)
    events = trades.cash_events(taken)
    sized = trades.sized_positions(taken, events)
    equity = trades.equity_curve(sized, events, panel, ["never"])
    row = risk.performance_metrics(equity, trades.trade_log(sized)).first()
    assert row["num_trades"] == 0 and row["total_return"] == 0 and row["sharpe_ratio"] == 0 and row["profit_factor"] == 0
