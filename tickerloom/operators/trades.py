"""Strategies as column rules, trade logs, cash and equity curves."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from tickerloom.functions import fixed_values as fixed
from tickerloom.functions.numeric import by_ticker, flag, running
from tickerloom.operators.cash import book_events, position_events


@dataclass(frozen=True)
class Strategy:
    """An entry rule as columns of the panel, and a holding period in calendar days.

    `enter`, `direction` (1 or -1) and `confidence` are SQL expressions, so a new
    strategy is three expressions and needs no Python in the row path.
    """

    name: str
    enter: str
    direction: str
    confidence: str
    holding_days: int


def sentiment_momentum(confidence: float = 0.6, holding_days: int = 5) -> Strategy:
    return Strategy(
        "sentiment_momentum",
        f"pred_confidence >= {confidence} AND pred_direction = 1",
        "pred_direction",
        "pred_confidence",
        holding_days,
    )


def news_volume(
    articles: int = 2, sentiment: float = 0.1, column: str = "headline_vader_compound_mean", holding_days: int = 3
) -> Strategy:
    return Strategy(
        "news_volume",
        f"article_count >= {articles} AND abs({column}) >= {sentiment}",
        f"CASE WHEN {column} > 0 THEN 1 ELSE -1 END",
        f"least(abs({column}) * 2, 1D)",
        holding_days,
    )


# Rows a ticker's chain is cut into; a ticker's blocks are bounded by the calendar.
BLOCK_ROWS = 256


def positions(panel: DataFrame, strategy: Strategy, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Positions a strategy takes, one after the other per ticker.

    A position opens on the first row that meets the rule while none is open, and closes
    on the first row at least `holding_days` later, a row that opens none itself. The
    closing row is among the next `holding_days` rows, as a ticker has one row per day.
    Open ends have a null `exit_date`.

    What a ticker holds is a number of rows until it is flat, so each row is a map of a few
    states to themselves, and maps compose in any grouping. A block of `block_rows` rows is composed to one
    map, the maps of the earlier blocks give the state a block begins with, and the block then
    tells its own entries: no array is longer than a block or than a ticker's blocks.
    """
    window = by_ticker()
    holding = strategy.holding_days
    due = F.date_add(F.col("date"), holding)
    ahead = [
        F.struct(F.lit(k).alias("rows"), F.lead("date", k).over(window).alias("date"), F.lead("close", k).over(window).alias("close"))
        for k in range(1, holding + 1)
    ]
    closing = F.coalesce(*[F.when(row["date"] >= due, row) for row in ahead])
    rows = panel.withColumns(
        {"_closing": closing, "_enter": flag(F.expr(strategy.enter)) == 1, "_number": F.row_number().over(window) - 1}
    ).select(
        "ticker",
        F.floor(F.col("_number") / block_rows).alias("_block"),
        F.struct(
            F.col("date").alias("entry_date"),
            # Rows until flat again after an entry here; one more than any if it never is.
            F.when(F.col("_enter"), F.coalesce(F.col("_closing.rows"), F.lit(holding + 1))).otherwise(0).alias("held"),
            # Only rows that may enter carry a position.
            F.when(
                F.col("_enter"),
                F.struct(
                    F.col("_closing.date").alias("exit_date"),
                    F.col("close").alias("entry_price"),
                    F.col("_closing.close").alias("exit_price"),
                    F.expr(strategy.direction).cast("int").alias("direction"),
                    F.expr(strategy.confidence).cast("double").alias("confidence"),
                ),
            ).alias("position"),
        ).alias("_row"),
    )

    def follow(state: Column, row: Column) -> Column:
        """The state behind a row; the last state, an open end, stays."""
        return F.when(state == 0, row["held"]).when(state > holding, state).otherwise(state - 1)

    blocks = rows.groupBy("ticker", "_block").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    states = F.sequence(F.lit(0), F.lit(holding + 1))
    mapped = blocks.withColumn("_map", F.transform(states, lambda start: F.aggregate("_rows", start, follow)))
    earlier = Window.partitionBy("ticker").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    maps = F.collect_list("_map").over(earlier)
    begun = mapped.withColumn("_state", F.aggregate(maps, F.lit(0), lambda state, block: F.get(block, state)))
    chosen = F.aggregate(
        "_rows",
        F.struct(F.col("_state").alias("state"), F.filter("_rows", lambda row: F.lit(False)).alias("taken")),
        lambda held, row: F.struct(
            follow(held["state"], row).alias("state"),
            F.when((held["state"] == 0) & (row["held"] > 0), F.concat(held["taken"], F.array(row)))
            .otherwise(held["taken"])
            .alias("taken"),
        ),
    )["taken"]
    taken = begun.select("ticker", F.explode(chosen).alias("_row"))
    return taken.select(F.lit(strategy.name).alias("strategy"), "ticker", "_row.entry_date", "_row.position.*").select(
        "strategy", "ticker", "entry_date", "exit_date", "entry_price", "exit_price", "direction", "confidence"
    )


def trade_return() -> Column:
    """Profit per unit of entry value: long (x - e)/e, short (e - x)/e."""
    return F.col("direction") * (F.col("exit_price") - F.col("entry_price")) / F.col("entry_price")


def cash_events(taken: DataFrame, initial_capital: float = fixed.INITIAL_CAPITAL) -> DataFrame:
    """Cash after every position event, and the position's entry cost: 2 % of the cash at that
    moment scaled by confidence, at most 10 %; an exit returns the cost with its profit."""
    return book_events(position_events(taken, trade_return()), initial_capital)


def sized_positions(taken: DataFrame, events: DataFrame) -> DataFrame:
    """Positions with quantity and, once closed, profit and return."""
    costs = events.where(~F.col("is_exit")).select("strategy", "ticker", "entry_date", "cost")
    gain = trade_return()
    return (
        taken.join(costs, ["strategy", "ticker", "entry_date"])
        .withColumns(
            {
                "quantity": F.col("cost") / F.col("entry_price"),
                "pnl": gain * F.col("cost"),
                "return": gain,
            }
        )
        .drop("cost")
    )


def trade_log(sized: DataFrame) -> DataFrame:
    return sized.where(F.col("exit_date").isNotNull()).select(
        "strategy", "ticker", "direction", "quantity", "entry_price", "exit_price", "entry_date", "exit_date", "pnl", "return"
    )


def _carried_total(changes: DataFrame) -> DataFrame:
    """Running total of value changes per (strategy, date): last known prices carry on."""
    per_date = changes.groupBy("strategy", "date").agg(F.sum("change").alias("change"))
    in_order = running(Window.partitionBy("strategy").orderBy("date"))
    return per_date.select("strategy", "date", F.sum("change").over(in_order).alias("position_value"))


def equity_curve(
    sized: DataFrame,
    events: DataFrame,
    bars: DataFrame,
    names: list[str],
    initial_capital: float = fixed.INITIAL_CAPITAL,
) -> DataFrame:
    """Cash plus the value of open positions, per strategy in `names` and day of the bars.

    A ticker's bar knows the position last opened on or before it, so positions meet
    bars in an equi-join and a window, not in a range join. A day's value is the running
    total of value changes, which keeps a ticker without a bar at its last close.
    """
    prices = bars.select("ticker", "date", "close")
    held_tickers = sized.select("strategy", "ticker").distinct()
    opened = sized.select(
        "strategy",
        "ticker",
        F.col("entry_date").alias("date"),
        F.struct("entry_date", "exit_date", "entry_price", "direction", "quantity").alias("opened"),
    )
    in_order = Window.partitionBy("strategy", "ticker").orderBy("date")
    marked = (
        prices.join(held_tickers, "ticker")
        .join(opened, ["strategy", "ticker", "date"], "left")
        .withColumn("opened", F.last("opened", ignorenulls=True).over(running(in_order)))
    )
    p = F.col("opened")
    is_open = p["exit_date"].isNull() | (F.col("date") < p["exit_date"])
    worth = p["quantity"] * (p["entry_price"] + p["direction"] * (F.col("close") - p["entry_price"]))
    valued = marked.withColumn("worth", F.coalesce(F.when(is_open, worth), F.lit(0.0)))
    changes = valued.select(
        "strategy",
        "date",
        (F.col("worth") - F.coalesce(F.lag("worth", 1).over(in_order), F.lit(0.0))).alias("change"),
    )
    position_value = _carried_total(changes)
    closing_cash = events.groupBy("strategy", "date").agg(F.max_by("cash", "ticker").alias("cash"))
    calendar = bars.select("date").distinct().select("date", F.explode(F.array(*[F.lit(name) for name in names])).alias("strategy"))
    curve_order = running(Window.partitionBy("strategy").orderBy("date"))
    return (
        calendar.join(position_value, ["strategy", "date"], "left")
        .join(closing_cash, ["strategy", "date"], "left")
        .select(
            "strategy",
            "date",
            # To a millionth: an entry moves cash into a position, and its float noise is no loss.
            F.round(
                F.coalesce(F.last("cash", ignorenulls=True).over(curve_order), F.lit(initial_capital))
                + F.coalesce(F.last("position_value", ignorenulls=True).over(curve_order), F.lit(0.0)),
                6,
            ).alias("value"),
        )
    )


def buy_and_hold_curve(bars: DataFrame, initial_capital: float = fixed.INITIAL_CAPITAL) -> DataFrame:
    """Equal amounts in every ticker at its first close; a missing close carries on."""
    window = by_ticker()
    tickers = bars.agg(F.count_distinct("ticker")).scalar()
    first = F.first("close").over(running(window))
    shares = F.lit(initial_capital) / tickers / first
    changes = bars.select(
        F.lit("buy_hold_benchmark").alias("strategy"),
        "date",
        (shares * (F.col("close") - F.coalesce(F.lag("close", 1).over(window), F.lit(0.0)))).alias("change"),
    )
    return _carried_total(changes).withColumnRenamed("position_value", "value")


def trade_statistics(log: DataFrame) -> DataFrame:
    """Wins, losses, mean, best, worst and holding days per strategy."""
    x = F.col("return")
    held = log.withColumn("holding_days", F.date_diff("exit_date", "entry_date"))
    # Holding days are whole numbers near the rule's period: few distinct values.
    return held.groupBy("strategy").agg(
        F.count("*").alias("num_trades"),
        F.count_if(x > 0).alias("winning_trades"),
        F.count_if(x < 0).alias("losing_trades"),
        F.avg(x).alias("avg_return"),
        F.max(x).alias("best_return"),
        F.min(x).alias("worst_return"),
        F.avg("holding_days").alias("avg_holding_days"),
        F.median("holding_days").alias("median_holding_days"),
    )


def trade_statistics_by_ticker(log: DataFrame) -> DataFrame:
    x = F.col("return")
    return log.groupBy("strategy", "ticker").agg(
        F.count("*").alias("num_trades"),
        F.bround(F.avg(x), 4).alias("avg_return"),
        F.bround(F.sum(x), 4).alias("total_return"),
    )
