"""Event-grain features: trailing windows and first-purchase cohorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch import schema
from tidewatch.functions.values import is_type, paid, paid_beyond

_SECOND = 10 ** 6
_DAY = 86400 * _SECOND
_BUSY_PARTS = 100_000
_METRICS = ("events", "purchases", "revenue", "beyond", "priced")


def rolling_aggregations(
    events: DataFrame,
    days: Sequence[int] = tuple(schema.ROLLING_DAYS),
    busy_rows: int = 1_000_000,
    slice_seconds: int = 900,
    busy_parts: int = _BUSY_PARTS,
) -> DataFrame:
    """Events, purchases and revenue of the customer's trailing N days, per event.

    The frame of an event at `t` is `[t - N days, t]`, both ends included, so events
    of the same instant share one result. Each value is a running total up to `t`
    minus a running total up to just before `t - N days`: both only ever add rows,
    where a frame that slides would be summed again for every row.

    A customer with more than `busy_rows` events, and more than one event in
    `busy_parts` of the table, is too much for one window task and is cut into time slices.
    """
    ordinary, busy = _split_busy(events, busy_rows, busy_parts)
    return _by_customer(ordinary, days).unionByName(_by_slice(busy, days, slice_seconds))


def _split_busy(events: DataFrame, busy_rows: int,
                busy_parts: int = _BUSY_PARTS) -> tuple[DataFrame, DataFrame]:
    """Events of ordinary customers and events of busy ones."""
    busy = F.broadcast(_busy_customers(events, busy_rows, busy_parts))
    same = events["customer_id"].eqNullSafe(F.col("_busy"))
    return events.join(busy, same, "left_anti"), events.join(busy, same, "left_semi")


def _busy_customers(events: DataFrame, busy_rows: int, busy_parts: int,
                    *facts: Column) -> DataFrame:
    """Customers too large for one task, with aggregates of their events. There are fewer than
    `busy_parts` of them, whatever the size of the table, so the list can be broadcast.

    The table's size is the sum of the customers' counts, so both come from one pass.
    """
    counts = events.groupBy(F.col("customer_id").alias("_busy")).agg(F.count("*").alias("rows"), *facts)
    share = counts.agg(F.sum("rows") / busy_parts).scalar()
    return counts.where((F.col("rows") > busy_rows) & (F.col("rows") > share)).drop("rows")


def _by_customer(events: DataFrame, days: Sequence[int]) -> DataFrame:
    """Rolling values with one window partition per customer, sorted once."""
    kept = [f"`{name}`" for name in events.columns]
    rows = events.withColumns({"_revenue": paid(), "_beyond": paid_beyond()}).selectExpr(
        *kept, "_revenue", "_beyond", "1 AS _events", "CAST(_revenue IS NOT NULL AS INT) AS _priced",
        "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS _purchases")

    def total(metric: str, end: str) -> str:
        return (f"coalesce(sum(_{metric}) OVER (PARTITION BY customer_id "
                f"ORDER BY unix_micros(timestamp) "
                f"RANGE BETWEEN UNBOUNDED PRECEDING AND {end}), 0)")

    totals = rows.selectExpr(
        *kept,
        *[f"{total(metric, 'CURRENT ROW')} AS _{metric}" for metric in _METRICS],
        *[f"{total(metric, f'{n * _DAY + 1} PRECEDING')} AS _{metric}_before_{n}"
          for n in days for metric in _METRICS])
    # Events without a time see each other and nothing else.
    trailing = totals.selectExpr(*kept, *[
        f"_{metric} - CASE WHEN timestamp IS NULL THEN 0 ELSE _{metric}_before_{n} END "
        f"AS {metric}_{n}" for n in days for metric in _METRICS])
    return trailing.selectExpr(*kept, *[text for n in days for text in _results(n)])


def _by_slice(events: DataFrame, days: Sequence[int], slice_seconds: int) -> DataFrame:
    """Rolling values with one window partition per customer and time slice.

    Every (customer, instant) is first summed to one tick. A tick enters all windows
    at `t` and leaves window N after `t + N days`; a result is the total of entries
    minus exits since the start of the slice, plus the opening balance of the slice.
    """
    ticks = events.groupBy("customer_id", "timestamp").agg(
        F.count("*").alias("events"),
        F.count(F.when(is_type("purchase"), 1)).alias("purchases"),
        F.coalesce(F.sum(paid()), F.lit(0)).alias("revenue"),
        F.coalesce(F.sum(paid_beyond()), F.lit(0.0)).alias("beyond"),
        F.count(paid()).alias("priced"),
    )
    # Both users of the moves start from the same ticks, whose exchange they share.
    moves = _moves(ticks, days, slice_seconds)
    balances = _opening_balances(moves, days)

    # Balances have no time and sort first; exits sort after entries of their instant.
    timeline = ("OVER (PARTITION BY customer_id, slice ORDER BY at, window "
                "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    totals = (moves.unionByName(balances, allowMissingColumns=True)
              .selectExpr("customer_id", "timestamp", *[
                  f"sum(coalesce(opening.{metric}_{n}, {_change(metric, n)})) {timeline} "
                  f"AS {metric}_{n}"
                  for n in days for metric in _METRICS], "is_entry")
              .where("is_entry"))
    results = totals.selectExpr(
        "customer_id AS _customer", "timestamp AS _instant",
        *[text for n in days for text in _results(n)])
    same_tick = (events["customer_id"].eqNullSafe(F.col("_customer"))
                 & events["timestamp"].eqNullSafe(F.col("_instant")))
    return events.join(results, same_tick).drop("_customer", "_instant")


def _moves(ticks: DataFrame, days: Sequence[int], slice_seconds: int) -> DataFrame:
    """Each tick as one entry (`window` 0) and one exit per window size.

    Only entries carry the tick's own `timestamp`. Events without a time see each other and
    nothing else: their tick is an entry alone, in a slice of its own.
    """
    entry = F.struct(F.lit(0).alias("window"), F.unix_micros("timestamp").alias("at"),
                     F.col("timestamp").alias("timestamp"))
    exits = [F.struct(F.lit(n).alias("window"),
                      (F.unix_micros("timestamp") + n * _DAY).alias("at"),
                      F.lit(None).cast("timestamp").alias("timestamp")) for n in days]
    return (ticks.select("customer_id", *_METRICS, F.explode(F.array(entry, *exits)).alias("move"))
            .select("customer_id", *_METRICS, "move.*",
                    F.floor(F.col("move.at") / (slice_seconds * _SECOND)).alias("slice"))
            .where("at IS NOT NULL OR window = 0").withColumn("is_entry", F.expr("window = 0")))


def _change(metric: str, n: int) -> str:
    """What a move adds to the running total of window `n`."""
    return f"CASE WHEN window = 0 THEN {metric} WHEN window = {n} THEN -{metric} ELSE 0 END"


def _opening_balances(moves: DataFrame, days: Sequence[int]) -> DataFrame:
    """Per customer and slice, the totals of all earlier slices."""
    names = {f"{metric}_{n}": _change(metric, n) for n in days for metric in _METRICS}
    slices = moves.where("slice IS NOT NULL").groupBy("customer_id", "slice").agg(
        *[F.expr(f"sum({change}) AS {name}") for name, change in names.items()])
    earlier = ("OVER (PARTITION BY customer_id ORDER BY slice "
               "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    fields = ", ".join(f"'{name}', coalesce(sum({name}) {earlier}, 0)" for name in names)
    return slices.selectExpr("customer_id", "slice", f"named_struct({fields}) AS opening")


def _results(n: int) -> list[str]:
    # A frame with nothing but purchases of unknown amount has no revenue.
    return [
        f"events_{n} AS rolling_events_{n}d",
        f"purchases_{n} AS rolling_purchases_{n}d",
        f"CASE WHEN priced_{n} > 0 THEN CAST(revenue_{n} AS DOUBLE) + beyond_{n} END "
        f"AS rolling_revenue_{n}d",
    ]


def first_purchase(events: DataFrame) -> DataFrame:
    """Time of the first purchase; customers without one are absent."""
    return (events.where(is_type("purchase")).groupBy("customer_id")
            .agg(F.min("timestamp").alias("first_purchase_date")))


def cohort_features(events: DataFrame, busy_rows: int = 1_000_000,
                    busy_parts: int = _BUSY_PARTS) -> DataFrame:
    """Each event with its customer's first purchase, the days since, and its month.

    Ordinary customers need one window and one exchange. The list of busy customers has
    their first purchases, found while they were counted, and is broadcast to their events,
    which then stay where they are.
    """
    first = F.min(F.when(is_type("purchase"), F.col("timestamp")))
    busy = F.broadcast(_busy_customers(events, busy_rows, busy_parts, first.alias("_first")))
    same = events["customer_id"].eqNullSafe(F.col("_busy"))
    ordinary = events.join(busy, same, "left_anti").withColumn(
        "_first", first.over(Window.partitionBy("customer_id")))
    known = events.join(busy, same).drop("_busy")
    # Events without a customer belong to no cohort.
    own = F.when(F.col("customer_id").isNotNull(), F.col("_first"))
    return ordinary.unionByName(known).withColumn("first_purchase_date", own).drop("_first").withColumns({
        "days_since_first_purchase": F.date_diff("timestamp", "first_purchase_date"),
        "cohort_month": F.date_format("first_purchase_date", "yyyy-MM"),
    })
