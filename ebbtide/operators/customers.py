"""Gold: one row per person, with purchase behaviour up to a snapshot and the churn label.

Label definition. The response window is ``snapshot < purchase <= date_add(snapshot, churn_days)``.
``date_add`` yields a day, so the window closes at 00:00 of its last day and a purchase later on
that day lies outside. A person with a purchase in the window is kept (0), all others churned (1).
Only people with a purchase up to the snapshot are rows; first-time buyers after it are not.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.columns import day_limit, earliest, moment
from ebbtide.operators.orders import ORDER, PURCHASED, Window

PERSON = "customer_unique_id"
LABEL = "churn"

# The feature columns, in the order the models see them.
FEATURES = [
    "recency",
    "frequency",
    "monetary",
    "total_items_volume",
    "payment_method_count",
    "max_installments",
    "avg_satisfaction",
    "min_review_score",
    "total_reviews_given",
]
# Descriptive columns of the feature table and the source column of each.
ATTRIBUTES = {
    "zip_code": "customer_zip_code_prefix",
    "city": "customer_city",
    "state": "customer_state",
    "primary_payment_type": "primary_payment_type",
}


def observation(master: DataFrame, snapshot: str | datetime) -> DataFrame:
    """Orders up to and including the snapshot."""
    return master.filter(F.col(PURCHASED) <= moment(master, PURCHASED, snapshot))


def response(master: DataFrame, snapshot: str | datetime, churn_days: int = 90) -> DataFrame:
    """Orders after the snapshot, up to midnight at the start of the window's last day."""
    purchased = F.col(PURCHASED)
    return master.filter(
        (purchased > moment(master, PURCHASED, snapshot))
        & (purchased <= day_limit(master, PURCHASED, snapshot, churn_days))
    )


def active_customers(master: DataFrame, snapshot: str | datetime, churn_days: int = 90) -> DataFrame:
    """People with a purchase in the response window."""
    return response(master, snapshot, churn_days).select(PERSON).distinct()


def label_churn(features: DataFrame, active: DataFrame) -> DataFrame:
    """Keep every row of ``features`` and flag those missing from ``active`` as churned.

    An EXISTS in the projection, which Spark runs as an existence join: ``active`` may repeat
    people, and no row is multiplied.
    """
    same_person = F.col(f"active.{PERSON}") == F.col(f"features.{PERSON}").outer()
    came_back = active.alias("active").where(same_person).exists()
    return features.alias("features").select("*", F.when(came_back, 0).otherwise(1).alias(LABEL))


#: How partial results of one person are merged; the attributes are the earliest known, as structs.
MERGES = {
    "last_purchase": F.max,
    "orders": F.sum,
    "payment": F.sum,
    "items": F.sum,
    "methods": F.max,
    "installments": F.max,
    "score_sum": F.sum,
    "score_count": F.sum,
    "score_min": F.min,
    "reviews": F.sum,
    **dict.fromkeys(ATTRIBUTES, F.min),
    "came_back": F.max,
}


def _per_order(rows: DataFrame, seen: Column, *keys: str) -> DataFrame:
    """One row per person and order, and per ``keys``, over the rows where ``seen`` holds; ``came_back`` tells of others.

    Copies of an order count once. Rows joined on the order id are already clustered for this, so it adds no exchange."""

    def observed(name: str) -> Column:
        return F.when(seen, F.col(name))

    return rows.groupBy(*keys, PERSON, ORDER).agg(
        F.max(observed(PURCHASED)).alias("last_purchase"),
        F.max(F.when(seen, 0).otherwise(1)).alias("came_back"),
        F.sum(observed("total_order_payment")).alias("payment"),
        F.sum(observed("total_items")).alias("items"),
        F.max(observed("payment_method_count")).alias("methods"),
        F.max(observed("max_installments")).alias("installments"),
        F.sum(observed("Avg_review_score")).alias("score_sum"),
        F.count(observed("Avg_review_score")).alias("score_count"),
        F.min(observed("Min_review_score")).alias("score_min"),
        F.sum(observed("Total_Review_Number")).alias("reviews"),
        *(earliest(source, PURCHASED, ORDER, where=seen).alias(name) for name, source in ATTRIBUTES.items()),
    )


def _merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Partial results of each person as one. It combines map-side: a person with very many orders is one row per task."""
    return parts.groupBy(*keys, PERSON).agg(*(merge(name).alias(name) for name, merge in MERGES.items()))


def _states(rows: DataFrame, seen: Column, *keys: str) -> DataFrame:
    """Partial results per person, from rows that hold all copies of their orders: two aggregations, (person, order) and person."""
    once = F.when(F.col("last_purchase").isNotNull(), 1).otherwise(0).cast("bigint")
    return _merged(_per_order(rows, seen, *keys).withColumn("orders", once), *keys)


def _finished(states: DataFrame, snapshot: Column, *keys: str) -> DataFrame:
    """Features from the merged partial results of each person with an observed order, and whether they came back."""
    return states.filter(F.col("orders") > 0).select(
        *keys,
        PERSON,
        F.datediff(snapshot, F.col("last_purchase")).alias("recency"),
        F.col("orders").alias("frequency"),
        F.col("payment").cast("double").alias("monetary"),
        F.col("items").alias("total_items_volume"),
        F.col("methods").alias("payment_method_count"),
        F.col("installments").alias("max_installments"),
        # Rounded, so that the order in which doubles were added does not show in the last digits.
        F.round(F.try_divide("score_sum", "score_count"), 12).alias("avg_satisfaction"),
        F.col("score_min").alias("min_review_score"),
        F.col("reviews").alias("total_reviews_given"),
        *(F.col(name)[source].alias(name) for name, source in ATTRIBUTES.items()),
        "came_back",
    )


def _per_person(rows: DataFrame, snapshot: Column, seen: Column, *keys: str) -> DataFrame:
    """Features over the rows where ``seen`` holds, and whether any other row exists; per ``keys`` if there are any."""
    return _finished(_states(rows, seen, *keys), snapshot, *keys)


def with_reviewed(features: DataFrame) -> DataFrame:
    """``features`` with ``reviewed``: 0 where the scores are 0 because the person has written no review."""
    return features.withColumn("reviewed", (F.coalesce("total_reviews_given", F.lit(0)) > 0).cast("int"))


def rfm_features(master: DataFrame, snapshot: str | datetime) -> DataFrame:
    """Recency, frequency, monetary value and the other features of each person; nulls kept."""
    at = moment(master, PURCHASED, snapshot)
    return _per_person(observation(master, snapshot), at, F.lit(True)).drop("came_back")


def churn_gold(master: DataFrame, snapshot: str | datetime, churn_days: int = 90) -> DataFrame:
    """Features and label in one pass over the orders of both windows.

    Equal to ``label_churn(rfm_features(...), active_customers(...))`` with the features'
    nulls set to 0, but it scans and joins the order tables once and needs no join for the label.
    """
    purchased = F.col(PURCHASED)
    seen = purchased <= moment(master, PURCHASED, snapshot)
    rows = master.filter(seen | (purchased <= day_limit(master, PURCHASED, snapshot, churn_days)))
    stayed = (F.col("came_back") == 1) & F.col(PERSON).isNotNull()
    people = _per_person(rows, moment(master, PURCHASED, snapshot), seen).withColumn(LABEL, F.when(stayed, 0).otherwise(1))
    return people.drop("came_back").na.fill(0, FEATURES)


class Cell(NamedTuple):
    """A month of a snapshot's window. ``part`` says how it lies in it: "seen" (all of it before the snapshot), "later" (all of
    it in the response window), or "border"."""

    month: str
    start: str
    snapshot: str
    end: str
    part: str


def window_cells(windows: Sequence[Window], churn_days: int = 90) -> list[Cell]:
    """The windows cut into months: an order meets those windows alone that its month belongs to."""
    cells = []
    for start, snapshot, end in windows:
        last = datetime.combine(snapshot.date() + timedelta(days=churn_days), datetime.min.time())
        first = datetime(start.year, start.month, 1)
        while first < end or first <= snapshot:
            following = datetime(first.year + first.month // 12, first.month % 12 + 1, 1)
            seen = start <= first and following <= snapshot
            later = snapshot < first and following <= min(last, end)
            part = "seen" if seen else "later" if later else "border"
            cells.append(Cell(f"{first:%Y-%m-%d}", str(start), str(snapshot), str(end), part))
            first = following
    return cells


def month_blocks(cells: Sequence[Cell]) -> dict[str, str]:
    """Months to the first month of their block. Months that meet the same windows in the same way are one block, so that
    a person's partial results are merged once and not for every snapshot."""
    met: dict[str, list[Cell]] = {}
    for cell in cells:
        met.setdefault(cell.month, []).append(cell._replace(month=""))
    first: dict[tuple[Cell, ...], str] = {}
    return {month: first.setdefault(tuple(sorted(met[month])), month) for month in sorted(met)}


def _cell_rows(df: DataFrame, cells: Sequence[Cell], churn_days: int) -> DataFrame:
    """The cells as a table of ``df``'s own time type: some rows per window, whatever the size of ``df``."""
    kind = df.schema[PURCHASED].dataType
    rows = df.sparkSession.createDataFrame([tuple(cell) for cell in cells], "month string, start string, at string, end string, part string")
    last = F.date_add(F.col("at").cast("timestamp_ntz").cast("date"), churn_days).cast(kind)
    return rows.select(
        F.col("month").cast("date").alias("cell_month"),
        F.col("start").cast(kind).alias("cell_start"),
        F.col("at").cast(kind).alias("snapshot_at"),
        F.col("end").cast(kind).alias("cell_end"),
        last.alias("last"),
        "part",
    )


def in_windows(df: DataFrame, cells: Sequence[Cell], churn_days: int) -> DataFrame:
    """Each row of ``df`` for every snapshot in whose history or response window it lies (``snapshot_at``, ``last``).

    An equi-join on the month and an exact test after it: the work follows the matches, not rows times snapshots."""
    purchased = F.col(PURCHASED)
    month = F.trunc(purchased.cast("date"), "month")
    found = df.join(F.broadcast(_cell_rows(df, cells, churn_days)), month == F.col("cell_month"))
    inside = (purchased >= F.col("cell_start")) & (purchased < F.col("cell_end"))
    wanted = (purchased <= F.col("snapshot_at")) | (purchased <= F.col("last"))
    return found.where(inside & wanted).select(*df.columns, "snapshot_at", "last")


def _labelled_at(people: DataFrame, master: DataFrame, newest: str | datetime) -> DataFrame:
    """The label and the snapshot's day. Where the response window ends after the ``newest`` order the label is null."""
    stayed = (F.col("came_back") == 1) & F.col(PERSON).isNotNull()
    known = F.col("last") <= moment(master, PURCHASED, newest)
    labelled = people.withColumn(LABEL, F.when(known, F.when(stayed, 0).otherwise(1)))
    dated = labelled.withColumn("snapshot_date", F.col("snapshot_at").cast("date"))
    return dated.drop("came_back", "snapshot_at", "last").na.fill(0, FEATURES)


def churn_gold_at(master: DataFrame, windows: Sequence[Window], newest: str | datetime, churn_days: int = 90) -> DataFrame:
    """Features and label of several snapshots, each over its own window, in one pass over the orders.

    Every order is repeated for the snapshots whose window holds it, and the aggregations are per snapshot.
    """
    rows = in_windows(master, window_cells(windows, churn_days), churn_days)
    people = _per_person(rows, F.col("snapshot_at"), F.col(PURCHASED) <= F.col("snapshot_at"), "snapshot_at", "last")
    return _labelled_at(people, master, newest)


#: The month that a stored partial result is of.
STATE_MONTH = "state_month"


def month_states(master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Partial results per month and person, and the rows of orders that have copies in several months.

    An order must count once in any window, so that those with rows in several months of a person stay
    rows; all others are in exactly one month's partial result, and whole months can be merged."""
    month = F.trunc(F.col(PURCHASED).cast("date"), "month")
    rows = master.withColumn(STATE_MONTH, month)
    months = rows.groupBy(PERSON, ORDER).agg(F.min(STATE_MONTH).alias("first_month"), F.max(STATE_MONTH).alias("last_month"))
    spread = months.where("first_month <> last_month").select(F.col(PERSON).alias("_person"), F.col(ORDER).alias("_order"))
    same = F.col(PERSON).eqNullSafe(F.col("_person")) & (F.col(ORDER) == F.col("_order"))
    single = rows.join(spread, same, "left_anti")
    return _states(single, F.lit(True), STATE_MONTH).drop("came_back"), rows.join(spread, same, "left_semi").drop(STATE_MONTH)


def churn_gold_from_states(
    states: DataFrame, spread: DataFrame, border: DataFrame, windows: Sequence[Window], newest: str | datetime, churn_days: int = 90
) -> DataFrame:
    """``churn_gold_at`` from stored partial results: whole months are merged, and rows are read where a window begins or ends.

    ``border`` holds the rows of the border months of the windows (``window_cells``); ``spread`` all rows that
    no partial result holds."""
    cells = window_cells(windows, churn_days)
    whole = [cell for cell in cells if cell.part != "border"]
    edges = [cell for cell in cells if cell.part == "border"]
    keys = ("snapshot_at", "last")
    seen = F.col(PURCHASED) <= F.col("snapshot_at")
    rows = in_windows(border, edges, churn_days).unionByName(in_windows(spread, whole, churn_days))
    of_rows = _states(rows, seen, *keys)
    blocks = month_blocks(whole)
    block_of = states.sparkSession.createDataFrame([(day, first) for day, first in blocks.items()], "month string, block string")
    block_of = block_of.select(F.col("month").cast("date").alias("_month"), F.col("block").cast("date").alias("block"))
    merged = [MERGES[name](name).alias(name) for name in MERGES if name != "came_back"]
    of_blocks = states.join(F.broadcast(block_of), F.col(STATE_MONTH) == F.col("_month")).groupBy("block", PERSON).agg(*merged)
    # A block's first month stands for all of its months: they meet the same windows in the same way.
    known = F.broadcast(_cell_rows(border, [cell for cell in whole if blocks[cell.month] == cell.month], churn_days))
    months = of_blocks.join(known, F.col("block") == F.col("cell_month"))
    is_seen = F.col("part") == "seen"
    merged = [F.when(is_seen, F.col(name)).alias(name) for name in MERGES if name not in ("orders", "came_back")]
    of_months = months.select(
        *keys,
        PERSON,
        *merged,
        F.when(is_seen, F.col("orders")).otherwise(0).alias("orders"),
        F.when(is_seen, 0).otherwise(1).alias("came_back"),
    )
    people = _finished(_merged(of_rows.unionByName(of_months), *keys), F.col("snapshot_at"), *keys)
    return _labelled_at(people, border, newest)
