"""The feature table against plain loops, on random tables with nulls, copies and loose ends."""

import random
from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from ebbtide.operators import customers
from ebbtide.plans import jobs
from ebbtide.sources.shop import ShopTables

SCHEMAS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_purchase_timestamp timestamp",
    "payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(12,2)",
    "items": "order_id string, product_id string, shipping_limit_date timestamp, price decimal(12,2), "
    "freight_value decimal(12,2)",
    "reviews": "review_id string, order_id string, review_score int",
}


def _random_tables(seed):
    source = random.Random(seed)

    def maybe(value, share=0.15):
        return None if source.random() < share else value

    def money():
        return maybe(Decimal(source.randrange(1, 100000)) / 100)

    newest = datetime(2018, 10, 17, 17, 30, 18)
    edge = datetime(2018, 10, 17)
    split = newest - timedelta(days=90)
    moments = [newest, split, split - timedelta(days=365), edge, edge + timedelta(seconds=1)]
    moments += [split + timedelta(seconds=1), split - timedelta(days=365, seconds=1)]
    people = [
        (f"c{i}", maybe(f"p{i // 2}", 0.05), maybe(f"0{i % 7}"), maybe(f"city{i % 5}"), maybe(f"s{i % 3}", 0.4))
        for i in range(40)
    ]
    placed = [
        (
            maybe(f"o{i}", 0.03),
            maybe(f"c{source.randrange(44)}", 0.03),
            maybe(source.choice(moments + [newest - timedelta(minutes=source.randrange(800000))] * 28), 0.03),
        )
        for i in range(150)
    ]
    placed += source.choices(placed, k=10) + [("o1", "c0", split), ("o1", "c1", split), ("last", "c2", newest)]

    def details(share):
        return [f"o{i}" for i in range(155) for _ in range(source.randrange(4)) if source.random() < share] + [None]

    return {
        "customers": people,
        "orders": placed,
        "payments": [
            (o, maybe(source.randrange(1, 4)), maybe(source.choice("abc")), maybe(source.randrange(1, 13)), money())
            for o in details(0.8)
        ],
        "items": [
            (o, maybe("x"), maybe(newest - timedelta(days=source.randrange(99))), money(), money()) for o in details(0.8)
        ],
        "reviews": [(maybe("r"), o, maybe(source.randrange(1, 6))) for o in details(0.5)],
    }


def _known(values):
    return [value for value in values if value is not None]


def _expected(tables, split=None):
    """The feature table by the definitions, one person at a time."""
    clean = [row for row in tables["orders"] if row[0] is not None and row[2] is not None]
    newest = max(row[2] for row in clean)
    split = split or newest - timedelta(days=90)
    end = split + timedelta(days=90)
    start = split - timedelta(days=365)
    limit = datetime.combine(split.date() + timedelta(days=90), datetime.min.time())
    of_order = {name: defaultdict(list) for name in ("payments", "items", "reviews")}
    for name, place in (("payments", 0), ("items", 0), ("reviews", 1)):
        for row in tables[name]:
            of_order[name][row[place]].append(row)

    rows = defaultdict(list)
    for order, customer, time in clean:
        for person in tables["customers"]:
            if person[0] == customer and start <= time < end:
                rows[person[1]].append((time, order, person))

    result = {}
    for person, mine in rows.items():
        seen = [row for row in mine if row[0] <= split]
        if not seen:
            continue
        back = person is not None and any(split < time <= limit for time, _, _ in mine)

        def first(value_of):
            found = sorted((t, o, value_of(o, who)) for t, o, who in seen if value_of(o, who) is not None)
            return found[0][2] if found else None

        def payment_type(order, _):
            paid = of_order["payments"][order]
            key = lambda p: (p[1] is None, p[1] or 0, p[2] is not None, p[2] or "")
            return min(paid, key=key)[2] if paid else None

        per_order = []
        for _, order, _ in seen:
            paid, had, said = (of_order[name][order] for name in ("payments", "items", "reviews"))
            scores = _known(r[2] for r in said)
            per_order.append(
                {
                    "paid": sum(_known(p[4] for p in paid)) if _known(p[4] for p in paid) else None,
                    "installments": max(_known(p[3] for p in paid), default=None),
                    "methods": len(_known(p[1] for p in paid)) if paid else None,
                    "items": len(_known(i[1] for i in had)) if had else None,
                    "mean": sum(scores) / len(scores) if scores else None,
                    "low": min(scores, default=None),
                    "said": len(_known(r[0] for r in said)) if said else None,
                }
            )
        column = lambda name: _known(o[name] for o in per_order)
        means = column("mean")
        result[person] = {
            "recency": (split.date() - max(t for t, _, _ in seen).date()).days,
            "frequency": len({o for _, o, _ in seen}),
            "monetary": float(sum(column("paid"))),
            "total_items_volume": sum(column("items")),
            "payment_method_count": max(column("methods"), default=0),
            "max_installments": max(column("installments"), default=0),
            "avg_satisfaction": sum(means) / len(means) if means else 0.0,
            "min_review_score": min(column("low"), default=0),
            "total_reviews_given": sum(column("said")),
            "zip_code": first(lambda o, who: who[2]),
            "city": first(lambda o, who: who[3]),
            "state": first(lambda o, who: who[4]),
            "primary_payment_type": first(payment_type),
            "churn": (0 if back else 1) if limit <= newest else None,
        }
    return result


@pytest.mark.parametrize("seed", range(4))
def test_feature_table_equals_plain_loops(spark, tmp_path, seed):
    rows = _random_tables(seed)
    tables = ShopTables(
        **{name: spark.createDataFrame(rows[name], schema).repartition(3) for name, schema in SCHEMAS.items()}
    )
    expected = _expected(rows)
    assert len({row["churn"] for row in expected.values()}) == 2 and None in expected
    for features in (jobs.gold(tables), jobs.gold(tables, detailed=jobs.silver(tables, str(tmp_path)))):
        found = {row[customers.PERSON]: row.asDict() for row in features.drop("snapshot_date").collect()}
        assert set(found) == set(expected)
        for person, values in expected.items():
            mine = {name: found[person][name] for name in values}
            assert mine == {**values, "avg_satisfaction": pytest.approx(values["avg_satisfaction"], abs=1e-9)}


@pytest.mark.parametrize("seed", range(2))
def test_each_snapshot_has_its_own_window(spark, tmp_path, seed):
    rows = _random_tables(seed)
    newest = max(row[2] for row in rows["orders"] if row[0] is not None and row[2] is not None)
    tables = ShopTables(
        **{name: spark.createDataFrame(rows[name], schema).repartition(3) for name, schema in SCHEMAS.items()}
    )
    # The usual one, one that overlaps it, one long before, one at midnight and one with an open response window.
    usual = newest - timedelta(days=90)
    midnight = datetime.combine((newest - timedelta(days=200)).date(), datetime.min.time())
    snapshots = [usual, usual - timedelta(days=31), usual - timedelta(days=400), midnight, newest - timedelta(days=20)]
    for features in (
        jobs.gold(tables, snapshots=snapshots),
        jobs.gold(tables, snapshots=snapshots, detailed=jobs.silver(tables, str(tmp_path))),
    ):
        found = {(r["snapshot_date"], r[customers.PERSON]): r.asDict() for r in features.collect()}
        expected = {(s.date(), person): v for s in snapshots for person, v in _expected(rows, s).items()}
        assert set(found) == set(expected)
        for key, values in expected.items():
            mine = {name: found[key][name] for name in values}
            assert mine == {**values, "avg_satisfaction": pytest.approx(values["avg_satisfaction"], abs=1e-9)}
    assert None in {v["churn"] for v in expected.values()}


def test_two_snapshots_of_one_day_are_refused(spark):
    rows = _random_tables(0)
    tables = ShopTables(**{name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()})
    with pytest.raises(ValueError, match="two snapshots"):
        jobs.gold(tables, snapshots=["2000-01-01 00:00:00", "2000-01-01 12:00:00"])


def test_any_number_of_snapshots_is_one_pass(spark):
    rows = _random_tables(0)
    tables = ShopTables(**{name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()})
    plans = []
    for count in (1, 3):
        days = [f"2001-0{i + 1}-01 00:00:00" for i in range(count)]
        plans.append(jobs.gold(tables, snapshots=days)._jdf.queryExecution().optimizedPlan().toString())
    assert plans[0].count("Join") == plans[1].count("Join") and plans[0].count("Aggregate") == plans[1].count("Aggregate")


def test_silver_replaces_the_changed_month_alone(spark, tmp_path):
    rows = _random_tables(1)
    tables = ShopTables(**{name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()})
    path = str(tmp_path / "silver")
    jobs.silver(tables, path)

    def parts():
        found = tmp_path.glob("silver/orders/order_purchase_month=*/*.parquet")
        return {(f.parent.name, f.name): f.stat().st_mtime_ns for f in found}

    before = parts()
    month = sorted({folder for folder, _ in before if "HIVE" not in folder})[3]
    day = month.split("=")[1]
    changed = [(i, c, t + timedelta(minutes=1) if t and t.strftime("%Y-%m-01") == day else t) for i, c, t in rows["orders"]]
    later = ShopTables(**{n: spark.createDataFrame(changed if n == "orders" else rows[n], s) for n, s in SCHEMAS.items()})
    stored = jobs.silver(later, path, months=[day])
    after = parts()
    assert {k for k in before if k[0] != month} == {k for k in after if k[0] != month}
    assert all(after[k] == before[k] for k in before if k[0] != month) and {k for k in after if k[0] == month} != {k for k in before if k[0] == month}
    whole = jobs.silver(later, str(tmp_path / "whole")).select(*stored.columns)
    assert stored.exceptAll(whole).count() == 0 and whole.exceptAll(stored).count() == 0
