"""The feature book against a brute-force count in plain Python."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest

from lakebook.operators.enrich import enrich, payload_bytes
from lakebook.plans.book import feature_book
from lakebook.plans.spec import BOOK, Dimension, FeatureSpec, Window
from lakebook.schemas import PRODUCTS, SALES

RUN = date(2026, 4, 8)
STAMP = "20260408120000"
FILE = "20260408094946"
LAST_DAYS = {1: 31, 2: 28, 3: 31, 4: 30, 5: 31, 6: 30, 7: 31, 8: 31, 9: 30, 10: 31, 11: 30, 12: 31}


def sale(user, product, ref, amount, payment, run=STAMP, file=FILE):
    amount = None if amount is None else Decimal(amount)
    return (ref, run, file, "t", user, product, None, amount, 1, payment)


def product(key, category, run=STAMP, file=FILE):
    return ("20260408", file, run, key, "d", category)


def frames(spark, sales, products):
    return spark.createDataFrame(sales, SALES), spark.createDataFrame(products, PRODUCTS)


def months_back(run: date, ref: str) -> int | None:
    try:
        sold = date(int(ref[:4]), int(ref[4:6]), int(ref[6:]))
    except ValueError:
        return None
    ends = run.day == LAST_DAYS[run.month] and sold.day == LAST_DAYS[sold.month]
    months = (run.year - sold.year) * 12 + run.month - sold.month
    if ends or run.day == sold.day:
        return months
    exact = months + (run.day - sold.day) / 31
    return int(exact)


def brute_force(sales, products, days=180, spec=BOOK):
    """Newest batches are assumed; every sale meets every product row in turn."""
    first = int((RUN - timedelta(days=days)).strftime("%Y%m%d"))
    by_id = defaultdict(list)
    for row in products:
        by_id[row[3]].append(row[5])
    rows = defaultdict(list)
    for ref, _, _, _, user, key, _, amount, _, payment in sales:
        if ref is None or not ref.isdigit() or int(ref) < first:
            continue
        matches = by_id.get(key) if key is not None else None
        for category in matches or [None]:
            values = {"product_category": category, "payment_method": payment}
            rows[user].append((months_back(RUN, ref), amount, values))
    book = {}
    for user, mine in rows.items():
        features = []
        for f in spec.features():
            inside = [
                amount
                for age, amount, values in mine
                if values[f.dimension.column] == f.value
                and (f.window.months is None or (age is not None and age <= f.window.months))
            ]
            priced = [a for a in inside if a is not None]
            if f.statistic == "qtd":
                features.append(len(inside) or None)
            elif not priced:
                features.append(None)
            elif f.statistic == "avg":
                exact = sum(priced) / len(priced)
                features.append(exact.quantize(Decimal("0.000001"), ROUND_HALF_UP))
            else:
                features.append({"sum": sum, "min": min, "max": max}[f.statistic](priced))
        book[user] = tuple(features)
    return book


def collected(book):
    return {row.user_id: tuple(row)[3:] for row in book.collect()}


@pytest.fixture(scope="module")
def random_tables():
    pick = random.Random(7)
    payments = [value for _, value in BOOK.dimensions[1].values] + ["Cheque", "pix", None]
    categories = [value for _, value in BOOK.dimensions[0].values] + ["Casa", "livros", None]
    days = [(RUN - timedelta(days=n)).strftime("%Y%m%d") for n in range(-20, 400)]
    days += ["20261345", "n/a", None]
    sales = [
        sale(
            # A third of all sales belong to one user, a third to one product.
            "u-hot" if pick.random() < 0.33 else pick.choice(["u-1", "u-2", "u-3", None]),
            "p-0" if pick.random() < 0.33 else pick.choice(["p-1", "p-2", "p-3", "p-x", None]),
            pick.choice(days),
            None if pick.random() < 0.1 else f"{pick.randint(-50, 10**6) / 100:.2f}",
            pick.choice(payments),
        )
        for _ in range(600)
    ]
    # Ids with one row, several categories, plain duplicates, and no id at all.
    products = [product("p-0", c) for c in categories + categories[:3]]
    products += [product("p-1", "Livros")] * 3 + [product("p-2", "Jogos"), product("p-2", "Casa")]
    products += [product("p-3", None), product(None, "Jogos")]
    return sales, products


@pytest.mark.parametrize("mode", ["two_phase", "direct"])
@pytest.mark.parametrize("days", [180, 3000])
@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_both_modes_equal_brute_force(spark, random_tables, mode, days, limit):
    """With a broadcast and with a shuffled product join."""
    sales, products = random_tables
    book = feature_book(
        *frames(spark, sales, products),
        RUN, STAMP, mode=mode, lookback_days=days, broadcast_limit=limit,
    )
    assert collected(book) == brute_force(sales, products, days)


@pytest.mark.parametrize("mode", ["two_phase", "direct"])
def test_columns_and_types(spark, random_tables, mode):
    book = feature_book(*frames(spark, *random_tables), RUN, STAMP, mode=mode)
    assert len(book.columns) == 163
    assert book.columns[:3] == ["user_id", "ref", "ts_proc"]
    assert book.columns[3:7] == [
        "qtd_pcat_livros", "qtd_pcat_roupas", "qtd_pcat_eletr", "qtd_pcat_jogos",
    ]
    assert book.columns[7] == "qtd_pcat_livros_u1m"
    assert book.columns[-1] == "avg_pm_boleto_u6m"
    types = {"qtd": "bigint", "sum": "decimal(24,2)", "avg": "decimal(18,6)",
             "min": "decimal(14,2)", "max": "decimal(14,2)"}
    for name, kind in book.dtypes[3:]:
        assert kind == types[name[:3]], name
    assert dict(book.dtypes)["ref"] == dict(book.dtypes)["ts_proc"] == "string"
    first = book.first()
    assert (first.ref, first.ts_proc) == ("20260408", STAMP)


def features(spark, sales, products):
    book = feature_book(*frames(spark, sales, products), RUN, STAMP)
    return {row.user_id: row for row in book.collect()}


def test_duplicate_products_count_once_per_match(spark):
    got = features(
        spark,
        [sale("u", "p", "20260401", "10.00", "PIX")],
        [product("p", "Livros"), product("p", "Jogos"), product("p", "Casa")],
    )["u"]
    assert (got.qtd_pcat_livros, got.qtd_pcat_jogos, got.qtd_pcat_roupas) == (1, 1, None)
    assert (got.qtd_pm_pix, got.sum_pm_pix, got.avg_pm_pix) == (3, Decimal(30), Decimal(10))


def test_unmatched_sale_only_moves_payment_features(spark):
    got = features(spark, [sale("u", "p", "20260401", "10.00", "Boleto")], [product("q", "Livros")])
    assert got["u"].qtd_pm_boleto == 1
    assert all(v is None for k, v in got["u"].asDict().items() if "pcat" in k)


def test_user_without_listed_values_still_appears(spark):
    got = features(
        spark,
        [sale("u", "p", "20260401", "1.00", "pix"), sale(None, "p", "20260401", "1.00", "PIX")],
        [product("p", "livros")],
    )
    assert set(got) == {"u", None}
    assert all(v is None for v in tuple(got["u"])[3:])
    assert got[None].qtd_pm_pix == 1


def test_null_amount_counts_but_does_not_add(spark):
    got = features(
        spark,
        [sale("u", "p", "20260401", None, "PIX"), sale("u", "p", "20260401", "4.00", "PIX")],
        [product("p", "Jogos")],
    )["u"]
    assert (got.qtd_pm_pix, got.sum_pm_pix, got.avg_pm_pix) == (2, Decimal(4), Decimal(4))
    alone = features(spark, [sale("u", "p", "20260401", None, "PIX")], [product("p", "Jogos")])["u"]
    assert (alone.qtd_pcat_jogos, alone.sum_pcat_jogos, alone.min_pcat_jogos) == (1, None, None)


def test_impossible_date_only_moves_the_whole_window(spark):
    got = features(spark, [sale("u", "p", "20261345", "2.00", "PIX")], [product("p", "Jogos")])["u"]
    assert (got.qtd_pm_pix, got.qtd_pm_pix_u6m, got.qtd_pm_pix_u1m) == (1, None, None)


def test_future_sale_is_recent(spark):
    got = features(spark, [sale("u", "p", "20270101", "2.00", "PIX")], [product("p", "Jogos")])["u"]
    assert (got.qtd_pm_pix, got.qtd_pm_pix_u1m) == (1, 1)


def test_newest_batch_outside_the_lookback_does_not_hide_an_older_one(spark):
    got = features(
        spark,
        [
            sale("u", "p", "20260401", "1.00", "PIX", run="20260401000000"),
            sale("v", "p", "20200101", "1.00", "PIX", run="20260408000000"),
        ],
        [product("p", "Jogos")],
    )
    assert set(got) == {"u"}


def test_products_come_from_the_newest_file(spark):
    got = features(
        spark,
        [sale("u", "p", "20260401", "1.00", "PIX")],
        [
            product("p", "Livros", run="20260410000000", file="20260401000000"),
            product("p", "Jogos", run="20260408000000", file="20260408000000"),
        ],
    )["u"]
    assert (got.qtd_pcat_livros, got.qtd_pcat_jogos) == (None, 1)


def test_average_rounds_half_up(spark):
    rows = [sale("u", "p", "20260401", f"0.0{int(n == 0)}", "PIX") for n in range(32)]
    got = features(spark, rows, [])["u"]
    assert got.avg_pm_pix == Decimal("0.000313")


def test_empty_tables(spark):
    assert features(spark, [], []) == {}


def test_other_specs(spark, random_tables):
    sales, products = random_tables
    spec = FeatureSpec(
        (Dimension("pay", "payment_method", (("pix", "PIX"),), ("sum",)),),
        (Window("_u2m", 2),),
    )
    for mode in ("two_phase", "direct"):
        book = feature_book(*frames(spark, sales, products), RUN, STAMP, spec=spec, mode=mode)
        assert book.columns[3:] == ["sum_pay_pix_u2m"]
        assert collected(book) == brute_force(sales, products, spec=spec)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_broadcast_only_below_the_limit(spark, random_tables):
    sales, products = frames(spark, *random_tables)
    assert payload_bytes(products.select("product_id")) > 0
    assert "BroadcastHashJoin" in plan_of(enrich(sales, products))
    assert "BroadcastHashJoin" not in plan_of(enrich(sales, products, limit=0))
    book = feature_book(sales, products, RUN, STAMP, broadcast_limit=0)
    assert "BroadcastHashJoin" not in plan_of(book)


def test_sales_are_aggregated_before_they_are_shuffled(spark, random_tables):
    """Between scan and first exchange on the user there is a partial aggregate."""
    plan = plan_of(feature_book(*frames(spark, *random_tables), RUN, STAMP))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(user_id" in line]
    assert len(exchanges) == 2
    assert "cell_pcat" in exchanges[1] and "REPARTITION_BY_COL" in exchanges[0]


def test_a_hot_product_is_split_in_the_shuffled_join(spark):
    """A third of all sales on one product, and a product side too large to broadcast."""
    sales = spark.range(0, 120_000, 1, 8).selectExpr(
        "'20260401' as ref", f"'{STAMP}' as ts_proc", f"'{FILE}' as ts_file_generation",
        "'t' as transaction_id", "sha2(cast(id % 5000 as string), 256) as user_id",
        "if(id % 3 = 0, 'hot', sha2(cast(id as string), 256)) as product_id",
        "cast(null as timestamp) as dat_creation", "cast(id % 100 as decimal(14,2)) as amount",
        "1 as quantity", "'PIX' as payment_method",
    )
    products = spark.createDataFrame([product("hot", "Jogos"), product("hot", "Livros")], PRODUCTS)
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        book = feature_book(sales, products, RUN, STAMP, broadcast_limit=0)
        rows = book.collect()
        assert "skew=true" in plan_of(book)
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    names = ("qtd_pm_pix", "qtd_pcat_jogos", "qtd_pcat_livros")
    totals = [sum(row[name] or 0 for row in rows) for name in names]
    assert totals == [160_000, 40_000, 40_000]
    assert len(rows) == 5000
