"""Conditional statistics per key: counts, sums, averages, minima and maxima.

A cell is one listed value of one dimension. ``qtd`` counts rows whatever their
amount, the other statistics ignore NULL amounts, and a cell without rows is
NULL, not 0. A key whose rows fall into no cell still gets its row.

``direct`` states this literally, with one conditional aggregate per feature. Its
partial rows carry every feature's buffer, which is what gets shuffled.

``compact`` and ``assemble`` compute the same in two steps:

* ``compact`` groups by key, cell of each dimension and recency band, with five
  plain aggregates. Its partial rows are about as wide as its input rows, and a
  key that holds a large share of all rows shrinks, before any shuffle, to at
  most one row per combination in each task.
* ``assemble`` moves those few rows per key together once, and then groups by
  (key, cell) and by key without further exchanges: both are satisfied by the
  partitioning on the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebook.functions.recency import band
from lakebook.plans.spec import Dimension, FeatureSpec
from lakebook.schemas import AMOUNT_AVG, AMOUNT_SUM

KEY = "user_id"


def direct(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    """``rows`` need the key, ``amount``, ``age`` and the dimensions' columns."""
    amount = F.col("amount")
    statistics = {
        "qtd": lambda condition: F.sum(F.when(condition, 1)),
        "sum": lambda condition: F.sum(F.when(condition, amount)),
        "avg": lambda condition: F.avg(F.when(condition, amount)),
        "min": lambda condition: F.min(F.when(condition, amount)),
        "max": lambda condition: F.max(F.when(condition, amount)),
    }
    columns = []
    for feature in spec.features():
        condition = F.col(feature.dimension.column) == feature.value
        if feature.window.months is not None:
            condition = (F.col("age") <= feature.window.months) & condition
        columns.append(statistics[feature.statistic](condition).alias(feature.name))
    return rows.groupBy(KEY).agg(*columns)


def cell(spec: FeatureSpec, dimension: Dimension) -> Column:
    """Number of the cell a row falls into, NULL for a value that is not listed."""
    first = 0
    for other in spec.dimensions:
        if other.prefix == dimension.prefix:
            break
        first += len(other.values)
    number = F.lit(None)
    for offset, (_, value) in enumerate(dimension.values):
        number = F.when(F.col(dimension.column) == value, first + offset).otherwise(number)
    return number.cast("tinyint")


def compact(rows: DataFrame, spec: FeatureSpec) -> DataFrame:
    """One row per key, cells and band.

    ``rows`` need the key, ``amount``, ``age``, ``copies`` and one ``cell_*`` column
    per dimension. ``copies`` says how many identical rows a row stands for.
    """
    cells = [f"cell_{d.prefix}" for d in spec.dimensions]
    amount, copies = F.col("amount"), F.col("copies")
    # Most rows stand for one: those are spared the decimal multiplication.
    total = F.when(copies == 1, amount).otherwise(amount * copies.cast("decimal(19,0)"))
    return (
        rows.withColumn("band", band(F.col("age"), spec.limits()))
        .groupBy(KEY, *cells, "band")
        .agg(
            F.sum(copies).alias("qtd"),
            F.sum(F.when(amount.isNotNull(), copies)).alias("priced"),
            F.sum(total).alias("sum"),
            F.min(amount).alias("min"),
            F.max(amount).alias("max"),
        )
    )


def assemble(compacted: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The feature row of each key, from the output of ``compact``."""
    limits = spec.limits()
    per_cell = compacted.repartition(KEY).select(
        KEY,
        "band",
        "qtd",
        "priced",
        "sum",
        "min",
        "max",
        F.explode(F.array(*[f"cell_{d.prefix}" for d in spec.dimensions])).alias("cell"),
    )

    # Expressions as text: the table is wide, and every Column built in Python
    # costs several calls into the JVM before the query even starts.
    wanted = {s for d in spec.dimensions for s in d.statistics}
    statistics = []
    for window in spec.windows:
        # Bands are nested: a window holds all bands up to its own.
        last = len(limits) if window.months is None else limits.index(window.months)
        inside = f"filter (where band <= {last})"
        amount = f"try_cast(sum(sum) {inside} as {AMOUNT_SUM.simpleString()})"
        priced = f"cast(sum(priced) {inside} as decimal(20,0))"
        forms = {
            "qtd": f"sum(qtd) {inside}",
            "sum": amount,
            "avg": f"cast(try_divide({amount}, {priced}) as {AMOUNT_AVG.simpleString()})",
            "min": f"min(min) {inside}",
            "max": f"max(max) {inside}",
        }
        statistics += [F.expr(forms[s]).alias(f"{s}{window.suffix}") for s in forms if s in wanted]

    cells = [(d.prefix, label) for d in spec.dimensions for label, _ in d.values]
    wide = per_cell.groupBy(KEY).pivot("cell", list(range(len(cells)))).agg(*statistics)
    columns = []
    for feature in spec.features():
        pivoted = str(cells.index((feature.dimension.prefix, feature.label)))
        # Pivot leaves out the statistic's name where there is only one.
        if len(statistics) > 1:
            pivoted += f"_{feature.statistic}{feature.window.suffix}"
        columns.append(f"`{pivoted}` as {feature.name}")
    return wide.selectExpr(KEY, *columns)
