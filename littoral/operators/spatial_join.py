"""Pairs of rows whose envelopes meet, by a grid.

Every envelope is laid on the grid cells that it touches and the sides are
joined on the cell, a plain equi-join that Spark can broadcast, sort, or split
where a cell is crowded. A pair comes out of one cell alone, the first that both
touch: nothing has to be made distinct. Envelopes of very many cells, which
would be copied too often, go to a coarser level of the grid instead: each row
has one level, by its size, and the sides meet at every pair of levels, on the
cells of the coarser one. So a continent among ponds costs a few rows.

The cell given is the largest: where rows lie close, smaller cells are taken, as
long as testing pairs costs more than the copies of rows in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import ENVELOPE, meets

#: A row covers so many cells each way at most at its own level; each level's cells are so much wider.
SPAN, STEP = 4, 8
#: A copy of a row costs as much as so many tests; a join of so many tests is dealt to tasks of so many each.
COPY, MANY, TASK = 20, 5_000_000, 50_000_000
#: Rows in lists are dealt to tasks of so many each.
LISTED = 200_000


def _level(env: Sequence[str], cell: float) -> Column:
    """The first level at which the envelope spans ``SPAN`` cells at most."""
    x0, y0, x1, y1 = map(F.col, env)
    ratio = F.greatest(x1 - x0, y1 - y0) / F.lit(float(cell * SPAN))
    return F.when(ratio <= 1, 0).otherwise(F.ceil(F.log(ratio) / F.log(F.lit(float(STEP)))).cast("int"))


def cell_size(df: DataFrame, env: Sequence[str] = ENVELOPE, share: float = 0.9) -> float:
    """About the given quantile of the larger sides; 1 for an empty table."""
    x0, y0, x1, y1 = map(F.col, env)
    found = df.agg(F.percentile_approx(F.greatest(x1 - x0, y1 - y0).cast("double"), share)).first()[0]
    return float(found) if found else 1.0


@dataclass
class Extent:
    """``n`` rows, their mean ``width`` and ``height``, the ``side`` that few exceed, the ``largest`` one, and what they span."""

    n: int
    width: float
    height: float
    side: float
    largest: float
    box: tuple[float, float, float, float]


def extent(df: DataFrame, env: Sequence[str] = ENVELOPE) -> Extent:
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in env)
    side = F.greatest(x1 - x0, y1 - y0)
    found = df.agg(F.count(side), F.avg(x1 - x0), F.avg(y1 - y0), F.percentile_approx(side, 0.999), F.max(side), F.min(x0), F.min(y0), F.max(x1), F.max(y1)).first()
    return Extent(found[0], *(v or 0.0 for v in found[1:5]), tuple(v or 0.0 for v in found[5:]))


def _span(a: Extent, b: Extent) -> tuple[float, float]:
    return max(a.box[2], b.box[2]) - min(a.box[0], b.box[0]), max(a.box[3], b.box[3]) - min(a.box[1], b.box[1])


def expected(a: Extent, b: Extent) -> float:
    """Pairs that would meet if the rows were spread evenly."""
    w, h = _span(a, b)
    near = lambda reach, whole: min(1.0, reach / whole) if whole > 0 else 1.0
    return a.n * b.n * near(a.width + b.width, w) * near(a.height + b.height, h)


def _work(a: Extent, b: Extent, cell: float) -> tuple[float, float]:
    """Tests and copies of rows at a size of cells, if the rows were spread evenly."""
    w, h = _span(a, b)
    cells = max(1.0, w / cell) * max(1.0, h / cell)
    copies = [e.n * (e.width / cell + 1) * (e.height / cell + 1) for e in (a, b)]
    return copies[0] * copies[1] / cells, sum(copies)


def _sizes(a: Extent, b: Extent, cell: float) -> list[float]:
    """``cell`` and parts of it at which nearly all rows stay on the first level."""
    least = min(cell, max(a.side, b.side) / SPAN)
    return [cell] + [cell / k for k in (1.5, 2, 3, 4, 6, 8, 12, 16, 32, 64) if cell / k >= least]


def _finer(a: Extent, b: Extent, cell: float) -> float:
    """``cell`` or a part of it, by the work."""
    sizes = _sizes(a, b, cell)
    cost = lambda c: (lambda tests, copies: tests + COPY * copies)(*_work(a, b, c))
    return min(sizes, key=cost)


def grid_join(left: DataFrame, right: DataFrame, cell: float, left_env: Sequence[str] = ENVELOPE, right_env: Sequence[str] = ENVELOPE, extents: tuple[Extent, Extent] | None = None) -> DataFrame:
    """Columns of both sides (names must differ) for each pair of envelopes that meet; borders count.

    Keep geometry out of both sides: ids and envelopes are what should move. ``extents``
    of tables that the sides are part of, where they are known, save the looking.
    """
    if not cell > 0:
        raise ValueError("the cell has a positive size")
    of_a, of_b = extents or (extent(left, left_env), extent(right, right_env))
    cell = _finer(of_a, of_b, cell)
    a = left.withColumn("_la", _level(left_env, cell))
    b = right.withColumn("_lb", _level(right_env, cell))
    la, lb = _levels(a, "_la", of_a, cell), _levels(b, "_lb", of_b, cell)
    spread_a = _spread(a, left_env, cell, "_la", lb)
    spread_b = _spread(b, right_env, cell, "_lb", la)
    keys = [("_a_at", "_b_at"), ("_a_cx", "_b_cx"), ("_a_cy", "_b_cy"), ("_a_other", "_lb"), ("_la", "_b_other")]
    tests = _work(of_a, of_b, cell)[0]
    if tests > MANY:
        # Neither few files nor small ones make few tasks of many tests; a side of many copies is not broadcast.
        context = left.sparkSession.sparkContext
        tasks = max(2 * context.defaultParallelism, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(20_000, int(tests / TASK)))
        spread_a = spread_a.repartition(tasks, *(k for k, _ in keys)).hint("merge")
        spread_b = spread_b.repartition(tasks, *(k for _, k in keys))
    first = (F.col("_a_cx") == F.greatest("_a_lx", "_b_lx")) & (F.col("_a_cy") == F.greatest("_a_ly", "_b_ly"))
    on = meets(left_env, right_env) & first
    for k, other in keys:
        on = on & (F.col(k) == F.col(other))
    return spread_a.join(spread_b, on).drop("_la", "_lb", *(f"{side}_{c}" for side in ("_a", "_b") for c in ("at", "cx", "cy", "lx", "ly", "other")))


def grid_lists(left: DataFrame, right: DataFrame, cell: float, most: int, left_env: Sequence[str] = ENVELOPE, right_env: Sequence[str] = ENVELOPE, extents: tuple[Extent, Extent] | None = None) -> DataFrame | None:
    """``left, right``: for each cell that rows of both sides touch, all columns of these rows as arrays of structs; None where a cell would have over ``most`` pairs.

    Each two envelopes that meet are together in a cell at least, and may be in several.
    """
    of_a, of_b = extents or (extent(left, left_env), extent(right, right_env))
    w, h = _span(of_a, of_b)
    sizes = _sizes(of_a, of_b, cell)
    cell = next((c for c in sizes if _work(of_a, of_b, c)[0] / (max(1.0, w / c) * max(1.0, h / c)) <= most / 8), sizes[-1])
    a = left.withColumn("_la", _level(left_env, cell))
    b = right.withColumn("_lb", _level(right_env, cell))
    spread_a = _spread(a, left_env, cell, "_la", _levels(b, "_lb", of_b, cell))
    spread_b = _spread(b, right_env, cell, "_lb", _levels(a, "_la", of_a, cell))
    keys = ["_at", "_cx", "_cy", "_of_a", "_of_b"]
    of_left = spread_a.select(*(F.col(c).alias(k) for c, k in zip(("_a_at", "_a_cx", "_a_cy", "_la", "_a_other"), keys)), F.struct(*left.columns).alias("left"))
    of_right = spread_b.select(*(F.col(c).alias(k) for c, k in zip(("_b_at", "_b_cx", "_b_cy", "_b_other", "_lb"), keys)), F.struct(*right.columns).alias("right"))
    both = of_left.unionByName(of_right, allowMissingColumns=True)
    counts = both.groupBy(*keys).agg(F.count("left").alias("n"), F.count("right").alias("m"))
    if (counts.agg(F.max(F.when((F.col("n") > 0) & (F.col("m") > 0), F.greatest(F.col("n") * F.col("m"), F.greatest("n", "m") * 100)))).first()[0] or 0) > most:
        return None
    # By the work and not by the setting: each task pays a fifth of a second for the functions called on the lists.
    tasks = max(2 * left.sparkSession.sparkContext.defaultParallelism, min(20_000, int(_work(of_a, of_b, cell)[1] / LISTED)))
    lists = both.repartition(tasks, *keys).groupBy(*keys).agg(F.collect_list("left").alias("left"), F.collect_list("right").alias("right"))
    return lists.filter((F.size("left") > 0) & (F.size("right") > 0)).select("left", "right")


def _levels(df: DataFrame, level: str, of: Extent, cell: float) -> list[int]:
    """Which levels there are: a handful of numbers, bounded by the range of doubles."""
    if of.n and of.largest <= cell * SPAN:
        return [0]
    return [r[0] for r in df.select(level).distinct().collect() if r[0] is not None]


def _spread(df: DataFrame, env: Sequence[str], cell: float, level: str, others: list[int]) -> DataFrame:
    """A row for each cell that the envelope touches at the coarser of its level and each level of the other side, with the first of these cells."""
    name = "_a" if level == "_la" else "_b"
    x0, y0, x1, y1 = map(F.col, env)
    levels = F.array(*map(F.lit, sorted(others))) if others else F.array().cast("array<int>")
    at, lx, ly, cx, cy, other = (f"{name}_{c}" for c in ("at", "lx", "ly", "cx", "cy", "other"))
    each = df.select("*", F.explode(levels).alias(other)).withColumn(at, F.greatest(other, level))
    size = F.lit(float(cell)) * F.pow(F.lit(float(STEP)), F.col(at))
    firsts = each.withColumns({lx: F.floor(x0 / size), ly: F.floor(y0 / size)})
    xs = firsts.select("*", F.explode(F.sequence(F.col(lx), F.floor(x1 / size))).alias(cx))
    return xs.select("*", F.explode(F.sequence(F.col(ly), F.floor(y1 / size))).alias(cy))
