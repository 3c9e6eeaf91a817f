"""Ordered per-key operators that stay balanced when one key holds a large share of the rows.

A plain window puts every row of a key into one task. Here rows are range-partitioned by key *and*
order: a sample gives the bounds, each row looks up its range, and rows are dealt to tasks by the
number of their range, so a key of any size, even inside one instant, is spread over as many tasks
as its rows need. The window runs inside each range; one row per range carries the state on into
the ranges behind it. Rows are shuffled once, and carries are taken from the same exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANGE, _VALUE, _NEAR, _EDGE, _CARRY, _POINT, _BOUNDS = "__range", "__value", "__near", "__edge", "__carry", "__point", "__bounds"

#: Sampled rows per range: the bounds of ranges are off by a fraction of a range only.
SAMPLED = 32


def _bounds(points: DataFrame, n: int) -> Column:
    """``n - 1`` or fewer ascending bounds that cut ``points`` evenly, as one array.

    The sample is the ``SAMPLED * n`` points of least hash, so it depends on the data alone and not
    on the order of tasks; each task forwards no more than that. It is a scalar subquery: nothing
    runs before the query itself does.
    """
    sample = points.orderBy(F.xxhash64(_POINT), _POINT).limit(SAMPLED * n)
    ordered = F.array_sort(F.collect_list(_POINT))
    at = lambda i: F.get(F.col("s"), F.floor(i * F.size("s") / n).cast("int"))
    cuts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(n - 1)), at))
    return sample.agg(ordered.alias("s")).select(cuts.alias("c")).scalar()


class Ordered:
    """Rows dealt by ranges of ``keys`` and ``order``, which must be total within a key.

    Methods add columns without another shuffle of the rows, in any number; ``rows`` gives the result. ``points`` are rows that the bounds
    may be taken from instead, where ``df`` costs more than its keys and order do.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], ranges: int | None = None, points: DataFrame | None = None):
        n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.keys, self.order, self.n = list(keys), list(order), n
        self.point = F.struct(*[F.col(c) for c in (*keys, *order)])
        found = df.withColumns({_RANGE: F.lit(0), _POINT: self.point})
        if n > 1:
            found = found.withColumn(_BOUNDS, _bounds((df if points is None else points).select(self.point.alias(_POINT)), n))
            # Binary search, a projection for each step, so that all of it is compiled.
            step = 1 << ((n - 1).bit_length() - 1)
            while step:
                passed = F.get(_BOUNDS, F.col(_RANGE) + (step - 1)) <= F.col(_POINT)
                found = found.withColumn(_RANGE, F.when(passed, F.col(_RANGE) + step).otherwise(F.col(_RANGE)))
                step >>= 1
        self.dealt = found.drop(_POINT, _BOUNDS).repartitionById(n, _RANGE)

    def _with(self, dealt: DataFrame) -> Ordered:
        other = object.__new__(Ordered)
        other.keys, other.order, other.n, other.point, other.dealt = self.keys, self.order, self.n, self.point, dealt
        return other

    def _key(self) -> Column:
        return F.struct(*[F.col(k) for k in self.keys]) if self.keys else F.struct(F.lit(True).alias("all"))

    def _carried(self, edges: DataFrame, carry: Column) -> DataFrame:
        """``dealt`` with what the ranges before it say; ``edges`` has at most one row per range."""
        one = edges.select(_RANGE, carry.alias(_CARRY))
        return self.dealt.join(F.broadcast(one), _RANGE, "left")

    def neighbour(self, values: Sequence[str], *, prefix: str = "prev_", where: Column | None = None, forward: bool = False) -> Ordered:
        """Add ``prefix + name`` for each value of the nearest earlier row of the same key.

        ``where`` restricts which rows may be the neighbour (last matching row strictly before this
        one). ``forward`` looks at the nearest later row instead.
        """
        columns = self.dealt.columns
        packed = F.struct(*[F.col(v) for v in values])
        base = self._with(self.dealt.withColumn(_VALUE, packed if where is None else F.when(where, packed)))

        def direction(name: str) -> Column:
            return F.desc_nulls_last(name) if forward else F.asc_nulls_first(name)

        before = (Window.unboundedPreceding, -1)
        inside = Window.partitionBy(_RANGE, *self.keys).orderBy(*[direction(o) for o in self.order]).rowsBetween(*before)
        # A range's nearest match lies with the key at its far end: the only one that goes on.
        pick = F.min_by if forward else F.max_by
        rank = F.when(F.col(_VALUE).isNotNull(), self.point)
        edges = base.dealt.groupBy(_RANGE).agg(pick(F.struct(self._key().alias("key"), F.col(_VALUE).alias("value")), rank).alias(_EDGE))
        across = Window.partitionBy(F.lit(0)).orderBy(direction(_RANGE)).rowsBetween(*before)
        found = base._carried(edges, F.last(_EDGE, ignorenulls=True).over(across))
        near = F.last(_VALUE, ignorenulls=True).over(inside)
        carried = F.when(F.col(_CARRY)["key"].eqNullSafe(self._key()), F.col(_CARRY)["value"])
        out = found.withColumn(_NEAR, F.coalesce(near, carried))
        return self._with(out.select(*columns, *[F.col(_NEAR)[v].alias(f"{prefix}{v}") for v in values]))

    def between(self, value: Column, before: str, after: str) -> Ordered:
        """Add as ``before`` and ``after`` the nearest ``value`` (a struct, null where a row has none) strictly before and after each row, in one step.

        For an order without keys: the rows are one line.
        """
        if self.keys:
            raise ValueError("between is for an order without keys")
        columns = self.dealt.columns
        base = self._with(self.dealt.withColumn(_VALUE, value))
        rank = F.when(F.col(_VALUE).isNotNull(), self.point)
        edges = base.dealt.groupBy(_RANGE).agg(F.max_by(_VALUE, rank).alias("last"), F.min_by(_VALUE, rank).alias("first"))
        line = Window.partitionBy(F.lit(0))
        carried = F.struct(
            F.last("last", ignorenulls=True).over(line.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)).alias("last"),
            F.first("first", ignorenulls=True).over(line.orderBy(_RANGE).rowsBetween(1, Window.unboundedFollowing)).alias("first"),
        )
        inside = Window.partitionBy(_RANGE).orderBy(*[F.asc_nulls_first(o) for o in self.order])
        near = F.last(_VALUE, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1))
        # Seen from behind, so that both are running values.
        back = Window.partitionBy(_RANGE).orderBy(*[F.desc_nulls_last(o) for o in self.order])
        next_ = F.last(_VALUE, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
        found = base._carried(edges, carried)
        return self._with(found.select(*columns, F.coalesce(near, F.col(_CARRY)["last"]).alias(before), F.coalesce(next_, F.col(_CARRY)["first"]).alias(after)))

    def numbered(self, name: str) -> Ordered:
        """Add the row number 1..n within a key along the order."""
        columns = self.dealt.columns
        counts = self.dealt.groupBy(_RANGE, self._key().alias("key")).agg(F.count(F.lit(1)).alias("n"))
        edges = counts.groupBy(_RANGE).agg(F.max_by(F.struct("key", "n"), F.col("key")).alias(_EDGE))
        upto = Window.partitionBy(F.col(_EDGE)["key"]).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, 0)
        totals = edges.select(_RANGE, F.struct(F.col(_EDGE)["key"].alias("key"), F.sum(F.col(_EDGE)["n"]).over(upto).alias("n")).alias(_EDGE))
        # The range before may end in another key: then nothing is carried. Ranges without rows have no edge, so rows take the last edge before them.
        found = self._carried(totals, F.lag(_EDGE).over(Window.partitionBy(F.lit(0)).orderBy(_RANGE)))
        inside = Window.partitionBy(_RANGE, *self.keys).orderBy(*[F.asc_nulls_first(o) for o in self.order])
        carried = F.when(F.col(_CARRY)["key"].eqNullSafe(self._key()), F.col(_CARRY)["n"])
        number = F.row_number().over(inside) + F.coalesce(carried, F.lit(0))
        return self._with(found.withColumn(_NEAR, number.cast("bigint")).select(*columns, F.col(_NEAR).alias(name)))

    def filter(self, condition: Column) -> Ordered:
        return self._with(self.dealt.filter(condition))

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return self._with(self.dealt.withColumns(columns))

    def rows(self) -> DataFrame:
        return self.dealt.drop(_RANGE)


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    *,
    prefix: str = "prev_",
    where: Column | None = None,
    forward: bool = False,
) -> DataFrame:
    """``Ordered.neighbour`` of the rows of ``df``."""
    return Ordered(df, keys, order).neighbour(values, prefix=prefix, where=where, forward=forward).rows()


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Row number 1..n within a key along ``order``, without one task per key."""
    return Ordered(df, keys, order).numbered(name).rows()


def join_on_key(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", nulls_match: bool = False
) -> DataFrame:
    """Join rows to a relation aggregated on the same keys, so that AQE can split a hot key.

    AQE splits a skewed partition only where a shuffle feeds the join directly. An aggregate that
    is already partitioned by the key would suppress that shuffle. Adding the key's own hash to
    the condition changes no result and makes both inputs shuffle for the join; if the aggregate
    turns out small, AQE still turns the join into a broadcast by its measured size.
    ``nulls_match`` treats a null key as a value of its own, as grouping does.
    """
    renamed = right.withColumn("__h_right", F.xxhash64(*keys))
    for name in keys:
        renamed = renamed.withColumnRenamed(name, f"__r_{name}")
    hashed = left.withColumn("__h_left", F.xxhash64(*keys))
    condition = F.col("__h_left") == F.col("__h_right")
    for name in keys:
        pair = hashed[name].eqNullSafe(renamed[f"__r_{name}"]) if nulls_match else hashed[name] == renamed[f"__r_{name}"]
        condition = condition & pair
    return hashed.join(renamed, condition, how).drop("__h_left", "__h_right", *[f"__r_{k}" for k in keys])


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """Newest row per key; ``newest_by`` ends in a unique column so ties are decided.

    Catalyst turns the ``== 1`` filter into a group limit before the shuffle: each task forwards
    at most one row per key, whatever the size of the key.
    """
    order = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in newest_by])
    return df.withColumn("__rank", F.row_number().over(order)).filter(F.col("__rank") == 1).drop("__rank")


BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side only after measuring it; otherwise leave the choice of join to Spark.

    The measurement stops at ``rows``; the size is that of the rows as text.
    """
    measured = (
        df.limit(rows + 1)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("size"))
        .first()
    )
    return F.broadcast(df) if measured.n <= rows and (measured.size or 0) <= size else df


def spread(df: DataFrame) -> DataFrame:
    """Rebalance a scan that arrives in fewer splits than there are cores, for work that is heavy per row.

    A table of many files already has enough splits and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
