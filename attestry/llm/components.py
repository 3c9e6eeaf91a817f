"""Connected components of a link table, by contraction.

Links are first contracted inside the blocks in which they are read: a union-find over at most ``BLOCK`` links leaves one link per node and
block. Then every round each node adopts one of the nodes it is linked to or itself, links are renamed to the adopted nodes, contracted in
blocks again, and the ones inside a component disappear. In every other round the smallest node is adopted, which ends stars at once; in the
rounds between, the node of smallest hash, which shortens chains of any order by a constant factor, so rounds are logarithmically many. Each
round is written to the shared folder, so a lost executor costs one round. Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.tables import ship, stored

#: Links contracted at once inside a task; bounds its memory only.
BLOCK = 200_000


class Merged:
    """A union-find over the nodes it was given; the top of a set is its smallest node."""

    def __init__(self):
        self.above: dict[int, int] = {}

    def top(self, x: int) -> int:
        above, root = self.above, x
        while above.get(root, root) != root:
            root = above[root]
        while above.get(x, x) != root:
            above[x], x = root, above[x]
        return root

    def join(self, x: int, y: int) -> None:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)


def _stars(links: DataFrame) -> DataFrame:
    """The links (a, b), contracted block by block."""
    ship(links.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= BLOCK:
                yield forest_of(held)
                held, rows = [], 0
        if rows:
            yield forest_of(held)

    def forest_of(held: list) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        merged = Merged()
        for x, y in zip(table.column(0).to_pylist(), table.column(1).to_pylist()):
            merged.join(x, y)
        nodes = list(merged.above)
        return pa.RecordBatch.from_arrays([pa.array([merged.top(x) for x in nodes], pa.int64()), pa.array(nodes, pa.int64())], names=["a", "b"])

    return links.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").mapInArrow(run, "a long, b long")


def representatives(links: DataFrame) -> DataFrame:
    """``links`` (a, b long) to (id, component): some node of its component, the same for all. Nodes without a link are not listed; null ends are ignored."""
    edges = stored(_stars(links), "edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id"))
    turn = 0
    while not edges.isEmpty():
        by = (lambda x: F.col(x)) if turn % 2 == 0 else (lambda x: F.xxhash64(x, F.lit(turn)))
        adopted = (
            edges.select(F.inline(F.array(F.struct(F.col("a").alias("n"), F.col("b").alias("m")), F.struct(F.col("b").alias("n"), F.col("a").alias("m")))))
            .groupBy("n")
            .agg(F.min(F.struct(by("m").alias("o"), F.col("m").alias("p"))).alias("best"))
            .select("n", F.least("best", F.struct(by("n").alias("o"), F.col("n").alias("p")))["p"].alias("p"))
        )
        adopted = stored(adopted, "adopted")
        labels = stored(
            labels.join(adopted, labels["component"] == adopted["n"], "left").select("id", F.coalesce("p", "component").alias("component")), "labels"
        )
        left = adopted.select(F.col("n").alias("a"), F.col("p").alias("pa"))
        right = adopted.select(F.col("n").alias("b"), F.col("p").alias("pb"))
        renamed = edges.join(left, "a").join(right, "b").filter("pa <> pb")
        edges = stored(_stars(renamed.select(F.col("pa").alias("a"), F.col("pb").alias("b"))), "edges")
        turn += 1
    return labels


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b long) to (id, component): the smallest id that can be reached. Nodes without a link are not listed; null ends are ignored."""
    labels = representatives(links)
    smallest = labels.groupBy("component").agg(F.min("id").alias("smallest"))
    return stored(labels.join(smallest, "component").select("id", F.col("smallest").alias("component")), "labels")
