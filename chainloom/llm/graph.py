"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainloom.llm.shared import kept

ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(id, component), the smallest id reachable, for every id in edges (a, b).

    Alternating large-star and small-star steps: every round is a grouping and a join by id, so no
    component is ever together in a task, and long chains halve in every round. Loops only name their id;
    nulls are left out; an empty table has no components.
    """
    spark = edges.sparkSession
    first = edges.select("a", "b").where("a is not null and b is not null")
    names = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    now = kept(
        first.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = None
    for _ in range(ROUNDS):
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if not seen["n"] or seen == state:
            break
        state = seen
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        wide = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        wide = wide.distinct()
        low = wide.groupBy("a").agg(F.min("b").alias("m"))
        narrow = wide.join(low, "a").select(F.col("b").alias("x"), F.col("m").alias("b"), F.col("a").alias("y"))
        narrow = narrow.select(F.explode(F.array("x", "y")).alias("a"), "b").where("a <> b").distinct()
        now = kept(narrow, "edges")
    else:
        raise RuntimeError(f"components need more than {ROUNDS} rounds")
    roots = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "id")
    return names.join(roots, "id", "left").select("id", F.coalesce("component", "id").alias("component"))
