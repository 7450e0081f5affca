"""Parent-child trees: ancestor paths by a recursive query that survives loops, lost parents and self parents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOPS = 50


def ancestor_paths(df: DataFrame, node: str, parent: str, name: str, max_hops: int = MAX_HOPS) -> DataFrame:
    """(node, depth, root_id, id_path, name_path): the way from the root to each node.

    Walks from the node upwards until there is no parent row, the parent was met before (a loop ends there) or
    ``max_hops`` is reached. Names of digits only and names equal to the one before them are left out of name_path.
    Rows without a node are left out; a repeated node counts by its least parent. The walk is a recursive query whose
    state is one row per node and step; the path array guards against loops.
    """
    spark = df.sparkSession
    nodes = df.where(F.col(node).isNotNull()).groupBy(node).agg(F.min(parent).alias("parent"), F.min(name).alias("name")).select(F.col(node).cast("bigint").alias("node"), F.col("parent").cast("bigint").alias("parent"), F.coalesce(F.trim("name"), F.lit("")).alias("name"))
    view = f"_tree_{abs(hash((node, parent, name))) % 10**9}"
    nodes.createOrReplaceTempView(view)
    walk = spark.sql(f"""
        WITH RECURSIVE up(node, at, next_id, ids, names, hops) MAX RECURSION LEVEL {max_hops + 2} AS (
          SELECT node, node, parent, array(node), array(name), 0 FROM {view}
          UNION ALL
          SELECT u.node, n.node, n.parent, array_prepend(u.ids, n.node), array_prepend(u.names, n.name), u.hops + 1
          FROM up u JOIN {view} n ON u.next_id = n.node WHERE u.hops < {max_hops} AND NOT array_contains(u.ids, n.node)
        ) SELECT * FROM up""")
    last = walk.groupBy("node").agg(F.max(F.struct("hops", "ids", "names")).alias("w")).select("node", F.col("w.hops").alias("depth"), F.col("w.ids").alias("ids"), F.col("w.names").alias("names"))
    plain = F.filter("names", lambda x: ~x.rlike(r"^\d+(?:\.0)?$") & (x != ""))
    return last.select("node", "depth", F.element_at("ids", 1).alias("root_id"), F.array_join(F.transform("ids", lambda x: x.cast("string")), "/").alias("id_path"), F.array_join(without_repeats(plain), " > ").alias("name_path"))


def without_repeats(names):
    """An array without values equal to the one before them."""
    return F.aggregate(names, F.array().cast("array<string>"), lambda acc, x: F.when(F.try_element_at(acc, F.lit(-1)) == x, acc).otherwise(F.concat(acc, F.array(x))))


def levels(paths: DataFrame, count: int = 6) -> DataFrame:
    """name_path split into level_1 … level_count, with site (levels 1 and 2) and department (level 5)."""
    parts = F.split("name_path", " > ")
    out = paths.withColumns({f"level_{k}": F.try_element_at(parts, F.lit(k)) for k in range(1, count + 1)})
    return out.withColumns({"site": F.concat_ws(" / ", "level_1", "level_2"), "department": F.coalesce("level_5", F.lit("Unknown"))})
