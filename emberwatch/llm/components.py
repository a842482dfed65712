"""Connected components by alternating stars.

A large star links every higher neighbour of a node to the lowest node around it, a small
star does so for the lower neighbours. Both only shorten paths and keep components; where
they change nothing more, every node hangs on the lowest node of its component. All of it
is grouped minima and joins of edges; no list of neighbours is ever gathered.
"""

from pyspark.sql import functions as F

from emberwatch.llm.common import kept


def _star(edges, lowest):
    """``edges`` (u, v) with ``lowest`` (u, m): every v of u gets the edge (v, m)."""
    return edges.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _large(edges):
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _star(both.filter("v > u"), lowest).filter("u != v").distinct()


def _small(edges):
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    linked = _star(down, lowest).unionAll(lowest.select("u", F.col("m").alias("v")))
    return linked.filter("u != v").distinct()


def _state(edges):
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges):
    """(u, v) to (node, root): the lowest node of its component for every node with an edge.

    Nulls, loops and repeated edges add nothing. Without edges there are no rows.
    """
    edges = kept(edges.select("u", "v").filter("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct())
    before = _state(edges)
    while before[0]:
        edges = kept(_small(_large(edges)))
        after = _state(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots).distinct()
