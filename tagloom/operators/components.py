"""Connected components by repeated contraction.

In every round each vertex picks, of all vertices within two steps, the one that comes first in
a random order, and all edges are rewritten to the picked vertices. Edges within one vertex
vanish, so the graph shrinks geometrically until it is empty, also for long chains. The order is
drawn anew for each round, as in Boegeholz, Brand, Todor: In-database connected component
analysis (ICDE 2020).
"""

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.operators.skew import hot_of_counts, lookup_join
from tagloom.session import Scratch, fits_broadcast


def connected_components(edges: DataFrame, max_broadcast_bytes: int | None = None) -> DataFrame:
    """`id` and `component`, the smallest id of its component, for every end of an edge.

    `edges` has string columns `src` and `dst`; an edge from an id to itself declares an isolated
    id. The result is a table in the shared folder.
    """
    scratch = Scratch(edges.sparkSession, "components")
    edges = scratch.save(edges.select("src", "dst").dropna().distinct(), "input")
    picks = _contract_all(scratch.save(_pairs(edges), "pairs_0"), scratch, max_broadcast_bytes)
    ids = edges.where(F.col("src") == F.col("dst")).select(F.col("src").alias("id"))
    if picks:
        labels = _unfold(picks, scratch, max_broadcast_bytes)
        isolated = ids.join(labels, "id", "left_anti").withColumn("component", F.col("id"))
        labels = labels.unionByName(isolated)
    else:
        labels = ids.withColumn("component", F.col("id"))
    result = scratch.save(labels, "labels")
    scratch.drop("input", "names", f"pairs_{len(picks)}",
                 *[f"{kind}_{turn}" for turn in range(len(picks)) for kind in ("picks", "unfolded")])
    return result


def _contract_all(pairs: DataFrame, scratch: Scratch, max_bytes: int | None) -> list[DataFrame]:
    """The picks of every round until no edge is left. Only their number reaches the driver."""
    picks, left = [], pairs.count()
    while left:
        turn = len(picks)
        nearest = _nearest(pairs, turn)
        # There are at most two rows per edge, and a row is about as wide as two edges.
        small = fits_broadcast(pairs, max_bytes, growth=4)
        if not small:
            nearest = scratch.save(nearest, f"nearest_{turn}")
        picked = scratch.save(_pick(pairs, nearest, max_bytes, small or None), f"picks_{turn}")
        picks.append(picked)
        pairs = scratch.save(_contract(pairs, picked, max_bytes), f"pairs_{turn + 1}")
        scratch.drop(f"pairs_{turn}", f"nearest_{turn}")
        before, left = left, pairs.count()
        # The neighbours of the first vertex of a component pick it, so edges vanish.
        if left >= before:
            raise RuntimeError(f"{left} edges were left of {before} after a round")
    return picks


def _pairs(edges: DataFrame) -> DataFrame:
    """Undirected edges between two different vertices, each once."""
    return (edges.where(F.col("src") != F.col("dst"))
            .select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v"))
            .distinct())


def _first_seen(pairs: DataFrame, seen: Column) -> DataFrame:
    """For each vertex the smallest value `seen` on its edges as `pick`, and the number of edges."""
    ends = pairs.select(F.explode(F.array("u", "v")).alias("vertex"), seen.alias("seen"))
    return ends.groupBy("vertex").agg(F.min("seen").alias("pick"), F.count("*").alias("degree"))


def _nearest(pairs: DataFrame, turn: int) -> DataFrame:
    """The first in this turn's order of each vertex and its neighbours."""
    def place(vertex):
        """Place in the order; the id itself settles equal hashes."""
        return F.struct(F.xxhash64(vertex, F.lit(turn)).alias("hash"), vertex.alias("id"))

    return _first_seen(pairs, F.least(place(F.col("u")), place(F.col("v"))))


def _pick(pairs: DataFrame, nearest: DataFrame, max_bytes: int | None,
          small: bool | None) -> DataFrame:
    """`pick`: the first in order of all vertices within two steps."""
    ends = _with_ends(pairs, nearest, max_bytes, small)
    seen = _first_seen(ends, F.least("new_u", "new_v"))
    return seen.withColumn("pick", F.col("pick")["id"])


def _with_ends(pairs: DataFrame, picked: DataFrame, max_bytes: int | None,
               small: bool | None = None) -> DataFrame:
    """Add the picks of both ends as `new_u` and `new_v`. A vertex with a large share of the edges
    is hot, as the degrees tell."""
    if small is None:
        small = fits_broadcast(picked, max_bytes)
    for end in ("u", "v"):
        hot = None
        if not small:
            degrees = picked.select(F.col("vertex").alias(end), F.col("degree").alias("n"))
            hot = hot_of_counts(degrees, end)
        lookup = picked.select(F.col("vertex").alias(end), F.col("pick").alias(f"new_{end}"))
        pairs = lookup_join(pairs, lookup, end, "inner", hot=hot, small=small)
    return pairs


def _contract(pairs: DataFrame, picked: DataFrame, max_bytes: int | None) -> DataFrame:
    """Edges between the picks of their ends."""
    moved = _with_ends(pairs, picked, max_bytes)
    return _pairs(moved.select(F.col("new_u").alias("src"), F.col("new_v").alias("dst")))


def _unfold(picks: list[DataFrame], scratch: Scratch, max_bytes: int | None) -> DataFrame:
    """Follow the picks of all turns from the last to the first, then name each component."""
    final = picks[-1].select("vertex", "pick")
    for turn in range(len(picks) - 2, -1, -1):
        # `final` has one row per vertex of the later turn.
        small = fits_broadcast(picks[turn + 1], max_bytes)
        if not small and turn < len(picks) - 2:
            final = scratch.save(final, f"unfolded_{turn + 1}")
        later = final.select(F.col("vertex").alias("pick"), F.col("pick").alias("final"))
        followed = lookup_join(picks[turn].select("vertex", "pick"), later, "pick",
                               max_bytes=max_bytes, small=small)
        final = followed.select("vertex", F.coalesce("final", "pick").alias("pick"))
    small = fits_broadcast(picks[0], max_bytes)
    if not small:
        final = scratch.save(final, "unfolded_0")
    names = final.groupBy("pick").agg(F.min("vertex").alias("component"))
    if not small:
        names = scratch.save(names, "names")
    return (lookup_join(final, names, "pick", "inner", max_bytes=max_bytes, small=small or None)
            .select(F.col("vertex").alias("id"), "component"))
