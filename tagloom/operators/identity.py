"""One user out of the many identifiers of a person, and the user's tags.

Users are kept in long form, so that no user's data has to fit one row:
`members` (user_id, id) and `weights` (user_id, tag, weight).
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tagloom.functions.predicates import any_non_blank
from tagloom.operators.components import connected_components
from tagloom.operators.skew import lookup_join
from tagloom.operators.tags import explode_tags
from tagloom.schema import ID_COLUMNS
from tagloom.session import Scratch, fits_broadcast


def identified_rows(df: DataFrame) -> DataFrame:
    """Rows with at least one filled identifier."""
    return df.where(any_non_blank(*ID_COLUMNS))


def identity_edges(records: DataFrame) -> DataFrame:
    """Edges from the main id of a record to each of its `ids`, itself included."""
    return (records.select(F.get("ids", F.lit(0)).alias("src"), F.explode_outer("ids").alias("dst"))
            .where(F.col("dst").isNotNull()).distinct())


def members_of(edges: DataFrame) -> DataFrame:
    """`user_id` and `id` for every id; the user id is the smallest id of the component."""
    return connected_components(edges).select(F.col("component").alias("user_id"), "id")


@dataclass
class Extension:
    """What today's edges change: `labels` (id, user_id) of today's ids, `touched` (old_user, user_id) of
    the old users among them, renamed or not, and `members` of all users."""
    labels: DataFrame
    touched: DataFrame
    members: DataFrame


def extend_members(old_members: DataFrame, edges: DataFrame) -> Extension:
    """The users of `old_members` and today's edges together, without resolving the old ones again.

    An old user is contracted to one vertex, its user id, so that only today's edges go through the
    rounds of the components. As a user id is the smallest id of its user, the smallest vertex of a
    component is the smallest id of the user that comes out. Old members are looked through for today's
    ids and for users that get another name, and not moved if those fit a broadcast.
    """
    scratch = Scratch(edges.sparkSession, "extension")
    edges = scratch.save(edges.select("src", "dst").dropna().distinct(), "edges")
    ids = scratch.save(edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct(), "ids")
    wanted = F.broadcast(ids) if fits_broadcast(ids) else ids
    known = scratch.save(old_members.select("id", "user_id").join(wanted, "id", "left_semi"), "known")
    vertices = scratch.save(ids.join(known, "id", "left").select(
        "id", F.coalesce("user_id", "id").alias("vertex")), "vertices")
    for end in ("src", "dst"):
        edges = lookup_join(edges, vertices.withColumnsRenamed({"id": end, "vertex": f"{end}_vertex"}),
                            end, "inner")
    found = connected_components(edges.select(F.col("src_vertex").alias("src"),
                                              F.col("dst_vertex").alias("dst")).distinct())
    found = found.withColumnsRenamed({"id": "vertex", "component": "user_id"})
    labels = scratch.save(lookup_join(vertices, found, "vertex", "inner").select("id", "user_id"), "labels")
    olds = known.select(F.col("user_id").alias("vertex")).distinct()
    touched = scratch.save(found.join(olds, "vertex", "left_semi")
                           .withColumnRenamed("vertex", "old_user"), "touched")
    renamed = touched.where("old_user <> user_id").select(
        F.col("old_user").alias("user_id"), F.col("user_id").alias("_now"))
    kept = lookup_join(old_members.select("user_id", "id"), scratch.save(renamed, "renamed"), "user_id")
    members = (kept.select(F.coalesce("_now", "user_id").alias("user_id"), "id")
               .unionByName(labels.join(known, "id", "left_anti").select("user_id", "id")))
    return Extension(labels, touched, members)


def with_user(records: DataFrame, members: DataFrame) -> DataFrame:
    """Add the `user_id` of the column `id`."""
    return lookup_join(records, members.select("id", "user_id"), "id", "inner", store_left=True)


def id_weights(records: DataFrame) -> DataFrame:
    """Weight of each tag per main id: the number of records (`ids`, `tags`) that have it."""
    return (explode_tags(records, F.get("ids", F.lit(0)).alias("id"))
            .groupBy("id", "tag").agg(F.count("*").cast("double").alias("weight")))


def tags_of_users(records: DataFrame, members: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """A row (`user_id`, `tag`, `weight` 1) for each tag of each record (`ids`, `tags`).

    The user is looked up once per record and not for its tags, so that these are summed per user at once.
    `hot` may give the hot main ids, as for `lookup_join`.
    """
    rows = records.select(F.get("ids", F.lit(0)).alias("id"), "tags")
    found = lookup_join(rows, members.select("id", "user_id"), "id", "inner", hot=hot)
    return explode_tags(found, "user_id").withColumn("weight", F.lit(1.0))


def summed(weights: DataFrame) -> DataFrame:
    """One weight per user and tag."""
    return weights.groupBy("user_id", "tag").agg(F.sum("weight").alias("weight"))


def user_weights(weights: DataFrame, members: DataFrame) -> DataFrame:
    """Tag weights per id (`id`, `tag`, `weight`), summed over the ids of each user."""
    return summed(with_user(weights, members))
