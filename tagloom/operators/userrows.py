"""Users as rows: nested, and as text.

Users are stored in long form. For readers that want rows, a user's entries are put into as many rows, by
their hash, as their number asks for: one, but for users with very many entries.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.operators.skew import lookup_join
from tagloom.session import Scratch

# Entries of a user from which they are put into several rows, of about so many each.
ROW_ENTRIES = 100_000

# Separators of the text form.
ID_SEPARATOR = ","
TAG_SEPARATOR = "#"
WEIGHT_SEPARATOR = " -> "
# Written instead of separators within names, and instead of what begins such a code.
_CODES = {"\\": "\\b", ",": "\\c", "#": "\\h", "->": "\\a"}


def user_rows(members: DataFrame, weights: DataFrame, parts: int | None = None,
              row_entries: int = ROW_ENTRIES) -> DataFrame:
    """`user_id`, `part`, `ids` (sorted) and `tags` (map of weights).

    Every user has the `parts` that are given, or those that its own number of entries asks for.
    `members` and `weights` should be stored tables, as they are read twice.
    """
    entries = (members.select("user_id", F.col("id").alias("entry"),
                              F.lit(None).cast("double").alias("weight"), F.lit(True).alias("is_id"))
               .unionByName(weights.select("user_id", F.col("tag").alias("entry"), "weight",
                                           F.lit(False).alias("is_id"))))
    if parts is None:
        sizes = entries.groupBy("user_id").agg(F.count("*").alias("n"))
        # At most one user per `row_entries` of all entries.
        large = Scratch(members.sparkSession, "user-rows").save(
            sizes.where(F.col("n") > row_entries)
            .select("user_id", F.ceil(F.col("n") / row_entries).alias("_parts")), "large")
        entries = lookup_join(entries, large, "user_id", spread=["entry"])
        of_user = F.coalesce("_parts", F.lit(1))
    else:
        of_user = F.lit(parts)
    part = F.pmod(F.xxhash64("entry"), of_user).cast("int")
    listed = entries.groupBy("user_id", part.alias("part")).agg(
        F.collect_list(F.when(F.col("is_id"), F.col("entry"))).alias("ids"),
        F.collect_list(F.when(~F.col("is_id"), F.struct("entry", "weight"))).alias("tags"))
    return listed.select("user_id", "part", F.array_sort("ids").alias("ids"),
                         F.map_from_entries(F.array_sort("tags")).alias("tags"))


def members_and_weights(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The long form of nested rows."""
    return (rows.select("user_id", F.explode("ids").alias("id")),
            rows.select("user_id", F.explode("tags").alias("tag", "weight")))


# -- text form ----------------------------------------------------------------------

def _escaped(name: Column) -> Column:
    for text, code in _CODES.items():
        name = F.replace(name, F.lit(text), F.lit(code))
    return name


def _unescaped(name: Column) -> Column:
    for text, code in reversed(_CODES.items()):
        name = F.replace(name, F.lit(code), F.lit(text))
    return name


def encode_ids(ids) -> Column:
    """Ids joined by commas; separators within ids are escaped."""
    return F.array_join(F.transform(ids, _escaped), ID_SEPARATOR)


def encode_tags(tags) -> Column:
    """`name -> weight` joined by `#`, by name; separators within names are escaped."""
    def text(entry):
        return F.concat(_escaped(entry["key"]), F.lit(WEIGHT_SEPARATOR), entry["value"].cast("string"))
    return F.array_join(F.transform(F.array_sort(F.map_entries(tags)), text), TAG_SEPARATOR)


def decode_ids(text) -> Column:
    return F.transform(F.filter(F.split(text, ID_SEPARATOR), lambda word: word != ""), _unescaped)


def decode_tags(text) -> Column:
    weights = F.str_to_map(F.when(text != "", text), F.lit(TAG_SEPARATOR), F.lit(WEIGHT_SEPARATOR))
    named = F.transform_keys(weights, lambda name, _: _unescaped(name))
    return F.transform_values(named, lambda _, weight: weight.try_cast("double"))


def to_text(rows: DataFrame) -> DataFrame:
    """Nested rows as the strings `all_user_id` and `tags`."""
    return rows.select("user_id", "part", encode_ids(F.col("ids")).alias("all_user_id"),
                       encode_tags(F.col("tags")).alias("tags"))


def from_text(rows: DataFrame) -> DataFrame:
    """Nested rows of their text form; rows without `part` are whole users."""
    part = F.col("part") if "part" in rows.columns else F.lit(0)
    return rows.select("user_id", part.alias("part"),
                       decode_ids(F.col("all_user_id")).alias("ids"),
                       decode_tags(F.col("tags")).alias("tags"))
