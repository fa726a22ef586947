"""Dictionary of business areas per geohash cell."""

from pyspark.sql import DataFrame, functions as F

from tagloom.functions.areas import area_names, request_key
from tagloom.functions.geohash import geohash
from tagloom.operators.skew import lookup_join


def distinct_coordinates(df: DataFrame) -> DataFrame:
    return df.select("longitude", "latitude").dropna().distinct()


def area_dictionary(coordinates: DataFrame, responses: DataFrame) -> DataFrame:
    """`geohash` and `areas`, the comma list of all area names found in the cell.

    `coordinates` are distinct; `responses` holds one service response per `location` (`lon,lat`).
    Cells without areas are left out. The names of a cell are made distinct before they
    are listed, so a list is as long as a 38 m x 19 m cell has names.
    """
    key = request_key(F.col("longitude"), F.col("latitude"))
    cell = geohash(F.col("longitude"), F.col("latitude"))
    names = (coordinates.select(key.alias("location"), cell.alias("geohash"))
             .join(responses.select("location", "response"), "location")
             .select("geohash", F.explode(area_names(F.col("response"))).alias("area"))
             .where(F.col("area") != "")
             .distinct())
    return names.groupBy("geohash").agg(
        F.array_join(F.array_sort(F.collect_list("area")), ",").alias("areas"))


def with_areas(df: DataFrame, dictionary: DataFrame, spread=None) -> DataFrame:
    """Add column `areas` by the cell of the row's coordinates; NULL where there is none."""
    cells = df.withColumn("_cell", geohash(F.col("longitude"), F.col("latitude")))
    dictionary = dictionary.select(F.col("geohash").alias("_cell"), "areas")
    return lookup_join(cells, dictionary, "_cell", spread=spread).drop("_cell")
