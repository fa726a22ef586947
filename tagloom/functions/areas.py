"""Requests to and responses of the reverse-geocoding service."""

from pyspark.sql import Column, functions as F

_RESPONSE = (
    "regeocode struct<addressComponent: struct<businessAreas: "
    "array<struct<id: string, location: string, name: string>>>>"
)


def request_key(longitude, latitude) -> Column:
    """`lon,lat`, the text a stored response is found by."""
    return F.when(longitude.isNotNull() & latitude.isNotNull(),
                  F.concat_ws(",", longitude.cast("string"), latitude.cast("string")))


def area_names(response) -> Column:
    """Names of the business areas in a response; empty if there are none or it is malformed."""
    document = F.from_json(response, _RESPONSE)
    names = F.transform(document["regeocode"]["addressComponent"]["businessAreas"],
                        lambda area: area["name"])
    return F.coalesce(F.filter(names, lambda name: name.isNotNull()),
                      F.array().cast("array<string>"))


def area_text(response) -> Column:
    return F.array_join(area_names(response), ",")
