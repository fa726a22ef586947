"""The jobs of a day as commands: python -m tagloom <job> --tables <folder> --date 2024-01-16 ..."""

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from tagloom.operators.funnel import COST_COLUMN
from tagloom.operators.history import DECAY
from tagloom.plans import daily
from tagloom.sources.adlog import read_json_log
from tagloom.sources.dictionaries import device_codes, read_dictionary
from tagloom.sources.ranges import read_ranges
from tagloom.sources.tables import DatedTables


REGION_COLUMNS = "country string, area string"
PLACE_COLUMNS = "lon double, lat double"


def _decay(text: str) -> float | dict[str, float]:
    """A number, or JSON with a number per tag prefix."""
    value = json.loads(text)
    return {k: float(v) for k, v in value.items()} if isinstance(value, dict) else float(value)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tagloom")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name, text):
        one = jobs.add_parser(name, help=text)
        one.add_argument("--tables", required=True, help="folder of the stored tables")
        one.add_argument("--date", required=True, type=dt.date.fromisoformat)
        return one

    etl = job("etl", "place the addresses of a raw log")
    etl.add_argument("--log", required=True, help="JSON lines")
    etl.add_argument("--regions", required=True, help="ranges with country and area")
    etl.add_argument("--places", required=True, help="ranges with longitude and latitude")
    etl.add_argument("--ranges-format", choices=("parquet", "csv"), default="parquet")
    job("reports", "the delivery reports").add_argument("--cost-column", default=COST_COLUMN)
    job("areas", "the dictionary of business areas").add_argument(
        "--responses", required=True, help="parquet with `location` and `response`")
    tags = job("tags", "users and their tags")
    tags.add_argument("--app-names", required=True, help="dictionary of app ids")
    tags.add_argument("--device-codes", help="dictionary of device codes; default: the fixed ones")
    tags.add_argument("--first-run", action="store_true", help="there is no table of the day before")
    tags.add_argument("--qualify-ids", action="store_true", help="keep kinds of identifiers apart")
    tags.add_argument("--decay", type=_decay, default=DECAY, help="a number, or JSON by tag prefix")
    tags.add_argument("--cooling", action="store_true",
                      help="weights carry their day, and days may be missing")
    return top


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = spark or SparkSession.builder.appName(f"tagloom-{given.job}").getOrCreate()
    tables = DatedTables(spark, given.tables)
    if given.job == "etl":
        daily.run_etl(tables, given.date, read_json_log(spark, given.log),
                      read_ranges(spark, given.regions, REGION_COLUMNS, given.ranges_format),
                      read_ranges(spark, given.places, PLACE_COLUMNS, given.ranges_format))
    elif given.job == "reports":
        daily.run_reports(tables, given.date, given.cost_column)
    elif given.job == "areas":
        daily.run_area_dictionary(tables, given.date, spark.read.parquet(given.responses))
    else:
        codes = (read_dictionary(spark, given.device_codes, "value", "code")
                 if given.device_codes else device_codes(spark))
        run = daily.run_cooling_tags if given.cooling else daily.run_tags
        run(tables, given.date, read_dictionary(spark, given.app_names, "appid", "appname"),
            codes, given.first_run, given.qualify_ids, given.decay)


if __name__ == "__main__":
    main()
