"""The jobs of a day, from the raw log to the stored tables.

A job leaves its tables and nothing else: intermediate tables are deleted at its end. Tables whose
key is repeated are refused.
"""

import datetime as dt
import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame

from tagloom.operators.funnel import COST_COLUMN, REPORTS, all_funnels, merged_funnels, partial_funnels, report_from
from tagloom.operators.history import DECAY
from tagloom.operators.unique import unique_by_key
from tagloom.plans.ods import build_ods
from tagloom.plans.tags import build_area_dictionary, build_tags
from tagloom.schema import TABLE_KEYS
from tagloom.session import Scratch, compiled_wide_rows, names_in, scratch_scope
from tagloom.sources.tables import DatedTables

MEMBERS = "user_id string, id string"
WEIGHTS = "user_id string, tag string, weight double"
# The folder of partial reports, by part.
PARTS = "report_parts"
# Of log rows with the same session, the latest stays.
ODS_ORDER = ("requestdate",)


def run_etl(tables: DatedTables, run_date: dt.date, log: DataFrame, regions: DataFrame,
            places: DataFrame) -> None:
    """The enriched log, one row per session."""
    with scratch_scope(tables.spark), compiled_wide_rows(tables.spark):
        raw = unique_by_key(log, TABLE_KEYS["ods"], ODS_ORDER)
        tables.write(build_ods(raw, regions, places, store_log=True), "ods", run_date, TABLE_KEYS["ods"])


def run_reports(tables: DatedTables, run_date: dt.date, cost_column: str = COST_COLUMN) -> None:
    """All report tables out of one pass over the day's log."""
    with scratch_scope(tables.spark):
        _write_reports(tables, run_date, all_funnels(tables.read("ods", run_date), cost_column=cost_column))


def _write_reports(tables: DatedTables, run_date: dt.date, funnels: DataFrame) -> None:
    funnels = Scratch(tables.spark, "reports").save(funnels, "funnels")
    for name, report in REPORTS.items():
        tables.write(report_from(funnels, name), report.table, run_date, TABLE_KEYS[report.table])
    counts = funnels.where("report = 'region'").selectExpr("province", "city", "n AS count")
    tables.write(counts, "province_city_analysis", run_date, TABLE_KEYS["province_city_analysis"])


def run_report_part(tables: DatedTables, run_date: dt.date, part: str, rows: DataFrame,
                    cost_column: str = COST_COLUMN) -> None:
    """The partial sums of a part of a day's enriched log, such as a file that came late. A part that is run
    again replaces itself."""
    tables.write(partial_funnels(rows, cost_column), f"{PARTS}/{part}", run_date)


def run_reports_of_parts(tables: DatedTables, run_date: dt.date) -> None:
    """All report tables out of the stored parts of the day, without a look at the log."""
    with scratch_scope(tables.spark):
        parts = [tables.read(f"{PARTS}/{part}", run_date) for part in names_in(tables.spark, f"{tables.base}/{PARTS}")
                 if tables.exists(f"{PARTS}/{part}", run_date)]
        if not parts:
            raise ValueError(f"no part of {run_date} is there")
        partials = functools.reduce(DataFrame.unionByName, parts)
        _write_reports(tables, run_date, merged_funnels(partials))


def run_area_dictionary(tables: DatedTables, run_date: dt.date, responses: DataFrame) -> None:
    with scratch_scope(tables.spark):
        areas = build_area_dictionary(tables.read("ods", run_date), responses)
        tables.write(areas, "business_area", run_date, TABLE_KEYS["business_area"])


def run_tags(tables: DatedTables, run_date: dt.date, app_names: DataFrame, codes: DataFrame,
             first_run: bool = False, qualify_ids: bool = False,
             decay: float | Mapping[str, float] = DECAY) -> None:
    """Today's users, merged with yesterday's tables: `tag_members` and `tag`, in long form.

    Yesterday has to be there, unless this is the `first_run`. `qualify_ids` has to be the same on
    all days.
    """
    yesterday = run_date - dt.timedelta(days=1)
    with scratch_scope(tables.spark):
        history = (tables.read_or_empty("tag_members", yesterday, MEMBERS, first_run),
                   tables.read_or_empty("tag", yesterday, WEIGHTS, first_run))
        members, weights = build_tags(
            tables.read("ods", run_date), tables.read("business_area", run_date), app_names, codes,
            history, decay, qualify_ids)
        tables.write(members, "tag_members", run_date, TABLE_KEYS["tag_members"])
        tables.write(weights, "tag", run_date, TABLE_KEYS["tag"])


def run_cooling_tags(tables: DatedTables, run_date: dt.date, app_names: DataFrame, codes: DataFrame,
                     first_run: bool = False, qualify_ids: bool = False,
                     decay: float | Mapping[str, float] = DECAY) -> None:
    """As `run_tags`, for weights that carry their day: `cooling_members` and `cooling_tag`.

    The run extends the latest stored day before it, however long ago that is, so that missed days
    need no run of their own. `cooled` gives the weights of any day.
    """
    with scratch_scope(tables.spark):
        before = tables.latest_before("cooling_tag", run_date)
        if before is None and not first_run:
            raise ValueError(f"cooling_tag has no day before {run_date}; this needs first_run")
        history = None if before is None else (tables.read("cooling_members", before),
                                               tables.read("cooling_tag", before))
        members, weights = build_tags(
            tables.read("ods", run_date), tables.read("business_area", run_date), app_names, codes,
            history, decay, qualify_ids, cooling_day=run_date)
        # The weights last, as they are what the next run looks for.
        tables.write(members, "cooling_members", run_date, TABLE_KEYS["tag_members"])
        tables.write(weights, "cooling_tag", run_date, TABLE_KEYS["tag"])
