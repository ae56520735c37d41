"""Landing the staging tables in the formats their sources use."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from martlet.sources import files
from martlet.sources.store import in_parallel

TRANSACTIONS = ("orders", "order_items", "payments", "reviews")
MASTER_DATA = ("customers", "products", "sellers", "geolocation")


def prepare_sources(
    staging: Mapping[str, DataFrame], holiday_feed: DataFrame, folder: str, database: str | None = None
) -> dict[str, str]:
    """Transactions as CSV, lookups as CSV and XML, holidays as JSON and CSV, masters as tables.

    Master data goes to catalog tables of ``database``, or to parquet when none is given.
    Returns where each piece was written.
    """
    translation = staging["category_translation"]
    placed = {name: f"{folder}/csv/{name}" for name in TRANSACTIONS}
    jobs = {name: lambda name=name: files.write_csv(staging[name], placed[name]) for name in TRANSACTIONS}
    placed["category_translation_csv"] = f"{folder}/csv/category_translation"
    jobs["category_translation_csv"] = lambda: files.write_csv(translation, placed["category_translation_csv"])
    placed["category_translation_xml"] = f"{folder}/xml/category_translation"
    jobs["category_translation_xml"] = lambda: files.write_category_xml(translation, placed["category_translation_xml"])
    placed["holidays"] = f"{folder}/json/holidays"
    jobs["holidays"] = lambda: files.write_json_array(holiday_feed, placed["holidays"], "date")
    placed["holidays_csv"] = f"{folder}/csv/holidays"
    jobs["holidays_csv"] = lambda: files.write_csv(files.flatten_arrays(holiday_feed), placed["holidays_csv"])
    for name in MASTER_DATA:
        if database:
            placed[name] = f"{database}.{name}"
            jobs[name] = lambda name=name: files.replace_table(staging[name], placed[name])
        else:
            placed[name] = f"{folder}/master/{name}"
            jobs[name] = lambda name=name: staging[name].write.mode("overwrite").parquet(placed[name])
    in_parallel(jobs)
    return placed
