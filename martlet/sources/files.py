"""Reading and writing staging data as CSV, JSON, XML and tables."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.schemas import CATEGORY_XML, HOLIDAY_FEED, STAGING, STAR
from martlet.sources.store import Store, in_parallel

FREE_TEXT = {"reviews"}  # tables whose fields may hold line breaks
CSV_QUOTING = {"header": True, "quote": '"', "escape": '"'}


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files under ``path``, each with its file, its split and its place in the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def file_kinds(lines: DataFrame) -> DataFrame:
    """One row for each file: its header line, where that is, and whether all of it is UTF-8 (the text source keeps the bytes).

    A collected set keeps the grouping hashed; with minima of text alone it would sort all lines by file.
    """
    place = F.struct("split", "place")
    broken = F.array_contains(F.collect_set(F.is_valid_utf8("value")), False)
    first = F.make_valid_utf8(F.min_by("value", place))
    return lines.groupBy("file").agg(
        F.rtrim(first, F.lit("\r")).alias("header"), (~broken).alias("valid"), F.min(place).alias("start")
    )


def _stored_lines(lines: DataFrame, store: Store) -> DataFrame:
    """The lines kept with their places, which another run of the scan may deal out otherwise."""
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    return store.put(lines.withColumn("turns", quotes % 2 == 1), "lines")


def _crossing(lines: DataFrame) -> DataFrame:
    """Places of the lines that belong to records of several lines, each with the place its record starts at.

    A line lies inside a quoted field if the quotes before it are odd in number (doubled quotes keep the count
    even; a quote inside an unquoted field is not allowed).  Only a line with an odd number of quotes begins or
    ends a record that crosses lines (``turns``), so only the places of those lines are put in order, split by
    split.  A running sum over the splits of a file tells which of them begin inside a record, and where it started.
    """
    turn = F.when(F.col("turns"), F.col("place"))
    splits = lines.groupBy("file", "split").agg(
        F.min("place").alias("first"), F.max("place").alias("last"),
        F.min(turn).alias("first_turn"), F.max(turn).alias("last_turn"), F.count(turn).alias("turns"),
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # one row for each split
    splits = splits.withColumn("begins", F.coalesce(F.sum("turns").over(earlier), F.lit(0)) % 2)
    left_open = F.when((F.col("begins") + F.col("turns")) % 2 == 1, F.col("last_turn"))
    splits = splits.withColumn("carried", F.last(left_open, ignorenulls=True).over(earlier))
    own = Window.partitionBy("file", "split").orderBy("place")
    turns = lines.filter("turns").select("file", "split", "place")
    turns = turns.select("*", F.row_number().over(own).alias("n"), F.lead("place").over(own).alias("next"))
    opened = turns.join(splits.select("file", "split", "begins", "last"), ["file", "split"])
    opened = opened.filter((F.col("begins") + F.col("n")) % 2 == 1)
    inside = splits.filter(F.col("begins") == 1)
    pieces = opened.select(F.col("place").alias("a"), F.coalesce("next", "last").alias("b"), F.col("place").alias("record"))
    pieces = pieces.union(inside.select("first", F.coalesce("first_turn", "last"), "carried"))
    return pieces.select(F.explode(F.sequence("a", "b")).alias("place"), "record")


def _records(lines: DataFrame, store: Store) -> DataFrame:
    """Records of free-text files, line breaks inside quoted fields included: file, split, place and value.

    One file is read by as many tasks as it has splits.  Lines that are a record by themselves stay where they
    are stored; the places of the others are stored too, so the planner knows whether they are few, and only
    these lines are put together.
    """
    placed = lines.join(store.put(_crossing(lines), "crossing"), "place", "left")
    single = placed.filter(F.col("record").isNull()).select("file", "split", "place", "value")
    pieces = F.array_sort(F.collect_list(F.struct("split", "place", "value")))
    crossing = placed.filter(F.col("record").isNotNull()).groupBy("file", "record").agg(pieces.alias("at")).select(
        "file", F.col("at")[0]["split"].alias("split"), F.col("at")[0]["place"].alias("place"), F.array_join("at.value", "\n").alias("value")
    )
    return single.unionByName(crossing)


def _names(header: str) -> list[str]:
    return next(csv.reader([header.lstrip("\ufeff")]), [])


def _fields(names: list[str], schema: T.StructType, path: str) -> tuple[T.StructType, list[Column]]:
    """Text layout of a file with these column names, and the columns of ``schema`` from it."""
    missing = [f.name for f in schema if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header {names!r}")
    # a name of its own for each place, so that repeated names do no harm
    text = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(len(names))])
    return text, [F.col(f"_{names.index(f.name)}").try_cast(f.dataType).alias(f.name) for f in schema]


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """A headed CSV file or folder in the columns of ``schema``.

    Columns are found by the names in each file's header, in any order; further columns
    are left out and a missing one is an error.  Text that does not fit its type becomes
    NULL.  Files that are not UTF-8 are read as Latin-1, each on its own account.
    ``multi_line`` allows line breaks inside quoted fields; the lines are then stored once, as
    they are at the time of the call.  Files are read in splits in either case; header and encoding meet the records by file name, and only the distinct
    pairs of them reach the driver.
    """
    lines = _lines(spark, path)
    if multi_line:
        store = Store(spark, "csv-lines")
        lines = _stored_lines(lines, store)
        described = store.put(file_kinds(lines), "files")  # the planner then knows how few they are
    else:
        described = file_kinds(lines)
    kinds = described.select("header", "valid").distinct().collect()  # one row for each layout
    if not kinds:
        return spark.createDataFrame([], schema)
    if len(kinds) == 1 and not multi_line:
        text, columns = _fields(_names(kinds[0]["header"]), schema, path)
        encoding = {} if kinds[0]["valid"] else {"encoding": "ISO-8859-1"}
        return spark.read.schema(text).options(**CSV_QUOTING, enforceSchema=True, **encoding).csv(path).select(*columns)
    records = (_records(lines, store) if multi_line else lines).join(described, "file")
    records = records.filter(F.struct("split", "place") != F.col("start"))  # the header itself
    latin = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    value = F.when(F.col("valid"), F.col("value")).otherwise(latin)
    value = F.rtrim(F.replace(value, F.lit("\r\n"), F.lit("\n")), F.lit("\r"))
    records = records.select("header", value.alias("value")).filter(F.trim("value") != "")
    parts = []
    for header in sorted({kind["header"] for kind in kinds}):
        text, columns = _fields(_names(header), schema, path)
        options = {k: v for k, v in CSV_QUOTING.items() if k != "header"}
        parsed = F.from_csv("value", text.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
        parts.append(records.filter(F.col("header") == header).select(parsed.alias("row")).select("row.*").select(*columns))
    return reduce(DataFrame.unionByName, parts)


def read_staging(spark: SparkSession, files: Mapping[str, str]) -> dict[str, DataFrame]:
    """Staging tables from their CSV files by logical name, each also a temp view."""
    frames = {
        name: read_csv(spark, path, STAGING[name], multi_line=name in FREE_TEXT)
        for name, path in files.items()
    }
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
    return frames


def land(df: DataFrame, table: str) -> DataFrame:
    """Cast to a staging layout; text that does not fit its type becomes NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in STAGING[table]]
    )


def land_all(staging: Mapping[str, DataFrame], store: Store) -> dict[str, DataFrame]:
    """Staging tables stored once in their declared layout.

    The build reads some sources several times; columnar copies keep text files from
    being parsed again and let each step read only its columns.
    """
    return in_parallel(
        {
            name: lambda name=name, df=df: store.put(land(df, name), f"staging_{name}")
            for name, df in staging.items()
        }
    )


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    df.write.mode("overwrite").options(**CSV_QUOTING).csv(path, compression=compression)


def read_holidays(spark: SparkSession, path: str) -> DataFrame:
    """Landed holiday feed; a folder reads every year.

    A file holds either one JSON array or one object per line.  Feeds of a year are small,
    so a file is parsed as a whole.
    """
    text = F.trim(F.col("value"), F.lit(" \t\r\n\ufeff"))
    lines = F.filter(F.split("value", "\n"), lambda line: F.trim(line, F.lit(" \t\r\ufeff")) != "")
    array = F.from_json(text, T.ArrayType(HOLIDAY_FEED))
    objects = F.transform(lines, lambda line: F.from_json(line, HOLIDAY_FEED))
    rows = F.when(text.startswith("["), array).otherwise(objects)
    return spark.read.text(path, wholetext=True).select(F.inline(rows))


def holidays_staging(feed: DataFrame) -> DataFrame:
    return feed.select(
        F.col("date").try_cast("date").alias("holiday_date"),
        F.col("localName").alias("local_name"),
        F.col("name").alias("english_name"),
        F.col("countryCode").alias("country_code"),
        F.coalesce("global", F.lit(True)).alias("global"),
    )


def write_json(df: DataFrame, path: str) -> None:
    """One object per line, NULL fields kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str, *order_by: str) -> None:
    """A lookup as one file with one JSON array; for feeds of bounded size only."""
    ordered = F.struct(*order_by, F.struct(*df.columns).alias("row"))
    rows = F.sort_array(F.collect_list(ordered))
    document = F.to_json(F.transform(rows, lambda r: r["row"]), {"ignoreNullFields": "false", "pretty": "true"})
    df.agg(document.alias("value")).write.mode("overwrite").text(path)


def flatten_arrays(df: DataFrame) -> DataFrame:
    """Array and struct columns as JSON text, so the table fits a CSV file."""
    return df.select(
        *[
            F.to_json(f.name).alias(f.name)
            if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))
            else F.col(f.name)
            for f in df.schema
        ]
    )


def write_category_xml(translation: DataFrame, path: str) -> None:
    rows = translation.select(
        F.col("product_category_name").alias("portuguese"),
        F.col("product_category_name_english").alias("english"),
    )
    rows.write.mode("overwrite").format("xml").option("rootTag", "categories").option(
        "rowTag", "category"
    ).save(path)


def read_category_xml(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.format("xml").schema(CATEGORY_XML).option("rowTag", "category").load(path)
    return rows.select(
        F.col("portuguese").alias("product_category_name"),
        F.col("english").alias("product_category_name_english"),
    )


def read_gold(
    spark: SparkSession, folder: str, tables: Iterable[str] = tuple(STAR), suffix: str = ""
) -> dict[str, DataFrame]:
    """Star tables from a folder of headed CSV data, typed."""
    return in_parallel(
        {table: lambda table=table: read_csv(spark, f"{folder}/{table}{suffix}", STAR[table]) for table in tables}
    )


def write_gold(star: Mapping[str, DataFrame], folder: str, compression: Mapping[str, str] = {}) -> None:
    """Star tables as headed CSV folders; ``compression`` names the codec of a table, plain text without it.

    Tables are read back by any codec.  A compressed file is read by one task, and one task wrote it.
    """
    in_parallel({
        table: lambda table=table, df=df: write_csv(df, f"{folder}/{table}", compression.get(table))
        for table, df in star.items()
    })


def replace_table(df: DataFrame, name: str) -> DataFrame:
    """Overwrite a catalog table and return it."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def save_star(star: Mapping[str, DataFrame], database: str) -> dict[str, DataFrame]:
    """Replace every table of the star in a catalog database."""
    return {table: replace_table(df, f"{database}.{table}") for table, df in star.items()}


def insert_columns(df: DataFrame, table: str) -> None:
    """Insert by name into an existing catalog table; absent columns become NULL."""
    layout = df.sparkSession.table(table).schema
    fitted = df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in layout
        ]
    )
    fitted.write.insertInto(table)


def read_jdbc(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """A table of an outside database; pass partitionColumn and bounds for big ones."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
