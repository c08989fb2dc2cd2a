"""Reading and writing the text tables and the model tables.

A field that should be a number and is none is read as null; no bad line ends
a job.
"""

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from broadsheet.functions.text import glue_key, key_part, one_line
from broadsheet.functions.times import epoch_millis
from broadsheet.operators.profiles import profile_parts
from broadsheet.plans.skew import ranked, salted_join
from broadsheet.settings import PROFILE_PARTS

# --- fixed values: record layouts ----------------------------------------------
CLICK_LOG = "user_id STRING, news_id STRING, click_s STRING, title STRING, content STRING, publish_text STRING"
BRIEF_LOG = "user_id STRING, news_id STRING, click_s STRING"
ASSIGNMENTS = "article_key STRING, category INT"
KEYWORD_MAP = "news_id BIGINT, keywords STRING, publish_text STRING"


def _read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, sep="\t", quote="", escape="", enforceSchema=True)


def _write_tsv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").csv(
        path, sep="\t", quote="", escape="", emptyValue="", nullValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def _number(column: str) -> Column:
    return F.expr(f"try_cast(trim({column}) AS BIGINT)")


def _click_time(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


# --- click logs -------------------------------------------------------------------


def read_click_log(spark: SparkSession, path: str) -> DataFrame:
    """The full click log, six fields a line."""
    raw = _read_tsv(spark, path, CLICK_LOG)
    return raw.select(
        _number("user_id").alias("user_id"),
        _number("news_id").alias("news_id"),
        _click_time(_number("click_s")).alias("click_ts"),
        "title",
        "content",
        F.trim("publish_text").alias("publish_text"),
    )


def write_click_log(log: DataFrame, path: str) -> None:
    seconds = F.unix_seconds(F.col("click_ts").cast("timestamp"))
    _write_tsv(
        log.select(
            "user_id", "news_id", seconds, one_line(F.col("title")), one_line(F.col("content")),
            "publish_text",
        ),
        path,
    )


def read_brief_log(spark: SparkSession, path: str) -> DataFrame:
    """The short click log: user, article, click time."""
    raw = _read_tsv(spark, path, BRIEF_LOG)
    return raw.select(
        _number("user_id").alias("user_id"),
        _number("news_id").alias("news_id"),
        _click_time(_number("click_s")).alias("click_ts"),
    )


def write_brief_log(clicks: DataFrame, path: str) -> None:
    seconds = F.unix_seconds(F.col("click_ts").cast("timestamp"))
    _write_tsv(clicks.select("user_id", "news_id", seconds), path)


# --- category assignments -----------------------------------------------------------


def write_assignments(assignment: DataFrame, path: str) -> None:
    key = glue_key(F.col("news_id"), epoch_millis(F.col("publish_ts")))
    _write_tsv(assignment.select(key, "category"), path)


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Lines of ``id|milliseconds`` and category."""
    raw = _read_tsv(spark, path, ASSIGNMENTS)
    key = F.col("article_key")
    return raw.select(
        key_part(key, 1).try_cast("bigint").alias("news_id"),
        F.timestamp_millis(key_part(key, 2).try_cast("bigint")).cast("timestamp_ntz").alias("publish_ts"),
        "category",
    )


# --- keyword maps -------------------------------------------------------------------


def _entries(digits: int | None) -> Column:
    """The keywords of a group as ``word:weight|word:weight|``, in word order."""
    weight = F.col("weight").cast("string")
    if digits is not None:
        weight = F.expr(f"format_number(weight, '0.{'0' * digits}')")
    entry = F.concat(F.col("term"), F.lit(":"), weight, F.lit("|"))
    return F.array_join(F.array_sort(F.collect_list(entry)), "").alias("keywords")


def keyword_lines(keywords: DataFrame, digits: int | None = None) -> DataFrame:
    """The keywords of each article as text; an article has few of them.

    Weights keep their full precision unless ``digits`` are given.
    """
    return keywords.groupBy("news_id").agg(_entries(digits))


def profile_lines(
    profile: DataFrame, digits: int | None = None, parts: int = PROFILE_PARTS
) -> DataFrame:
    """User profiles as text, a line per user and part (see ``profile_parts``)."""
    return profile_parts(profile, parts).groupBy("user_id", "part").agg(
        _entries(digits)
    )


def parse_keyword_lines(lines: DataFrame, key: str = "news_id") -> DataFrame:
    """Long rows from keyword text; entries that are not a pair are skipped."""
    pairs = F.filter(
        F.transform(F.split("keywords", r"\|"), lambda e: F.split(e, ":")),
        lambda pair: F.size(pair) == 2,
    )
    return (
        lines.select(key, F.explode(pairs).alias("pair"))
        .select(
            key,
            F.trim(F.col("pair")[0]).alias("term"),
            F.trim(F.col("pair")[1]).try_cast("double").alias("weight"),
        )
    )


def write_keyword_map(keywords: DataFrame, articles: DataFrame, path: str) -> None:
    lines = keyword_lines(keywords).join(articles.select("news_id", "publish_text"), "news_id")
    _write_tsv(lines.select("news_id", "keywords", "publish_text"), path)


def read_keyword_map(spark: SparkSession, path: str) -> DataFrame:
    return parse_keyword_lines(_read_tsv(spark, path, KEYWORD_MAP))


# --- labelled tables ----------------------------------------------------------------


CELL_PATTERN = r'("(?:[^"\\]|\\.|"")*"|[^,]*),'  # one cell and the comma after it


def write_labelled_csv(frame: DataFrame, path: str) -> None:
    """Label and cells of each row, comma separated, no header."""
    frame.write.mode("overwrite").csv(path)


def read_labelled_csv(
    spark: SparkSession, path: str, label_index: int = 0, header: bool = False
) -> DataFrame:
    """Rows of label and cells; cells stay text until they are indexed.

    Rows may have any number of cells, each its own. A cell in quotes may hold
    commas, and quotes that are doubled or follow a backslash, but no line end.
    With ``header``, lines like the first one are left out; empty lines are.
    """
    lines = spark.read.text(path).where("value <> ''")
    if header and (first := lines.first()):
        lines = lines.where(F.col("value") != F.lit(first[0]))
    found = F.regexp_extract_all(F.concat("value", F.lit(",")), F.lit(CELL_PATTERN), F.lit(1))
    bare = F.transform(
        found,
        lambda c: F.when(
            c.startswith('"'), F.regexp_replace(F.substring(c, F.lit(2), F.length(c) - 2), r'["\\]"', '"')
        ).otherwise(c),
    )
    cells = lines.select(bare.alias("all"))
    return cells.select(
        F.get("all", F.lit(label_index)).alias("label"),
        F.concat(
            F.slice("all", 1, label_index), F.slice("all", label_index + 2, F.size("all"))
        ).alias("cells"),
    )


def cell_rows(rows: DataFrame) -> DataFrame:
    """One row per cell with its position."""
    others = [c for c in rows.columns if c != "cells"]
    return rows.select(*others, F.posexplode("cells").alias("position", "cell"))


def cell_dictionary(cells: DataFrame) -> DataFrame:
    """Numbers for the cells that are no numbers: most frequent first, from 1."""
    words = (
        cells.where(F.expr("try_cast(cell AS DOUBLE) IS NULL"))
        .groupBy("cell")
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    return ranked(words, [(F.col("uses"), "desc"), (F.col("cell"), "asc")], "cell_id")


def index_cells(cells: DataFrame, dictionary: DataFrame, spread_by: list[str]) -> DataFrame:
    """The value of each cell: a number as it is, a word by its id, else 0."""
    joined = salted_join(
        cells, dictionary.select("cell", "cell_id"), "cell",
        cells.groupBy("cell").agg(F.count(F.lit(1)).alias("uses")), "uses", spread_by, "left",
    )
    number = F.expr("try_cast(cell AS DOUBLE)")
    return joined.withColumn(
        "value", F.coalesce(number, F.col("cell_id").cast("double"), F.lit(0.0))
    ).drop("cell_id")


# --- union of sources ------------------------------------------------------------------


def tagged_union(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of several sources, each with the name of its own; columns by name."""
    tagged = [frame.withColumn("source", F.lit(name)) for name, frame in sources.items()]
    merged = tagged[0]
    for frame in tagged[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged


# --- model tables ----------------------------------------------------------------------


def write_table(frame: DataFrame, path: str, format: str = "parquet", **options: str) -> None:
    """Overwrite a dataset."""
    frame.write.mode("overwrite").format(format).options(**options).save(path)


MANIFEST = "version long, name string, path string"


def save_state(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Keep the tables of a trained model, all or none.

    Tables go to a folder of their own; one file added to the manifest, at the
    end, makes them the current ones. A save that fails on the way leaves what
    was there before, and a reader has the tables of one save.
    """
    spark = next(iter(tables.values())).sparkSession
    path = f"{folder}/versions/{uuid.uuid4().hex}"
    for name, frame in tables.items():
        write_table(frame, f"{path}/{name}")
    version = 1 + (_manifest(spark, folder).agg(F.max("version")).first()[0] or 0)
    rows = [(version, name, f"{path}/{name}") for name in tables]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def _manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The saves that are complete; none before the first."""
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def load_state(spark: SparkSession, folder: str, names: list[str]) -> dict[str, DataFrame]:
    """The named tables, each of the last save that had it."""
    rows = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").where(F.col("name").isin(names))
    paths = {r["name"]: r["path"] for r in rows.groupBy("name").agg(F.max_by("path", "version").alias("path")).collect()}
    return {name: spark.read.parquet(paths[name]) for name in names}
