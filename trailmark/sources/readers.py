"""Sources: CSV folders, partitioned Parquet, days of events, JSON, taxonomies, Kafka."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names as N


def csv_folder(spark: SparkSession, root: str) -> DataFrame:
    """All CSV files below ``root`` as strings, columns united by name, with _source_file; archive litter is skipped."""
    here = F.input_file_name()
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False).csv
    lines = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").text(root).select("_metadata.file_path", "_metadata.file_name", "value", F.monotonically_increasing_id().alias("at"))
    own = ~F.contains("file_path", F.lit("/__MACOSX/")) & ~F.startswith("file_name", F.lit("._"))
    heads = lines.where(own).groupBy("file_path").agg(F.min_by("value", "at").alias("head"))  # one row a file, from one pass
    by_header: dict[str, list[str]] = {}
    for r in heads.orderBy("file_path").collect():  # files of one first line are read together
        by_header.setdefault(r["head"], []).append(unquote(r["file_path"]))
    if not by_header:
        raise ValueError(f"no CSV files below {root}")
    out = None
    for same in by_header.values():
        part = rows(same).withColumn("_source_file", here)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def csv_file(spark: SparkSession, path: str, platform: str | None = None) -> DataFrame:
    """One CSV file as strings, of one platform if given; ValueError if nothing is left."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    rows = rows if platform is None else rows.where(N.platform(F.col("platform")) == platform.lower())
    if rows.isEmpty():
        raise ValueError(f"no events in {path}" + (f" for {platform}" if platform else ""))
    return rows


def parquet(spark: SparkSession, root: str) -> DataFrame:
    """A Parquet dataset; platform and bucket come from the path where they are partitions."""
    return spark.read.option("mergeSchema", True).parquet(root)


def day(spark: SparkSession, root: str, date: str, topic: str = "events") -> DataFrame:
    """One day's CSV events below ``date=YYYY-MM-DD``, record ids prefixed by the topic, each id once in sending order."""
    rows = spark.read.option("header", True).csv(f"{root}/date={date}")
    rows = rows.withColumn("record_id", F.concat_ws(":", F.lit(topic), "record_id"))
    order = [F.col(c).cast("long") for c in ("kafka_timestamp", "kafka_partition", "kafka_offset") if c in rows.columns]
    from ..operators.serving import keep_first

    return keep_first(rows, ["record_id"], [*order, F.substring_index("record_id", "-", -1).try_cast("long")])


def kafka(spark: SparkSession, servers: str, topic: str, start_ms: int, end_ms: int) -> DataFrame:
    """A topic's messages with a time in [start, end); needs Spark's Kafka package on the class path."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    rows = reader.option("startingTimestamp", start_ms).option("endingTimestamp", end_ms).load()
    return rows.select(F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp")


def flatten(rows: DataFrame, separator: str = ".") -> DataFrame:
    """Nested structs as flat columns named by their path; other types stay as they are."""

    def leaves(schema: T.StructType, at: tuple[str, ...]) -> list[Column]:
        out = []
        for f in schema.fields:
            path = (*at, f.name)
            out += leaves(f.dataType, path) if isinstance(f.dataType, T.StructType) else [F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))]
        return out

    return rows.select(*leaves(rows.schema, ()))


def json(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    return flatten(spark.read.option("multiLine", not lines).json(path))


EVENT = "session_id string, platform string, key string, segmentation_name string, screen_id string, client_time string"


def parse_events(rows: DataFrame, column: str, form: str = "json") -> DataFrame:
    """Events in a text column, as JSON (one object, or an array of them) or CSV lines; bad ones come out with nulls.

    A CSV text may hold many records; a line end within quotes belongs to its field. Times in seconds become milliseconds.
    """
    if form == "json":
        array = F.startswith(F.ltrim(column), F.lit("["))
        parsed = F.when(array, F.from_json(column, f"array<struct<{EVENT.replace(' string', ':string')}>>")).otherwise(F.array(F.from_json(column, EVENT)))
    else:
        lines = F.filter(F.regexp_extract_all(column, F.lit(r'((?:[^"\r\n]|"(?:[^"]|"")*")+)'), F.lit(1)), lambda x: F.trim(x) != "")
        parsed = F.transform(lines, lambda x: F.from_csv(x, EVENT, {"multiLine": "true", "escape": '"'}))
    out = rows.select(F.explode(parsed).alias("e")).select("e.*")
    time = F.col("client_time")
    return out.withColumn("client_time", F.when(time.rlike(r"^\d{10}$"), F.concat(time, F.lit("000"))).otherwise(time))


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Leaves from CSV, JSON or a Markdown table: taxonomy_id, family, submodule, detail."""
    wanted = ["taxonomy_id", "family", "submodule", "detail"]
    names = {"business_family": "family", "business_submodule": "submodule", "business_detail": "detail"}
    if path.endswith(".md"):
        cells = F.split("value", r"\s*\|\s*")
        rows = spark.read.text(path).where(F.col("value").rlike(r"^\s*\|\s*M\d\d\.\d\d\.\d\d\s*\|"))
        return rows.select(*(F.nullif(F.trim(F.get(cells, i + 1)), F.lit("")).alias(c) for i, c in enumerate(wanted)))
    rows = spark.read.option("multiLine", True).json(path) if path.endswith(".json") else spark.read.option("header", True).csv(path)
    rows = rows.withColumnsRenamed({a: b for a, b in names.items() if a in rows.columns})
    if lacking := set(wanted) - set(rows.columns):
        raise ValueError(f"missing taxonomy columns: {sorted(lacking)}")
    return rows.select(*(F.nullif(F.trim(c), F.lit("")).alias(c) for c in wanted))


def journey(scored: DataFrame, journey_id: str) -> DataFrame:
    """One journey: its id starts with its partition, which prunes the scan."""
    part = journey_id.partition("::")[0]
    rows = scored.where(F.col("source_partition") == part) if "source_partition" in scored.columns else scored
    return rows.where(F.col("journey_id") == journey_id)


#: Columns of an export that say nothing, its names and its values under their own names.
EXPORT_DROPS = ("segmentation.class_name", "segmentation.external_id", "segmentation.$stable", "segmentation.visit", "segmentation.stable", "segmentation.platform")
EXPORT_NAMES = {"_id.$oid": "record_id", "created_at.$date": "created_at", "dur": "duration"}
EXPORT_VALUES = {"key": {"[CLY]_view": "View", "action": "Action"}}


def clean_export(rows: DataFrame, drops: tuple[str, ...] = EXPORT_DROPS, names: dict[str, str] = EXPORT_NAMES, values: dict[str, dict[str, str]] = EXPORT_VALUES) -> DataFrame:
    """``rows`` without ``drops``, renamed, and with ``values`` put in other words; a value without a word of its own becomes null."""
    rows = rows.drop(*(F.col(f"`{c}`") for c in drops if c in rows.columns)).withColumnsRenamed({a: b for a, b in names.items() if a in rows.columns})
    for c, words in values.items():
        if c in rows.columns:
            rows = rows.withColumn(c, F.try_element_at(F.create_map(*(F.lit(x) for kv in words.items() for x in kv)), F.col(f"`{c}`")))
    return rows


def split_by(rows: DataFrame, column: str, values: tuple[str, ...] = ("Android", "iOS")) -> list[DataFrame]:
    """``rows`` by the values of a column, one table each; others are in none."""
    return [rows.where(F.col(f"`{column}`") == v) for v in values]


def bundles(spark: SparkSession, root: str, platforms: tuple[str, ...] = ("android", "ios"), summary: str = "summary") -> DataFrame:
    """(bundle, label, platforms, has_summary) of the scored runs below ``root``: summaries first, then by name.

    Paths alone are looked at: a run has ``<run>/<platform>/...`` or ``<run>/<summary>/...``.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select(F.col("path"))
    below = re.sub(r"^[A-Za-z0-9+.-]+:/*", "/", root.rstrip("/")) + "/"  # the root without its scheme
    rest = F.split(F.expr(f"substring(path, instr(path, '{below}') + {len(below)})"), "/")
    parts = files.select(F.get(rest, 0).alias("bundle"), F.get(rest, 1).alias("part")).where(F.col("part").isin(*platforms, summary)).distinct()
    found = parts.groupBy("bundle").agg(F.array_sort(F.collect_set(F.when(F.col("part") != summary, F.col("part")))).alias("platforms"), F.bool_or(F.col("part") == summary).alias("has_summary"))
    return found.select("bundle", F.replace("bundle", F.lit("_"), F.lit(" ")).alias("label"), "platforms", "has_summary").orderBy(F.col("has_summary").desc(), "bundle")
