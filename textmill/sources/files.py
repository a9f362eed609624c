"""Files in and out: CSV with and without types, tolerant JSON, day files, calendars, sorted sinks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Doubled quotes, line breaks inside quotes, and white space kept as it is.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def require(df: DataFrame, *columns: str) -> DataFrame:
    """``df``, or an error that names the columns it lacks."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def renamed(df: DataFrame, **names: str) -> DataFrame:
    """``df`` with columns renamed (old=new), or an error that names those it lacks."""
    return require(df, *names).withColumnsRenamed(names)


def with_defaults(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` with the columns it lacks as empty strings, those it has with '' for null, in the given order."""
    return df.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | str, line_breaks: bool = True) -> DataFrame:
    """CSV with a header and doubled quotes; columns are taken by name, a byte order mark is none of the first name.

    With ``line_breaks`` inside quotes a file is read by one task; without, large files are split."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = _without_mark(spark.read.options(**CSV, multiLine=line_breaks).csv(path))
    require(raw, *schema.names)
    return raw.select(*(F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields))


def _without_mark(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.lstrip("\ufeff") for c in df.columns if c.startswith("\ufeff")})


def read_csv_strings(spark: SparkSession, path: str | list[str], columns: tuple[str, ...], line_breaks: bool = True) -> DataFrame:
    """CSV of strings from a path, several, or a glob: nothing is guessed, a missing value is the empty string; no file, or an empty folder, gives an empty table."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    try:
        raw = _without_mark(spark.read.options(**CSV, multiLine=line_breaks).csv(path))
    except Exception as e:  # no file matches, or an empty folder
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return spark.createDataFrame([], schema)
        raise
    if not raw.columns:
        return spark.createDataFrame([], schema)
    require(raw, *columns)
    return raw.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns))


def read_json_reports(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per JSON file with ``day`` from its name and ``report``; a corrupt file has a null report."""
    raw = spark.read.option("wholetext", True).text(path)
    name = F.regexp_extract(F.input_file_name(), r"([0-9]{4}-[0-9]{2}-[0-9]{2})\.json$", 1)
    return raw.select(name.try_cast("date").alias("day"), F.when(F.try_parse_json("value").isNotNull(), F.from_json("value", schema)).alias("report"))


def newest(reports: DataFrame) -> DataFrame:
    """The report of the last day."""
    return reports.where("day IS NOT NULL").agg(F.max("day").alias("day"), F.max_by("report", "day").alias("report"))


def days_of(reports: DataFrame) -> DataFrame:
    """``day``, ``readable`` of all files with a day in their name, in the order of the days."""
    return reports.where("day IS NOT NULL").select("day", F.col("report").isNotNull().alias("readable")).orderBy("day")


def read_yaml(spark: SparkSession, path: str) -> object:
    """The content of a small YAML file (or JSON, which is YAML); {} where there is none or it is empty."""
    try:
        text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())  # a file of settings
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    try:
        import yaml
    except ImportError:  # without that library only the JSON part of YAML can be read
        return json.loads(text or "{}") or {}
    return yaml.safe_load(text) or {}


def settings(given: dict | None, block: str, defaults: dict, fallback: dict[str, tuple[str, str]] | None = None) -> dict:
    """The values of one block of settings, each in the type of its default; a missing one is the default, or
    the value of (block, name) that ``fallback`` names for it."""
    given = given or {}
    own, out = given.get(block) or {}, {}
    for name, default in defaults.items():
        value = own.get(name)
        if value is None and fallback and name in fallback:
            other, key = fallback[name]
            value = (given.get(other) or {}).get(key)
        out[name] = default if value is None else type(default)(value)
    return out


CALENDAR = "place int, name string, date string, rule string, confirmed boolean, lead_days int"


def calendar(spark: SparkSession, entries: list | None) -> DataFrame:
    """``place``, ``name``, ``date``, ``rule``, ``confirmed``, ``lead_days`` of calendar entries; those that are no mapping
    or have no name are skipped, a date that cannot be read is null."""
    rows = []
    for i, e in enumerate(entries or []):
        if isinstance(e, dict) and e.get("name"):
            rows.append((i, str(e["name"]), str(e["date"]) if e.get("date") else None, e.get("rule"), bool(e.get("confirmed", False)), e.get("lead_days")))
    return spark.createDataFrame(rows, CALENDAR).withColumn("date", F.col("date").try_cast("date"))


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """The entries under ``events`` of a YAML file."""
    content = read_yaml(spark, path)
    return calendar(spark, content.get("events") if isinstance(content, dict) else None)


def _paths(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return hadoop, at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_state(spark: SparkSession, path: str, text: str) -> None:
    """A small file replaced as a whole: written beside it and renamed, so a reader sees the old or the new one."""
    hadoop, at, fs = _paths(spark, path)
    part = hadoop.Path(f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    fs.delete(at, False)
    if not fs.rename(part, at):
        raise OSError(f"{part} could not be renamed to {path}")


def read_state(spark: SparkSession, path: str) -> str | None:
    """The content of a small file, null where there is none."""
    _, at, fs = _paths(spark, path)
    if not fs.exists(at):
        return None
    return "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())


def exposition(df: DataFrame, metric: str, value: str, *labels: str) -> DataFrame:
    """``line``: one sample of a metric a row in the text format of monitoring systems; label values are escaped."""
    quoted = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), r"\\", r"\\\\"), '"', r'\\"')
    named = F.concat_ws(",", *(F.concat(F.lit(f'{c}="'), quoted(c), F.lit('"')) for c in labels))
    return df.select(F.concat(F.lit(f"{metric}{{"), named, F.lit("} "), F.col(value).cast("string")).alias("line"))


def write_csv_sorted(df: DataFrame, path: str, columns: tuple[str, ...], *order: str) -> None:
    """One CSV folder whose parts, read in order, are sorted by content: the same rows give the same bytes."""
    df.select(*columns).orderBy(*(order or columns)).write.mode("overwrite").options(**CSV).csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """A one-row table as a JSON document; nulls are written."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false", "pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def append_by_day(df: DataFrame, path: str, day: str) -> None:
    """Append to a table partitioned by day."""
    df.write.mode("append").partitionBy(day).parquet(path)


def long_metrics(df: DataFrame, *keys: str) -> DataFrame:
    """Numeric columns as rows ``metric``, ``value``; null metrics are not written."""
    numeric = [f.name for f in df.schema.fields if f.name not in keys and isinstance(f.dataType, T.NumericType)]
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numeric))).alias("x")
    return df.select(*keys, cells).select(*keys, "x.*").where("value IS NOT NULL")


def markdown(df: DataFrame, limit: int = 200) -> str:
    """A small table as Markdown: a report of at most ``limit`` rows, said so where it is cut."""
    rows = df.limit(limit + 1).collect()
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows[:limit]]
    if len(rows) > limit:
        lines.append(f"\nFirst {limit} rows.")
    return "\n".join(lines) + "\n"
