"""Batch lists, configuration, sequence dictionaries and interval files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators.genome import intervals
from regionflow.operators.ingest import numbered


def batch(spark: SparkSession, path: str) -> DataFrame:
    """sample_id, path1, path2 (null for one file) of lines of exactly two words; another line is an error."""
    words = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")
    bad = F.raise_error(F.concat(F.lit("not a sample and a path: "), "value"))
    w = spark.read.text(path).select(F.when(F.size(words) == 2, words).otherwise(bad).alias("w"))
    paths = F.split(F.col("w")[1], ",")
    return w.select(F.col("w")[0].alias("sample_id"), F.get(paths, F.lit(0)).alias("path1"), F.get(paths, F.lit(1)).alias("path2"))


_ENTRY = re.compile(r"(?P<key>[^:]*):(?P<value>.*)")
_IGNORED = re.compile(r"#.*|---|.{0,2}")


def config(lines: list[str]) -> dict[str, str | list[str]]:
    """A flat YAML subset: `key: value` and `key: [a, b]`, all scalars text, quotes dropped. Comments, `---` and lines
    under three characters say nothing, `...` ends it, a key without a value is an error."""
    body = [x.strip() for x in lines]
    body = body[: body.index("...")] if "..." in body else body
    entries = [_ENTRY.fullmatch(x) or {"key": x, "value": ""} for x in body if not _IGNORED.fullmatch(x)]
    return {e["key"].strip(): _value(e["key"], e["value"].strip()) for e in entries}


def _value(key: str, text: str) -> str | list[str]:
    if not text:
        raise IndexError(f"{key} has no value")
    if text.startswith("["):
        return re.sub(r"[\s'\"]", "", text)[1:-1].split(",")
    return text.strip("'\"")


def with_values(text: str, values: dict[str, str]) -> str:
    """Configuration text with the values of the given keys replaced, quoted; all else stays, keys it lacks are not added."""
    names = "|".join(map(re.escape, values))
    return re.sub(rf"(?m)^[ \t]*({names})[ \t]*:.*$", lambda m: f'{m[1]}: "{values[m[1]]}"', text) if values else text


def sequence_dict(spark: SparkSession, path: str) -> DataFrame:
    """contig_id (file order), contig, len of the @SQ lines. A dictionary is one small file, read as a whole."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("n", "line")).where("line like '@SQ%'")
    at = lines.select("n", F.regexp_extract("line", r"\tSN:([^\t]+)", 1).alias("contig"), F.regexp_extract("line", r"\tLN:(\d+)", 1).cast("long").alias("len"))
    return numbered(at, ["n"], "contig_id").select(F.col("contig_id").cast("int"), "contig", "len")


def read_intervals(spark: SparkSession, path: str, halo: int) -> DataFrame:
    """region_name, contig, lo, hi of files `<region>.m<k>bp.intervals`; contig names may hold colons."""
    rows = spark.read.option("pathGlobFilter", f"*.m{halo // 1000}bp.intervals").text(path).where("trim(value) <> ''")
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)\.", 1)
    part = lambda k: F.regexp_extract("value", r"^(.*):(\d+)-(\d+)$", k)
    return rows.select(name.alias("region_name"), part(1).alias("contig"), part(2).cast("long").alias("lo"), part(3).cast("long").alias("hi"))


def interval_rows(spark: SparkSession, path: str) -> DataFrame:
    """contig, lo, hi of the contig:start-end lines of a file; empty lines and those that begin with @ or # are left out, another
    form is an error."""
    lines = spark.read.text(path).select(F.trim("value").alias("value")).where("value <> '' and value not like '@%' and value not like '#%'")
    part = lambda k: F.regexp_extract("value", r"^(.+):(\d+)-(\d+)$", k)
    checked = F.when(F.col("value").rlike(r"^.+:\d+-\d+$"), part(1)).otherwise(F.raise_error(F.concat(F.lit("not an interval: "), "value")))
    return lines.select(checked.alias("contig"), part(2).cast("long").alias("lo"), part(3).cast("long").alias("hi"))


def interval_lines(iv: DataFrame, n_regions: int) -> DataFrame:
    """name and value, the line, and what they are sorted by (contig_id, lo)."""
    return iv.select(R.region_name(F.col("region"), n_regions).alias("name"), R.interval_text(F.col("contig"), F.col("lo"), F.col("hi")).alias("value"), "contig_id", "lo")


def write_interval_files(contigs: DataFrame, n_regions: int, path: str, halo: int = 1000) -> None:
    """The intervals of all regions with 0, 1, 2 and 3 halos, as text below path/halo=m<k>bp/name=<region>."""
    each = [interval_lines(intervals(contigs, n_regions, k * halo), n_regions).withColumn("halo", F.lit(f"m{k}bp")) for k in range(4)]
    reduce(DataFrame.unionByName, each).repartition("halo", "name").sortWithinPartitions("halo", "name", "contig_id", "lo").select("halo", "name", "value").write.partitionBy("halo", "name").text(path)


def read_interval_files(spark: SparkSession, path: str, halos: int) -> DataFrame:
    """region_name, contig, lo, hi of what write_interval_files wrote for so many halos."""
    rows = spark.read.text(path).where(F.col("halo") == f"m{halos}bp")
    part = lambda k: F.regexp_extract("value", r"^(.*):(\d+)-(\d+)$", k)
    return rows.select(F.col("name").alias("region_name"), part(1).alias("contig"), part(2).cast("long").alias("lo"), part(3).cast("long").alias("hi"))
