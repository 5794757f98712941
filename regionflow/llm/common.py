"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: A side of a join is broadcast only when it has been counted and has no more rows than this.
BROADCAST_ROWS = 500_000
#: A group is hot if it holds more than this share of all rows; there are fewer such groups than one in the share.
HOT = 1 / 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A session without one gets a local folder if it runs in one process, as tests
    do; on a cluster, whose executors would each see a folder of their own, that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="regionflow-")
        spark.conf.set("spark.checkpoint.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Computes df once into the shared folder; later reads survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def join_small(df: DataFrame, keys: DataFrame, on: Column, how: str) -> DataFrame:
    """df semi- or anti-joined with keys, which must be cut: broadcast if counted small, else shuffled."""
    side = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
    return df.join(side, on, how)


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size_col: str, total: int) -> DataFrame:
    """rows joined with the one group that each belongs to, by keys without nulls. size_col counts the rows of a group,
    total all of them. Groups over the share HOT, fewer than 1 / HOT, are broadcast, so none makes a shuffled partition
    large; the rows of the others shuffle. rows is read twice and should be cut."""
    hot = F.col(size_col) > int(total * HOT)
    few = F.broadcast(groups.where(hot))
    return rows.join(few, keys).unionByName(rows.join(few.select(*keys), keys, "left_anti").join(groups.where(~hot), keys))


def row_keys(id_col: str, text_col: str) -> list[Column]:
    """What names a row: its id and a hash of its text. Rows that agree in both are repeats of one another."""
    return [F.col(id_col).alias("k_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k_text")]


def keep_rows(docs: DataFrame, decisions: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of docs that decisions (k_id, k_text, kept; one row per row of docs) keeps.

    If a row and its own repeats (same id, same text) differ in kept, one of them stays: that whose other columns come
    first as JSON. The columns of docs, whatever their names, come back unchanged.
    """
    verdict = cut(
        decisions.groupBy("k_id", "k_text")
        .agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("long")).alias("n_kept"))
        .where("n_kept < n")
    )
    dropped, repeated = verdict.where("n_kept = 0"), cut(verdict.where("n_kept > 0"))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    key = (F.col("row")[id_col].eqNullSafe(F.col("k_id"))) & (
        F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))) == F.col("k_text")
    )
    if repeated.isEmpty():
        out = join_small(left, cut(dropped.select("k_id", "k_text")), key, "left_anti")
    else:
        out = join_small(left, cut(verdict.select("k_id", "k_text")), key, "left_anti").unionByName(
            join_small(left, repeated.select("k_id", "k_text"), key, "left_semi")
            .groupBy(F.col("row")[id_col].alias("a"), F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))).alias("b"))
            .agg(F.min_by("row", F.to_json("row")).alias("row"))
            .select("row")
        )
    return out.select("row.*")


def bounded_sample(df: DataFrame, class_col: str, key_cols: list[str], per_class: int) -> DataFrame:
    """About per_class distinct rows of each class, by a hash of the key columns: the same rows whatever the partitions.
    Rows that agree in the keys and the class count once, so that one which repeats cannot swell the sample."""
    counted = [(r[0], r["count"]) for r in df.groupBy(class_col).count().collect() if r[0] is not None]
    if not counted:
        return df.limit(0)
    place = F.pmod(F.xxhash64(*key_cols, F.lit("sample")), F.lit(1_000_000))
    kind = df.schema[class_col].dataType
    below = F.create_map(*[x for value, n in counted for x in (F.lit(value).cast(kind), F.lit(int(1_000_000 * min(1.0, per_class / n))))])
    return df.where(place < F.try_element_at(below, F.col(class_col))).dropDuplicates([class_col, *key_cols])


def slices(lengths: list[int], points: int, rows: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of the given lengths that are worked at once: a text, and those after it within both bounds."""
    a = total = 0
    for i, n in enumerate(lengths):
        if i > a and (total + n > points or i - a >= rows):
            yield a, i
            a, total = i, 0
        total += n
    if len(lengths) > a:
        yield a, len(lengths)


def remainder(id_col: str, k: int):
    """crc32 of the id as text, modulo k; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % k


class Store(dict):
    """What compute gives, by key. Beyond size entries the older half goes, so there are never over twice as many; a
    key longer than longest is computed each time, so entries are small too."""

    def __init__(self, compute, size: int, longest: int):
        self.compute, self.size, self.longest, self.old = compute, size, longest, {}

    def __missing__(self, key):
        if len(key) > self.longest:
            return self.compute(key)
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value
