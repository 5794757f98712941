"""The batch pipeline as stages over DataFrames; finished stages are read back instead of run again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Stage = tuple[str, Callable[[DataFrame], DataFrame]]

#: The file in a run's folder that tells what it was made from.
TOLD = "made_from.txt"


def _path(spark: SparkSession, text: str):
    """A path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(text)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def fingerprint(spark: SparkSession, inputs: list[str], **parameters: object) -> str:
    """A hash of the files that inputs (paths, folders or patterns) name, their lengths and times, and of parameters. A
    path that names nothing is an error."""
    found = []
    for text in inputs:
        path, fs = _path(spark, text)
        tops = fs.globStatus(path)
        if not tops:
            raise ValueError(f"no such input: {text}")
        for top in tops:
            files = [top] if top.isFile() else []
            listed = fs.listFiles(top.getPath(), True) if not top.isFile() else None
            while listed is not None and listed.hasNext():
                files.append(listed.next())
            found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    told = json.dumps([sorted(found), sorted((k, str(v)) for k, v in parameters.items())])
    return hashlib.sha256(told.encode()).hexdigest()


def claim(spark: SparkSession, folder: str, made_from: str, first: str) -> None:
    """Notes in folder what its stages are made from. A folder of another run, or one that holds a finished first stage
    without telling, is an error, so its results are not taken for this run's."""
    path, fs = _path(spark, f"{folder}/{TOLD}")
    if fs.exists(path):
        had = spark.read.text(path.toString()).first()
        if had is None or had[0] != made_from:
            raise ValueError(f"{folder} holds the stages of other inputs or parameters")
        return
    done, _ = _path(spark, f"{folder}/{first}/_SUCCESS")
    if fs.exists(done):
        raise ValueError(f"{folder} holds stages of unknown inputs")
    out = fs.create(path, True)
    out.write(bytearray(made_from.encode()))
    out.close()


def run(spark: SparkSession, start: DataFrame, stages: list[Stage], folder: str, check: Callable[[str, DataFrame], bool] | None = None, made_from: str | None = None) -> DataFrame:
    """Each stage's result is a Parquet folder; one with a success mark is not computed again. check may refuse a
    result, which ends the run. made_from (of fingerprint) must be what the folder's stages were made from before, if any."""
    if made_from is not None and stages:
        claim(spark, folder, made_from, stages[0][0])
    df = start
    for name, stage in stages:
        path = f"{folder}/{name}"
        mark, fs = _path(spark, f"{path}/_SUCCESS")
        if not fs.exists(mark):
            stage(df).write.mode("overwrite").parquet(path)
        df = spark.read.parquet(path)
        if check is not None and not check(name, df):
            raise RuntimeError(f"stage {name} failed its check")
    return df
