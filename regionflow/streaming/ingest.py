"""Reads that arrive as SAM text files: the same parsing and filters on a stream, and mates that find each other."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from regionflow.functions import reads as R
from regionflow.operators.ingest import passing
from regionflow.sources.sequence import parse_sam

PAIRS = "qname string, kind string, flag1 int, seq1 string, qual1 string, flag2 int, seq2 string, qual2 string"
HELD = "flag int, seq string, qual string, done boolean"


def passing_reads(spark: SparkSession, folder: str, files_per_trigger: int = 16) -> DataFrame:
    """A streaming DataFrame of the passing records of the SAM files that appear in folder, with at, their file's time."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return passing(parse_sam(lines.select("value", F.col("_metadata.file_modification_time").alias("at"))))


def contig_counts(reads: DataFrame) -> DataFrame:
    """Running counts by contig, for an update or complete sink."""
    return reads.groupBy("rname").agg(F.count("*").alias("n"))


def mate_pairs(reads: DataFrame, wait: int = 86_400, delay: str = "1 hour") -> DataFrame:
    """qname, kind, flag1, seq1, qual1, flag2, seq2, qual2 of a stream of passing reads (qname, flag, seq, qual, at).

    A record that finds its mate waiting leaves with it as a pair, whatever batch either came in; another of a mate that
    waits or has left is extra. One whose mate has not come when the stream's times, less delay, are wait seconds past its
    own leaves as an orphan. A name's state is one record and goes with the wait. Records without a name have no mate and
    are left out."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in PAIRS.split(", ")]
        sides = lambda a, b: [*(a or (None,) * 3), *(b or (None,) * 3)]
        one = lambda kind, r: [key[0], kind, *(sides(r, None) if r[0] & R.READ1 else sides(None, r))]
        if state.hasTimedOut:
            flag, seq, qual, done = state.get
            state.remove()
            yield pd.DataFrame([] if done else [one("orphan", (flag, seq, qual))], columns=names)
            return
        held, out = (state.get if state.exists else None), []
        rows = pd.concat(list(batches))
        for flag, seq, qual in sorted(zip(rows["flag"].tolist(), rows["seq"].tolist(), rows["qual"].tolist()), key=lambda r: (not r[0] & R.READ1, *map(str, r))):
            r = (int(flag), seq, qual)
            if held is None:
                held = (*r, False)
            elif not held[3] and bool(held[0] & R.READ1) != bool(r[0] & R.READ1):
                first, second = sorted((held[:3], r), key=lambda x: not x[0] & R.READ1)
                out.append([key[0], "pair", *sides(first, second)])
                held = (*held[:3], True)
            else:
                out.append(one("extra", r))
        state.update(held)
        last = int(rows["at"].max().timestamp() * 1000)
        state.setTimeoutTimestamp(max(last + 1000 * wait, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=names)

    named = reads.where("qname is not null").select("qname", "flag", "seq", "qual", "at").withWatermark("at", delay)
    return named.groupBy("qname").applyInPandasWithState(step, PAIRS, HELD, "append", GroupStateTimeout.EventTimeTimeout)


def write_pairs(pairs: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """A query that writes each batch of mate_pairs to a folder of its own below path, batch=<number>; a batch that is run again
    after a failure replaces its folder, so nothing is told twice."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return pairs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
