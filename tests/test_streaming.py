import os
import random

from regionflow.operators import ingest
from regionflow.sources import sequence
from regionflow.streaming import ingest as streaming


def line(name, flag, seq):
    return "\t".join([name, str(flag), "c1", "1", "60", f"{len(seq)}M", "*", "0", "0", seq, "I" * len(seq)])


def write(folder, number, lines, hours):
    path = folder / f"f{number}.sam"
    path.write_text("".join(x + "\n" for x in lines))
    os.utime(path, (1_700_000_000 + hours * 3600,) * 2)


def told(spark, out):
    return {(r.qname, r.kind, r.flag1, r.seq1, r.flag2, r.seq2) for r in spark.read.parquet(str(out)).collect()}


def test_mates_meet_over_batches_and_restarts(spark, tmp_path):
    rng = random.Random(51)
    src, out, mark = tmp_path / "in", tmp_path / "out", str(tmp_path / "mark")
    src.mkdir()
    records = [(f"p{i}", f, f"{'ACGT'[i % 4]}{'CA'[f == 65]}") for i in range(60) for f in (65, 129)] + [(f"o{i}", rng.choice([65, 129]), "GG") for i in range(10)]
    records += [("skip", 65 | 512, "AA"), ("skip", 129 | 256, "AA"), ("twice", 65, "AC"), ("twice", 65, "AG"), ("twice", 129, "TT")]
    rng.shuffle(records)
    parts = [records[i::5] for i in range(5)]

    def run():
        query = streaming.write_pairs(streaming.mate_pairs(streaming.passing_reads(spark, str(src), 1), wait=7200, delay="1 hour"), str(out), mark)
        assert query.awaitTermination(240) and query.exception() is None

    for k in (0, 1, 2):
        write(src, k, [line(*r) for r in parts[k]], 0)
    run()
    for k in (3, 4):  # the rest comes after a restart, within the wait
        write(src, k, [line(*r) for r in parts[k]], 1)
    run()
    got = told(spark, out)
    assert {x[0] for x in got if x[1] == "pair"} == {f"p{i}" for i in range(60)} | {"twice"} and not [x for x in got if x[1] == "orphan"]
    batch = sequence.sam(spark, str(src))
    frame = batch.withColumn("rec_id", batch["seq"])
    assert {r.qname: (r.r1, r.r2) for r in ingest.pairs(frame).collect()} == {x[0]: (x[3], x[5]) for x in got if x[1] == "pair" and x[0] != "twice"}
    write(src, 5, [line("late", 65, "A"), line("late", 129, "C")], 9)  # past every wait
    run()
    write(src, 6, [line("later", 65, "A"), line("later", 129, "C")], 9)
    run()
    got = told(spark, out)
    assert {x[0] for x in got if x[1] == "orphan"} == {f"o{i}" for i in range(10)}
    assert sum(x[0] == "twice" and x[1] == "extra" for x in got) == 1 and not [x for x in got if x[0] == "skip"]
    rows = spark.read.parquet(str(out))
    assert rows.count() == 60 + 10 + 2 + 2 and rows.select("batch").distinct().count() >= 5
