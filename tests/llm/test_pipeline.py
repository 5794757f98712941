"""Every stage of the pipeline, on what its predecessor kept, against a plain version over Python lists."""

import random
import re

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece

import corpus_pipeline
from regionflow.llm import sentencepiece_codec, simhash

WORDS = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("ane", "ilo", "ume", "ost", "ery")]
PUBLIC = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.default_model())


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    rng, folder = random.Random(3), tmp_path_factory.mktemp("tables")
    item = prose(rng, 30)
    texts = [prose(rng, rng.randint(20, 120)) for _ in range(120)]
    texts = [f"{t} you total idiot and moron" if i % 3 == 0 else t for i, t in enumerate(texts)]
    long = prose(rng, 400)
    extra = [None, "", " \n", texts[1], texts[1].replace(" ", "  "), texts[4], long, long + " tail", f"{prose(rng, 10)} {item}", item, "x" * 3000]
    rows = list(enumerate(texts + extra)) + [(4, texts[4])]
    pq.write_table(pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "digest": ["k"] * len(rows)}), folder / "documents.parquet")
    ids = list(range(len(texts)))
    pq.write_table(pa.table({"doc_id": ids, "quality": [1] * len(ids), "toxic": [int(i % 3 == 0) for i in ids]}), folder / "labels.parquet")
    pq.write_table(pa.table({"item_id": [1, 2], "text": [item, None]}), folder / "benchmark.parquet")
    return str(folder)


def exact(rows):
    best = {}
    for r in rows:
        key = re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")
        if key not in best or (-len(r[1] or ""), r[0]) < (-len(best[key][1] or ""), best[key][0]):
            best[key] = r
    return list(best.values())


def near(rows):
    prints, left = [simhash.fingerprint(r[1]) for r in rows], set(range(len(rows)))
    kept = []
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            i = todo.pop()
            group.add(i)
            new = {j for j in left if (prints[i] ^ prints[j]).bit_count() <= simhash.TAU}
            left -= new
            todo += new
        kept.append(min((rows[i] for i in group), key=lambda r: r[0]))
    return kept


def clean(rows, item):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    w = words(item)
    windows = {tuple(w[i : i + 13]) for i in range(len(w) - 12)}
    out = []
    for r in rows:
        d = words(r[1])
        hit = {j for i in range(len(d) - 12) if tuple(d[i : i + 13]) in windows for j in range(i, i + 13)}
        if not (hit and 20 * len(hit) >= len(d)):
            out.append(r)
    return out


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=repr)


def test_stages_equal_brute_force(spark, tables, tmp_path):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    item = spark.read.parquet(f"{tables}/benchmark.parquet").where("text is not null").first().text
    columns, got = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, tables).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        got[name] = docs
        assert k == 4 or docs.columns == columns
    start = pairs(spark.read.parquet(f"{tables}/documents.parquet"))
    kept = pairs(got["toxicity"])
    gone = [r for r in start if r not in kept]
    assert all(r[1].endswith("idiot and moron") for r in gone) and len(gone) >= 36
    want = exact(kept)
    assert pairs(got["exact_dedup"]) == sorted(want, key=repr)
    want = near(want)
    assert pairs(got["simhash_near_dedup"]) == sorted(want, key=repr)
    want = clean(want, item)
    assert pairs(got["decontaminate"]) == sorted(want, key=repr) and len(want) > 60
    out = {r.doc_id: (list(r.ids), r.n_tokens, r.round_trip) for r in got["sentencepiece"].collect()}
    assert out == {i: (PUBLIC.encode(t or ""), len(PUBLIC.encode(t or "")), True) for i, t in want}
    assert {r.doc_id for r in corpus_pipeline.run(spark, tables).select("doc_id").collect()} == set(out)


def test_stages_on_an_empty_table(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).count() == 0
