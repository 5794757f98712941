"""Source divergence against plain Python integers."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from regionflow.llm import divergence as D

SCHEMA = "doc_id long, text string, lang string, source string, rank int"


def plain(docs, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, seen, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in docs:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang].add(source)
        counts[lang, source].update(words)
        seen[lang].update(set(words))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]
        v = len(kept)

        def shares(of):
            n = sum(of[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (of[t] + 5) // (n + 5 * v) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, rows in (("pair", pairs), ("term", terms)):
                rows.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, t, x, k + 1) for k, (t, x) in enumerate(rows if part == "pair" else rows[:top])]
    return sorted(out)


def documents(n):
    rng = random.Random(4)
    words = ["Alpha", "beta", "É", "é", "x1y", "𝔘ber", "zeta", "dont", "ß", "Gamma_delta"] + [f"w{chr(97 + i)}" for i in range(12)]
    docs = [(i, rng.choice([" ", "-", "\t"]).join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "a", "a", "b", "ü", None]), i) for i in range(n)]
    docs += [docs[0]] * 30  # repeated rows
    docs += [(n, None, "en", "silent", 0), (n + 1, "!!!", "fr", "x", 0), (n + 2, None, "fr", "y", 0), (n + 3, "alone", "it", "z", 0), (n + 4, "beta " * 5000, "en", "b", 0)]
    return docs


def test_divergence_equals_plain_integers(spark):
    docs = documents(160)
    got = D.divergence(spark.createDataFrame(docs, SCHEMA), least_documents=8, top=3)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["value"] == "bigint"
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == plain(docs, 8, 3)
    assert {("fr", "x", "pair", "y", 0, 1)} <= set(rows) and not [r for r in rows if r[0] == "it"]
    assert D.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shuffled_languages_give_the_same(spark, monkeypatch):
    docs = documents(60)
    monkeypatch.setattr(D, "BROADCAST_ROWS", 0)
    assert sorted(tuple(r) for r in D.divergence(spark.createDataFrame(docs, SCHEMA), least_documents=3, top=5).collect()) == plain(docs, 3, 5)


def test_shares_of_large_counts_are_exact(spark):
    cases = [(0, 0, 1), (7, 90, 3), ((1 << 32) - 1, 1 << 40, 9), (1 << 32, 1 << 40, 9), (10**16 + 3, 3 * 10**16 + 1, 12345), (5, 5, 0)]
    got = spark.createDataFrame(cases, "c long, n long, v long").select("c", D.share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (c + 5) // (n + 5 * v) if v else 0 for c, n, v in cases]
