"""Benchmark decontamination, in DataFrame operations only.

The normalised n-grams of the test items form a broadcast hash set: each is filed under the hash of its words. The
windows of a training text are hashed at every word and probe the set; a hit is verified by comparing the windows word
by word, and only verified hits leave the scan. Items of fewer words than n are windows of their own size, so a text is
scanned once for each size that the items have, n at most. The set is broadcast after its bytes have been summed;
beyond BROADCAST_BYTES the scan gives place and hash of each window only, these are joined by a shuffle, and the texts
that have candidates are read again to verify them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionflow.llm.common import UPPER, ascii_lower, cut, join_small

N = 13
#: What separates words, before and after A-Z are lower-cased.
SEPARATORS_LOWER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """The lower-cased words of a text; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS_LOWER), "")


def hashes(w: Column) -> Column:
    """The hashes of an array of words; the hash of a slice of them is that of the window."""
    return F.transform(w, lambda x: F.xxhash64(x))


def item_windows(items: DataFrame, id_col: str, text_col: str, n: int = N) -> DataFrame:
    """One row per distinct window: win, n_win, h (its hash), items (ids as text)."""
    listed = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    each = listed.select(
        "item",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size("w") - (n - 1), F.lit(1))), lambda i: F.slice("w", i, n)
            )
        ).alias("win"),
    )
    return (
        each.groupBy("win")
        .agg(F.collect_set("item").alias("items"))
        .select("win", "items", F.size("win").alias("n_win"), F.xxhash64(hashes(F.col("win"))).alias("h"))
    )


def probes(texts: DataFrame, sizes: list[int]) -> DataFrame:
    """texts (w and other columns) with pos, n and p_h of each window of each of the sizes."""
    hashed = texts.withColumn("hw", hashes(F.col("w"))).select("*", F.explode(F.sequence(F.lit(0), F.size("w") - 1)).alias("pos"))
    at = lambda n: F.xxhash64(F.slice("hw", F.col("pos") + 1, n)).alias("p_h")
    if len(sizes) == 1:
        each = hashed.withColumn("n", F.lit(sizes[0])).withColumn("p_h", at(sizes[0]))
    else:
        each = hashed.select("*", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), at(n)) for n in sizes])).alias("x")).select("*", "x.n", "x.p_h").drop("x")
    return each.where(F.col("pos") + F.col("n") <= F.size("w")).drop("hw")


def window_hits(docs: DataFrame, windows: DataFrame, id_col: str, text_col: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Verified occurrences: k_id, k_text, s, e (word range, end exclusive), items."""
    windows = cut(windows)
    size = windows.agg(F.sum(F.octet_length(F.array_join("win", " ")) + 24 * F.col("n_win") + 64 * F.size("items"))).first()[0] or 0
    sizes = sorted(r[0] for r in windows.select("n_win").distinct().collect())  # n at most
    texts = docs.select(
        F.col(id_col).alias("k_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k_text"),
        words(F.col(text_col)).alias("w"),
    ).where(F.size("w") > 0)
    same = (F.col("p_h") == F.col("h")) & (F.col("n") == F.col("n_win")) & (F.slice("w", F.col("pos") + 1, F.col("n")) == F.col("win"))
    if not sizes:
        found = texts.join(F.broadcast(windows), F.size("w") == F.col("n_win")).withColumn("pos", F.lit(0)).withColumn("n", F.lit(0))
    elif size <= broadcast_bytes:
        found = probes(texts, sizes).join(F.broadcast(windows), same)
    else:
        names = windows.select("h", F.col("n_win").alias("n")).distinct()
        slim = probes(texts, sizes).select("k_id", "k_text", "pos", "n", F.col("p_h").alias("h"))
        candidates = cut(slim.join(names, ["h", "n"], "left_semi").select(F.col("k_id").alias("c_id"), F.col("k_text").alias("c_text"), "pos", "n", F.col("h").alias("p_h")).distinct())
        again = F.col("k_id").eqNullSafe(F.col("c_id")) & (F.col("k_text") == F.col("c_text"))
        read = texts.dropDuplicates(["k_id", "k_text"]).join(candidates, again).drop("c_id", "c_text")
        found = read.join(windows, same)
    return found.select("k_id", "k_text", F.col("pos").alias("s"), (F.col("pos") + F.col("n")).alias("e"), "items")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", n: int = N, share: int = 20, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of docs: k_id, k_text, n_words, n_hit, spans, items (sorted as text), contaminated.

    A window is n consecutive words of an item, or a whole item of fewer words (but not none). A document word inside
    any occurrence is hit; spans lists the occurrences as word ranges. contaminated: n_hit > 0 and
    share * n_hit >= n_words. Null and empty texts have no words. Repeated items count once; an item whose id is null
    marks words but is not listed. Rows of docs that repeat an id and a text get the same result each. An empty
    items table leaves all clean, an empty docs table gives no rows. Other columns are not looked at.
    """
    hits = window_hits(docs, item_windows(items, item_id_col, item_text_col, n), id_col, text_col, broadcast_bytes)
    found = hits.groupBy("k_id", "k_text").agg(
        F.sort_array(F.collect_set(F.struct("s", "e"))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("last"))
    found = found.withColumn(
        "n_hit",
        F.aggregate(
            "spans", zero,
            lambda a, x: F.struct(
                (a["n"] + F.greatest(x["e"] - F.greatest(x["s"], a["last"]), F.lit(0))).alias("n"),
                F.greatest(a["last"], x["e"]).alias("last"),
            ),
            lambda a: a["n"],
        ),
    )
    pieces = F.split(F.coalesce(F.col(text_col), F.lit("")), SEPARATORS)
    every = docs.select(
        F.col(id_col).alias("k_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k_text"),
        F.size(F.array_remove(pieces, "")).cast("long").alias("n_words"),
    )
    f = found.select(F.col("k_id").alias("f_id"), F.col("k_text").alias("f_text"), "spans", "items", "n_hit")
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    return every.join(f, F.col("k_id").eqNullSafe(F.col("f_id")) & (F.col("k_text") == F.col("f_text")), "left").select(
        "k_id", "k_text", "n_words", n_hit.alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def _keyed(docs: DataFrame, report: DataFrame, id_col: str, text_col: str):
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    on = F.col("row")[id_col].eqNullSafe(F.col("k_id")) & (
        F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))) == F.col("k_text")
    )
    return left, on


def remove_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without the contaminated documents; columns unchanged. Nulls, empty texts, repeated rows and empty tables are
    as in contamination: null and empty texts stay, and rows that repeat an id and a text stay or go together."""
    report = contamination(docs, items, id_col, text_col, **how)
    bad = cut(report.where("contaminated").select("k_id", "k_text").distinct())
    left, on = _keyed(docs, report, id_col, text_col)
    return join_small(left, bad, on, "left_anti").select("row.*")


def remove_spans(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs with the hit words, each with the separators before it, cut out of text; columns unchanged, null stays
    null and empty texts empty, repeated rows are cut alike, an empty items table cuts nothing."""
    report = contamination(docs, items, id_col, text_col, **how)
    bad = cut(report.where("n_hit > 0").select("k_id", "k_text", "spans").dropDuplicates(["k_id", "k_text"]))
    left, on = _keyed(docs, report, id_col, text_col)
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    # The text as pieces that end with a word, and the separators after the last word.
    pieces = F.regexp_extract_all(text, F.lit(f"({SEPARATORS[:-1]}*{WORD})"), F.lit(1))
    tail = F.regexp_extract(text, f"({SEPARATORS[:-1]}*)$", 1)
    kept = F.filter(pieces, lambda _, i: ~F.exists("spans", lambda x: (x["s"] <= i) & (i < x["e"])))
    cleaned = F.when(F.col("spans").isNull(), F.col("row")[text_col]).otherwise(F.concat(F.array_join(kept, ""), tail))
    side = F.broadcast(bad) if bad.count() <= 100_000 else bad
    return left.join(side, on, "left").select(F.col("row").withField(text_col, cleaned).alias("row")).select("row.*")


#: DuckDB SQL of the op2 contract.
SQL = f"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), {N}) AS n, array_to_string(w[i : i + {N - 1}], ' ') AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {N - 1}, 1) + 1)) AS i FROM iw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw CROSS JOIN sizes)),
hits AS (SELECT DISTINCT d.doc_id, d.i, d.n, win.item_id FROM dwin d JOIN win USING (win, n)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY 1)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
