"""How far the sources of a language differ in their words: shares of terms, compared term by term in exact integers.

Words and the documents that have them are counted by source and term before the shuffle. Each kept term of a language becomes one wide row, the counts of its sources as an array in the order of
the language's sources. Higher-order functions turn it into shares and emit what the term adds to each pair of sources;
these rows are summed in the tasks that make them before they move. A pair of sources that both lack a term differs by
the same amount for every such term, so that is added once for all terms and a row only corrects it: the work of a
term is the sources that have it times the sources there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionflow.llm.common import BROADCAST_ROWS, ascii_lower, cut

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents that a kept term is in at least, terms told of a source, what is added to a count, and the whole of a share.
LEAST_DOCUMENTS, TOP, ADDED, WHOLE = 30, 50, 5, 1_000_000_000


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(WHOLE * (count + ADDED) / (n + ADDED * v)), exact for any count; 0 if there are no terms."""
    over, more = n + ADDED * v, count + ADDED
    near = F.call_function("div", more * WHOLE, over)
    far = F.call_function("div", more.cast("decimal(28,0)") * F.lit(WHOLE).cast("decimal(10,0)"), over.cast("decimal(38,0)"))
    return F.when(v == 0, 0).when(count < 1 << 32, 1 + near).otherwise(1 + far)


def numbered_groups(docs: DataFrame) -> DataFrame:
    """lang, source, g (a number of its own) and i (its place among the sources of its language) of the groups of docs."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return cut(docs.select("lang", "source").distinct().select("lang", "source", place.alias("i")).withColumn("g", F.monotonically_increasing_id()))


def wide_terms(docs: DataFrame, groups: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """lang, term, counts (array of i and n) of the terms in at least so many documents of a language; docs has g and text.
    All words of a text and its different ones are told apart by number, so one group counts both."""
    words = docs.select("g", F.regexp_extract_all(ascii_lower(F.col("text")), F.lit(TERM), F.lit(0)).alias("words"))
    both = words.select("g", F.posexplode(F.array("words", F.array_distinct("words"))).alias("kind", "own")).select("g", "kind", F.explode("own").alias("term"))
    each = both.groupBy("g", "term").agg(F.sum(1 - F.col("kind")).alias("n"), F.sum("kind").alias("documents"))
    wide = each.join(groups.drop("source"), "g").groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.collect_list(F.struct("i", "n")).alias("counts"))
    return wide.where(F.col("documents") >= least_documents).select("lang", "term", "counts")


def languages(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """A row per lang: sources (array in order), ns (occurrences of kept terms in each), n (in all), v (kept terms) and
    base (the share in each source of a term that it lacks)."""
    occurring = kept.select("lang", F.inline("counts")).groupBy("lang", "i").agg(F.sum("n").alias("n"))
    listed = groups.join(occurring, ["lang", "i"], "left").select("lang", F.struct("i", "source", F.coalesce("n", F.lit(0)).alias("n")).alias("x"))
    v = kept.groupBy("lang").agg(F.count("*").alias("v"))
    whole = listed.groupBy("lang").agg(F.array_sort(F.collect_list("x")).alias("xs"), F.sum("x.n").alias("n")).join(v, "lang", "left").withColumn("v", F.coalesce("v", F.lit(0)))
    base = F.transform("xs", lambda x: share(F.lit(0).cast("long"), x["n"], F.col("v")))
    return whole.select("lang", F.col("xs.source").alias("sources"), F.col("xs.n").alias("ns"), "n", "v", base.alias("base"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_documents: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank: for each source its difference from every other source of its language (part
    `pair`), and its top terms that it has more of than its language (part `term`).

    Null lang, source and text count as empty ones; a source without terms is compared too, a language without kept terms
    has values of 0. Repeated rows are documents of their own; ties are ranked by the item's bytes. An empty table gives
    no rows; further columns are not looked at. A language's sources are one array, as its wide terms are; the result has
    the square of their number."""
    own = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    groups = numbered_groups(own)
    small = groups.count() <= BROADCAST_ROWS
    side = F.broadcast if small else lambda df: df
    kept = cut(wide_terms(own.join(side(groups.select("lang", "source", "g")), ["lang", "source"]), side(groups), least_documents))
    langs = cut(languages(groups, kept))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    terms = kept.join(side(langs), "lang").withColumn("of", F.map_from_entries("counts")).withColumn("q", share(total, F.col("n"), F.col("v")))
    counted = F.transform("ns", lambda _, i: F.coalesce(F.try_element_at("of", i), F.lit(0)))
    vector = terms.withColumn("counted", counted).select(
        "lang", "term", "q", "base", "counted", F.array_sort("counts.i").alias("had"), F.zip_with("counted", "ns", lambda c, n: share(c, n, F.col("v"))).alias("shares")
    )
    # The sources that have a term, one row each; the arrays go along within the task.
    each = vector.withColumn("i", F.explode("had")).withColumn("p", F.element_at("shares", F.col("i") + 1))

    lacked = F.element_at("base", F.col("i") + 1)
    more = F.zip_with("shares", "base", lambda p, b: F.abs(F.col("p") - p) - F.abs(F.col("lacked") - b))
    wanted = lambda c, j: (j != F.col("i")) & ((c == 0) | (j > F.col("i")))  # noqa: E731  a pair that both have once
    emitted = F.filter(F.transform("counted", lambda c, j: F.when(wanted(c, j), F.struct(j.alias("j"), F.element_at("more", j + 1).alias("more")))), lambda x: x.isNotNull())
    added = each.withColumn("lacked", lacked).withColumn("more", more).select("lang", "i", F.inline(emitted))
    added = added.select("lang", F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "more")
    # Every pair once, as if no source had any term.
    ends = langs.where(F.size("sources") > 1).select("lang", "v", "base", F.posexplode("base").alias("a", "p"))
    plain = ends.select("lang", "v", "p", "a", F.posexplode("base").alias("b", "r")).where("a < b").select("lang", "a", "b", (F.col("v") * F.abs(F.col("p") - F.col("r"))).alias("more"))
    sums = plain.unionByName(added).groupBy("lang", "a", "b").agg(F.sum("more").alias("value"))
    names = side(langs).select("lang", "sources")
    both = sums.join(names, "lang").select("lang", "value", F.element_at("sources", F.col("a") + 1).alias("x"), F.element_at("sources", F.col("b") + 1).alias("y"))
    way = lambda s, t: F.struct(F.col(s).alias("source"), F.col(t).alias("item"))
    pairs = both.select("lang", F.inline(F.array(way("x", "y"), way("y", "x"))), "value")
    said = each.where("p > q").select("lang", F.col("i").alias("a"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "a").orderBy(F.desc("value"), "item"))
    best = said.withColumn("rank", rank).where(F.col("rank") <= top).join(names, "lang").select("lang", F.element_at("sources", F.col("a") + 1).alias("source"), F.lit("term").alias("part"), "item", "value", "rank")
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", order.alias("rank")).unionByName(best)


SQL = """
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tok AS (SELECT lang, source, r, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY 1, 2 HAVING count(DISTINCT r) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT l.lang, count(term) AS v FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN kept ON kept.lang = l.lang GROUP BY 1),
c AS (SELECT lang, source, term, count(*) AS c FROM tok GROUP BY 1, 2, 3),
cell AS (SELECT g.lang, g.source, kept.term, coalesce(c.c, 0) AS c FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
tot AS (SELECT lang, source, sum(c) AS n FROM cell GROUP BY 1, 2),
p AS (SELECT cell.lang, cell.source, term, c, 1 + 1000000000::HUGEINT * (c + 5) // (n + 5 * v) AS p FROM cell JOIN tot ON tot.lang = cell.lang AND tot.source = cell.source JOIN v ON v.lang = cell.lang),
q AS (SELECT x.lang, term, 1 + 1000000000::HUGEINT * (c + 5) // (n + 5 * v) AS q FROM (SELECT lang, term, sum(c) AS c FROM cell GROUP BY 1, 2) x JOIN (SELECT lang, sum(n) AS n FROM tot GROUP BY 1) t ON t.lang = x.lang JOIN v ON v.lang = x.lang),
diff AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY 1, 2, 3),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN diff ON diff.lang = a.lang AND diff.source = a.source AND diff.item = b.source),
term AS (SELECT p.lang, source, 'term' AS part, p.term AS item, CAST(p - q AS BIGINT) AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE c > 0 AND p > q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)) WHERE part = 'pair' OR rank <= 50
"""
