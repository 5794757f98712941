"""The reference's operators as queries over the virtual genome, and the SQL that each is held against."""

from __future__ import annotations

from pyspark.sql import functions as F

from regionflow.functions import reads as R
from regionflow.operators import active, align, bqsr, calling, dedup, genome, haplotypes, ingest, joint, logs, route, variants
from regionflow.plans import calls as assembled
from regionflow.plans.fixture import N_REGIONS, Genome
from regionflow.plans.fixture_sql import with_genome
from regionflow.sources import sequence

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None, halo: int = 3000, panel: bool = False):
    def add(f):
        QUERIES[name] = lambda spark, sf_dir: f(Genome(spark, sf_dir))
        if sql:
            ORACLES[name] = with_genome(sql, halo, panel)
        return f

    return add


def iv(g: Genome, halo: int = 3000):
    return genome.intervals(g.contigs(), N_REGIONS, halo)


@query("seq_dict", "SELECT * FROM contigs")
def _(g):
    return genome.with_offsets(g.contigs())


@query("intervals_m0", "SELECT * FROM iv", halo=0)
def _(g):
    return iv(g, 0)


for _k in (1000, 2000, 3000):
    query(f"intervals_halo_{_k}", "SELECT * FROM iv", halo=_k)(lambda g, k=_k: iv(g, k))


@query("interval_strings", "SELECT 'region_' || lpad(CAST(region AS VARCHAR), 2, '0') AS name, contig || ':' || lo || '-' || hi AS txt, lo - 1 AS bed_start FROM iv")
def _(g):
    return iv(g).select(R.region_name(F.col("region"), N_REGIONS).alias("name"), R.interval_text(F.col("contig"), F.col("lo"), F.col("hi")).alias("txt"), (F.col("lo") - 1).alias("bed_start"))


@query("region_sizes", "SELECT region, count(*) AS n_intervals, CAST(sum(hi - lo + 1) AS BIGINT) AS bases FROM iv GROUP BY 1", halo=0)
def _(g):
    return iv(g, 0).groupBy("region").agg(F.count("*").alias("n_intervals"), F.sum(F.col("hi") - F.col("lo") + 1).alias("bases"))


@query("region_empty", "SELECT r AS region, coalesce(n, 0) AS n FROM rid LEFT JOIN (SELECT region, count(*) AS n FROM reads JOIN iv ON reads.contig_id = iv.contig_id AND pos BETWEEN lo AND hi GROUP BY 1) x ON r = region", halo=0)
def _(g):
    n = genome.points_in(g.reads().select("contig_id", "pos"), iv(g, 0)).groupBy("region").agg(F.count("*").alias("n"))
    return genome.with_empty(g.spark.range(N_REGIONS).withColumnRenamed("id", "region"), n)


@query("reads_scan", "SELECT qname, rec_id, contig_id, pos, mapq, flag, cigar, seq, qual FROM reads")
def _(g):
    return g.reads().select("qname", "rec_id", "contig_id", "pos", "mapq", "flag", "cigar", "seq", "qual")


@query("flag_decode", "SELECT flag, count(*) AS n, (flag & 4) <> 0 AS unmapped, (flag & 16) <> 0 AS is_reverse, CASE WHEN (flag & 64) <> 0 THEN 1 WHEN (flag & 128) <> 0 THEN 2 END AS mate, (flag & 2820) = 0 AS prim FROM reads GROUP BY flag")
def _(g):
    f = F.col("flag")
    return g.reads().groupBy("flag").agg(F.count("*").alias("n")).select("flag", "n", R.has(f, R.UNMAPPED).alias("unmapped"), R.has(f, R.REVERSE).alias("is_reverse"), R.mate(f).alias("mate"), R.is_primary(f).alias("prim"))


@query("revcomp", "SELECT rec_id, reverse(translate(seq, 'ACGTN', 'TGCAN')) AS seq, reverse(qual) AS qual FROM reads WHERE (flag & 16) <> 0")
def _(g):
    return g.reads().where("(flag & 16) <> 0").select("rec_id", R.reverse_complement(F.col("seq")).alias("seq"), F.reverse("qual").alias("qual"))


@query("fastq_format", "SELECT rec_id, '@' || qname || '/' || CASE WHEN (flag & 64) <> 0 THEN '1' ELSE '2' END || chr(10) || CASE WHEN (flag & 16) <> 0 THEN reverse(translate(seq, 'ACGTN', 'TGCAN')) ELSE seq END || chr(10) || '+' || chr(10) || CASE WHEN (flag & 16) <> 0 THEN reverse(qual) ELSE qual END AS fq FROM reads")
def _(g):
    f = F.col("flag")
    return g.reads().select("rec_id", R.fastq(F.col("qname"), R.mate(f), F.col("seq"), F.col("qual"), R.has(f, R.REVERSE)).alias("fq"))


@query("name_normalise", "SELECT rec_id, qname, CASE WHEN l_linenumber < 5 THEN CASE WHEN (flag & 64) <> 0 THEN 1 ELSE 2 END WHEN right(qname, 1) IN ('1', '2') THEN CAST(right(qname, 1) AS INT) END AS mate FROM reads")
def _(g):
    line = F.concat(F.lit("@"), "qname", F.when(F.col("l_linenumber") < 5, F.concat(F.lit("/"), R.mate(F.col("flag")).cast("string"))).otherwise(""))
    return g.reads().select("rec_id", R.read_name(line).alias("x")).select("rec_id", "x.*")


@query("cigar_ops", "SELECT o AS op, count(*) AS n, CAST(sum(CAST(l AS INT)) AS BIGINT) AS bases FROM (SELECT unnest(regexp_extract_all(cigar, '(\\d+)([MIDNSHP=XB])', 2)) AS o, unnest(regexp_extract_all(cigar, '(\\d+)([MIDNSHP=XB])', 1)) AS l FROM reads) GROUP BY 1")
def _(g):
    return g.reads().select(F.explode(R.cigar(F.col("cigar"))).alias("x")).groupBy("x.op").agg(F.count("*").alias("n"), F.sum("x.len").alias("bases"))


@query("phred_stats", "SELECT rec_id, CAST(list_sum(q) AS BIGINT) AS total, list_min(q) AS least, list_max(q) AS most FROM (SELECT rec_id, list_transform(string_split(qual, ''), lambda c: ascii(c) - 33) AS q FROM reads)")
def _(g):
    q = R.phred(F.col("qual"))
    return g.reads().select("rec_id", F.aggregate(q, F.lit(0).cast("long"), lambda a, x: a + x).alias("total"), F.array_min(q).alias("least"), F.array_max(q).alias("most"))


@query("sam_tags", "SELECT rec_id, CAST(mapq AS BIGINT) AS nm, 'sample 1:' || l_suppkey AS rg, mapq / 4.0 AS xf, CAST(l_suppkey + l_partkey AS BIGINT) AS xb FROM reads")
def _(g):
    fields = F.array(F.concat(F.lit("NM:i:"), "mapq"), F.concat(F.lit("RG:Z:sample 1:"), "l_suppkey"), F.concat(F.lit("XF:f:"), F.col("mapq") / 4), F.concat(F.lit("XB:B:i,"), "l_suppkey", F.lit(","), "l_partkey"))
    t = F.col("t")
    total = F.aggregate(t["XB"]["b"], F.lit(0).cast("long"), lambda a, x: a + x)
    return g.reads().select("rec_id", R.tags(fields).alias("t")).select("rec_id", t["NM"]["i"].alias("nm"), t["RG"]["val"].alias("rg"), t["XF"]["f"].alias("xf"), total.alias("xb"))


@query("mate_ref", "SELECT rec_id, CASE l_linenumber % 3 WHEN 0 THEN 'c' || contig_id WHEN 1 THEN NULL ELSE 'c' || l_partkey % 25 END AS mate_contig FROM reads")
def _(g):
    rnext = F.expr("case l_linenumber % 3 when 0 then '=' when 1 then '*' else concat('c', l_partkey % 25) end")
    return g.reads().select("rec_id", R.mate_reference(rnext, F.concat(F.lit("c"), "contig_id")).alias("mate_contig"))


@query("ingest_counters", "SELECT count(*) AS total, count(*) FILTER ((flag & 256) <> 0) AS secondary, count(*) FILTER ((flag & 256) = 0 AND (flag & 512) <> 0) AS qcfail FROM reads")
def _(g):
    return ingest.counters(g.reads())


@query("chunk_count", "SELECT CAST(ceil(count(*) / 1000.0) AS BIGINT) AS n_chunks FROM reads")
def _(g):
    return ingest.chunk_count(ingest.chunks(g.reads().select("rec_id"), ["rec_id"], 1000))


@query("contig_lookup", "SELECT rec_id, CASE WHEN contig_id % 5 <> 0 THEN contig_id END AS contig_id FROM reads")
def _(g):
    """Reads of every fifth contig bear `*` for a name."""
    named = g.reads().join(g.contigs().select("contig_id", "contig"), "contig_id").select("rec_id", F.when(F.col("contig_id") % 5 != 0, F.col("contig")).alias("rname"))
    return ingest.with_contigs(named, g.contigs()).select("rec_id", "contig_id")


@query("primary_pass", "SELECT rec_id FROM reads WHERE (flag & 2816) = 0")
def _(g):
    return ingest.passing(g.reads()).select("rec_id")


_NAMES = "SELECT qname, count(*) FILTER ((flag & 64) <> 0) AS n1, count(*) FILTER ((flag & 64) = 0) AS n2 FROM reads WHERE (flag & 2816) = 0 GROUP BY 1"


@query("name_classes", f"SELECT *, CASE WHEN n1 = 1 AND n2 = 1 THEN 'pair' WHEN n1 + n2 = 1 THEN 'orphan' ELSE 'ambiguous' END AS kind FROM ({_NAMES})")
def _(g):
    return ingest.name_classes(g.reads())


@query("pair_by_name", "SELECT qname, max(rec_id) FILTER ((flag & 64) <> 0) AS r1, max(rec_id) FILTER ((flag & 64) = 0) AS r2 FROM reads WHERE (flag & 2816) = 0 GROUP BY 1 HAVING count(*) = 2 AND count(*) FILTER ((flag & 64) <> 0) = 1")
def _(g):
    return ingest.pairs(g.reads())


@query("orphans", f"SELECT qname FROM ({_NAMES}) WHERE n1 + n2 = 1")
def _(g):
    return ingest.name_classes(g.reads()).where("kind = 'orphan'").select("qname")


_MATES = "SELECT qname, list(CASE WHEN (flag & 64) <> 0 THEN 1 ELSE 2 END ORDER BY rec_id) AS ms FROM reads WHERE (flag & 768) = 0 GROUP BY 1"


@query("improper_pairs", f", mm AS ({_MATES}), st AS (SELECT qname, 1 AS i, 0 AS w, 0 AS n, ms FROM mm UNION ALL SELECT 0, 0, 0, 0, NULL WHERE false) SELECT qname, CAST(len(list_filter(range(1, len(s) + 1), lambda i: s[i] = -1)) AS BIGINT) AS improper FROM (SELECT qname, list_reduce(list_prepend([0], list_transform(ms, lambda m: [m])), lambda a, b: CASE WHEN a[1] = 0 THEN list_concat([b[1]], a[2:]) WHEN a[1] = b[1] THEN list_concat([b[1]], list_append(a[2:], -1)) ELSE list_concat([0], a[2:]) END) AS s FROM st) WHERE len(list_filter(s, lambda x: x = -1)) > 0".replace("SELECT 0, 0, 0, 0, NULL WHERE false", "SELECT '', 0, 0, 0, NULL WHERE false"))
def _(g):
    return ingest.improper(g.reads(), ["rec_id"])


@query("zip_pairs", "SELECT row_number() OVER (ORDER BY rec_id) - 1 AS n, qname, rec_id AS r1, rec_id AS r2 FROM reads")
def _(g):
    file = ingest.numbered(g.reads().selectExpr("rec_id", "qname"), ["rec_id"])
    side = lambda k: file.selectExpr("n", f"concat(qname, ' {k}') as name", "rec_id")
    return ingest.zip_pairs(side(1), side(2))


@query("interleaved_pairs", "SELECT n // 2 AS pair, max(rec_id) FILTER (n % 2 = 0) AS r1, max(rec_id) FILTER (n % 2 = 1) AS r2 FROM (SELECT rec_id, row_number() OVER (ORDER BY rec_id) - 1 AS n FROM reads) GROUP BY 1 HAVING count(*) = 2")
def _(g):
    return ingest.interleaved(ingest.numbered(g.reads().select("rec_id"), ["rec_id"]))


@query("chunks", "SELECT n // 1000 AS chunk_id, count(*) AS n, min(rec_id) AS first, max(rec_id) AS last FROM (SELECT rec_id, row_number() OVER (ORDER BY rec_id) - 1 AS n FROM reads) GROUP BY 1")
def _(g):
    return ingest.chunks(g.reads().select("rec_id"), ["rec_id"], 1000).groupBy("chunk_id").agg(F.count("*").alias("n"), F.min("rec_id").alias("first"), F.max("rec_id").alias("last"))


_IN = "reads JOIN iv ON reads.contig_id = iv.contig_id AND pos BETWEEN lo AND hi"


@query("region_assign", f"SELECT rec_id, region FROM {_IN}")
def _(g):
    return genome.points_in(g.reads().select("rec_id", "contig_id", "pos"), iv(g)).select("rec_id", "region")


_SPAN = "pos + list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS INT))) - 1"


@query("overlap_assign", f"SELECT region, count(*) AS n FROM (SELECT DISTINCT rec_id, region FROM reads JOIN iv ON reads.contig_id = iv.contig_id AND pos <= hi AND {_SPAN} >= lo) GROUP BY 1", halo=0)
def _(g):
    end = F.col("pos") + R.reference_span(R.cigar(F.col("cigar"))) - 1
    return genome.spans_over(g.reads().select("rec_id", "contig_id", "pos", "cigar"), iv(g, 0), end).select("rec_id", "region").distinct().groupBy("region").agg(F.count("*").alias("n"))


_ROUTE = """, hit AS (SELECT rec_id, qname, flag, reads.contig_id, pos, count(*) AS n, min(region) AS r, (flag & 2820) = 0 AS prim FROM reads JOIN iv ON reads.contig_id = iv.contig_id AND pos BETWEEN lo AND hi GROUP BY ALL),
w AS (SELECT *, count(*) FILTER (prim) OVER (PARTITION BY qname) AS np, max(n) FILTER (prim) OVER (PARTITION BY qname) AS mx, min(r) FILTER (prim) OVER (PARTITION BY qname) AS r0, max(r) FILTER (prim) OVER (PARTITION BY qname) AS r1, min(contig_id) FILTER (prim) OVER (PARTITION BY qname) AS c0, max(contig_id) FILTER (prim) OVER (PARTITION BY qname) AS c1 FROM hit),
routed AS (SELECT rec_id, r, CASE WHEN (flag & 4) <> 0 THEN 'unmapped' WHEN (flag & 512) <> 0 THEN 'qcfail' WHEN prim AND np = 2 THEN CASE WHEN mx = 1 AND r0 = r1 AND c0 = c1 THEN 'region' ELSE 'chri' END WHEN n > 1 THEN 'chri' ELSE 'region' END AS dest FROM w)"""


@query("route_reads", _ROUTE + " SELECT rec_id, dest, CASE WHEN dest = 'region' THEN r END AS region FROM routed")
def _(g):
    return route.route(g.reads(), iv(g))


@query("route_counts", _ROUTE + " SELECT dest, count(*) AS cnt FROM routed GROUP BY 1")
def route_counts(g):
    return route.route(g.reads(), iv(g)).groupBy("dest").agg(F.count("*").alias("cnt"))


@query("side_outputs", _ROUTE + " SELECT dest, rec_id FROM routed WHERE dest IN ('unmapped', 'qcfail')")
def _(g):
    return route.route(g.reads(), iv(g)).where(F.col("dest").isin("unmapped", "qcfail")).select("dest", "rec_id")


@query("coord_sort_rank", f"SELECT rec_id, region, row_number() OVER (PARTITION BY region ORDER BY reads.contig_id, pos, rec_id) AS place FROM {_IN}")
def _(g):
    return route.coordinate_rank(g.reads(), iv(g))


@query("exact_partition", f"SELECT region, count(*) AS n FROM {_IN} GROUP BY 1", halo=0)
def _(g):
    return genome.points_in(g.reads().select("rec_id", "contig_id", "pos"), iv(g, 0)).groupBy("region").agg(F.count("*").alias("n"))


@query("merge_regional", _ROUTE + " SELECT rec_id, row_number() OVER (PARTITION BY reads.contig_id ORDER BY pos, CASE WHEN dest = 'chri' THEN 0 ELSE 1 END, rec_id) AS place FROM routed JOIN reads USING (rec_id) WHERE dest IN ('region', 'chri')")
def _(g):
    return route.merged_order(g.reads(), route.route(g.reads(), iv(g)))


@query("route_unplaced", """, placed AS (SELECT * REPLACE (CASE WHEN (flag & 4) <> 0 AND l_partkey % 3 = 0 THEN NULL ELSE contig_id END AS contig_id, CASE WHEN (flag & 4) <> 0 AND l_partkey % 3 = 0 THEN NULL ELSE pos END AS pos) FROM reads),
hit AS (SELECT rec_id, qname, flag, p.contig_id, pos, count(region) AS n, min(region) AS r, (flag & 2820) = 0 AS prim FROM placed p LEFT JOIN iv ON p.contig_id = iv.contig_id AND pos BETWEEN lo AND hi GROUP BY ALL),
w AS (SELECT *, count(*) FILTER (prim) OVER (PARTITION BY qname) AS np, max(n) FILTER (prim) OVER (PARTITION BY qname) AS mx, min(r) FILTER (prim) OVER (PARTITION BY qname) AS r0, max(r) FILTER (prim) OVER (PARTITION BY qname) AS r1, min(contig_id) FILTER (prim) OVER (PARTITION BY qname) AS c0, max(contig_id) FILTER (prim) OVER (PARTITION BY qname) AS c1 FROM hit)
SELECT rec_id, CASE WHEN (flag & 4) <> 0 THEN 'unmapped' WHEN (flag & 512) <> 0 THEN 'qcfail' WHEN n = 0 THEN 'lost' WHEN prim AND np = 2 THEN CASE WHEN mx = 1 AND r0 = r1 AND c0 = c1 THEN 'region' ELSE 'chri' END WHEN n > 1 THEN 'chri' ELSE 'region' END AS dest FROM w""")
def _(g):
    """Unmapped reads of every third part have no place."""
    away = "(flag & 4) <> 0 and l_partkey % 3 = 0"
    reads = g.reads().withColumns({c: F.expr(f"case when not ({away}) then {c} end") for c in ("contig_id", "pos")})
    return route.route(reads, iv(g)).select("rec_id", "dest")


@query("back_to_regions", _ROUTE + f" SELECT region, count(*) AS n FROM (SELECT rec_id, r AS region FROM routed WHERE dest = 'region' UNION ALL SELECT DISTINCT rec_id, region FROM (SELECT reads.*, {_SPAN} AS e FROM reads JOIN (SELECT rec_id FROM routed WHERE dest = 'chri') USING (rec_id)) x JOIN iv ON x.contig_id = iv.contig_id AND pos <= hi AND e >= lo) GROUP BY 1")
def _(g):
    end = F.col("pos") + R.reference_span(R.cigar(F.col("cigar"))) - 1
    reads = g.reads().select("rec_id", "qname", "flag", "contig_id", "pos", "cigar")
    return route.back_to_regions(reads, route.route(reads, iv(g)), iv(g), end).groupBy("region").agg(F.count("*").alias("n"))


@query("ordered_concat", "SELECT rec_id, region, row_number() OVER (ORDER BY reads.contig_id, pos, rec_id) - 1 AS place FROM reads JOIN iv ON reads.contig_id = iv.contig_id AND pos BETWEEN lo AND hi", halo=0)
def _(g):
    return route.ordered_concat(g.reads().select("rec_id", "contig_id", "pos"), iv(g, 0)).select("rec_id", "region", "place")


@query("interval_lists", "SELECT region, string_agg(contig || ':' || lo || '-' || hi, ',' ORDER BY contig_id) AS ivs FROM iv GROUP BY 1")
def _(g):
    text = lambda x: R.interval_text(x["contig"], x["lo"], x["hi"])
    return genome.interval_lists(iv(g)).select("region", F.array_join(F.transform("ivs", text), ",").alias("ivs"))


_ENDS = """, ops AS (SELECT *, regexp_extract(cigar, '^(\\d+)S', 1) AS ls, regexp_extract(cigar, '(\\d+)S$', 1) AS ts, list_sum(list_transform(regexp_extract_all(cigar, '(\\d+)[MDN=X]', 1), lambda x: CAST(x AS INT))) AS span FROM reads WHERE (flag & 2820) = 0),
ends AS (SELECT rec_id, qname, contig_id, CAST(CASE WHEN (flag & 16) <> 0 THEN pos + span - 1 + coalesce(TRY_CAST(ts AS INT), 0) ELSE pos - coalesce(TRY_CAST(ls AS INT), 0) END AS BIGINT) AS end5, CASE WHEN (flag & 16) <> 0 THEN 1 ELSE 0 END AS strand,
CAST(coalesce(list_sum(list_filter(list_transform(string_split(qual, ''), lambda c: ascii(c) - 33), lambda q: q >= 15)), 0) AS BIGINT) AS score FROM ops)"""
_MARK = _ENDS + """, e AS (SELECT *, count(*) OVER (PARTITION BY qname) AS k, min((contig_id, end5, strand)) OVER (PARTITION BY qname) AS a, max((contig_id, end5, strand)) OVER (PARTITION BY qname) AS b, sum(score) OVER (PARTITION BY qname) AS total FROM ends),
m AS (SELECT *, k = 2 AS is_pair, CASE WHEN k = 2 THEN dense_rank() OVER (PARTITION BY k = 2, a, b ORDER BY total DESC, qname) > 1 END AS dup, row_number() OVER (PARTITION BY contig_id, end5, strand ORDER BY k = 2 DESC, score DESC, rec_id) > 1 AS first FROM e),
marked AS (SELECT rec_id, is_pair, CASE WHEN is_pair THEN dup ELSE first END AS duplicate FROM m)"""


@query("unclipped_ends", _ENDS + " SELECT * FROM ends")
def _(g):
    return dedup.ends(g.reads())


@query("dup_groups", _ENDS + " SELECT contig_id, end5, strand, count(*) AS n FROM ends GROUP BY 1, 2, 3 HAVING count(*) > 1")
def _(g):
    return dedup.ends(g.reads()).groupBy("contig_id", "end5", "strand").agg(F.count("*").alias("n")).where("n > 1")


@query("markdup", _MARK + " SELECT * FROM marked")
def _(g):
    return dedup.mark(g.reads())


@query("dup_metrics", _MARK + " SELECT is_pair, count(*) AS n, count(*) FILTER (duplicate) AS duplicates FROM marked GROUP BY 1")
def _(g):
    return dedup.mark(g.reads()).groupBy("is_pair").agg(F.count("*").alias("n"), F.count_if("duplicate").alias("duplicates"))


@query("remove_dup", _MARK + " SELECT rec_id FROM marked WHERE NOT duplicate")
def _(g):
    return dedup.mark(g.reads()).where("not duplicate").select("rec_id")


# The context of a base is that of its read: it is taken before known sites are masked.
_COV = """, cv AS (SELECT rec_id, contig_id, rpos, bq AS q, CASE WHEN (flag & 128) <> 0 THEN -cycle ELSE cycle END AS cyc, lag(base_call) OVER (PARTITION BY rec_id ORDER BY cycle) || base_call AS ctx, base_call <> ref_base AS miss, 'rg' || CAST(split_part(rec_id, '_', 1) AS BIGINT) % 3 AS rg FROM panel_bases),
un AS (SELECT * FROM cv WHERE NOT EXISTS (SELECT 1 FROM known_sites k WHERE k.contig_id = cv.contig_id AND k.pos = cv.rpos)),
cov AS (SELECT contig_id, rpos, q, cyc, ctx, miss, rg FROM un)"""


def grouped(g):
    """The panel's bases with a read group."""
    return g.bases().withColumn("rg", F.concat(F.lit("rg"), F.split("rec_id", "_")[0].cast("long") % 3))


def cov(g):
    return bqsr.unknown_only(bqsr.covariates(grouped(g), "rg"), g.known_sites())


@query("base_explode", "SELECT contig_id, ref_base, base_call, count(*) AS n, CAST(sum(bq) AS BIGINT) AS q FROM panel_bases GROUP BY 1, 2, 3", panel=True)
def _(g):
    return g.bases().groupBy("contig_id", "ref_base", "base_call").agg(F.count("*").alias("n"), F.sum("bq").alias("q"))


@query("known_mask", _COV + " SELECT contig_id, count(*) AS n FROM un GROUP BY 1", panel=True)
def _(g):
    return bqsr.unknown_only(g.bases(), g.known_sites()).groupBy("contig_id").agg(F.count("*").alias("n"))


_PART = " SELECT (contig_id * 2000 + rpos - 1) // 500 AS region, q, cyc, count(*) AS obs, count(*) FILTER (miss) AS err FROM cov GROUP BY 1, 2, 3"


def partials(g):
    return bqsr.tabulate(cov(g).withColumn("region", F.expr("(contig_id * 2000 + rpos - 1) div 500")), "region", "q", "cyc")


@query("bqsr_partial", _COV + _PART, panel=True)
def _(g):
    return partials(g)


@query("bqsr_gather", _COV + " SELECT q, cyc, count(*) AS obs, count(*) FILTER (miss) AS err, round(-10 * log10((count(*) FILTER (miss) + 1) / (count(*) + 2)), 4) AS emp_q FROM cov GROUP BY 1, 2", panel=True)
def _(g):
    return bqsr.gather(partials(g), "q", "cyc")


@query("bqsr_marginals", _COV + " SELECT q, cyc, ctx, count(*) AS obs, count(*) FILTER (miss) AS err, CAST(grouping(q) AS INT) AS g_q, CAST(grouping(cyc) AS INT) AS g_cyc, CAST(grouping(ctx) AS INT) AS g_ctx FROM cov GROUP BY GROUPING SETS ((), (q), (q, cyc), (q, ctx))", panel=True)
def _(g):
    return bqsr.marginals(cov(g))


_APPLY = ", t AS (SELECT q, round(-10 * log10((count(*) FILTER (miss) + 1) / (count(*) + 2)), 4) - q AS delta FROM cov GROUP BY 1) SELECT bq, CASE WHEN bq < 6 THEN bq ELSE greatest(1, least(60, CAST(floor(bq + coalesce(delta, 0) + 0.5) AS INT))) END AS new_q, count(*) AS n FROM panel_bases LEFT JOIN t ON bq = q GROUP BY 1, 2"


@query("bqsr_apply", _COV + _APPLY, panel=True)
def _(g):
    return bqsr.apply_quality(g.bases(), bqsr.gather(bqsr.tabulate(cov(g), "q"), "q")).groupBy("bq", "new_q").agg(F.count("*").alias("n"))


_RECALIBRATE = _COV + """,
ta AS (SELECT round(round(-10 * log10((count(*) FILTER (miss) + 1) / (count(*) + 2)), 4) + 10 * log10(sum(pow(10.0, -q / 10.0)) / count(*)), 4) AS d FROM un),
tq AS (SELECT q, round(-10 * log10((count(*) FILTER (miss) + 1) / (count(*) + 2)), 4) AS emp FROM un GROUP BY 1),
tc AS (SELECT q, cyc, round(-10 * log10((count(*) FILTER (miss) + 1) / (count(*) + 2)), 4) AS emp FROM un GROUP BY 1, 2),
tx AS (SELECT q, ctx, round(-10 * log10((count(*) FILTER (miss) + 1) / (count(*) + 2)), 4) AS emp FROM un WHERE ctx IS NOT NULL GROUP BY 1, 2),
shifted AS (SELECT cv.*, coalesce(ta.d, 0) + coalesce(tq.emp - cv.q - ta.d, 0) + coalesce(tc.emp - tq.emp, 0) + coalesce(tx.emp - tq.emp, 0) AS shift
FROM cv CROSS JOIN ta LEFT JOIN tq ON tq.q = cv.q LEFT JOIN tc ON tc.q = cv.q AND tc.cyc = cv.cyc LEFT JOIN tx ON tx.q = cv.q AND tx.ctx = cv.ctx),
recal AS (SELECT *, CASE WHEN q < 6 THEN q ELSE greatest(1, least(60, CAST(floor(round(q + shift, 4) + 0.5) AS INT))) END AS new_q FROM shifted)"""


def recalibrated(g):
    return bqsr.apply(g.bases(), bqsr.marginals(cov(g)))


@query("bqsr_recalibrate", _RECALIBRATE + " SELECT q AS bq, cyc, ctx, new_q, count(*) AS n FROM recal GROUP BY 1, 2, 3, 4", panel=True)
def _(g):
    return recalibrated(g).groupBy("bq", "cyc", "ctx", "new_q").agg(F.count("*").alias("n"))


@query("bqsr_rewrite", _RECALIBRATE + " SELECT rec_id, string_agg(chr(33 + new_q), '' ORDER BY abs(cyc)) AS qual FROM recal GROUP BY 1", panel=True)
def _(g):
    return bqsr.rewrite(g.panel(), recalibrated(g)).select("rec_id", "qual")


_GROUPED = (
    _RECALIBRATE.replace("ta AS (SELECT round", "ta AS (SELECT rg, round").replace("4) AS d FROM un)", "4) AS d FROM un GROUP BY 1)")
    .replace("tq AS (SELECT q,", "tq AS (SELECT rg, q,").replace("tc AS (SELECT q, cyc,", "tc AS (SELECT rg, q, cyc,").replace("tx AS (SELECT q, ctx,", "tx AS (SELECT rg, q, ctx,")
    .replace("AS emp FROM un GROUP BY 1, 2)", "AS emp FROM un GROUP BY 1, 2, 3)").replace("AS emp FROM un GROUP BY 1)", "AS emp FROM un GROUP BY 1, 2)")
    .replace("ctx IS NOT NULL GROUP BY 1, 2)", "ctx IS NOT NULL GROUP BY 1, 2, 3)")
    .replace("FROM cv CROSS JOIN ta", "FROM cv LEFT JOIN ta ON ta.rg = cv.rg").replace("tq ON tq.q", "tq ON tq.rg = cv.rg AND tq.q").replace("tc ON tc.q", "tc ON tc.rg = cv.rg AND tc.q").replace("tx ON tx.q", "tx ON tx.rg = cv.rg AND tx.q")
)


@query("bqsr_by_read_group", _GROUPED + " SELECT rg, q AS bq, new_q, count(*) AS n FROM recal GROUP BY 1, 2, 3", panel=True)
def _(g):
    return bqsr.apply(grouped(g), bqsr.marginals(cov(g), "rg"), "rg").groupBy("rg", "bq", "new_q").agg(F.count("*").alias("n"))


@query("bqsr_restricted", _COV + ", two AS (SELECT r AS region, contig_id, GREATEST(contig_id * 2000, r * 500 - 100) - contig_id * 2000 + 1 AS lo, LEAST((contig_id + 1) * 2000, (r + 1) * 500 + 100, 10000) - contig_id * 2000 AS hi FROM rid CROSS JOIN (SELECT DISTINCT contig_id FROM panel) WHERE r IN (3, 4, 11)) SELECT q, cyc, count(*) AS obs, count(*) FILTER (miss) AS err FROM cov WHERE EXISTS (SELECT 1 FROM two WHERE two.contig_id = cov.contig_id AND rpos BETWEEN lo AND hi) GROUP BY 1, 2", panel=True)
def _(g):
    """The tables of three regions alone, with their halos."""
    contigs = g.spark.range(5).selectExpr("cast(id as int) as contig_id", "cast(id as string) as contig", "cast(2000 as bigint) as len")
    three = genome.intervals(contigs, N_REGIONS, 100).where("region in (3, 4, 11)")
    return bqsr.tabulate(genome.restricted(cov(g), three), "q", "cyc")


@query("bqsr_overlap_excess", _COV + " SELECT q, count(*) AS regional, count(*) FILTER (own) AS once FROM (SELECT q, g >= r * 500 AND g < (r + 1) * 500 AS own FROM (SELECT *, contig_id * 2000 + rpos - 1 AS g FROM cov) JOIN rid ON g >= r * 500 - 100 AND g < (r + 1) * 500 + 100) GROUP BY 1", panel=True)
def _(g):
    c = cov(g).withColumn("g", F.expr("contig_id * 2000 + rpos - 1"))
    c = c.withColumn("r", F.explode(F.sequence(F.greatest(F.lit(0), F.expr("(g - 100) div 500")), F.expr("(g + 100) div 500")))).where(f"r < {N_REGIONS}")
    return c.where("g >= r * 500 - 100 and g < (r + 1) * 500 + 100").groupBy("q").agg(F.count("*").alias("regional"), F.count_if(F.expr("g >= r * 500 and g < (r + 1) * 500")).alias("once"))


@query("pileup", "SELECT contig_id, rpos, ref_base, base_call, count(*) AS depth, CAST(sum(bq) AS BIGINT) AS sum_bq FROM panel_bases WHERE bq >= 17 GROUP BY 1, 2, 3, 4", panel=True)
def _(g):
    return calling.pileup(g.bases())


@query("allele_counts", "SELECT contig_id, rpos, ref_base, count(*) AS dp, count(*) FILTER (base_call = ref_base) AS n_ref, count(*) FILTER (base_call <> ref_base) AS n_alt FROM panel_bases WHERE bq >= 17 GROUP BY 1, 2, 3", panel=True)
def _(g):
    return calling.alleles(g.bases())


_LIK = """, lb AS (SELECT contig_id, rpos, ref_base, base_call = ref_base AS is_ref, CAST(round(-10000 * log10(1 - pow(10.0, -bq / 10.0))) AS BIGINT) AS m, CAST(round(-10000 * log10(pow(10.0, -bq / 10.0) / 3)) AS BIGINT) AS o FROM panel_bases WHERE bq >= 17),
lik AS (SELECT contig_id, rpos, ref_base, count(*) AS dp, count(*) FILTER (NOT is_ref) AS n_alt, CAST(sum(CASE WHEN is_ref THEN m ELSE o END) AS BIGINT) AS rr, CAST(sum(CASE WHEN is_ref THEN o ELSE m END) AS BIGINT) AS aa, 3010 * count(*) AS ra FROM lb GROUP BY 1, 2, 3),
calls AS (SELECT contig_id, rpos, ref_base, dp, n_alt, CASE WHEN rr = least(rr, ra, aa) THEN '0/0' WHEN ra = least(rr, ra, aa) THEN '0/1' ELSE '1/1' END AS gt, rr - least(rr, ra, aa) AS qual, list_sort([rr, ra, aa])[2] - least(rr, ra, aa) AS gq FROM lik)"""


@query("genotype_lik", _LIK + " SELECT * FROM lik", panel=True)
def _(g):
    return calling.likelihoods(g.bases())


def calls(g):
    return calling.genotypes(calling.likelihoods(g.bases()))


@query("genotype", _LIK + " SELECT * FROM calls WHERE gt <> '0/0'", panel=True)
def _(g):
    return calls(g).where("gt <> '0/0'")


@query("call_conf50", _LIK + " SELECT contig_id, rpos, gt, qual FROM calls WHERE gt <> '0/0' AND qual >= 50000", panel=True)
def _(g):
    return calls(g).where("gt <> '0/0' and qual >= 50000").select("contig_id", "rpos", "gt", "qual")


@query("gvcf_bands", _LIK + " SELECT contig_id, band, min(rpos) AS lo, max(rpos) AS hi, min(dp) AS min_dp FROM (SELECT *, rpos - row_number() OVER (PARTITION BY contig_id, band ORDER BY rpos) AS run FROM (SELECT *, CASE WHEN gq < 200000 THEN 0 WHEN gq < 600000 THEN 1 ELSE 2 END AS band FROM calls WHERE gt = '0/0')) GROUP BY contig_id, band, run", panel=True)
def _(g):
    return calling.bands(calls(g))


@query("vcf_concat", "SELECT min(region) AS region, contig_id, pos, gt FROM regional_variants GROUP BY 2, 3, 4", panel=True)
def _(g):
    return variants.concat_distinct(g.regional_variants(), ["contig_id", "pos", "gt"])


@query("dbsnp_annotate", "SELECT t.contig_id, t.pos, gt, min(source) AS source FROM truth t LEFT JOIN known_sites k ON k.contig_id = t.contig_id AND k.pos = t.pos GROUP BY 1, 2, 3", panel=True)
def _(g):
    return variants.annotate(g.truth(), g.known_sites())


_LABEL = """, lab AS (SELECT t.contig_id, t.pos, gt, coalesce(bool_or(name IN ('dbsnp', 'omni')), false) AS is_known, coalesce(bool_or(name IN ('hapmap', 'kg_indel', 'mills')), false) AS is_training, coalesce(bool_or(name IN ('hapmap', 'mills')), false) AS is_truth,
coalesce(max(CASE name WHEN 'hapmap' THEN 10 WHEN 'dbsnp' THEN 2 WHEN 'omni' THEN 7 WHEN 'kg_indel' THEN 10 WHEN 'mills' THEN 12 END), 0) AS prior FROM truth t LEFT JOIN resource_sites s ON s.contig_id = t.contig_id AND s.pos = t.pos GROUP BY 1, 2, 3),
scored AS (SELECT *, (pos * 37 + contig_id * 11) % 101 AS score FROM lab),
cut AS (SELECT max(score) AS cut FROM (SELECT score, row_number() OVER (ORDER BY score DESC) AS k, count(*) OVER () AS total FROM scored WHERE is_truth) WHERE k >= ceil(0.99 * total))"""


def labelled(g):
    return variants.label(g.truth(), g.resource_sites())


def scored(g):
    return labelled(g).withColumn("score", F.expr("(pos * 37 + contig_id * 11) % 101"))


@query("vqsr_labels", _LABEL + " SELECT * FROM lab", panel=True)
def _(g):
    return labelled(g)


@query("tranches", _LABEL + " SELECT * FROM cut", panel=True)
def _(g):
    return variants.tranche_cut(scored(g))


@query("vqsr_filter", _LABEL + " SELECT contig_id, pos, score, CASE WHEN score >= cut THEN 'PASS' ELSE 'VQSRTranche99.0' END AS filter FROM scored CROSS JOIN cut", panel=True)
def _(g):
    s = scored(g)
    return variants.apply_cut(s, variants.tranche_cut(s)).select("contig_id", "pos", "score", "filter")


@query("site_features", "SELECT contig_id, rpos, ref_base, count(*) AS dp, round(sqrt(sum(mapq * mapq) / count(*)), 4) AS mq, count(*) FILTER (base_call = ref_base AND (flag & 16) = 0) AS ref_fwd, count(*) FILTER (base_call = ref_base AND (flag & 16) <> 0) AS ref_rev, count(*) FILTER (base_call <> ref_base AND (flag & 16) = 0) AS alt_fwd, count(*) FILTER (base_call <> ref_base AND (flag & 16) <> 0) AS alt_rev FROM panel_bases WHERE bq >= 17 GROUP BY 1, 2, 3", panel=True)
def _(g):
    return calling.features(g.bases())


_ANNOTATE = _LIK + """, tab AS (SELECT contig_id, rpos, ref_base, count(*) AS n, round(sqrt(sum(mapq * mapq) / count(*)), 4) AS mq, count(*) FILTER (base_call = ref_base AND (flag & 16) = 0) AS a, count(*) FILTER (base_call = ref_base AND (flag & 16) <> 0) AS b, count(*) FILTER (base_call <> ref_base AND (flag & 16) = 0) AS c, count(*) FILTER (base_call <> ref_base AND (flag & 16) <> 0) AS d FROM panel_bases WHERE bq >= 17 GROUP BY 1, 2, 3),
probs AS (SELECT *, a - greatest(0, a - d) AS nth, list_transform(range(greatest(0, a - d), least(a + b, a + c) + 1), lambda k: exp(lgamma(a + b + 1) - lgamma(k + 1) - lgamma(a + b - k + 1) + lgamma(c + d + 1) - lgamma(a + c - k + 1) - lgamma(d - a + k + 1) - lgamma(n + 1) + lgamma(a + c + 1) + lgamma(b + d + 1))) AS ps FROM tab),
fish AS (SELECT *, ps[nth + 1] AS seen FROM probs)
SELECT contig_id, rpos, ref_base, gt, dp, abs(round(-10 * log10(greatest(least(list_sum(list_filter(ps, lambda p: p <= seen * (1 + 1e-7))), 1.0), 1e-300)), 3)) AS fs, mq, round(qual / 1000 / dp, 4) AS qd,
round(ln((a + 1) * (d + 1) / ((b + 1) * (c + 1)) + (b + 1) * (c + 1) / ((a + 1) * (d + 1))) + ln(least(a + 1, b + 1) / greatest(a + 1, b + 1)) - ln(least(c + 1, d + 1) / greatest(c + 1, d + 1)), 4) AS sor FROM fish JOIN calls USING (contig_id, rpos, ref_base) WHERE gt <> '0/0'"""


@query("site_annotations", _ANNOTATE, panel=True)
def _(g):
    return calling.annotations(g.bases())


@query("vqsr_gmm")
def _(g):
    f = calling.annotations(g.bases())
    t = labelled(g).select(F.col("contig_id").alias("l_c"), F.col("pos").alias("l_p"), "is_training", "prior")
    sites = f.join(t, (F.col("contig_id") == F.col("l_c")) & (F.col("rpos") == F.col("l_p"))).drop("l_c", "l_p").withColumn("dp", F.col("dp").cast("double"))
    lod = variants.vqslod(sites, ["dp", "fs", "mq", "qd", "sor"], "is_training", "prior")
    return lod.select("contig_id", "rpos", F.round("vqslod", 4).alias("vqslod"))


@query("indel_events", ", c AS (SELECT contig_id, pos, regexp_extract_all(cigar, '(\\d+)([MIDNSHP=XB])', 2) AS o, list_transform(regexp_extract_all(cigar, '(\\d+)([MIDNSHP=XB])', 1), lambda x: CAST(x AS INT)) AS l FROM reads WHERE (flag & 2820) = 0), e AS (SELECT *, unnest(range(1, len(o) + 1)) AS i FROM c) SELECT contig_id, CAST(pos + coalesce(list_sum(list_transform(range(1, i), lambda j: CASE WHEN o[j] IN ('M', 'D', 'N', '=', 'X') THEN l[j] ELSE 0 END)), 0) - 1 AS BIGINT) AS pos, o[i] AS op, l[i] AS len, count(*) AS n FROM e WHERE o[i] IN ('I', 'D') GROUP BY ALL")
def _(g):
    return calling.indel_events(g.reads())


@query("log_terms", "SELECT doc_id % 50 AS task_index, bool_or(lower(text) LIKE '%the%') AND NOT bool_or(lower(text) LIKE '%idiot%' OR lower(text) LIKE '%password%') AS ok FROM documents GROUP BY 1")
def _(g):
    return logs.check_terms(g.table("documents").selectExpr("doc_id % 50 as task_index", "text as line"), ["the"], ["idiot", "password"])


@query("failed_partitions", "SELECT doc_id % 50 AS task_index FROM documents GROUP BY 1 HAVING NOT (bool_or(lower(text) LIKE '%the%') AND NOT bool_or(lower(text) LIKE '%idiot%' OR lower(text) LIKE '%password%'))")
def _(g):
    return logs.failed(g.table("documents").selectExpr("doc_id % 50 as task_index", "text as line"), ["the"], ["idiot", "password"])


_SEEDS = ", km AS (SELECT rec_id, i - 1 AS at, substr(seq, i, 11) AS kmer FROM (SELECT rec_id, seq, unnest(range(1, length(seq) - 9)) AS i FROM reads)), gm AS (SELECT p_partkey AS ref_id, i - 1 AS at, substr(s, i, 11) AS kmer FROM (SELECT p_partkey, s, unnest(range(1, length(s) - 9)) AS i FROM (SELECT p_partkey, translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s FROM part))) SELECT rec_id, ref_id, gm.at - km.at AS diagonal, count(*) AS seeds FROM km JOIN gm USING (kmer) GROUP BY 1, 2, 3"


def part_lines(g):
    return g.table("part").selectExpr("p_partkey as ref_id", "translate(md5(cast(p_partkey as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as ref_seq")


@query("seed_hits", _SEEDS)
def _(g):
    return align.seed_hits(g.reads(), part_lines(g), 11)


@query("seed_best", ", hits AS (" + _SEEDS.replace(", km AS", "WITH km AS", 1) + "), r AS (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY seeds DESC, ref_id, diagonal) AS k FROM hits) SELECT a.rec_id, a.ref_id, a.diagonal, a.seeds, coalesce(b.seeds, 0) AS second FROM r a LEFT JOIN r b ON b.rec_id = a.rec_id AND b.k = 2 WHERE a.k = 1")
def _(g):
    return align.seed_best(g.reads(), part_lines(g), 11)


@query("align_reads", """, x AS (SELECT rec_id, flag, l_linenumber % 4 AS k, CASE WHEN l_partkey % 100 = 99 THEN l_partkey - 1 ELSE l_partkey END AS a FROM reads)
SELECT rec_id, CAST(a // 100 AS INT) AS contig_id, CAST(a % 100 * 32 + 1 AS BIGINT) AS pos, (flag & 16) <> 0 AS flip, CASE k WHEN 1 THEN 59 WHEN 2 THEN 52 WHEN 3 THEN 56 ELSE 64 END AS score,
CASE k WHEN 2 THEN 61 ELSE 64 END AS matched, CASE k WHEN 3 THEN 2 ELSE 0 END AS inserted, CASE k WHEN 2 THEN 3 ELSE 0 END AS deleted FROM x""")
def _(g):
    ops = R.cigar(F.col("cigar"))
    kinds = [R.cigar_sum(ops, op).alias(name) for op, name in (("M", "matched"), ("I", "inserted"), ("D", "deleted"))]
    return align.alignments(g.planted_reads(), g.parts_reference()).where("rank = 0").select("rec_id", "contig_id", "pos", "flip", "score", *kinds)


_ALT = """, eb AS (SELECT contig_id, rpos, ref_base, base_call, count(*) AS d, CAST(sum(CAST(round(-10000 * log10(1 - pow(10.0, -bq / 10.0))) AS BIGINT)) AS BIGINT) AS m, CAST(sum(CAST(round(-10000 * log10(pow(10.0, -bq / 10.0) / 3)) AS BIGINT)) AS BIGINT) AS o FROM panel_bases WHERE bq >= 17 GROUP BY 1, 2, 3, 4),
nth AS (SELECT *, row_number() OVER (PARTITION BY contig_id, rpos, ref_base, base_call = ref_base ORDER BY d DESC, base_call) AS k FROM eb),
st AS (SELECT contig_id, rpos, ref_base, CAST(sum(d) AS BIGINT) AS dp, CAST(sum(o) AS BIGINT) AS o, coalesce(max(d) FILTER (base_call = ref_base), 0) AS rd, coalesce(max(m) FILTER (base_call = ref_base), 0) AS rm, coalesce(max(o) FILTER (base_call = ref_base), 0) AS ro,
max(base_call) FILTER (base_call <> ref_base AND k = 1) AS alt, coalesce(max(d) FILTER (base_call <> ref_base AND k = 1), 0) AS ad, coalesce(max(m) FILTER (base_call <> ref_base AND k = 1), 0) AS am, coalesce(max(o) FILTER (base_call <> ref_base AND k = 1), 0) AS ao FROM nth GROUP BY 1, 2, 3),
lk AS (SELECT *, rm + o - ro AS rr, am + o - ao AS aa, 3010 * (rd + ad) + o - ro - ao AS ra FROM st)
SELECT contig_id, rpos, ref_base, alt, dp, rd AS ad_ref, ad AS ad_alt, CASE WHEN rr = least(rr, ra, aa) THEN '0/0' WHEN ra = least(rr, ra, aa) THEN '0/1' ELSE '1/1' END AS gt, rr - least(rr, ra, aa) AS qual, list_sort([rr, ra, aa])[2] - least(rr, ra, aa) AS gq FROM lk"""


@query("genotype_alt", _ALT, panel=True)
def _(g):
    return calling.allele_genotypes(g.bases())


_EVENTS = ORACLES["indel_events"]


@query("indel_genotypes", _EVENTS[_EVENTS.index(", c AS (SELECT contig_id, pos, regexp"):].replace("SELECT contig_id, CAST(pos + coalesce", ", ev AS (SELECT contig_id, CAST(pos + coalesce").replace("IN ('I', 'D') GROUP BY ALL", "IN ('I', 'D') GROUP BY ALL), sp AS (SELECT contig_id, pos AS s, " + _SPAN + " - 1 AS t FROM reads WHERE (flag & 2820) = 0), cover AS (SELECT p.contig_id, p.pos, count(*) AS c FROM (SELECT DISTINCT contig_id, pos FROM ev) p JOIN sp ON sp.contig_id = p.contig_id AND s <= p.pos AND t >= p.pos GROUP BY 1, 2), lk AS (SELECT ev.*, greatest(coalesce(c, 0), n) AS dp FROM ev LEFT JOIN cover USING (contig_id, pos)), l2 AS (SELECT *, 4 * (dp - n) + 30000 * n AS rr, 4 * n + 30000 * (dp - n) AS aa, 3010 * dp AS ra FROM lk) SELECT contig_id, pos, op, len, n, dp, CASE WHEN rr = least(rr, ra, aa) THEN '0/0' WHEN ra = least(rr, ra, aa) THEN '0/1' ELSE '1/1' END AS gt, rr - least(rr, ra, aa) AS qual, list_sort([rr, ra, aa])[2] - least(rr, ra, aa) AS gq FROM l2"))
def _(g):
    return calling.indel_genotypes(g.reads())


@query("dbsnp_annotate_alleles", ", tv AS (SELECT contig_id, pos, SUBSTR('ACGT', 1 + CAST((pos * 31 + contig_id * 17 + ((pos * pos) % 7)) % 4 AS INT), 1) AS ref, SUBSTR('ACGT', 1 + CAST((pos * 31 + contig_id * 17 + ((pos * pos) % 7) + 2) % 4 AS INT), 1) AS alt FROM truth), kv AS (SELECT contig_id, pos, ref, SUBSTR('ACGT', 1 + CAST(i AS INT), 1) AS alt, 'rs' || pos AS source FROM tv CROSS JOIN (SELECT DISTINCT n_nationkey % 4 AS i FROM nation) WHERE (pos + i) % 3 = 0) SELECT tv.*, source FROM tv LEFT JOIN kv USING (contig_id, pos, ref, alt)", panel=True)
def _(g):
    """Known sites at some calls have another alt."""
    base = lambda shift: f"substr('ACGT', 1 + cast((pos * 31 + contig_id * 17 + ((pos * pos) % 7) + {shift}) % 4 as int), 1)"
    calls = g.truth().selectExpr("contig_id", "pos", f"{base(0)} as ref", f"{base(2)} as alt")
    known = calls.selectExpr("contig_id", "pos", "ref", "explode(sequence(0, 3)) as i").where("(pos + i) % 3 = 0")
    return variants.annotate(calls, known.selectExpr("contig_id", "pos", "ref", "substr('ACGT', 1 + i, 1) as alt", "concat('rs', pos) as source"))


@query("vqsr_modes")
def _(g):
    """Sites at even places stand for one mode, those at odd ones for the other."""
    f = calling.annotations(g.bases())
    t = labelled(g).select(F.col("contig_id").alias("l_c"), F.col("pos").alias("l_p"), "is_training", "is_truth", "prior")
    sites = f.join(t, (F.col("contig_id") == F.col("l_c")) & (F.col("rpos") == F.col("l_p"))).drop("l_c", "l_p").withColumn("dp", F.col("dp").cast("double"))
    moded = sites.withColumn("mode", F.when(F.col("rpos") % 2 == 0, "SNP").otherwise("INDEL"))
    return variants.recalibrate(moded, ["dp", "fs", "mq", "qd", "sor"], k=1).select("contig_id", "rpos", "mode", F.round("vqslod", 4).alias("vqslod"), "filter")


_LIBRARY = _MARK.replace("SELECT rec_id, qname, contig_id, CAST(CASE", "SELECT rec_id, qname, 'lib' || l_orderkey % 2 AS library, contig_id, CAST(CASE").replace("(contig_id, end5, strand)", "(library, contig_id, end5, strand)").replace("PARTITION BY contig_id, end5, strand", "PARTITION BY library, contig_id, end5, strand")


@query("markdup_by_library", _LIBRARY + " SELECT * FROM marked")
def _(g):
    return dedup.mark(g.reads().withColumn("library", F.concat(F.lit("lib"), F.col("l_orderkey") % 2)))


_END_TO_END = _RECALIBRATE + ", pr AS (SELECT p.contig_id, p.rpos, p.ref_base, p.base_call, r.new_q AS bq FROM panel_bases p JOIN recal r ON r.rec_id = p.rec_id AND r.contig_id = p.contig_id AND r.rpos = p.rpos)" + _ALT.replace("FROM panel_bases", "FROM pr")


@query("end_to_end_calls", _END_TO_END.replace("\nSELECT contig_id, rpos, ref_base, alt", ",\nout AS (SELECT contig_id, rpos, ref_base, alt").replace("AS gq FROM lk", "AS gq FROM lk) SELECT * FROM out WHERE gt <> '0/0' AND qual >= 30000"), panel=True)
def _(g):
    """The panel written as SAM text and read again, over the reference as lines, to calls."""
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("cycle", "base_call"))), lambda x: x["base_call"]), "")
    reads = g.panel().select("rec_id", "flag", "contig_id", "pos", "mapq", "cigar", "qual").join(g.bases().groupBy("rec_id").agg(seq.alias("seq")), "rec_id")
    star, zero = F.lit("*"), F.lit(0)
    lines = sequence.sam_lines(reads.select(F.col("rec_id").alias("qname"), "flag", F.concat(F.lit("c"), "contig_id").alias("rname"), "pos", "mapq", "cigar", star.alias("rnext"), zero.alias("pnext"), zero.alias("tlen"), "seq", "qual"))
    base = "substr('ACGT', cast(1 + (p * 31 + contig_id * 17 + ((p * p) % 7)) % 4 as int), 1)"
    lines_of = g.spark.range(5 * 34).selectExpr("cast(id div 34 as int) as contig_id", "id % 34 as line")
    reference = lines_of.selectExpr("contig_id", "concat('c', contig_id) as contig", "line", "60 as width", f"array_join(transform(sequence(line * 60 + 1, line * 60 + 60), p -> {base}), '') as seq")
    bases = assembled.bases_of(sequence.as_reads(sequence.parse_sam(lines), sequence.contigs_of(reference)), reference, g.known_sites())
    return assembled.called(assembled.recalibrated(bases))


_ACTIVE = """, pa AS (SELECT contig_id, rpos AS pos, count(*) AS dp, count(*) FILTER (base_call <> ref_base) AS n FROM panel_bases WHERE bq >= 17 GROUP BY 1, 2),
act AS (SELECT contig_id, pos, 1000 * n // dp AS activity FROM pa WHERE n >= 2),
sm AS (SELECT *, sum(activity) OVER (PARTITION BY contig_id ORDER BY pos RANGE BETWEEN 10 PRECEDING AND 10 FOLLOWING) AS total FROM act),
fi AS (SELECT contig_id, pos, CASE WHEN pos - lag(pos) OVER (PARTITION BY contig_id ORDER BY pos) <= 25 THEN 0 ELSE 1 END AS first FROM sm WHERE total >= 100),
ru AS (SELECT contig_id, pos, sum(first) OVER (PARTITION BY contig_id ORDER BY pos) AS run FROM fi),
isl AS (SELECT contig_id, min(pos) AS lo, max(pos) AS hi, max(pos) - min(pos) + 1 AS n, (max(pos) - min(pos) + 300) // 300 AS parts FROM ru GROUP BY contig_id, run)
SELECT contig_id, lo + n * k // parts AS lo, lo + n * (k + 1) // parts - 1 AS hi FROM (SELECT *, unnest(range(0, parts)) AS k FROM isl)"""


@query("active_regions", _ACTIVE, panel=True)
def _(g):
    n = calling.alleles(g.bases()).where(F.col("n_alt") >= active.LEAST_READS)
    rows = n.select("contig_id", F.col("rpos").alias("pos"), F.expr("1000 * n_alt div dp").alias("activity"))
    return active.regions(rows).select("contig_id", "lo", "hi")


@query("haplotype_calls", """, pt AS (SELECT CAST(p_partkey // 100 AS INT) AS c, string_agg(translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT'), '' ORDER BY p_partkey) AS t FROM part GROUP BY 1 HAVING count(*) = 100),
st AS (SELECT c, s, t, 100 + 160 * s AS pl, (c * 7 + s) % 5 AS k, substr(t, CAST(101 + 160 * s AS BIGINT), 1) AS base FROM pt CROSS JOIN (SELECT DISTINCT n_nationkey AS s FROM nation WHERE n_nationkey < 19)),
sk AS (SELECT *, CASE WHEN k IN (2, 4) THEN 'ins' WHEN k = 3 AND substr(t, CAST(pl + 13 AS BIGINT), 1) <> base THEN 'del' ELSE 'snp' END AS kind FROM st)
SELECT c AS contig_id, CAST(pl + 1 AS BIGINT) AS pos, CASE kind WHEN 'del' THEN substr(t, CAST(pl + 1 AS BIGINT), 13) ELSE base END AS ref,
CASE kind WHEN 'del' THEN base WHEN 'snp' THEN translate(base, 'ACGT', 'CGTA') ELSE base || translate(substr(md5(c || '_' || s), 1, 11), '0123456789abcdef', 'ACGTACGTACGTACGT') || translate(base, 'ACGT', 'CGTA') END AS alt,
CASE WHEN k IN (0, 2) THEN '1/1' ELSE '0/1' END AS gt FROM sk""")
def _(g):
    """Reads of two copies with planted letters, insertions and deletions: what is called is what was planted."""
    found = haplotypes.call(g.haplotype_reads(), g.parts_reference())
    return found.select("contig_id", "pos", "ref", F.array_join("alts", ",").alias("alt"), "gt")


_GVCF = """, es AS (SELECT 'rg' || CAST(split_part(rec_id, '_', 1) AS BIGINT) % 3 AS rg, contig_id, rpos, ref_base, base_call, count(*) AS d, CAST(sum(CAST(round(-10000 * log10(1 - pow(10.0, -bq / 10.0))) AS BIGINT)) AS BIGINT) AS m, CAST(sum(CAST(round(-10000 * log10(pow(10.0, -bq / 10.0) / 3)) AS BIGINT)) AS BIGINT) AS o FROM panel_bases WHERE bq >= 17 GROUP BY ALL),
ow AS (SELECT rg, contig_id, rpos, ref_base, CAST(sum(o) AS BIGINT) AS o, CAST(sum(d) AS BIGINT) AS dp FROM es GROUP BY 1, 2, 3, 4),
nm AS (SELECT *, row_number() OVER (PARTITION BY rg, contig_id, rpos ORDER BY d DESC, base_call) AS k FROM es WHERE base_call <> ref_base AND d >= 2),
na AS (SELECT rg, contig_id, rpos, base_call AS b, d, m, o FROM nm WHERE k <= 2 UNION ALL SELECT rg, contig_id, rpos, ref_base, d, m, o FROM es WHERE base_call = ref_base),
su AS (SELECT DISTINCT contig_id, rpos, base_call AS b FROM nm WHERE k <= 2),
al AS (SELECT contig_id, rpos, 0 AS i, min(ref_base) AS b FROM ow SEMI JOIN su USING (contig_id, rpos) GROUP BY 1, 2 UNION ALL SELECT contig_id, rpos, row_number() OVER (PARTITION BY contig_id, rpos ORDER BY b) AS i, b FROM su),
li AS (SELECT contig_id, rpos, string_agg(b, ',' ORDER BY i) FILTER (i > 0) AS alts, max(i) AS n FROM al GROUP BY 1, 2),
la AS (SELECT al.contig_id, al.rpos, al.i, ow.rg, coalesce(na.d, 0) AS d, coalesce(na.m, 0) AS m, coalesce(na.o, 0) AS o, (al.i = 0 OR na.d IS NOT NULL) AS named FROM al JOIN ow ON ow.contig_id = al.contig_id AND ow.rpos = al.rpos LEFT JOIN na ON na.rg = ow.rg AND na.contig_id = al.contig_id AND na.rpos = al.rpos AND na.b = al.b),
gc AS (SELECT x.rg, x.contig_id, x.rpos, x.i, y.i AS j, ow.ref_base, ow.dp, CASE WHEN x.i = y.i THEN ow.o - x.o + x.m ELSE ow.o - x.o - y.o + 3010 * (x.d + y.d) END AS c FROM la x JOIN la y ON y.rg = x.rg AND y.contig_id = x.contig_id AND y.rpos = x.rpos AND x.i <= y.i JOIN ow ON ow.rg = x.rg AND ow.contig_id = x.contig_id AND ow.rpos = x.rpos),
gp AS (SELECT *, CAST(round((c - min(c) OVER (PARTITION BY rg, contig_id, rpos)) / 1000.0) AS INT) AS p FROM gc),
gw AS (SELECT gp.*, n, CASE WHEN j = 0 THEN 0.9985 WHEN i = 0 THEN 0.001 / n ELSE 0.001 / (n * (n + 1)) END * pow(10.0, -p / 10.0) AS w FROM gp JOIN li USING (contig_id, rpos)),
sa AS (SELECT rg, contig_id, rpos, min(ref_base) AS ref, min(dp) AS dp, string_agg(p, ',' ORDER BY j, i) AS pl, first(i || '/' || j ORDER BY p, j, i) AS gt, least(99, list_sort(list(p))[2]) AS gq, -10 * log10(max(w) FILTER (j = 0) / sum(w)) AS q FROM gw GROUP BY 1, 2, 3),
sq AS (SELECT contig_id, rpos, round(sum(q), 3) AS qual FROM sa GROUP BY 1, 2 HAVING bool_or(gt <> '0/0'))
SELECT contig_id, rpos AS pos, ref, alts, rg AS sample, gt, gq, pl, dp, qual FROM sa JOIN sq USING (contig_id, rpos) JOIN li USING (contig_id, rpos)"""


def gvcf_records(g):
    """Records of the panel's three read groups as samples: where two reads of a letter differ, up to two such letters and
    NON_REF; elsewhere NON_REF alone."""
    match, other = calling._costs()
    ok = grouped(g).where(F.col("bq") >= calling.MIN_BASE_QUALITY)
    each = ok.groupBy("rg", *calling.SITE, "base_call").agg(F.count("*").alias("d"), F.sum(match).alias("m"), F.sum(other).alias("o"))
    row = F.struct((-F.col("d")).alias("less"), "base_call", "d", "m", "o")
    s = each.groupBy("rg", *calling.SITE).agg(F.array_sort(F.collect_list(row)).alias("xs"), F.sum("o").alias("all"), F.sum("d").alias("dp"))
    zero = F.struct(F.lit(0).cast("long").alias("less"), F.col("ref_base").alias("base_call"), *[F.lit(0).cast("long").alias(c) for c in ("d", "m", "o")])
    none = F.struct(F.lit(0).cast("long").alias("less"), F.lit(joint.NON_REF).alias("base_call"), *[F.lit(0).cast("long").alias(c) for c in ("d", "m", "o")])
    ref = F.coalesce(F.get(F.filter("xs", lambda x: x["base_call"] == F.col("ref_base")), F.lit(0)), zero)
    alts = F.slice(F.filter("xs", lambda x: (x["base_call"] != F.col("ref_base")) & (x["d"] >= 2)), 1, 2)
    s = s.withColumn("as", F.concat(F.array(ref), alts, F.array(none)))
    a = lambda i: F.element_at("as", i + 1)
    cost = lambda q: F.when(q["i"] == q["j"], F.col("all") - a(q["i"])["o"] + a(q["i"])["m"]).otherwise(F.col("all") - a(q["i"])["o"] - a(q["j"])["o"] + calling.HET * (a(q["i"])["d"] + a(q["j"])["d"]))
    s = s.withColumn("c", F.transform(joint.genotypes_of(F.size("as")), cost))
    pl = F.transform("c", lambda x: F.round((x - F.array_min("c")) / 1000.0).cast("int"))
    return s.select(F.col("rg").alias("sample"), "contig_id", F.col("rpos").alias("pos"), F.col("rpos").alias("end"), F.col("ref_base").alias("ref"), F.slice("as.base_call", 2, 9).alias("alts"), pl.alias("pl"), "dp")


@query("genotype_gvcf", _GVCF, panel=True)
def _(g):
    found = joint.genotype(gvcf_records(g))
    return found.select("contig_id", "pos", "ref", F.array_join("alts", ",").alias("alts"), "sample", "gt", "gq", F.array_join(F.col("pl").cast("array<string>"), ",").alias("pl"), "dp", "qual")
