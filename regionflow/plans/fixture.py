"""The virtual genome: genomic tables derived by arithmetic from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionflow.operators import bqsr
from regionflow.operators.store import spread

N_REGIONS = 20
#: The panel's reference letter at a place, and the call of a read there by what is planted, that letter and the cycle.
_REF = "cast(({0} * 31 + contig_id * 17 + (({0} * {0}) % 7)) % 4 as int)"
_CALL = (
    "case when {0} = 'hom' or ({0} = 'het' and (l_orderkey + l_partkey + l_linenumber) % 2 = 0) then ({1} + 2) % 4 "
    "when (l_orderkey * 31 + l_partkey * 7 + {2} * 13) % 199 = 0 then ({1} + 1) % 4 else {1} end"
)


class Genome:
    """The tables of one folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def contigs(self) -> DataFrame:
        return self.table("nation").selectExpr("n_nationkey as contig_id", "n_name as contig", "cast(20000 + 4000 * n_nationkey as bigint) as len")

    def reads(self) -> DataFrame:
        raw = self.table("lineitem").selectExpr(
            "*", "case when l_suppkey % 10 = 0 then l_suppkey % 25 else l_orderkey % 25 end as contig_id",
            "cast(round(l_tax * 100) as int) as tp", "cast(round(l_discount * 100) as int) as dp", "cast(l_quantity as int) as mapq",
        )
        base = "translate(md5(concat({}, '_', {})), '0123456789abcdef', '{}')"
        return raw.selectExpr(
            "concat('q', l_orderkey) as qname", "concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey, mapq) as rec_id",
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "contig_id", "1 + (l_orderkey * 7919 + l_partkey) % (20000 + 4000 * contig_id) as pos", "mapq",
            "1 + if(l_linenumber % 2 = 1, 64, 128) + if(l_returnflag = 'R', 16, 0) + if(l_linestatus = 'O', 256, 0) + if(tp = 0, 4, 0) + if(tp = 8, 512, 0) + if(dp = 10, 2048, 0) as flag",
            "case l_linenumber when 1 then '5S27M' when 2 then '20M2I10M' when 3 then '20M3D9M3S' else '32M' end as cigar",
            base.format("l_orderkey", "l_partkey", "ACGTACGTACGTACGT") + " as seq", base.format("l_partkey", "l_suppkey", "#(-27<ADFGHIJKLM") + " as qual",
        )

    def parts_reference(self) -> DataFrame:
        """Contigs of 100 lines of 32 bases, a line per part."""
        return self.table("part").selectExpr(
            "cast(p_partkey div 100 as int) as contig_id", "concat('p', p_partkey div 100) as contig", "cast(p_partkey % 100 as bigint) as line", "32 as width",
            "translate(md5(cast(p_partkey as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq",
        )

    def planted_reads(self) -> DataFrame:
        """rec_id and seq: two lines of parts_reference with a letter changed, three left out, two put in, or as they are, by
        the line number; turned round by the return flag."""
        line = "translate(md5(cast({} as string)), '0123456789abcdef', 'ACGTACGTACGTACGT')"
        two = self.reads().withColumn("a", F.expr("if(l_partkey % 100 = 99, l_partkey - 1, l_partkey)"))
        # Within an array a text is made once, not again for each of its uses.
        two = two.withColumn("ts", F.array(F.concat(F.expr(line.format("a")), F.expr(line.format("a + 1")))))
        edited = "case l_linenumber % 4 when 1 then concat(left(t, 32), translate(substr(t, 33, 1), 'ACGT', 'CGTA'), substr(t, 34)) when 2 then concat(left(t, 32), substr(t, 36)) when 3 then concat(left(t, 32), translate(substr(t, 33, 2), 'ACGT', 'GTAC'), substr(t, 33)) else t end"
        es = two.withColumn("es", F.expr(f"transform(ts, t -> {edited})"))
        return es.selectExpr("rec_id", "transform(es, e -> if(flag & 16 <> 0, reverse(translate(e, 'ACGT', 'TGCA')), e))[0] as seq")

    def planted_sites(self) -> DataFrame:
        """c, at (from 0), kind (snp, ins, del), both (whether both copies have it) and put: a site each 160 bases of a contig of
        parts_reference, of single letters and of 12 bases put in after or left out after the place."""
        lines = self.parts_reference().groupBy("contig_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "seq"))), lambda x: x["seq"]), "").alias("t"))
        at = lines.where("length(t) = 3200").selectExpr("contig_id as c", "t", "explode(sequence(0, 18)) as s").selectExpr("*", "100 + 160 * s as at", "(c * 7 + s) % 5 as k")
        base = at.withColumn("base", F.expr("substr(t, at + 1, 1)"))
        kind = "case when k in (2, 4) then 'ins' when k = 3 and substr(t, at + 13, 1) <> base then 'del' else 'snp' end"
        put = "concat(translate(substr(md5(concat(c, '_', s)), 1, 11), '0123456789abcdef', 'ACGTACGTACGTACGT'), translate(base, 'ACGT', 'CGTA'))"
        return base.selectExpr("c", "at", f"{kind} as kind", "k in (0, 2) as both", f"{put} as put", "t")

    def haplotype_reads(self) -> DataFrame:
        """Reads of 100 bases of two copies that have the planted sites, aligned where they come from; a third has a letter of
        low quality changed. Reads that end within 15 bases of a site are left out."""
        raw = spread(self.table("lineitem")).selectExpr(
            "concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(l_quantity as int)) as rec_id", "cast(l_partkey div 100 as int) as c", "(l_orderkey * 7919 + l_suppkey * 31 + l_linenumber * 17 + l_partkey) % 3070 as start",
            "(l_orderkey + l_linenumber) % 2 as copy", "if((l_orderkey * 31 + l_linenumber) % 3 = 0, (l_suppkey * 13 + l_orderkey) % 100, null) as wrong", "if(l_returnflag = 'R', 16, 0) as flag",
        )
        near = raw.withColumn("at", F.expr("100 + 160 * greatest(0, (start - 100 + 159) div 160)")).withColumn("d", F.expr("at - start")).where("d between 15 and 84 or d between 100 and 146 or start < 85 and d >= 100")
        met = near.join(self.planted_sites().withColumnRenamed("c", "s_c").withColumnRenamed("at", "s_at"), F.expr("c = s_c and least(at, 2980) = s_at"))
        has = "at = s_at and d between 15 and 84 and (both or copy = 1)"
        text = f"case when not ({has}) then substr(t, start + 1, 100) when kind = 'snp' then concat(substr(t, start + 1, d), translate(substr(t, at + 1, 1), 'ACGT', 'CGTA'), substr(t, at + 2, 99 - d)) when kind = 'ins' then concat(substr(t, start + 1, d + 1), put, substr(t, at + 2, 87 - d)) else concat(substr(t, start + 1, d + 1), substr(t, at + 14, 99 - d)) end"
        cigar = f"case when not ({has}) or kind = 'snp' then '100M' when kind = 'ins' then concat(d + 1, 'M12I', 87 - d, 'M') else concat(d + 1, 'M12D', 99 - d, 'M') end"
        own = met.withColumn("x", F.expr(text))
        wrong = "if(wrong is null, x, concat(substr(x, 1, wrong), translate(substr(x, wrong + 1, 1), 'ACGT', 'GTAC'), substr(x, wrong + 2)))"
        qual = "if(wrong is null, repeat('I', 100), concat(repeat('I', wrong), '&', repeat('I', 99 - wrong)))"
        return own.selectExpr("rec_id", "c as contig_id", "start + 1 as pos", "flag", "60 as mapq", f"{cigar} as cigar", f"{wrong} as seq", f"{qual} as qual")

    def known_sites(self) -> DataFrame:
        return self.table("part").selectExpr(
            "cast(p_partkey % 25 as int) as contig_id", "cast(1 + (p_partkey * 6151) % (20000 + 4000 * (p_partkey % 25)) as bigint) as pos",
            "case when p_size % 3 = 0 then 'dbsnp' when p_size % 3 = 1 then 'mills' else 'kg_indel' end as source",
        )

    def truth(self) -> DataFrame:
        k = self.spark.range(20).selectExpr("id as k")
        return self.table("nation").where("n_nationkey < 5").crossJoin(k).selectExpr(  # 5 contigs x 20 sites
            "cast(n_nationkey as int) as contig_id", "cast(k * 97 + n_nationkey * 11 + 5 as bigint) as pos", "if(k % 3 = 0, 'hom', 'het') as gt"
        )

    def panel(self) -> DataFrame:
        return self.reads().where("(flag & 2820) = 0 and cigar = '32M'").selectExpr(
            "rec_id", "cast(l_orderkey % 5 as int) as contig_id", "1 + (l_orderkey * 7919 + l_partkey) % 2000 as pos", "flag", "mapq", "cigar", "seq", "qual", "l_orderkey", "l_partkey", "l_linenumber"
        )

    def bases(self) -> DataFrame:
        """The panel's reads, a row per base, against a formula reference with planted variants. The calls are those of
        the formula instead of the reads' own; so is the call before, as a read's bases stand over neighbouring places."""
        b = bqsr.explode(self.panel()).drop("base_call", "before").withColumn("rb", F.expr(_REF.format("rpos"))).withColumn("rb0", F.expr(_REF.format("(rpos - 1)")))
        t = F.broadcast(self.truth().selectExpr("contig_id as t_c", "pos as t_p", "gt"))  # 100 rows
        b = b.join(t, (F.col("contig_id") == F.col("t_c")) & (F.col("rpos") == F.col("t_p")), "left").drop("t_c", "t_p")
        t = t.selectExpr("t_c", "t_p", "gt as gt0")
        b = b.join(F.broadcast(t), (F.col("contig_id") == F.col("t_c")) & (F.col("rpos") - 1 == F.col("t_p")), "left")
        call, before = (f"substr('ACGT', 1 + cast({_CALL.format(*x)} as int), 1)" for x in (("gt", "rb", "cycle"), ("gt0", "rb0", "(cycle - 1)")))
        return b.selectExpr("rec_id", "contig_id", "rpos", "cycle", "flag", "mapq", "bq", "substr('ACGT', 1 + rb, 1) as ref_base", f"{call} as base_call", f"if(cycle > 1, {before}, null) as before")

    def resource_sites(self) -> DataFrame:
        t = self.truth()
        rules = (("hapmap", "pos % 2 = 0"), ("omni", "pos % 3 = 0"), ("mills", "pos % 5 = 0"), ("dbsnp", "pos % 7 < 5"), ("kg_indel", "pos % 11 < 3"))
        names = F.array(*[F.when(F.expr(rule), name) for name, rule in rules])
        return t.select("contig_id", "pos", F.explode(F.array_compact(names)).alias("name"))

    def regional_variants(self) -> DataFrame:
        r = self.spark.range(N_REGIONS).selectExpr("id as region")
        v = self.truth().selectExpr("contig_id", "contig_id * 2000 + pos - 1 as g", "pos", "gt")
        return v.join(r, F.expr("g >= region * 500 - 100 and g < (region + 1) * 500 + 100")).drop("g")  # 100 sites x 20 regions
