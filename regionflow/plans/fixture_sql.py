"""The virtual genome over the driver tables as SQL: common table expressions for the oracle."""

GENOME = """contigs AS (SELECT n_nationkey AS contig_id, n_name AS contig, CAST(20000+4000*n_nationkey AS BIGINT) AS len,
  CAST(COALESCE(SUM(20000+4000*n_nationkey) OVER (ORDER BY n_nationkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),0) AS BIGINT) AS off FROM nation),
tot AS (SELECT CAST(SUM(len) AS BIGINT) AS total, CAST(CEIL(SUM(len)/20.0) AS BIGINT) AS l FROM contigs),
rid AS (SELECT DISTINCT CAST(n_nationkey AS BIGINT) AS r FROM nation WHERE n_nationkey<20),
iv AS (SELECT r AS region, contig_id, contig, GREATEST(off, r*l-3000)-off+1 AS lo, LEAST(off+len, (r+1)*l+3000, total)-off AS hi
   FROM rid CROSS JOIN tot CROSS JOIN contigs WHERE GREATEST(off, r*l-3000) < LEAST(off+len,(r+1)*l+3000,total)),
reads0 AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 
   CASE WHEN l_suppkey%10=0 THEN l_suppkey%25 ELSE l_orderkey%25 END AS contig_id,
   CAST(ROUND(l_tax*100) AS INT) AS tp, CAST(ROUND(l_discount*100) AS INT) AS dp, CAST(l_quantity AS INT) AS mapq, l_returnflag, l_linestatus FROM lineitem),
reads AS (SELECT CONCAT('q',CAST(l_orderkey AS VARCHAR(20))) AS qname, CONCAT(CAST(l_orderkey AS VARCHAR(20)),'_',CAST(l_linenumber AS VARCHAR(20)),'_',CAST(l_partkey AS VARCHAR(20)),'_',CAST(l_suppkey AS VARCHAR(20)),'_',CAST(mapq AS VARCHAR(20))) AS rec_id,
   l_orderkey, l_linenumber, l_partkey, l_suppkey,
   contig_id, 1+(l_orderkey*7919+l_partkey)%(20000+4000*contig_id) AS pos, mapq,
   1+CASE WHEN l_linenumber%2=1 THEN 64 ELSE 128 END+CASE WHEN l_returnflag='R' THEN 16 ELSE 0 END+CASE WHEN l_linestatus='O' THEN 256 ELSE 0 END
    +CASE WHEN tp=0 THEN 4 ELSE 0 END+CASE WHEN tp=8 THEN 512 ELSE 0 END+CASE WHEN dp=10 THEN 2048 ELSE 0 END AS flag,
   CASE l_linenumber WHEN 1 THEN '5S27M' WHEN 2 THEN '20M2I10M' WHEN 3 THEN '20M3D9M3S' ELSE '32M' END AS cigar,
   TRANSLATE(MD5(CONCAT(CAST(l_orderkey AS VARCHAR(20)),'_',CAST(l_partkey AS VARCHAR(20)))),'0123456789abcdef','ACGTACGTACGTACGT') AS seq,
   TRANSLATE(MD5(CONCAT(CAST(l_partkey AS VARCHAR(20)),'_',CAST(l_suppkey AS VARCHAR(20)))),'0123456789abcdef','#(-27<ADFGHIJKLM') AS qual FROM reads0)"""

PANEL = """known_sites AS (SELECT CAST(p_partkey%25 AS INT) AS contig_id, CAST(1+(p_partkey*6151)%(20000+4000*(p_partkey%25)) AS BIGINT) AS pos, 
   CASE WHEN p_size%3=0 THEN 'dbsnp' WHEN p_size%3=1 THEN 'mills' ELSE 'kg_indel' END AS source FROM part),
panel AS (SELECT rec_id, CAST(l_orderkey%5 AS INT) AS contig_id, 1+(l_orderkey*7919+l_partkey)%2000 AS pos, flag, mapq, qual, l_orderkey, l_partkey, l_linenumber
   FROM reads WHERE (flag & (4|512|256|2048))=0 AND cigar='32M'),
idx AS (SELECT DISTINCT CAST(i AS INT) AS i FROM (SELECT n_nationkey+1 AS i FROM nation UNION ALL SELECT n_nationkey+8 FROM nation) z WHERE i BETWEEN 1 AND 32),
pb0 AS (SELECT rec_id, contig_id, pos+i-1 AS rpos, i AS cycle, flag, mapq, ASCII(SUBSTR(qual,i,1))-33 AS bq, l_orderkey, l_partkey, l_linenumber,
   CAST(((pos+i-1)*31+contig_id*17+((pos+i-1)*(pos+i-1))%7)%4 AS INT) AS rb FROM panel CROSS JOIN idx),
truth AS (SELECT CAST(n_nationkey AS INT) AS contig_id, CAST(k*97+n_nationkey*11+5 AS BIGINT) AS pos, CASE WHEN k%3=0 THEN 'hom' ELSE 'het' END AS gt
   FROM nation CROSS JOIN (SELECT DISTINCT n_nationkey%20 AS k FROM nation) z WHERE n_nationkey<5),
panel_bases AS (SELECT rec_id, b.contig_id, rpos, cycle, flag, mapq, bq, SUBSTR('ACGT',1+rb,1) AS ref_base,
   SUBSTR('ACGT',1+CAST(CASE WHEN t.gt='hom' OR (t.gt='het' AND (l_orderkey+l_partkey+l_linenumber)%2=0) THEN (rb+2)%4
     WHEN (l_orderkey*31+l_partkey*7+cycle*13)%199=0 THEN (rb+1)%4 ELSE rb END AS INT),1) AS base_call
   FROM pb0 b LEFT JOIN truth t ON b.contig_id=t.contig_id AND b.rpos=t.pos),
resource_sites AS (SELECT contig_id,pos,'hapmap' AS name FROM truth WHERE pos%2=0 UNION ALL SELECT contig_id,pos,'omni' FROM truth WHERE pos%3=0
   UNION ALL SELECT contig_id,pos,'mills' FROM truth WHERE pos%5=0 UNION ALL SELECT contig_id,pos,'dbsnp' FROM truth WHERE pos%7<5 UNION ALL SELECT contig_id,pos,'kg_indel' FROM truth WHERE pos%11<3),
pvar AS (SELECT contig_id, contig_id*2000+pos-1 AS g, pos, gt FROM truth),
regional_variants AS (SELECT r AS region, contig_id, pos, gt FROM pvar JOIN rid ON g>=r*500-100 AND g<(r+1)*500+100)"""


def with_genome(query: str, halo: int = 3000, panel: bool = False) -> str:
    genome = GENOME.replace("3000", str(halo))
    return "WITH " + genome + ("," + PANEL if panel else "") + " " + query
