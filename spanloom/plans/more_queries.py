"""Further operators and pipelines on the driver's tables, with the same results in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as S
from ..operators import intervals, order, statistics
from . import evidence, pipelines
from .driver_queries import BEFORE_SQL, DAY, DNA_SQL, ITEMS_SQL, ORDERS_SQL, UNION_SQL, day, dna, items, order_spans, read


def intersection_lengths(spark, d):
    return intervals.intersection_length(order_spans(spark, d, 5), items(spark, d), ["part"], "part", width=64).select("part", F.col("covered").alias("both"))


INTERSECTION_LENGTHS = f"""WITH g AS ({ORDERS_SQL.format(5)}), f AS ({ITEMS_SQL}), c AS (SELECT g.part, greatest(g.s, f.s) AS s, least(g.e, f.e) AS e FROM g JOIN f ON g.part = f.part AND g.s <= f.e AND f.s <= g.e),
w AS (SELECT *, {BEFORE_SQL.format('part')} AS before FROM c) SELECT part, {UNION_SQL} AS both FROM w GROUP BY part"""


def distinct_in_regions(spark, d):
    return intervals.distinct_in(order_spans(spark, d, 30), items(spark, d), ["part"], "id", "supplier", width=64)


DISTINCT_IN_REGIONS = f"WITH g AS ({ORDERS_SQL.format(30)}), f AS ({ITEMS_SQL}) SELECT g.id, count(DISTINCT f.supplier) AS n_distinct FROM g JOIN f ON g.part = f.part AND g.s <= f.e AND f.s <= g.e GROUP BY g.id"


def _exons(spark, d):
    rows = read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").cast("long").alias("q"))
    start = F.col("l_linenumber").cast("long") * 1000
    return rows.select(F.col("l_orderkey").alias("transcript_id"), F.lit("c").alias("seqid"), F.when(F.col("l_orderkey") % 2 == 0, "-").otherwise("+").alias("strand"), start.alias("start"), (start + F.col("q") - 1).alias("end"))


_EXONS = "SELECT l_orderkey AS t, CASE WHEN l_orderkey % 2 = 0 THEN '-' ELSE '+' END AS strand, l_linenumber * 1000 AS s, l_linenumber * 1000 + CAST(max(l_quantity) AS BIGINT) - 1 AS e FROM lineitem GROUP BY l_orderkey, l_linenumber"


def transcript_to_genome(spark, d):
    exons = _exons(spark, d)
    spans = exons.select("transcript_id").distinct().select("transcript_id", F.lit("o").alias("id"), F.lit(5).cast("long").alias("start"), F.lit(60).cast("long").alias("end"))
    return pipelines.to_genome(exons, spans).select("transcript_id", "g_start", "g_end", "offset")


TRANSCRIPT_TO_GENOME = f"""WITH x AS ({_EXONS}), p AS (SELECT *, e - s + 1 AS n, COALESCE(sum(e - s + 1) OVER (PARTITION BY t ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM x),
q AS (SELECT *, greatest(5, before + 1) AS a, least(60, before + n) AS b FROM p)
SELECT t AS transcript_id, CAST(CASE WHEN strand = '-' THEN e - (b - before - 1) ELSE s + a - before - 1 END AS BIGINT) AS g_start, CAST(CASE WHEN strand = '-' THEN e - (a - before - 1) ELSE s + b - before - 1 END AS BIGINT) AS g_end, CAST(a - 5 AS BIGINT) AS "offset" FROM q WHERE a <= b"""


def exon_introns(spark, d):
    return intervals.introns(_exons(spark, d), ["transcript_id"]).groupBy("transcript_id").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("length"))


EXON_INTRONS = f"WITH x AS ({_EXONS}), l AS (SELECT t, lag(e) OVER (PARTITION BY t ORDER BY s, e) + 1 AS a, s - 1 AS b FROM x) SELECT t AS transcript_id, count(*) AS n, sum(b - a + 1)::BIGINT AS length FROM l WHERE a <= b GROUP BY t"


def renamed_orders(spark, d):
    return order.renamed(read(spark, d, "orders").select("o_custkey", "o_orderkey"), "gene", ["o_custkey"], ["o_orderkey"]).select("o_orderkey", "name")


RENAMED_ORDERS = "SELECT o_orderkey, 'gene' || lpad(CAST(row_number() OVER (ORDER BY o_custkey, o_orderkey) AS VARCHAR), CAST(length(CAST(count(*) OVER () AS VARCHAR)) AS INTEGER), '0') AS name FROM orders"


def top_longest(spark, d):
    """O2: a limit is the feature."""
    return read(spark, d, "documents").filter("n_chars <= 20000").select("doc_id", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(50)


TOP_LONGEST = "SELECT doc_id, n_chars FROM documents WHERE n_chars <= 20000 ORDER BY n_chars DESC, doc_id LIMIT 50"


def masked_sequence(spark, d):
    ranges = F.expr("array(named_struct('start', 2L, 'end', 5L), named_struct('start', 8L, 'end', 9L))")
    return dna(spark, d).filter(F.length("seq") >= 10).select("doc_id", F.md5(S.masked(F.col("seq"), ranges)).alias("hard"), F.md5(S.masked(F.col("seq"), ranges, "lower")).alias("soft"))


MASKED_SEQUENCE = f"WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents) SELECT doc_id, md5(seq[1:1] || 'NNNN' || seq[6:7] || 'NN' || seq[10:]) AS hard, md5(seq[1:1] || lower(seq[2:5]) || seq[6:7] || lower(seq[8:9]) || seq[10:]) AS soft FROM q WHERE length(seq) >= 10"


def least_orf_lengths(spark, d):
    n = S.base_counts(F.col("seq"), both_strands=False)
    return dna(spark, d).filter("seq != ''").select("doc_id", S.least_orf(200.0 * n["C"] / F.length("seq")).cast("long").alias("least"))


#: The first step that isn't below the GC percentage.
LEAST_ORF_LENGTHS = f"""WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents), g AS (SELECT doc_id, 200.0::DOUBLE * (length(seq) - length(replace(seq, 'C', ''))) / length(seq) AS gc FROM q WHERE seq <> ''),
t(step, least) AS (VALUES (25, 465), (30, 510), (35, 555), (40, 590), (45, 645), (50, 749), (55, 797), (60, 927), (65, 1086), (70, 1358), (75, 1743), (80, 2422))
SELECT doc_id, CAST(COALESCE((SELECT min(least) FROM t WHERE step >= gc), 1000000) AS BIGINT) AS least FROM g"""


def text_scalars(spark, d):
    url = F.coalesce("url", F.lit(""))
    return read(spark, d, "pages").select("page_id", S.species(url).alias("species"), S.valid_protein(url).alias("plain"), F.length(S.revcomp(url, keep_case=True)).cast("long").alias("n"))


TEXT_SCALARS = "SELECT page_id, CASE WHEN regexp_extract(COALESCE(url, ''), '(?i)(species[a-zA-Z0-9]+)', 1) <> '' THEN regexp_extract(COALESCE(url, ''), '(?i)(species[a-zA-Z0-9]+)', 1) ELSE COALESCE(url, '') END AS species, NOT regexp_matches(COALESCE(url, ''), '\\*.+') AS plain, CAST(length(COALESCE(url, '')) AS BIGINT) AS n FROM pages"


def best_hits(spark, d):
    rows = read(spark, d, "lineitem")
    a = F.col("l_linenumber").cast("long") * 10
    hsps = rows.select(F.col("l_orderkey").alias("query"), (F.col("l_suppkey") % 5).alias("subject"), F.floor("l_quantity").cast("double").alias("pident"), F.lit(20).cast("long").alias("length"), a.alias("qstart"), (a + F.col("l_quantity").cast("long")).alias("qend"), F.col("l_quantity").cast("long").alias("sstart"), F.lit(30).cast("long").alias("send"), F.lit(1e-9).alias("evalue"), F.col("l_extendedprice").alias("bitscore"))
    found = pipelines.blast_hits(hsps, least_identity=5.0, top_share=0.5, most_hits=2)
    return found.select("query", "subject", "q_covered", "s_covered", (F.floor(F.col("identity") * 1e4 + 0.5) / 1e4).alias("identity"))


BEST_HITS = f"""WITH h AS (SELECT l_orderkey AS q, l_suppkey % 5 AS t, floor(l_quantity) AS pid, l_linenumber * 10 AS qs, l_linenumber * 10 + CAST(l_quantity AS BIGINT) AS qe, least(CAST(l_quantity AS BIGINT), 30) AS ss, greatest(CAST(l_quantity AS BIGINT), 30) AS se, l_extendedprice AS bits FROM lineitem),
a AS (SELECT q, t, avg(pid) AS identity, max(bits) AS bits FROM h GROUP BY q, t),
x AS (SELECT q, t, {UNION_SQL} AS q_covered FROM (SELECT q, t, s, e, {BEFORE_SQL.format('q, t')} AS before FROM (SELECT q, t, qs AS s, qe AS e FROM h)) GROUP BY q, t),
y AS (SELECT q, t, {UNION_SQL} AS s_covered FROM (SELECT q, t, s, e, {BEFORE_SQL.format('q, t')} AS before FROM (SELECT q, t, ss AS s, se AS e FROM h)) GROUP BY q, t),
j AS (SELECT * FROM a JOIN x USING (q, t) JOIN y USING (q, t) WHERE identity >= 5), b AS (SELECT * FROM j QUALIFY bits >= max(bits) OVER (PARTITION BY q) * 0.5)
SELECT q AS query, t AS subject, q_covered, s_covered, floor(identity * 1e4 + 0.5) / 1e4 AS identity FROM b QUALIFY row_number() OVER (PARTITION BY q ORDER BY bits DESC, t) <= 2"""


def source_priority(spark, d):
    name = F.element_at(F.array(F.lit("augustus"), F.lit("transfrag"), F.lit("homolog"), F.lit("other")), (F.col("id") % 4 + 1).cast("int"))
    rows = order_spans(spark, d, 60).select(F.col("part").alias("seqid"), F.lit("+").alias("strand"), F.col("id").alias("gene_id"), name.alias("source"), "start", "end")
    return pipelines.combined(rows).select("gene_id", "source")


SOURCE_PRIORITY = f"""WITH g AS (SELECT *, id % 4 AS r FROM ({ORDERS_SQL.format(60)})), w AS (SELECT *, max(e) OVER (PARTITION BY part ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM g),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR s - before > -31 THEN 1 ELSE 0 END) OVER (PARTITION BY part ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM w)
SELECT id AS gene_id, ['augustus', 'transfrag', 'homolog', 'other'][r + 1] AS source FROM i QUALIFY r = min(r) OVER (PARTITION BY part, island)"""


def accuracy_levels(spark, d):
    """Discounted lines as the reference, taxed ones as what is predicted."""
    rows = read(spark, d, "lineitem").select(F.col("l_suppkey").alias("seqid"), F.lit("+").alias("strand"), F.concat_ws(":", "l_partkey", "l_suppkey").alias("gene_id"), day("l_shipdate").alias("start"), (day("l_shipdate") + F.col("l_quantity").cast("long")).alias("end"), "l_discount", "l_tax")
    found = pipelines.accuracy(rows.filter("l_discount > 0.02").drop("l_discount", "l_tax"), rows.filter("l_tax > 0.02").drop("l_discount", "l_tax"))
    r = lambda c: (F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c)
    return found.select("level", "standard", "predicted", "tp", r("sensitivity"), r("specificity"))


_LINES = f"SELECT l_partkey AS part, l_suppkey AS supplier, {DAY.format('l_shipdate')} AS s, {DAY.format('l_shipdate')} + CAST(l_quantity AS BIGINT) AS e FROM lineitem"
ACCURACY_LEVELS = f"""WITH a AS ({_LINES} WHERE l_discount > 0.02), b AS ({_LINES} WHERE l_tax > 0.02),
n(what, n) AS (SELECT 'a', (SELECT {UNION_SQL} FROM (SELECT s, e, {BEFORE_SQL.format('supplier')} AS before FROM a)) UNION ALL SELECT 'b', (SELECT {UNION_SQL} FROM (SELECT s, e, {BEFORE_SQL.format('supplier')} AS before FROM b)) UNION ALL SELECT 'u', (SELECT {UNION_SQL} FROM (SELECT s, e, {BEFORE_SQL.format('supplier')} AS before FROM (SELECT * FROM a UNION ALL SELECT * FROM b)))),
p AS (SELECT 'position' AS level, max(n) FILTER (what = 'a') AS standard, max(n) FILTER (what = 'b') AS predicted, max(n) FILTER (what = 'a') + max(n) FILTER (what = 'b') - max(n) FILTER (what = 'u') AS tp FROM n),
x AS (SELECT DISTINCT supplier, s, e FROM a), y AS (SELECT DISTINCT supplier, s, e FROM b), q AS (SELECT 'part' AS level, (SELECT count(*) FROM x) AS standard, (SELECT count(*) FROM y) AS predicted, (SELECT count(*) FROM (FROM x INTERSECT FROM y)) AS tp),
gx AS (SELECT part, supplier, string_agg(CASE WHEN k > 1 THEN s END || '-' || e, ',' ORDER BY s, e) AS c, first(e ORDER BY s, e) AS z FROM (SELECT *, row_number() OVER (PARTITION BY part, supplier ORDER BY s, e) AS k FROM (SELECT DISTINCT part, supplier, s, e FROM a)) GROUP BY ALL),
gy AS (SELECT part, supplier, string_agg(CASE WHEN k > 1 THEN s END || '-' || e, ',' ORDER BY s, e) AS c, first(e ORDER BY s, e) AS z FROM (SELECT *, row_number() OVER (PARTITION BY part, supplier ORDER BY s, e) AS k FROM (SELECT DISTINCT part, supplier, s, e FROM b)) GROUP BY ALL),
g AS (SELECT 'gene' AS level, (SELECT count(*) FROM gx) AS standard, (SELECT count(*) FROM gy) AS predicted, (SELECT count(*) FROM gx WHERE EXISTS (SELECT 1 FROM gy WHERE gy.supplier = gx.supplier AND gy.c IS NOT DISTINCT FROM gx.c AND gy.z = gx.z)) AS tp)
SELECT level, standard, predicted, tp, floor(tp / standard * 1e4 + 0.5) / 1e4 AS sensitivity, floor(tp / predicted * 1e4 + 0.5) / 1e4 AS specificity FROM (FROM p UNION ALL FROM q UNION ALL FROM g)"""


def intron_support(spark, d):
    rows = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set(F.col("l_partkey").cast("string")).alias("introns")).withColumns({"seqid": F.lit("c"), "strand": F.lit("+")})
    return evidence.intron_multiplicity(rows).select("id", "support")


INTRON_SUPPORT = "WITH n AS (SELECT l_partkey, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY l_partkey) SELECT l_orderkey AS id, min(n) AS support FROM lineitem JOIN n USING (l_partkey) GROUP BY l_orderkey"


def length_statistics(spark, d):
    """A5 over several lengths, with upper medians."""
    rows = items(spark, d).select(F.lit("item").alias("what"), (F.col("end") - F.col("start") + 1).alias("n"))
    rows = rows.unionByName(read(spark, d, "documents").select(F.lit("text").alias("what"), F.col("n_chars").alias("n")))
    return rows.groupBy("what").agg(F.count("*").alias("count"), F.sum("n").cast("long").alias("sum")).join(order.medians_of_few(rows, "what", "n"), "what")


LENGTH_STATISTICS = f"""WITH r AS (SELECT 'item' AS what, e - s + 1 AS n FROM ({ITEMS_SQL}) UNION ALL SELECT 'text', n_chars FROM documents) SELECT what, count(*) AS count, sum(n)::BIGINT AS sum, list_sort(list(n))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS median FROM r GROUP BY what"""


def redundancy_merge(spark, d):
    """Rows only, since the order of suppression isn't SQL; the tests compare it with a loop."""
    cds = order_spans(spark, d, 20).select(F.col("part").alias("seqid"), F.lit("+").alias("strand"), F.col("id").alias("gene_id"), F.col("id").alias("transcript_id"), "start", "end")
    scores = order_spans(spark, d, 0).select(F.col("id").alias("gene_id"), F.col("id").alias("transcript_id"), F.col("price").cast("long").alias("score"))
    return pipelines.without_redundancy(cds, scores)


def weighted_score(spark, d):
    rows = read(spark, d, "lineitem").groupBy("l_suppkey").agg(*[F.avg(c).alias(c) for c in ("l_discount", "l_tax")])
    pair = (F.col("l_discount"), F.col("l_tax"))
    return rows.select("l_suppkey", (F.floor(statistics.weighted_accuracy(pair, pair, pair) * 1e6 + 0.5) / 1e6).alias("score"))


WEIGHTED_SCORE = "SELECT l_suppkey, floor((9 * avg(l_discount) + 6 * avg(l_tax)) / 15 * 1e6 + 0.5) / 1e6 AS score FROM lineitem GROUP BY l_suppkey"

NAMES = [
    "intersection_lengths", "distinct_in_regions", "transcript_to_genome", "exon_introns", "renamed_orders", "top_longest", "masked_sequence", "least_orf_lengths", "text_scalars", "best_hits", "source_priority",
    "accuracy_levels", "intron_support", "length_statistics", "redundancy_merge", "weighted_score",
]
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES if name.upper() in globals()}
