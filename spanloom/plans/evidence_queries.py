"""Evidence operators on the driver's tables; their SQL is written from the operators' definitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals, statistics
from . import evidence, pipelines
from .driver_queries import BEFORE_SQL, ITEMS_SQL, ORDERS_SQL, UNION_SQL, items, order_spans, read


def contig_pieces(spark, d):
    """Customers of a nation as the sequences of a genome, their account balance as length."""
    rows = read(spark, d, "customer").select("c_nationkey", "c_custkey", F.abs(F.floor("c_acctbal")).cast("long").alias("len"))
    return intervals.chunks(rows, ["c_nationkey"], "len", 12_000, "c_custkey").select("c_custkey", "piece")


CONTIG_PIECES = """WITH RECURSIVE r AS (SELECT c_nationkey AS g, c_custkey AS id, CAST(abs(floor(c_acctbal)) AS BIGINT) AS len, row_number() OVER (PARTITION BY c_nationkey ORDER BY abs(floor(c_acctbal)) DESC, c_custkey) AS k FROM customer),
w AS (SELECT g, k, id, len AS filled, 0::BIGINT AS piece FROM r WHERE k = 1
  UNION ALL SELECT r.g, r.k, r.id, CASE WHEN w.filled >= 12000 THEN r.len ELSE w.filled + r.len END, CASE WHEN w.filled >= 12000 THEN w.piece + 1 ELSE w.piece END FROM w JOIN r ON r.g = w.g AND r.k = w.k + 1)
SELECT id AS c_custkey, piece FROM w"""


def score_geometric(spark, d):
    rows = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("len"))
    score = statistics.model_score(F.col("len"), F.col("n"), 0.3, F.when(F.col("n") % 2 == 0, 0.5).otherwise(0.0))
    return rows.select("l_orderkey", (F.floor(score * 1e4 + 0.5) / 1e4).alias("score"))


#: Each further intron adds 0.7 of what the one before added.
SCORE_GEOMETRIC = """WITH r AS (SELECT l_orderkey, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS len FROM lineitem GROUP BY l_orderkey)
SELECT l_orderkey, floor((len * (1 + COALESCE(list_sum(list_transform(range(0, n - 1), lambda k: 0.3::DOUBLE * pow(0.7::DOUBLE, k))), 0) + CASE WHEN n % 2 = 0 THEN 0.5 ELSE 0 END)) * 1e4 + 0.5) / 1e4 AS score FROM r"""


def transcript_score_table(spark, d):
    """Orders as genes, suppliers as transcripts, the return flag as the state of their ends."""
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("gene_id"), F.concat_ws(":", "l_orderkey", "l_suppkey").alias("transcript_id"), F.lit(1).cast("long").alias("start"), F.col("l_quantity").cast("long").alias("end"), (F.col("l_orderkey") % 3).alias("file_ord"), "l_returnflag")
    ends = F.create_map(F.lit("A"), F.lit("complete"), F.lit("N"), F.lit("5prime_partial"), F.lit("R"), F.lit("internal"))
    integrity = rows.groupBy("transcript_id").agg(F.max("l_returnflag").alias("f")).select("transcript_id", F.try_element_at(ends, F.col("f")).alias("integrity"))
    return pipelines.transcript_scores(rows, integrity).select("transcript_id", (F.floor(F.col("score") * 1e4 + 0.5) / 1e4).alias("score"))


TRANSCRIPT_SCORE_TABLE = """WITH r AS (SELECT l_orderkey AS g, l_suppkey AS t, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS len, max(l_returnflag) AS f FROM lineitem GROUP BY ALL)
SELECT g || ':' || t AS transcript_id, floor((len + len * COALESCE(list_sum(list_transform(range(0, n - 1), lambda k: 0.3::DOUBLE * pow(0.7::DOUBLE, k))), 0) + CASE f WHEN 'A' THEN len * 1.0 WHEN 'N' THEN len * 0.5 ELSE 0 END + CASE WHEN g % 3 = 1 THEN len * 0.5 ELSE 0 END) * 1e4 + 0.5) / 1e4 AS score FROM r"""


def validated_genes(spark, d):
    rows = read(spark, d, "lineitem")
    name = F.concat_ws(":", "l_orderkey", "l_linenumber")
    transcripts = rows.select(name.alias("transcript_id"), F.col("l_orderkey").alias("gene_id")).distinct()
    evalue = F.pow(F.lit(10.0), -F.col("l_quantity"))
    domains = rows.filter("l_discount >= 0.04").select(name.alias("query"), evalue.alias("evalue"), (F.col("l_discount") * 10).alias("coverage"))
    hits = rows.filter("l_tax >= 0.06").select(name.alias("query"), evalue.alias("evalue"), (F.col("l_tax") * 10).alias("identity"), F.lit(0.7).alias("coverage"), (F.col("l_quantity") / 50).alias("s_coverage"))
    return pipelines.validated(transcripts, domains, hits)


#: Found in both tables, or strictly in the one it is in.
VALIDATED_GENES = """WITH a AS (SELECT l_orderkey AS g, l_linenumber AS k, l_quantity >= 7 AND l_discount * 10 >= 0.5 AS strict FROM lineitem WHERE l_discount >= 0.04),
b AS (SELECT l_orderkey AS g, l_linenumber AS k, l_quantity >= 12 AND l_tax * 10 >= 0.6 AND l_quantity / 50 >= 0.6 AS strict FROM lineitem WHERE l_tax >= 0.06)
SELECT DISTINCT g AS gene_id FROM (SELECT g FROM a WHERE strict OR EXISTS (SELECT 1 FROM b WHERE b.g = a.g AND b.k = a.k) UNION ALL SELECT g FROM b WHERE strict)"""


def reason_rows(spark, d):
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("gene_id"), F.concat_ws(":", "l_orderkey", "l_linenumber", "l_partkey").alias("transcript_id"), (F.col("l_quantity") * 30).cast("long").alias("cds_len"), F.lit(2000).cast("long").alias("exon_len"), (F.col("l_discount") * 5).alias("repeat_share"))
    return evidence.filter_reasons(rows)


REASON_ROWS = """WITH r AS (SELECT l_orderkey AS gene_id, l_orderkey || ':' || l_linenumber || ':' || l_partkey AS transcript_id, CAST(l_quantity * 30 AS BIGINT) AS n, l_discount * 5 AS rep FROM lineitem),
bad AS (SELECT gene_id FROM r GROUP BY gene_id HAVING count(*) = count(*) FILTER (n / 2000 < 0.3 OR n < 600 OR rep >= 0.3))
SELECT gene_id, transcript_id, 'ratio' AS reason FROM r WHERE n / 2000 < 0.3 UNION ALL SELECT gene_id, transcript_id, 'short' FROM r WHERE n < 600 AND gene_id IN (FROM bad) UNION ALL SELECT gene_id, transcript_id, 'repeat' FROM r WHERE rep >= 0.3 AND gene_id IN (FROM bad)"""


def _models(spark, d):
    rows = read(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("gene_id")).agg(F.sum("l_quantity").cast("long").alias("cds_len"), F.count("*").alias("cds_num"), F.max("l_returnflag").alias("f"), F.max("l_linestatus").alias("s"), F.max("l_discount").alias("x"))
    return rows


_MODELS_SQL = "SELECT l_orderkey AS gene_id, CAST(sum(l_quantity) AS BIGINT) AS len, count(*) AS num, max(l_returnflag) AS f, max(l_linestatus) AS s, max(l_discount) AS x FROM lineitem GROUP BY l_orderkey"


def reliable_classes(spark, d):
    rows = _models(spark, d).select("gene_id", "cds_num", "cds_len", (F.col("f") == "R").alias("keyword"), (F.col("s") == "O").alias("augustus"), (F.col("x") * 1000).alias("exon_hint_ratio"))
    return pipelines.reliable(rows).select("gene_id", "verdict")


#: Thresholds come from models with the keyword only; each test is asked in turn.
RELIABLE_CLASSES = f"""WITH m AS ({_MODELS_SQL}), k AS (SELECT list_sort(list(num))[CAST(floor(count(*) * 0.5) AS INTEGER) + 1] AS num, list_sort(list(len))[CAST(floor(count(*) * 0.5) AS INTEGER) + 1] AS len FROM m WHERE f = 'R')
SELECT gene_id, CASE WHEN f = 'R' THEN 'keyword' WHEN s = 'O' AND x * 1000 < 40 THEN 'augustus' WHEN m.len < k.len THEN 'length' WHEN m.num < k.num THEN 'number' ELSE 'other' END AS verdict FROM m, k"""


def hint_classes(spark, d):
    rows = _models(spark, d).select("gene_id", "cds_num", "cds_len", (F.col("f") == "R").alias("excellent"), (F.col("x") >= 0.1).alias("filled"), F.when(F.col("s") == "O", "complete").otherwise("internal").alias("integrity"))
    return pipelines.hint_sources(rows).select("gene_id", "src")


HINT_CLASSES = f"""WITH m AS (SELECT *, (f = 'R' AND s = 'O') OR x >= 0.1 AS sure FROM ({_MODELS_SQL})), k AS (SELECT list_sort(list(num))[CAST(floor(count(*) * 0.333) AS INTEGER) + 1] AS num, list_sort(list(len))[CAST(floor(count(*) * 0.333) AS INTEGER) + 1] AS len FROM m WHERE sure)
SELECT gene_id, CASE WHEN sure THEN 'M' WHEN m.len >= k.len AND m.num >= k.num THEN 'E' ELSE 'P' END AS src FROM m, k"""


def supported_models(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.col("l_discount") * 200).alias("transcript_percent"), F.floor(F.col("l_quantity") / 20).cast("long").alias("n_introns"), F.col("l_tax").alias("intron_ratio"))
    both = [pipelines.supported(rows, strict).withColumn("strict", F.lit(strict)) for strict in (False, True)]
    return both[0].unionByName(both[1]).groupBy("strict", "l_orderkey").agg(F.count("*").alias("n"))


SUPPORTED_MODELS = """WITH r AS (SELECT l_orderkey, l_discount * 200 >= 10 AS a, floor(l_quantity / 20) >= 1 AND l_tax >= 0.01 AS b FROM lineitem)
SELECT false AS strict, l_orderkey, count(*) AS n FROM r WHERE a OR b GROUP BY l_orderkey UNION ALL SELECT true, l_orderkey, count(*) FROM r WHERE a AND b GROUP BY l_orderkey"""


def better_genes(spark, d):
    """Orders as evidence genes, runs of lines of one part and supplier as reference genes."""
    own = order_spans(spark, d, 25).select(F.col("part").alias("seqid"), F.lit("+").alias("strand"), F.col("id").alias("gene_id"), "start", "end", (F.col("id") % 2 == 0).alias("complete"))
    other = items(spark, d).select(F.col("part").alias("seqid"), F.lit("+").alias("strand"), F.concat_ws(":", "part", "supplier").alias("gene_id"), "start", "end")
    return pipelines.better_evidence(own.withColumn("gene_id", F.col("gene_id").cast("string")), other, 0.2, (2, 1.5, 0.85, 0.85))


BETTER_GENES = f"""WITH g AS (SELECT part, CAST(id AS VARCHAR) AS id, s, e, id % 2 = 0 AS whole FROM ({ORDERS_SQL.format(25)})), f AS (SELECT part, part || ':' || supplier AS id, s, e FROM ({ITEMS_SQL})),
rl AS (SELECT id, {UNION_SQL} AS len FROM (SELECT *, {BEFORE_SQL.format('id')} AS before FROM f) GROUP BY id), rs AS (SELECT id, max(e) - min(s) + 1 AS span FROM f GROUP BY id),
c AS (SELECT g.id, f.id AS rid, greatest(g.s, f.s) AS s, least(g.e, f.e) AS e FROM g JOIN f ON g.part = f.part AND g.s < f.e AND f.s < g.e),
m AS (SELECT id, rid, {UNION_SQL} AS met FROM (SELECT *, {BEFORE_SQL.format('id, rid')} AS before FROM c) GROUP BY id, rid),
p AS (SELECT g.id, met / (g.e - g.s + 1) AS ratio, g.e - g.s + 1 AS len, rl.len AS rlen, rs.span AS rspan, whole FROM m JOIN g ON g.id = m.id JOIN rl ON rl.id = rid JOIN rs ON rs.id = rid),
d AS (SELECT g.id, COALESCE(max(ratio), 0) AS ratio, bool_or(ratio >= 0.2 AND (p.len > rspan * 2 OR p.len > rlen * 1.5)) AS larger, bool_or(ratio >= 0.2 AND p.whole AND (p.len > rspan * 0.85 OR p.len > rlen * 0.85)) AS longer FROM g LEFT JOIN p ON p.id = g.id GROUP BY g.id)
SELECT id AS gene_id, why FROM (SELECT id, CASE WHEN ratio = 0 THEN 'alone' WHEN ratio < 0.2 THEN 'little' WHEN larger THEN 'larger' WHEN longer THEN 'complete' END AS why FROM d) WHERE why IS NOT NULL"""


def flank_lengths(spark, d):
    rows = items(spark, d).select(F.col("supplier").alias("seqid"), F.col("part").alias("strand"), "start", "end")
    return evidence.intergenic_flank(rows, 5)


FLANK_LENGTHS = f"""WITH g AS (SELECT DISTINCT supplier, part, s, e FROM ({ITEMS_SQL})), w AS (SELECT s - max(e) OVER (PARTITION BY supplier, part ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS gap FROM g),
a AS (SELECT list_sort(list(e - s + 1))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS gene FROM g), b AS (SELECT COALESCE(list_sort(list(gap))[CAST(floor(count(*) / 2) AS INTEGER) + 1], 0) AS gap FROM w WHERE gap >= 5)
SELECT CAST(least(gene, floor(gap / 8)) AS BIGINT) AS flank FROM a, b"""


def sure_models(spark, d):
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("gene_id"), F.concat_ws(":", "l_orderkey", "l_linenumber").alias("transcript_id"), F.when(F.col("l_returnflag") == "N", "complete").otherwise("internal").alias("integrity"), (F.col("l_quantity") * 4).alias("support"), F.when(F.col("l_discount") > 0.01, F.col("l_discount") - 0.02).alias("transcript_ratio"))
    return evidence.surely_right(rows).select("gene_id", "transcript_id")


SURE_MODELS = """WITH r AS (SELECT l_orderkey AS gene_id, l_orderkey || ':' || l_linenumber AS transcript_id, CASE WHEN l_discount > 0.01 THEN l_discount - 0.02 END AS ratio FROM lineitem WHERE l_returnflag = 'N' AND l_quantity * 4 >= 100)
SELECT gene_id, transcript_id FROM (FROM r WHERE ratio IS NOT NULL QUALIFY row_number() OVER (PARTITION BY gene_id ORDER BY ratio DESC, transcript_id) = 1) WHERE ratio > 0"""


def homolog_classes(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("covered"), F.lit(50.0).alias("homolog_len"), F.when(F.col("l_tax") > 0.04, 1).otherwise(0).alias("inner_stops"))
    return pipelines.prediction_classes(rows).groupBy("l_orderkey", "class").agg(F.count("*").alias("n"))


HOMOLOG_CLASSES = """SELECT l_orderkey, CASE WHEN l_quantity = 50 AND l_tax <= 0.04 THEN 'A' WHEN l_quantity / 50 >= 0.8 THEN 'B' WHEN l_quantity / 50 >= 0.4 THEN 'C' ELSE 'D' END AS class, count(*) AS n FROM lineitem GROUP BY ALL"""


def domain_coverage(spark, d):
    a = F.col("l_linenumber").cast("long") * 8
    rows = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("query"), (F.col("l_suppkey") % 3).alias("target"), F.when(F.col("l_suppkey") % 3 == 0, 60).otherwise(100).cast("long").alias("tlen"), F.pow(F.lit(10.0), -(F.col("l_orderkey") % 8)).alias("evalue"), F.lit(1.0).alias("score"), a.alias("hmm_from"), (a + F.col("l_quantity").cast("long")).alias("hmm_to"), F.lit("x").alias("description"))
    return pipelines.domain_hits(rows).select("query", "target", "covered")


DOMAIN_COVERAGE = f"""WITH h AS (SELECT l_orderkey AS q, l_suppkey % 3 AS t, l_linenumber * 8 AS s, l_linenumber * 8 + CAST(l_quantity AS BIGINT) AS e FROM lineitem),
c AS (SELECT q, t, {UNION_SQL} AS covered FROM (SELECT *, {BEFORE_SQL.format('q, t')} AS before FROM h) GROUP BY q, t)
SELECT q AS query, t AS target, covered FROM c WHERE CASE WHEN t = 0 THEN covered / 60 >= 0.25 AND q % 8 >= 3 ELSE covered / 100 >= 0.25 AND q % 8 >= 5 END"""

_LETTERS, _BASES = "ABCDEFGHIJKLMNOPQRSTUVWXYZ ", "ACGTACGTACGTACGTACGTACGTACA"


def coding_likelihoods(spark, d):
    """The model of all part names as coding sequences, and their scores in six frames."""
    rows = read(spark, d, "part").select("p_partkey", F.translate(F.upper(F.coalesce("p_name", F.lit(""))), _LETTERS, _BASES).alias("seq"))
    base = spark.createDataFrame([(b, 0.25) for b in "ACGT"], "base string, p double")
    found = statistics.coding_scores(rows, "p_partkey", "seq", statistics.coding_model(rows, "seq", base))
    return found.select("p_partkey", *[(F.floor(F.col(f"score_{k}") * 1e4 + 0.5) / 1e4).alias(f"score_{k}") for k in range(1, 7)])


_STOP_SQL = "(CASE WHEN length(s) % 3 = 0 AND right(s, 3) IN ('TAA', 'TAG', 'TGA') THEN length(s) - 3 ELSE length(s) END)"
CODING_LIKELIHOODS = f"""WITH q AS (SELECT p_partkey AS id, translate(upper(COALESCE(p_name, '')), '{_LETTERS}', '{_BASES}') AS s FROM part),
i AS (SELECT s, m, unnest(range(m, CASE WHEN length(s) - 3 >= m THEN {_STOP_SQL} ELSE length(s) END)) AS i FROM q, (SELECT unnest(range(0, 6)) AS m)),
n AS (SELECT substr(s, i - m + 1, m + 1) AS kmer, i % 3 AS frame, count(*) AS n FROM i GROUP BY ALL), f AS (SELECT i % 3 AS frame, count(*) AS n FROM i WHERE m = 0 GROUP BY ALL),
model AS (SELECT n.kmer, n.frame, ln((n.n + 1)::DOUBLE / (COALESCE(CASE WHEN length(n.kmer) = 1 THEN f.n ELSE b.n END, 0) + 4) / 0.25) AS ll FROM n LEFT JOIN n b ON b.kmer = left(n.kmer, length(n.kmer) - 1) AND b.frame = (n.frame + 2) % 3 LEFT JOIN f ON f.frame = (n.frame + 2) % 3 WHERE NOT regexp_matches(n.kmer, '[^ACGT]')),
v AS (SELECT id, k, substr(x, k - CASE WHEN k > 3 THEN 3 ELSE 0 END) AS s FROM (SELECT id, k, CASE WHEN k > 3 THEN reverse(translate(s, 'ATCG', 'TAGC')) ELSE s END AS x FROM q, (SELECT unnest(range(1, 7)) AS k))),
w AS (SELECT id, k, s, unnest(range(0, {_STOP_SQL})) AS i FROM v WHERE length(s) >= 6),
t AS (SELECT id, k, sum(ll) AS x FROM w JOIN model ON kmer = substr(s, i - least(i, 5) + 1, least(i, 5) + 1) AND frame = i % 3 GROUP BY id, k)
SELECT id AS p_partkey, {', '.join(f'floor(COALESCE(max(x) FILTER (k = {k}), 0) * 1e4 + 0.5) / 1e4 AS score_{k}' for k in range(1, 7))} FROM q LEFT JOIN t USING (id) GROUP BY id"""

NAMES = [
    "contig_pieces", "score_geometric", "transcript_score_table", "validated_genes", "reason_rows", "reliable_classes", "hint_classes", "supported_models", "better_genes", "flank_lengths", "sure_models", "homolog_classes", "domain_coverage", "coding_likelihoods",
]
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
