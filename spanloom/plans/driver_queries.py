"""Each operator on tables of an isomorphic shape, with the same result in SQL.

Features are line items: the part is the sequence, the day of shipping the start, the quantity the length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions.genetic_code import stops, table
from ..operators import graph, intervals, order, statistics

DAY = "CAST(date_diff('day', DATE '1970-01-01', CAST({} AS DATE)) AS BIGINT)"
ITEMS_SQL = f"SELECT l_partkey AS part, l_orderkey * 10 + l_linenumber AS id, {DAY.format('l_shipdate')} AS s, {DAY.format('l_shipdate')} + CAST(l_quantity AS BIGINT) AS e, l_suppkey AS supplier FROM lineitem"
ORDERS_SQL = f"SELECT o_custkey AS part, o_orderkey AS id, {DAY.format('o_orderdate')} AS s, {DAY.format('o_orderdate')} + {{}} AS e, o_totalprice AS price FROM orders"
UNION_SQL = "sum(greatest(0, e - greatest(s - 1, COALESCE(before, s - 1))))::BIGINT"
BEFORE_SQL = "max(e) OVER (PARTITION BY {} ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
DNA_SQL = "regexp_replace(translate(lower(COALESCE(text, '')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', '', 'g')"


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def day(c: str):
    return F.unix_date(F.col(c).cast("date")).cast("long")


def items(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem")
    return rows.select(F.col("l_partkey").alias("part"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), day("l_shipdate").alias("start"), (day("l_shipdate") + F.col("l_quantity").cast("long")).alias("end"), F.col("l_suppkey").alias("supplier"))


def order_spans(spark: SparkSession, d: str, days: int) -> DataFrame:
    return read(spark, d, "orders").select(F.col("o_custkey").alias("part"), F.col("o_orderkey").alias("id"), day("o_orderdate").alias("start"), (day("o_orderdate") + days).alias("end"), F.col("o_totalprice").alias("price"))


def dna(spark: SparkSession, d: str) -> DataFrame:
    text = F.translate(F.lower(F.coalesce("text", F.lit(""))), "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")
    return read(spark, d, "documents").select("doc_id", F.regexp_replace(text, "[^ACGT]", "").alias("seq"))


def interval_union_coverage(spark, d):
    rows = items(spark, d)
    isles = intervals.islands(rows, ["part"], order=["id"]).groupBy("part").agg(F.count("*").alias("n"), F.max("island").alias("islands"))
    return isles.join(intervals.union_length(rows, ["part"]), "part")


INTERVAL_UNION_COVERAGE = f"""WITH f AS ({ITEMS_SQL}), w AS (SELECT *, {BEFORE_SQL.format('part')} AS before FROM f)
SELECT part, count(*) AS n, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END)::BIGINT AS islands, {UNION_SQL} AS covered FROM w GROUP BY part"""


def interval_union_binned(spark, d):
    """The union over everything shipped by a supplier, cut at bins: the same length, without a task for each supplier."""
    return intervals.union_length(items(spark, d), ["supplier"], bin_width=64)


INTERVAL_UNION_BINNED = f"""WITH f AS ({ITEMS_SQL}), w AS (SELECT *, {BEFORE_SQL.format('supplier')} AS before FROM f) SELECT supplier, {UNION_SQL} AS covered FROM w GROUP BY supplier"""


def _visits(spark, d, *keys):
    rows = read(spark, d, "events")
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("long")
    return rows.select(*keys, start.alias("start"), (start + F.floor(F.coalesce(F.col("value"), F.lit(0.0))).cast("long")).alias("end"), *[c for c in ("user_id",) if c not in keys])


VISITS_SQL = "SELECT user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS s, CAST(floor(epoch(ts)) AS BIGINT) + CAST(floor(COALESCE(value, 0)) AS BIGINT) AS e FROM events"


def interval_islands(spark, d):
    return intervals.island_spans(_visits(spark, d, "user_id"), ["user_id"], slack=3600)


INTERVAL_ISLANDS = f"""WITH f AS ({VISITS_SQL}), w AS (SELECT *, {BEFORE_SQL.format('user_id')} AS before FROM f),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR s - before > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS island FROM w)
SELECT user_id, island, min(s) AS start, max(e) AS "end", count(*) AS n FROM g GROUP BY ALL"""


def overlap_pairs_binned(spark, d):
    pairs = intervals.self_overlaps(items(spark, d), ["part"], "id", width=64)
    return pairs.select("part", "id", F.col("id_r").alias("other"), intervals.nucleotides_in_common(*[F.col(c) for c in ("start", "end", "start_r", "end_r")]).alias("overlap"))


OVERLAP_PAIRS_BINNED = f"""WITH f AS ({ITEMS_SQL}) SELECT a.part, a.id, b.id AS other, least(a.e, b.e) - greatest(a.s, b.s) + 1 AS overlap
FROM f a JOIN f b ON a.part = b.part AND a.id < b.id AND a.s <= b.e AND b.s <= a.e"""


def overlap_fraction_filter(spark, d):
    found = intervals.coverage(order_spans(spark, d, 30), items(spark, d), ["part"], ["id"], width=64)
    return found.filter(F.col("covered") >= 0.6 * F.col("length")).select("id", "length", "covered")


OVERLAP_FRACTION_FILTER = f"""WITH g AS ({ORDERS_SQL.format(30)}), f AS ({ITEMS_SQL}),
c AS (SELECT g.id, greatest(g.s, f.s) AS s, least(g.e, f.e) AS e FROM g JOIN f ON g.part = f.part AND g.s <= f.e AND f.s <= g.e),
w AS (SELECT *, {BEFORE_SQL.format('id')} AS before FROM c)
SELECT id, CAST(31 AS BIGINT) AS length, {UNION_SQL} AS covered FROM w GROUP BY id HAVING {UNION_SQL} >= 0.6 * 31"""


def contained_intervals(spark, d):
    return intervals.contained_join(order_spans(spark, d, 90), items(spark, d), ["part"], width=64).select("id", F.col("id_r").alias("inner_id"))


CONTAINED_INTERVALS = f"WITH g AS ({ORDERS_SQL.format(90)}), f AS ({ITEMS_SQL}) SELECT g.id, f.id AS inner_id FROM g JOIN f ON g.part = f.part AND f.s > g.s AND f.e < g.e"


def evidence_common_specific(spark, d):
    rows = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("y"))
    a, b = rows.filter("y = 1996").select("l_partkey", "l_suppkey").distinct(), rows.filter("y = 1997").select("l_partkey", "l_suppkey").distinct()
    both = a.join(b, ["l_partkey", "l_suppkey"], "left_semi").withColumn("found_in", F.lit("common"))
    only = lambda x, y, name: x.join(y, ["l_partkey", "l_suppkey"], "left_anti").withColumn("found_in", F.lit(name))
    return both.unionByName(only(a, b, "reference")).unionByName(only(b, a, "evidence"))


EVIDENCE_COMMON_SPECIFIC = """WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) = 1996), b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) = 1997)
SELECT *, 'common' AS found_in FROM (FROM a INTERSECT FROM b) UNION ALL SELECT *, 'reference' FROM (FROM a EXCEPT FROM b) UNION ALL SELECT *, 'evidence' FROM (FROM b EXCEPT FROM a)"""


def neighbor_overlap(spark, d):
    return order.neighbour_overlaps(items(spark, d), ["part"], ["id"]).select("part", "id", "id_before", "overlap")


NEIGHBOR_OVERLAP = f"""WITH f AS ({ITEMS_SQL}), w AS (SELECT *, lag(s) OVER o AS ps, lag(e) OVER o AS pe, lag(id) OVER o AS id_before FROM f WINDOW o AS (PARTITION BY part ORDER BY s, e, id))
SELECT part, id, id_before, least(e, pe) - greatest(s, ps) + 1 AS overlap FROM w WHERE least(e, pe) - greatest(s, ps) + 1 > 0 AND least(e, pe) - greatest(s, ps) + 1 >= 0.1 * (least(e - s, pe - ps) + 1)"""


def gap_to_previous(spark, d):
    return intervals.gaps(order_spans(spark, d, 10), ["part"], ["id"]).select("part", "id", "gap")


GAP_TO_PREVIOUS = f"WITH g AS ({ORDERS_SQL.format(10)}) SELECT part, id, s - max(e) OVER (PARTITION BY part ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1 AS gap FROM g"


def phase_running_sum(spark, d):
    rows = read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.col("l_quantity").cast("long").alias("len"))
    by = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "len")]
    return order.phases(rows, ["l_orderkey"], by, "len").select("l_orderkey", "l_linenumber", "l_partkey", "len", "phase")


PHASE_RUNNING_SUM = """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS BIGINT) AS len,
CAST((3 - COALESCE(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) % 3) % 3 AS INTEGER) AS phase FROM lineitem"""


def best_per_group(spark, d):
    rows = read(spark, d, "lineitem")
    rank = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3)
    best = order.best_isoform(rows, ["l_orderkey"], "l_extendedprice", [rank, F.desc("l_discount"), F.desc("l_extendedprice"), F.col("l_linenumber")])
    return best.select("l_orderkey", "l_linenumber", "l_returnflag")


BEST_PER_GROUP = """WITH m AS (SELECT *, max(l_extendedprice) OVER (PARTITION BY l_orderkey) AS best FROM lineitem)
SELECT l_orderkey, l_linenumber, l_returnflag FROM m WHERE l_extendedprice >= best * 0.8
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, l_discount DESC, l_extendedprice DESC, l_linenumber) = 1"""


def cap_per_species(spark, d):
    rows = read(spark, d, "customer").join(read(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return order.capped(rows, ["n_nationkey"], ["n_regionkey"], [F.desc("c_acctbal"), F.col("c_custkey")], 2, 5).select("n_regionkey", "n_nationkey", "c_custkey")


CAP_PER_SPECIES = """WITH a AS (SELECT n_regionkey, n_nationkey, c_custkey, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey QUALIFY row_number() OVER (PARTITION BY n_regionkey, n_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 2)
SELECT n_regionkey, n_nationkey, c_custkey FROM a QUALIFY row_number() OVER (PARTITION BY n_regionkey ORDER BY c_acctbal DESC, c_custkey) <= 5"""


def top_score_band(spark, d):
    return order.band(read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_totalprice", 0.9)


TOP_SCORE_BAND = "SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY o_totalprice >= max(o_totalprice) OVER (PARTITION BY o_custkey) * 0.9"


def upper_median_stats(spark, d):
    rows = read(spark, d, "lineitem")
    n = rows.groupBy("l_partkey").agg(F.count("l_extendedprice").alias("n"), F.max("l_extendedprice").alias("most"))
    return n.join(order.upper_median(rows, ["l_partkey"], "l_extendedprice"), "l_partkey").select("l_partkey", "n", "most", F.col("median").alias("upper_median"))


UPPER_MEDIAN_STATS = "SELECT l_partkey, count(*) AS n, max(l_extendedprice) AS most, list_sort(list(l_extendedprice))[CAST(floor(count(*) / 2) AS INTEGER) + 1] AS upper_median FROM lineitem GROUP BY l_partkey"


def quantile_threshold_gate(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return order.by_percentile(order.by_percentile(rows, "o_totalprice", 0.95), "o_totalprice", 0.05, keep_below=False)


QUANTILE_THRESHOLD_GATE = """WITH a AS (SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= (SELECT list_sort(list(o_totalprice))[CAST(floor(count(*) * 0.95) AS INTEGER) + 1] FROM orders))
SELECT * FROM a WHERE o_totalprice >= (SELECT list_sort(list(o_totalprice))[CAST(floor(count(*) * 0.05) AS INTEGER) + 1] FROM a)"""


def class_rollup_union(spark, d):
    part = read(spark, d, "part").select(F.col("p_partkey").alias("part"), F.col("p_type").alias("type"), F.col("p_brand").alias("brand"))
    return statistics.rollup_union(items(spark, d).join(part, "part"), ["type", "brand"], ["supplier"], 256).select("level", "type", "brand", "n", "covered")


CLASS_ROLLUP_UNION = f"""WITH f AS (SELECT i.*, p_type AS type, p_brand AS brand FROM ({ITEMS_SQL}) i JOIN part ON part.p_partkey = i.part),
x AS (SELECT 0 AS level, NULL AS type, NULL AS brand, supplier, s, e FROM f UNION ALL SELECT 1, type, NULL, supplier, s, e FROM f UNION ALL SELECT 2, type, brand, supplier, s, e FROM f),
w AS (SELECT *, {BEFORE_SQL.format('level, type, brand, supplier')} AS before FROM x)
SELECT level, type, brand, count(*) AS n, {UNION_SQL} AS covered FROM w GROUP BY level, type, brand"""


def semi_anti_router(spark, d):
    a = read(spark, d, "documents").select("doc_id", (F.col("n_chars") >= 300).alias("long"))
    b = read(spark, d, "labels").select("doc_id", "quality", "toxic")
    route = F.when(F.col("quality").isNull(), F.when(F.col("long"), "unlabelled").otherwise("short")).when((F.col("quality") == 1) & (F.col("toxic") == 0), "accepted").when(F.col("toxic") == 1, "toxic").otherwise("low")
    return a.join(b, "doc_id", "full_outer").select("doc_id", route.alias("route"))


SEMI_ANTI_ROUTER = """SELECT doc_id, CASE WHEN quality IS NULL THEN CASE WHEN n_chars >= 300 THEN 'unlabelled' ELSE 'short' END WHEN quality = 1 AND toxic = 0 THEN 'accepted' WHEN toxic = 1 THEN 'toxic' ELSE 'low' END AS route
FROM documents FULL JOIN labels USING (doc_id)"""


def forall_fail_filter(spark, d):
    return order.all_fail(read(spark, d, "lineitem"), ["l_orderkey"], F.col("l_discount") < 0.05)


FORALL_FAIL_FILTER = "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING bool_and(l_discount < 0.05)"


def distinct_fragments(spark, d):
    rows = intervals.islands(_visits(spark, d, "event_type"), ["event_type"], slack=30)
    return rows.groupBy("event_type", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count_distinct("user_id").alias("n_users"))


DISTINCT_FRAGMENTS = f"""WITH f AS ({VISITS_SQL}), w AS (SELECT *, {BEFORE_SQL.format('event_type')} AS before FROM f),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR s - before > 30 THEN 1 ELSE 0 END) OVER (PARTITION BY event_type ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS island FROM w)
SELECT event_type, island, min(s) AS start, max(e) AS "end", count(DISTINCT user_id) AS n_users FROM g GROUP BY event_type, island"""


def _labelled(spark, d):
    return read(spark, d, "labels").join(read(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")


def _rounded(*names):
    return [F.floor(F.col(c) * 1e4 + 0.5) / 1e4 for c in names]


def sensitivity_specificity(spark, d):
    rows = statistics.sensitivity_specificity(_labelled(spark, d), F.col("quality") == 1, F.col("n_chars") >= 500)
    a, b = _rounded("sensitivity", "specificity")
    return rows.select("tp", "fp", "fn", "tn", a.alias("sensitivity"), b.alias("specificity"))


SENSITIVITY_SPECIFICITY = """WITH c AS (SELECT count(*) FILTER (quality = 1 AND n_chars >= 500) AS tp, count(*) FILTER (quality <> 1 AND n_chars >= 500) AS fp, count(*) FILTER (quality = 1 AND n_chars < 500) AS fn, count(*) FILTER (quality <> 1 AND n_chars < 500) AS tn FROM labels JOIN documents USING (doc_id))
SELECT tp, fp, fn, tn, floor(tp / (tp + fn) * 1e4 + 0.5) / 1e4 AS sensitivity, floor(tp / (tp + fp) * 1e4 + 0.5) / 1e4 AS specificity FROM c"""

THRESHOLDS = (0, 100, 250, 500, 1000, 2000, 4000, 8000, 16000, 32000)


def roc_table(spark, d):
    rows = statistics.roc(_labelled(spark, d), "n_chars", F.col("quality") == 1, THRESHOLDS)
    return rows.select("threshold", "tp", "fp", "tn", "fn", *[c.alias(n) for c, n in zip(_rounded("tpr", "fpr", "f1"), ("tpr", "fpr", "f1"), strict=True)])


_ROC_SQL = f"""SELECT CAST(t AS DOUBLE) AS threshold, count(*) FILTER (quality = 1 AND n_chars >= t) AS tp, count(*) FILTER (quality <> 1 AND n_chars >= t) AS fp, count(*) FILTER (quality <> 1 AND n_chars < t) AS tn, count(*) FILTER (quality = 1 AND n_chars < t) AS fn
FROM labels JOIN documents USING (doc_id), (SELECT unnest([{', '.join(map(str, THRESHOLDS))}]) AS t) GROUP BY t"""
ROC_TABLE = f"""SELECT threshold, tp, fp, tn, fn, floor(tp / (tp + fn) * 1e4 + 0.5) / 1e4 AS tpr, floor(fp / (fp + tn) * 1e4 + 0.5) / 1e4 AS fpr, floor(2 * tp / (2 * tp + fp + fn) * 1e4 + 0.5) / 1e4 AS f1 FROM ({_ROC_SQL})"""


def auc_trapezoid(spark, d):
    return statistics.auc(statistics.roc(_labelled(spark, d), "n_chars", F.col("quality") == 1, THRESHOLDS)).select(_rounded("auc")[0].alias("auc"))


AUC_TRAPEZOID = f"""WITH p AS (SELECT DISTINCT fp / (fp + tn) AS x, tp / (tp + fn) AS y FROM ({_ROC_SQL}) UNION SELECT 0.0::DOUBLE, 0.0::DOUBLE UNION SELECT 1.0::DOUBLE, 1.0::DOUBLE),
a AS (SELECT (x - lag(x) OVER (ORDER BY x, y)) * (y + lag(y) OVER (ORDER BY x, y)) / 2 AS part FROM p) SELECT floor(sum(part) * 1e4 + 0.5) / 1e4 AS auc FROM a"""


def revcomp_text(spark, d):
    return dna(spark, d).select("doc_id", F.md5(S.revcomp(F.col("seq"))).alias("md5"))


REVCOMP_TEXT = f"SELECT doc_id, md5(reverse(translate({DNA_SQL}, 'ATCG', 'TAGC'))) AS md5 FROM documents"


def codon_translate(spark, d):
    rows = dna(spark, d)
    return rows.select("doc_id", F.md5(S.translate(F.col("seq"), starts=("ATG",))).alias("md5"), S.internal_stops(F.col("seq")).cast("long").alias("n_stops"))


_MAP = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in sorted(table(1).items())) + "}"
CODON_TRANSLATE = f"""WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents), c AS (SELECT doc_id, seq, regexp_extract_all(seq, '...') AS cs FROM q),
p AS (SELECT doc_id, seq, cs, array_to_string(list_transform(cs, lambda x: {_MAP}[x]), '') AS p FROM c)
SELECT doc_id, md5(CASE WHEN seq[1:3] = 'ATG' THEN 'M' || p[2:] ELSE p END) AS md5, CAST(len(list_filter(cs[1:-2], lambda x: x IN ('{"', '".join(stops(1))}'))) AS BIGINT) AS n_stops FROM p"""


def integrity_class(spark, d):
    return dna(spark, d).select("doc_id", S.integrity(F.col("seq")).alias("integrity"))


INTEGRITY_CLASS = f"""WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents), f AS (SELECT doc_id, left(seq, 3) = 'ATG' AS a, right(seq, 3) IN ('TAA', 'TAG', 'TGA') AS b FROM q)
SELECT doc_id, CASE WHEN a AND b THEN 'complete' WHEN b THEN '5prime_partial' WHEN a THEN '3prime_partial' ELSE 'internal' END AS integrity FROM f"""


def base_frequency(spark, d):
    counts = S.base_counts(F.col("seq"))
    n = dna(spark, d).agg(*[F.sum(counts[b]).cast("long").alias(b) for b in "ACGT"])
    rows = n.select(F.explode(F.array(*[F.struct(F.lit(b).alias("base"), F.col(b).alias("n")) for b in "ACGT"])).alias("r")).select("r.*")
    return statistics.shares(rows, [], "n").select("base", "n", _rounded("p")[0].alias("p"))


BASE_FREQUENCY = f"""WITH q AS (SELECT {DNA_SQL} AS seq FROM documents), c AS (SELECT sum(length(seq) - length(replace(seq, 'A', ''))) AS a, sum(length(seq) - length(replace(seq, 'C', ''))) AS c, sum(length(seq) - length(replace(seq, 'G', ''))) AS g, sum(length(seq) - length(replace(seq, 'T', ''))) AS t FROM q),
r AS (SELECT 'A' AS base, (a + t)::BIGINT AS n FROM c UNION ALL SELECT 'C', (c + g)::BIGINT FROM c UNION ALL SELECT 'G', (c + g)::BIGINT FROM c UNION ALL SELECT 'T', (a + t)::BIGINT FROM c)
SELECT base, n, floor(n / sum(n) OVER () * 1e4 + 0.5) / 1e4 AS p FROM r"""


def framed_kmer_loglik(spark, d):
    counts = statistics.framed_kmers(dna(spark, d), "seq", 3)
    base = spark.createDataFrame([(b, 0.25) for b in "ACGT"], "base string, p double")
    rows = statistics.kmer_loglik(counts, base)
    return rows.select("kmer", F.col("frame").cast("long").alias("frame"), "n", F.col("n_prefix").cast("long").alias("n_prefix"), _rounded("loglik")[0].alias("loglik"))


FRAMED_KMER_LOGLIK = f"""WITH q AS (SELECT {DNA_SQL} AS seq FROM documents),
k AS (SELECT substr(seq, i + 1, 3) AS kmer, i % 3 AS frame FROM (SELECT seq, unnest(range(0, greatest(0, length(seq) - 2))) AS i FROM q)), c AS (SELECT kmer, CAST(frame AS BIGINT) AS frame, count(*) AS n FROM k GROUP BY ALL),
p AS (SELECT *, CAST(sum(n) OVER (PARTITION BY kmer[1:2], frame) AS BIGINT) AS n_prefix FROM c)
SELECT kmer, frame, n, n_prefix, floor(ln(((n + 1) / (n_prefix + 4)) / 0.25) * 1e4 + 0.5) / 1e4 AS loglik FROM p"""


def exact_dedupe_first_wins(spark, d):
    return graph.first_of_each_text(read(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", ["doc_id"]).select("doc_id")


EXACT_DEDUPE_FIRST_WINS = "SELECT min(doc_id) AS doc_id FROM documents GROUP BY COALESCE(text, '')"


def xml_hit_parse(spark, d):
    html = F.coalesce("html", F.lit(""))
    return read(spark, d, "pages").select("page_id", F.regexp_extract(html, "(?s)<title>(.*?)</title>", 1).alias("title"), F.regexp_count(html, F.lit("<a[ >]")).cast("long").alias("n_links"), F.regexp_count(html, F.lit("<p[ >]")).cast("long").alias("n_paragraphs"))


XML_HIT_PARSE = """SELECT page_id, regexp_extract(COALESCE(html, ''), '<title>(.*?)</title>', 1, 's') AS title, CAST(len(regexp_extract_all(html, '<a[ >]')) AS BIGINT) AS n_links, CAST(len(regexp_extract_all(html, '<p[ >]')) AS BIGINT) AS n_paragraphs FROM pages"""


def segment_tiling(spark, d):
    spans = order_spans(spark, d, 0).groupBy("part").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return intervals.tiles(spans, 365, 30).select("part", "tile", "tile_start", "tile_end")


SEGMENT_TILING = f"""WITH g AS (SELECT part, min(s) AS s, max(e) AS e FROM ({ORDERS_SQL.format(0)}) GROUP BY part)
SELECT part, t.i AS tile, s + t.i * 335 AS tile_start, least(s + t.i * 335 + 364, e) AS tile_end FROM g, LATERAL (SELECT unnest(range(0, greatest(0, CAST(ceil((e - s + 1 - 365) / 335) AS BIGINT)) + 1)) AS i) t"""


def depth_profile(spark, d):
    return intervals.depth(items(spark, d), ["supplier"])


DEPTH_PROFILE = f"""WITH f AS ({ITEMS_SQL}), v AS (SELECT supplier, s AS p, 1 AS step FROM f UNION ALL SELECT supplier, e + 1, -1 FROM f), g AS (SELECT supplier, p, sum(step) AS step FROM v GROUP BY ALL HAVING sum(step) <> 0),
r AS (SELECT supplier, p AS start, lead(p) OVER (PARTITION BY supplier ORDER BY p) - 1 AS "end", CAST(sum(step) OVER (PARTITION BY supplier ORDER BY p) AS BIGINT) AS depth FROM g) SELECT * FROM r WHERE depth > 0"""


def _overlap_edges(spark, d):
    return intervals.self_overlaps(order_spans(spark, d, 7), ["part"], "id", width=32)


def connected_components(spark, d):
    edges = _overlap_edges(spark, d).select(F.col("id").alias("u"), F.col("id_r").alias("v"))
    return graph.components(edges).select("node", "root")


CONNECTED_COMPONENTS = f"""WITH g AS ({ORDERS_SQL.format(7)}), w AS (SELECT *, {BEFORE_SQL.format('part')} AS before FROM g),
i AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before THEN 1 ELSE 0 END) OVER (PARTITION BY part ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM w)
SELECT id AS node, min(id) OVER (PARTITION BY part, island) AS root FROM i QUALIFY count(*) OVER (PARTITION BY part, island) > 1"""


def greedy_nms(spark, d):
    """Of overlapping orders of a customer the dearest stay."""
    nodes = order_spans(spark, d, 7).select("id", (-F.col("price")).alias("cheap"))
    return graph.suppress(nodes, _overlap_edges(spark, d).select(F.col("id").alias("u"), F.col("id_r").alias("v")), ["cheap"]).select("id")


def degree_pruning(spark, d):
    nodes = order_spans(spark, d, 7).select("id", F.col("price").alias("score"))
    return graph.prune_by_degree(nodes, _overlap_edges(spark, d).select(F.col("id").alias("u"), F.col("id_r").alias("v"))).select("id")


def interval_subtract(spark, d):
    return intervals.subtract(order_spans(spark, d, 60).select("part", "id", "start", "end"), items(spark, d), ["part"], ["id"], width=64).groupBy("id").agg(F.count("*").alias("n"), F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("left_over"))


INTERVAL_SUBTRACT = f"""WITH g AS ({ORDERS_SQL.format(60)}), f AS ({ITEMS_SQL}), days AS (SELECT g.id, g.part, t.x FROM g, LATERAL (SELECT unnest(range(g.s, g.e + 1)) AS x) t),
open AS (SELECT id, x FROM days ANTI JOIN f ON f.part = days.part AND days.x BETWEEN f.s AND f.e), r AS (SELECT id, x, x - row_number() OVER (PARTITION BY id ORDER BY x) AS run FROM open)
SELECT id, count(DISTINCT run) AS n, count(*) AS left_over FROM r GROUP BY id"""


def median_depth(spark, d):
    regions = order_spans(spark, d, 60).select("part", "id", "start", "end")
    return intervals.depth_statistic(regions, intervals.depth(items(spark, d), ["part"]), ["part"], "id", width=64).select("id", "median_depth")


MEDIAN_DEPTH = f"""WITH g AS ({ORDERS_SQL.format(60)}), f AS ({ITEMS_SQL}), days AS (SELECT g.id, g.part, t.x FROM g, LATERAL (SELECT unnest(range(g.s, g.e + 1)) AS x) t),
c AS (SELECT days.id, days.x, count(f.id) AS n FROM days LEFT JOIN f ON f.part = days.part AND days.x BETWEEN f.s AND f.e GROUP BY ALL) SELECT id, list_sort(list(n))[31] AS median_depth FROM c GROUP BY id"""


def set_accuracy(spark, d):
    rows = read(spark, d, "lineitem").select("l_partkey", "l_suppkey", F.year("l_shipdate").alias("y"))
    found = statistics.set_accuracy(rows.filter("y = 1996"), rows.filter("y = 1997"), ["l_partkey", "l_suppkey"])
    a, b = _rounded("sensitivity", "specificity")
    return found.select("standard", "predicted", "tp", a.alias("sensitivity"), b.alias("specificity"))


SET_ACCURACY = """WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) = 1996), b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE year(l_shipdate) = 1997),
c AS (SELECT (SELECT count(*) FROM a) AS standard, (SELECT count(*) FROM b) AS predicted, (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS tp) SELECT *, floor(tp / standard * 1e4 + 0.5) / 1e4 AS sensitivity, floor(tp / predicted * 1e4 + 0.5) / 1e4 AS specificity FROM c"""


def isoform_histogram(spark, d):
    return statistics.isoform_histogram(read(spark, d, "lineitem"), "l_orderkey")


ISOFORM_HISTOGRAM = "SELECT isoforms, count(*) AS genes FROM (SELECT l_orderkey, count(*) AS isoforms FROM lineitem GROUP BY l_orderkey) GROUP BY isoforms"


def winsorised_scores(spark, d):
    rows = statistics.fenced(read(spark, d, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price")), "price", ["l_partkey"])
    return rows.select("l_orderkey", "l_linenumber", _rounded("price")[0].alias("price"))


WINSORISED_SCORES = """WITH q AS (SELECT l_partkey, list_sort(list(l_extendedprice)) AS xs FROM lineitem GROUP BY l_partkey), f AS (SELECT l_partkey, xs[CAST(floor((len(xs) - 1) * 0.25) AS INTEGER) + 1] AS q1, xs[CAST(floor((len(xs) - 1) * 0.75) AS INTEGER) + 1] AS q3 FROM q)
SELECT l_orderkey, l_linenumber, floor(least(greatest(l_extendedprice, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) * 1e4 + 0.5) / 1e4 AS price FROM lineitem JOIN f USING (l_partkey)"""


def orf_calls(spark, d):
    """Longest open reading frames of six frames; checked against a plain loop in the tests."""
    return S.orfs(dna(spark, d), "doc_id", "seq", least_codons=30).select("doc_id", "strand", "frame", "start", "end", F.length("orf").alias("length"))


def feature_numbers(spark, d):
    rows = items(spark, d).withColumn("strand", F.when(F.col("part") % 2 == 0, "-").otherwise("+")).withColumn("at", F.col("start") * 1_000_000 + F.col("id") % 1_000_000)
    return order.numbered(rows, ["part"], "at", "strand").select("id", "part", "number")


FEATURE_NUMBERS = f"SELECT id, part, CAST(row_number() OVER (PARTITION BY part ORDER BY CASE WHEN part % 2 = 0 THEN -1 ELSE 1 END * (s * 1000000 + id % 1000000)) AS INTEGER) AS number FROM ({ITEMS_SQL})"


def weight_matrix(spark, d):
    """Every run of 12 letters of the whole texts, one after the other, is a site."""
    sites = dna(spark, d).select(F.explode(F.regexp_extract_all("seq", F.lit(".{12}"), F.lit(0))).alias("seq"))
    return statistics.weight_matrix(sites, "seq").select(F.col("pos").cast("long").alias("pos"), "base", "n", "prob")


WEIGHT_MATRIX = f"""WITH q AS (SELECT unnest(regexp_extract_all({DNA_SQL}, '.{{12}}')) AS seq FROM documents), c AS (SELECT i AS pos, seq[i + 1] AS base, count(*) AS n FROM q, range(0, 12) t(i) GROUP BY ALL),
g AS (SELECT pos, base, COALESCE(n, 0) AS n FROM (SELECT pos, base FROM (SELECT DISTINCT pos FROM c), (SELECT unnest(['A', 'C', 'G', 'T']) AS base)) LEFT JOIN c USING (pos, base))
SELECT pos, base, n, round((n + 1) / (sum(n) OVER (PARTITION BY pos) + 4), 6) AS prob FROM g"""


NAMES = [
    "interval_union_coverage", "interval_union_binned", "interval_islands", "overlap_pairs_binned", "overlap_fraction_filter", "contained_intervals", "evidence_common_specific", "neighbor_overlap", "gap_to_previous", "phase_running_sum",
    "best_per_group", "cap_per_species", "top_score_band", "upper_median_stats", "quantile_threshold_gate", "class_rollup_union", "semi_anti_router", "forall_fail_filter", "distinct_fragments", "sensitivity_specificity",
    "roc_table", "auc_trapezoid", "revcomp_text", "codon_translate", "integrity_class", "base_frequency", "framed_kmer_loglik", "exact_dedupe_first_wins", "xml_hit_parse", "segment_tiling", "depth_profile",
    "connected_components", "greedy_nms", "degree_pruning", "interval_subtract", "median_depth", "set_accuracy", "isoform_histogram", "winsorised_scores", "orf_calls", "feature_numbers", "weight_matrix",
]
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES if name.upper() in globals()}
