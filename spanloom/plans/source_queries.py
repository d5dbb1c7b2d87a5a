"""Sources and sinks: lines of each format are made from the driver's tables, written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import graph
from ..sources import formats, sinks
from . import pipelines
from .driver_queries import DNA_SQL, dna, read
from .more_queries import _EXONS, _exons


def _written(df: DataFrame, column: str = "value") -> str:
    """The folder that holds the lines; in the shared folder, since executors write them."""
    path = f"{graph.shared_dir(df.sparkSession)}/lines-{uuid.uuid4().hex}"
    df.select(column).write.text(path)
    return path


def _text(*cells: Column | str | int) -> Column:
    return F.concat(*[c.cast("string") if isinstance(c, Column) else F.lit(str(c)) for c in cells])


def fasta_records(spark: SparkSession, d: str) -> DataFrame:
    """Letters of documents, 80 a line."""
    rows = dna(spark, d).select(F.concat(F.lit("d"), "doc_id", F.lit(" a document")).alias("seq_id"), "seq")
    found = formats.fasta(spark, _written(sinks.fasta(rows)))
    return found.select("seq_id", "description", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("md5"))


FASTA_RECORDS = f"WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents) SELECT 'd' || doc_id AS seq_id, 'a document' AS description, CAST(length(seq) AS BIGINT) AS n, md5(seq) AS md5 FROM q"


def fetched_regions(spark: SparkSession, d: str) -> DataFrame:
    """Letters of regions over chunks."""
    rows = dna(spark, d).filter(F.length("seq") >= 1500).select(F.col("doc_id").cast("string").alias("seq_id"), "seq")
    regions = rows.select(F.col("seq_id").alias("id"), "seq_id", F.lit(490).cast("long").alias("start"), F.lit(1490).cast("long").alias("end"))
    return formats.fetch(regions, formats.chunked(rows, 500), 500).select("id", F.md5("seq").alias("md5"))


FETCHED_REGIONS = f"WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents) SELECT CAST(doc_id AS VARCHAR) AS id, md5(substr(seq, 490, 1001)) AS md5 FROM q WHERE length(seq) >= 1500"


def gff3_features(spark: SparkSession, d: str) -> DataFrame:
    """A row for each parent of a feature; intervals written backwards are turned round, comments and short lines stay out."""
    o = read(spark, d, "orders")
    low, high = F.col("o_orderkey"), F.col("o_orderkey") + F.col("o_custkey")
    back = F.col("o_orderkey") % 3 == 0
    note = _text("ID=g", F.col("o_orderkey"), ";Parent=a", F.col("o_custkey"), ",b;Note=first;Note=", F.col("o_orderstatus"))
    lines = o.select(sinks.line(F.col("o_custkey"), F.lit("x"), F.lit("gene"), F.when(back, high).otherwise(low), F.when(back, low).otherwise(high), F.lit("."), F.lit("+"), F.lit("."), note).alias("value"))
    lines = lines.unionByName(o.select(_text("# a comment\t", F.col("o_orderkey")).alias("value"))).unionByName(o.select(_text("short\tline\t", F.col("o_orderkey")).alias("value")))
    return formats.gff3(spark, _written(lines)).select("id", "parent", "seqid", "start", "end", F.try_element_at("attrs", F.lit("Note")).alias("note"))


GFF3_FEATURES = """SELECT 'g' || o_orderkey AS id, p AS parent, CAST(o_custkey AS VARCHAR) AS seqid, CAST(o_orderkey AS BIGINT) AS start, CAST(o_orderkey + o_custkey AS BIGINT) AS "end", o_orderstatus AS note FROM (SELECT *, unnest(['a' || o_custkey, 'b']) AS p FROM orders)"""


def _parts(spark, d):
    rows = _exons(spark, d).select(F.col("transcript_id").cast("string").alias("transcript_id"), F.concat(F.lit("g"), "transcript_id").alias("gene_id"), "seqid", "strand", "start", "end")
    return rows.withColumns({"type": F.lit("exon"), "phase": F.lit(None).cast("string")}).unionByName(rows.withColumns({"type": F.lit("CDS"), "phase": F.lit("0")}))


def gtf_genes(spark: SparkSession, d: str) -> DataFrame:
    """Parts written as GTF and read back as gene models."""
    genes, transcripts, parts = sinks.models_from_gtf(formats.gtf(spark, _written(sinks.gtf(_parts(spark, d)))))
    n = parts.filter("type = 'exon'").groupBy("gene_id").agg(F.count("*").alias("exons"))
    return genes.join(n, "gene_id").select("gene_id", "seqid", "strand", "start", "end", "exons")


GTF_GENES = f"""SELECT 'g' || t AS gene_id, 'c' AS seqid, strand, min(s)::BIGINT AS start, max(e)::BIGINT AS "end", count(*) AS exons FROM ({_EXONS}) GROUP BY t, strand"""


def codon_lines(spark: SparkSession, d: str) -> DataFrame:
    """K4: start and stop codons, split where a part ends."""
    rows = formats.gtf(spark, _written(sinks.gtf(_parts(spark, d)))).filter(F.col("type").isin("start_codon", "stop_codon"))
    return rows.groupBy("transcript_id", "type").agg(F.sum(F.col("end") - F.col("start") + 1).cast("long").alias("n"), F.min("start").alias("low"), F.max("end").alias("high"))


CODON_LINES = f"""WITH x AS ({_EXONS}), p AS (SELECT t, strand, unnest(range(s, e + 1)) AS pos FROM x), k AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY CASE WHEN strand = '-' THEN -pos ELSE pos END) AS k, count(*) OVER (PARTITION BY t) AS n FROM p)
SELECT CAST(t AS VARCHAR) AS transcript_id, type, count(*) AS n, min(pos)::BIGINT AS low, max(pos)::BIGINT AS high FROM (SELECT t, 'start_codon' AS type, pos FROM k WHERE k <= 3 UNION ALL SELECT t, 'stop_codon', pos FROM k WHERE k > n - 3) GROUP BY t, type"""


def bed_lines(spark: SparkSession, d: str) -> DataFrame:
    """K5."""
    c = F.split("value", "\t")
    return spark.read.text(_written(sinks.bed12(_parts(spark, d)))).select(c[3].alias("name"), c[1].cast("long").alias("start"), c[2].cast("long").alias("end"), c[9].cast("long").alias("blocks"), c[10].alias("sizes"), c[11].alias("starts"))


BED_LINES = f"""SELECT CAST(t AS VARCHAR) AS name, min(s)::BIGINT - 1 AS start, max(e)::BIGINT AS "end", count(*) AS blocks, string_agg(e - s + 1, ',' ORDER BY s, e) AS sizes, string_agg(s - low, ',' ORDER BY s, e) AS starts FROM (SELECT *, min(s) OVER (PARTITION BY t) AS low FROM ({_EXONS})) GROUP BY t"""


def alignment_targets(spark: SparkSession, d: str) -> DataFrame:
    """Places of exons in their transcripts."""
    rows = formats.gff3(spark, _written(sinks.alignment_gff3(_parts(spark, d))))
    return rows.select("id", "start", "end", F.try_element_at("attrs", F.lit("Target")).alias("target"))


ALIGNMENT_TARGETS = f"""WITH x AS (SELECT *, COALESCE(sum(e - s + 1) OVER (PARTITION BY t ORDER BY CASE WHEN strand = '-' THEN -s ELSE s END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM ({_EXONS}))
SELECT CAST(t AS VARCHAR) AS id, CAST(s AS BIGINT) AS start, CAST(e AS BIGINT) AS "end", t || ' ' || (before + 1) || ' ' || (before + e - s + 1) AS target FROM x"""


def sam_introns(spark: SparkSession, d: str) -> DataFrame:
    """Introns of spliced reads with their depth; secondary and unmapped lines don't count."""
    r = read(spark, d, "lineitem")
    q = F.col("l_quantity").cast("long")
    cigar = F.when(F.col("l_returnflag") == "A", F.lit("*")).otherwise(_text(q, "M", F.col("l_suppkey") % 7 + 15, "N3S"))
    lines = r.select(sinks.line(_text("r", F.col("l_orderkey")), F.when(F.col("l_returnflag") == "R", 256).otherwise(0), _text("c", F.col("l_linenumber")), F.col("l_suppkey"), F.lit(60), cigar, F.lit("*"), F.lit(0), F.lit(0), F.lit("*"), F.lit("*"), F.lit("XS:A:+")).alias("value"))
    lines = lines.unionByName(r.select("l_linenumber").distinct().select(_text("@SQ\tSN:c", F.col("l_linenumber"), "\tLN:1000").alias("value")))
    reads = formats.sam(spark, _written(lines)).withColumn("strand", F.try_element_at("tags", F.lit("XS")))
    reads = reads.withColumn("strand", F.right("strand", F.lit(1)))
    return pipelines.read_evidence(reads)[2].select("seqid", "strand", "start", "end", "depth")


SAM_INTRONS = """SELECT 'c' || l_linenumber AS seqid, '+' AS strand, CAST(l_suppkey + CAST(l_quantity AS BIGINT) AS BIGINT) AS start, CAST(l_suppkey + CAST(l_quantity AS BIGINT) + l_suppkey % 7 + 14 AS BIGINT) AS "end", count(*) AS depth FROM lineitem WHERE l_returnflag = 'N' AND l_suppkey % 7 >= 5 GROUP BY ALL"""


def repeat_hits(spark: SparkSession, d: str) -> DataFrame:
    """What a hit covers of its repeat, on either strand."""
    r = read(spark, d, "lineitem")
    q, left = F.col("l_quantity").cast("long"), _text("(", F.col("l_suppkey"), ")")
    plus = F.col("l_linenumber") % 2 == 0
    place = F.when(plus, _text(1, " ", q, " ", left)).otherwise(_text(left, " ", q, " ", 1))
    lines = r.select(_text("  ", F.col("l_linenumber") * 10, " 1.0 0.0 0.0 c", F.col("l_orderkey"), " 5 ", q + 5, " (100) ", F.when(plus, "+").otherwise("C"), " rep LINE/L1 ", place, " 7").alias("value"))
    head = spark.createDataFrame([("   SW   perc perc perc",), ("score   div. del. ins.",), ("",)], "value string")
    rows = formats.repeatmasker(spark, _written(head.unionByName(lines)))
    return rows.groupBy("seqid", "strand", "class").agg(F.count("*").alias("n"), F.count_if(F.col("ratio") >= 0.25).alias("covering"))


REPEAT_HITS = """SELECT 'c' || l_orderkey AS seqid, CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand, 'LINE' AS class, count(*) AS n, count(*) FILTER (CAST(l_quantity AS BIGINT) / (CAST(l_quantity AS BIGINT) + l_suppkey) >= 0.25) AS covering FROM lineitem GROUP BY ALL"""


def blast_tab_rows(spark: SparkSession, d: str) -> DataFrame:
    """S10."""
    lines = read(spark, d, "lineitem").select(sinks.line(_text("q", F.col("l_orderkey")), _text("s", F.col("l_suppkey")), F.col("l_quantity"), F.lit(20), F.lit(0), F.lit(0), F.lit(1), F.lit(20), F.lit(5), F.lit(24), F.lit("1e-30"), F.col("l_linenumber")).alias("value"))
    rows = formats.blast_tab(spark, _written(lines.unionByName(spark.createDataFrame([("# a comment",)], "value string"))))
    return rows.groupBy("query").agg(F.count("*").alias("n"), F.max("pident").alias("best"), F.sum("bitscore").cast("long").alias("bits"), F.max(F.col("evalue") < 1e-29).alias("small"))


BLAST_TAB_ROWS = "SELECT 'q' || l_orderkey AS query, count(*) AS n, CAST(max(l_quantity) AS DOUBLE) AS best, sum(l_linenumber)::BIGINT AS bits, true AS small FROM lineitem GROUP BY l_orderkey"


def blast_xml_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders as queries, their lines as hits of one segment each."""
    hsp = _text("<Hsp><Hsp_bit-score>", F.col("l_quantity"), "</Hsp_bit-score><Hsp_evalue>1e-9</Hsp_evalue><Hsp_query-from>1</Hsp_query-from><Hsp_query-to>", F.col("l_linenumber") + 9, "</Hsp_query-to><Hsp_hit-from>1</Hsp_hit-from><Hsp_hit-to>10</Hsp_hit-to><Hsp_identity>5</Hsp_identity><Hsp_align-len>10</Hsp_align-len></Hsp>")
    hit = _text("<Hit><Hit_id>s", F.col("l_suppkey"), "</Hit_id><Hit_def>x</Hit_def><Hit_len>90</Hit_len><Hit_hsps>", hsp, "</Hit_hsps></Hit>")
    whole = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(hit), "").alias("hits"))
    lines = whole.select(_text("<Iteration><Iteration_query-def>q", F.col("l_orderkey"), "</Iteration_query-def><Iteration_query-len>50</Iteration_query-len><Iteration_hits>", F.col("hits"), "</Iteration_hits></Iteration>").alias("value"), F.pmod(F.xxhash64("l_orderkey"), F.lit(4)).alias("part"), F.lit(1).alias("ord"))
    # Four files, each a document with a root of its own.
    ends = spark.createDataFrame([(v, k, o) for k in range(4) for o, v in ((0, "<BlastOutput_iterations>"), (2, "</BlastOutput_iterations>"))], "value string, part long, ord int")
    path = f"{graph.shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    lines.unionByName(ends).repartition("part").sortWithinPartitions("part", "ord").select("part", "value").write.partitionBy("part").text(path)
    rows = formats.blast_xml(spark, path)
    return rows.groupBy("query").agg(F.count("*").alias("n"), F.sum("qend").cast("long").alias("ends"), F.max("pident").alias("pident"), F.max("qlen").alias("qlen"))


BLAST_XML_ROWS = "SELECT 'q' || l_orderkey AS query, count(*) AS n, sum(l_linenumber + 9)::BIGINT AS ends, 50.0::DOUBLE AS pident, 50::BIGINT AS qlen FROM lineitem GROUP BY l_orderkey"


def domain_rows(spark: SparkSession, d: str) -> DataFrame:
    """S11."""
    n = F.col("l_linenumber")
    lines = read(spark, d, "lineitem").select(F.concat_ws("  ", F.lit("Dom"), F.lit("PF1"), F.lit("100"), _text("q", F.col("l_orderkey")), F.lit("-"), F.lit("300"), F.lit("1e-9"), F.lit("50.5"), F.lit("0"), n, F.lit("9"), F.lit("1e-5"), F.lit("1e-4"), F.lit("9"), F.lit("0"), n * 10, n * 10 + 5, F.lit("1"), F.lit("6"), F.lit("1"), F.lit("9"), F.lit("0.9"), F.lit("a name of words")).alias("value"))
    rows = formats.domtblout(spark, _written(lines.unionByName(spark.createDataFrame([("# head",)], "value string"))))
    return rows.groupBy("query", "target", "description").agg(F.sum("hmm_from").cast("long").alias("froms"), F.max("hmm_to").alias("last"), F.max("evalue").alias("evalue"))


DOMAIN_ROWS = "SELECT 'q' || l_orderkey AS query, 'Dom' AS target, 'a name of words' AS description, sum(l_linenumber * 10)::BIGINT AS froms, CAST(max(l_linenumber * 10 + 5) AS BIGINT) AS last, 1e-9::DOUBLE AS evalue FROM lineitem GROUP BY l_orderkey"


def fastq_reads(spark: SparkSession, d: str) -> DataFrame:
    """Quality lines may begin with @."""
    rows = dna(spark, d).filter("seq != ''").select("doc_id", F.left("seq", F.lit(50)).alias("seq"))
    qual = F.concat(F.when(F.col("doc_id") % 2 == 0, "@").otherwise("I"), F.repeat(F.lit("F"), F.length("seq") - 1))
    return formats.fastq(spark, _written(rows.select(F.concat(F.lit("@r"), "doc_id", F.lit("\n"), "seq", F.lit("\n+\n"), qual).alias("value")))).select("name", "seq", F.left("qual", F.lit(1)).alias("first"))


FASTQ_READS = f"WITH q AS (SELECT doc_id, {DNA_SQL} AS seq FROM documents) SELECT 'r' || doc_id AS name, left(seq, 50) AS seq, CASE WHEN doc_id % 2 = 0 THEN '@' ELSE 'I' END AS first FROM q WHERE seq <> ''"


def genbank_parts(spark: SparkSession, d: str) -> DataFrame:
    """A record for each transcript, its parts joined."""
    place = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda p: _text(p["start"], "..", p["end"])), ",")
    rows = _exons(spark, d).groupBy("transcript_id", "strand").agg(place.alias("p"))
    joined = _text("join(", F.col("p"), ")")
    text = _text("LOCUS       t", F.col("transcript_id"), "   9000 bp\nFEATURES\n     CDS             ", F.when(F.col("strand") == "-", _text("complement(", joined, ")")).otherwise(joined), "\n                     /gene=\"x\"\nORIGIN\n//")
    found = formats.genbank(spark, _written(rows.select(text.alias("value"))))
    return found.select("locus", "length", "minus", F.size("parts").cast("long").alias("n"), F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["end"] - p["start"] + 1).alias("sum"))


GENBANK_PARTS = f"SELECT 't' || t AS locus, 9000::BIGINT AS length, strand = '-' AS minus, count(*) AS n, sum(e - s + 1)::BIGINT AS sum FROM ({_EXONS}) GROUP BY t, strand"


def spliced_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Parts on documents' letters, joined in order of transcription."""
    genome = dna(spark, d).filter(F.length("seq") >= 600).select(F.col("doc_id").cast("string").alias("seq_id"), "seq")
    one = lambda t, s, a, b: F.struct(F.concat(F.lit(t), "seq_id").alias("transcript_id"), F.lit(s).alias("strand"), F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end"))
    parts = genome.select(F.col("seq_id").alias("seqid"), F.explode(F.array(one("p", "+", 11, 60), one("p", "+", 101, 150), one("m", "-", 201, 260), one("m", "-", 301, 333))).alias("x")).select("seqid", "x.*", F.lit("CDS").alias("type"))
    return sinks.sequences(parts, genome).select("seq_id", F.md5("seq").alias("md5"))


SPLICED_SEQUENCES = f"""WITH q AS (SELECT doc_id, {DNA_SQL} AS s FROM documents) SELECT 'p' || doc_id AS seq_id, md5(substr(s, 11, 50) || substr(s, 101, 50)) AS md5 FROM q WHERE length(s) >= 600
UNION ALL SELECT 'm' || doc_id, md5(reverse(translate(substr(s, 201, 60) || substr(s, 301, 33), 'ATCG', 'TAGC'))) FROM q WHERE length(s) >= 600"""


def listed_sequences(spark: SparkSession, d: str) -> DataFrame:
    """An id list with repeated lines, and the sequences that it doesn't name."""
    ids = read(spark, d, "labels").filter("toxic = 1").select(_text(F.col("doc_id"), " x").alias("value"))
    found = formats.id_list(spark, _written(ids.unionByName(ids)))
    rows = dna(spark, d).select(F.col("doc_id").cast("string").alias("seq_id"))
    return formats.selected(rows, found, reverse=True)


LISTED_SEQUENCES = "SELECT CAST(doc_id AS VARCHAR) AS seq_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)"

NAMES = [
    "fasta_records", "fetched_regions", "gff3_features", "gtf_genes", "codon_lines", "bed_lines", "alignment_targets", "sam_introns", "repeat_hits", "blast_tab_rows", "blast_xml_rows", "domain_rows", "fastq_reads", "genbank_parts", "spliced_sequences", "listed_sequences",
]
QUERIES = {name: globals()[name] for name in NAMES}
ORACLES = {name: globals()[name.upper()] for name in NAMES}
