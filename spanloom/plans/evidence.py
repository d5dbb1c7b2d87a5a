"""Smaller evidence operators: intron lookups, end corrections, filters, splits and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..operators import graph, intervals, order, statistics
from . import pipelines


def prediction_lines(spark, path, software: str) -> DataFrame:
    """Coding parts (region, seqid, start, end, strand, score, software) of GFF-like predictor output; the last column's first word names the prediction."""
    c = F.split("value", "\t")
    kinds = {"genewise": ["cds"], "gth": ["exon"], "exonerate": ["cds"]}[software]
    rows = spark.read.text(path).filter(~F.col("value").startswith("#")).filter(F.size(c) >= 8).filter(F.lower(c[2]).isin(*kinds))
    a, b = c[3].try_cast("long"), c[4].try_cast("long")
    return rows.select(F.regexp_extract(F.coalesce(F.get(c, F.lit(8)), F.lit("")), r"([^;\s=]+)", 1).alias("prediction"), c[0].alias("seqid"), F.least(a, b).alias("start"), F.greatest(a, b).alias("end"), c[6].alias("strand"), c[5].try_cast("double").alias("score"), F.lit(software).alias("software"))


def long_enough(transcripts: DataFrame, least: int = 300) -> tuple[DataFrame, DataFrame]:
    """P5: rows of genes whose longest transcript has at least `least` coding positions, and the others."""
    rows = transcripts.withColumn("_most", F.max("cds_len").over(W.partitionBy("gene_id")))
    return rows.filter(F.col("_most") >= least).drop("_most"), rows.filter(F.col("_most") < least).drop("_most")


def filter_reasons(transcripts: DataFrame, least_ratio: float = 0.3, least_cds: int = 600, most_repeat: float = 0.3) -> DataFrame:
    """(gene_id, transcript_id, reason): a low coding share always; short coding parts and repeats where every transcript of the gene has one reason or another."""
    ratio = F.coalesce(F.try_divide("cds_len", "exon_len"), F.lit(0.0)) < least_ratio
    short, repeat = F.col("cds_len") < least_cds, F.coalesce("repeat_share", F.lit(0.0)) >= most_repeat
    rows = transcripts.withColumns({"_ratio": ratio, "_short": short, "_repeat": repeat})
    rows = rows.withColumn("_all", F.bool_and(F.col("_ratio") | F.col("_short") | F.col("_repeat")).over(W.partitionBy("gene_id")))
    reasons = F.array(F.when(F.col("_ratio"), "ratio"), F.when(F.col("_short") & F.col("_all"), "short"), F.when(F.col("_repeat") & F.col("_all"), "repeat"))
    return rows.select("gene_id", "transcript_id", F.explode(F.array_compact(reasons)).alias("reason"))


def surely_right(models: DataFrame, least_support: float = 100.0) -> DataFrame:
    """Of each gene's transcripts that are complete and fully supported the one of the highest ratio (then the first id), if that is over 0."""
    rows = models.filter((F.col("integrity") == "complete") & (F.col("support") >= least_support) & F.col("transcript_ratio").isNotNull())
    return order.best_per_group(rows, ["gene_id"], [F.desc("transcript_ratio"), F.col("transcript_id")]).filter("transcript_ratio > 0")


def training_gates(models: DataFrame, least_parts: int = 3, least_cds: int = 600, least_ratio: float = 0.6, longest: float = 0.95) -> DataFrame:
    """Complete models with enough parts, coding length and coding share, without the longest."""
    rows = models.filter((F.col("integrity") == "complete") & (F.col("n_cds") >= least_parts) & (F.col("cds_len") >= least_cds) & (F.col("cds_len") / F.col("exon_len") >= least_ratio))
    return order.by_percentile(rows, "cds_len", longest)


def without_contained(hits: DataFrame, most: float = 0.8, slack: int = 1000) -> DataFrame:
    """Of hits of a region that another one of better score covers by over `most` of their query and target, the better stays.  hits: (id, seqid, strand, start, end, covered)."""
    wide = hits.withColumns({"start": F.col("start") - slack, "end": F.col("end") + slack})
    pairs = intervals.overlap_join(wide, hits, ["seqid", "strand"]).filter("id != id_r")
    both = intervals.nucleotides_in_common(F.col("start") + slack, F.col("end") - slack, F.col("start_r"), F.col("end_r"))
    edges = pairs.filter(both >= most * F.least(F.col("end") - F.col("start") - 2 * slack + 1, F.col("end_r") - F.col("start_r") + 1)).select(F.col("id").alias("u"), F.col("id_r").alias("v"))
    return hits.join(graph.suppress(hits.select("id", (-F.col("covered")).alias("less")), edges, ["less"]).select("id"), "id", "left_semi")


def longer_ends(cds: DataFrame, evidence: DataFrame) -> DataFrame:
    """For each gene's last intron (in order of position) the longest chain of coding parts that evidence has behind the same intron with the same phase: (gene_id, evidence_id, extra_parts, extra_len)."""
    def chain(df: DataFrame, ident: str) -> DataFrame:
        by = W.partitionBy(ident).orderBy("start")
        n = F.col("end") - F.col("start") + 1
        rest = W.partitionBy(ident).orderBy(F.desc("start")).rowsBetween(W.unboundedPreceding, 0)
        rows = df.withColumns({"i_start": F.lag("end").over(by) + 1, "i_end": F.col("start") - 1, "parts": F.count("*").over(rest), "len": F.sum(n).over(rest), "k": F.row_number().over(by), "m": F.count("*").over(W.partitionBy(ident))})
        return rows.filter("i_start is not null")

    key = ["seqid", "strand", "i_start", "i_end", "phase"]
    last = chain(cds, "gene_id").filter("k = m").select(*key, "gene_id", F.col("parts").alias("own_parts"), F.col("len").alias("own_len"))
    best = chain(evidence, "evidence_id").groupBy(*key).agg(F.max(F.struct("len", "parts", "evidence_id")).alias("b"))
    rows = last.join(best, key).filter(F.col("b.len") > F.col("own_len"))
    return rows.select("gene_id", "b.evidence_id", (F.col("b.parts") - F.col("own_parts")).alias("extra_parts"), (F.col("b.len") - F.col("own_len")).alias("extra_len"))


def single_part_matches(cds: DataFrame, evidence: DataFrame) -> DataFrame:
    """Genes of one coding part that lie in frame inside a longer coding part of evidence; the longest of those."""
    one = cds.withColumn("n", F.count("*").over(W.partitionBy("gene_id"))).filter("n = 1").drop("n")
    pairs = intervals.overlap_join(one, evidence, ["seqid", "strand"]).filter("start_r <= start and end <= end_r and (start - start_r) % 3 = 0 and end_r - start_r > end - start")
    return order.best_per_group(pairs, ["gene_id"], [F.desc(F.col("end_r") - F.col("start_r")), F.col("evidence_id_r")]).select("gene_id", F.col("evidence_id_r").alias("evidence_id"), F.col("start_r").alias("start"), F.col("end_r").alias("end"))


def same_intron_chain(genes: DataFrame, isoforms: DataFrame) -> DataFrame:
    """Isoforms that overlap a gene, flagged where their introns equal those of one of the gene's transcripts.  Both: (seqid, strand, start, end, introns) with gene_id or isoform_id."""
    pairs = intervals.overlap_join(isoforms, genes, ["seqid", "strand"])
    return pairs.groupBy("isoform_id", F.col("gene_id_r").alias("gene_id")).agg(F.bool_or(F.col("introns") == F.col("introns_r")).alias("known"))


def hints_of_segments(segments: DataFrame, hints: DataFrame) -> DataFrame:
    """Hints that lie inside a segment, in its own coordinates."""
    rows = intervals.overlap_join(segments, hints, ["seqid"], 10_000).filter("start_r >= start and end_r <= end")
    return rows.select("segment", "seqid", (F.col("start_r") - F.col("start") + 1).alias("start"), (F.col("end_r") - F.col("start") + 1).alias("end"), F.col("type_r").alias("type"), F.col("src_r").alias("src"))


def from_segments(found: DataFrame, segments: DataFrame) -> DataFrame:
    """Predictions of overlapping segments back in the sequence's coordinates, each once."""
    rows = found.join(segments.select("segment", "seqid", F.col("start").alias("offset")), "segment")
    return intervals.shift(rows, "offset").drop("segment", "offset").dropDuplicates(["seqid", "strand", "start", "end"])


def intron_multiplicity(models: DataFrame) -> DataFrame:
    """Models with the least number of models that share each of their introns (start-end pairs in `introns`)."""
    rows = models.select("id", "seqid", "strand", F.explode("introns").alias("intron"))
    n = rows.groupBy("seqid", "strand", "intron").agg(F.count_distinct("id").alias("n"))
    least = rows.join(n, ["seqid", "strand", "intron"]).groupBy("id").agg(F.min("n").alias("support"))
    return models.join(least, "id", "left").withColumn("support", F.coalesce("support", F.lit(0)))


def intergenic_flank(genes: DataFrame, least_gap: int = 50) -> DataFrame:
    """The flanking length from the upper medians of the lengths of different genes and of the gaps between those of one sequence and strand."""
    rows = genes.select("seqid", "strand", "start", "end").distinct()
    gaps = intervals.gaps(rows, ["seqid", "strand"]).filter(F.col("gap") >= least_gap)
    gene, gap = order.element_at(rows.withColumn("len", F.col("end") - F.col("start") + 1), "len", 0.5), order.element_at(gaps, "gap", 0.5)
    medians = genes.sparkSession.createDataFrame([(gene, gap or 0)], "gene long, gap long")
    return medians.select(statistics.flank_length(F.col("gene"), F.col("gap")).alias("flank"))


def refined_starts(orfs: DataFrame, matrix: dict, background: dict, seq: str = "seq", before: int = 20, after: int = 10, least: float = 0.0, share: float = 0.15) -> DataFrame:
    """of start codons in frame in the first max(30, 15 % of the length) positions the one of the best matrix score, if that reaches `least` and the frame's own start is open."""
    length = F.col("end") - F.col("start") + 1
    steps = F.floor(F.greatest(F.lit(30), length * share) / 3).cast("int")
    rows = orfs.withColumn("at", F.explode(F.transform(F.sequence(F.lit(0), steps), lambda k: F.col("start") + 3 * k))).filter(F.upper(F.substr(F.col(seq), F.col("at").cast("int"), F.lit(3))) == "ATG").filter(F.col("at") > before)
    rows = rows.withColumn("start_score", statistics.matrix_score(F.substr(F.col(seq), (F.col("at") - before).cast("int"), F.lit(before + 3 + after)), matrix, background)).filter(F.col("start_score") >= least)
    best = order.best_per_group(rows, ["id"], [F.desc("start_score"), F.col("at")]).select("id", F.col("at").alias("new_start"), "start_score")
    return orfs.join(best, "id", "left").withColumn("new_start", F.coalesce("new_start", "start"))


def exons_from(cds: DataFrame, exons: DataFrame) -> DataFrame:
    """exons whose introns are those of the coding parts and those exon introns that don't meet a coding part."""
    key = ["transcript_id", "seqid", "strand"]
    own = intervals.introns(cds, key)
    other = intervals.introns(exons, key).withColumn("id", F.concat_ws(":", "transcript_id", "start", "end"))
    clash = intervals.overlap_join(other, cds.select(*key, "start", "end"), key).select("id").distinct()
    holes = own.unionByName(other.join(clash, "id", "left_anti").drop("id")).distinct()
    span = exons.select(*key, "start", "end").unionByName(cds.select(*key, "start", "end")).groupBy(*key).agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return intervals.subtract(span.withColumn("row", F.col("transcript_id")), holes, key, ["row"]).drop("row")


def bounded(exons: DataFrame, genes: DataFrame) -> DataFrame:
    """each transcript's first and last exon end where its gene does."""
    by = W.partitionBy("transcript_id")
    rows = exons.join(genes.select("gene_id", F.col("start").alias("g1"), F.col("end").alias("g2")), "gene_id").withColumns({"first": F.min("start").over(by), "last": F.max("end").over(by)})
    return rows.withColumns({"start": F.when(F.col("start") == F.col("first"), F.col("g1")).otherwise(F.col("start")), "end": F.when(F.col("end") == F.col("last"), F.col("g2")).otherwise(F.col("end"))}).drop("g1", "g2", "first", "last")


def split_sets(df: DataFrame, ident: str, folds: int = 10, seed: int = 1) -> DataFrame:
    """Df with a reproducible fold by a hash of its id."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), ident), F.lit(folds)).cast("int"))


def long_orfs(transcripts: DataFrame, least_codons: int = 100, code: int = 1, one_strand: bool = False) -> DataFrame:
    """Open reading frames of transcripts (seq_id, seq) with their class and proteins."""
    rows = S.orfs(transcripts, "seq_id", "seq", least_codons, code, both_strands=not one_strand)
    return rows.withColumns({"integrity": S.integrity(F.col("orf"), code), "protein": S.translate(F.col("orf"), code), "id": F.concat_ws(":", "seq_id", "strand", "start", "end")})


def training_set(models: DataFrame, similar: DataFrame, **gates) -> DataFrame:
    """Gated models without those that are similar to others: edges (u, v), the node of most edges goes first."""
    rows = training_gates(models, **gates)
    return graph.prune_by_degree(rows.withColumn("score", F.col("cds_len").cast("double")).withColumnRenamed("gene_id", "id"), similar).withColumnRenamed("id", "gene_id")


def backed_by_domains(transcripts: DataFrame, domains: DataFrame, least_cds: int = 300) -> DataFrame:
    """Genes that are long enough and have a domain."""
    kept, _ = long_enough(transcripts, least_cds)
    return kept.join(pipelines.domain_hits(domains).select(F.col("query").alias("transcript_id")).distinct(), "transcript_id", "left_semi").select("gene_id").distinct()


def noise_depleted(sites: DataFrame, background: dict, rounds: int = 5, drop: float = 0.1, seq: str = "seq", ident: str = "id") -> DataFrame:
    """Sites of one length without those that fit the matrix of the others worst, a share in each round."""
    rows = sites
    for _ in range(rounds):
        matrix: dict = {}
        for r in statistics.weight_matrix(rows, seq).collect():  # four rows for each position of a site
            matrix.setdefault(r["pos"], {})[r["base"]] = r["prob"]
        scored = rows.withColumn("_score", statistics.matrix_score(F.col(seq), matrix, background)).filter("_score is not null")
        rows = graph.checkpoint(order.by_percentile(scored, "_score", drop, keep_below=False).drop("_score"))
    return rows


def report(parts: dict[str, DataFrame]) -> DataFrame:
    """K8: (what, measure, value) of one-row or few-row tables; a table's text columns name the measure."""
    out = None
    for what, df in parts.items():
        names = [c for c, t in df.dtypes if t == "string"]
        values = [c for c, t in df.dtypes if t != "string"]
        head = F.concat_ws(".", *names) if names else F.lit("")
        rows = df.select(F.lit(what).alias("what"), F.explode(F.array(*[F.struct(F.concat_ws(".", F.nullif(head, F.lit("")), F.lit(c)).alias("measure"), F.col(c).cast("double").alias("value")) for c in values])).alias("r")).select("what", "r.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def transfrag_tables(parts: DataFrame, genome: DataFrame, keys: Sequence[str] = ("transcript_id", "seqid", "strand")) -> tuple[DataFrame, DataFrame]:
    """K9: spliced sequences of transfrags, and length statistics by strand."""
    from ..sources import sinks

    seqs = sinks.sequences(parts, genome, "cDNA")
    sizes = parts.filter("type = 'exon'").groupBy(*keys).agg(F.sum(F.col("end") - F.col("start") + 1).alias("len"))
    return seqs, sizes.groupBy("strand").agg(F.count("*").alias("n"), F.sum("len").alias("sum"), F.max("len").alias("most")).join(order.upper_median(sizes, ["strand"], "len"), "strand")
