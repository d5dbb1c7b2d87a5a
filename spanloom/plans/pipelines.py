"""X pipelines of the survey from tables to tables, composed of the operators; README lists those left out or partial."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..functions.genetic_code import stops
from ..operators import graph, intervals, order, statistics

# Repeat classes that don't count against genes.
IGNORED_REPEATS = ("Simple_repeat", "Low_complexity", "Satellite", ".*RNA", "Tandem.*")
UNSURE_REPEATS = ("Unknown", "Unspecified", "Other")


def repeats(hits: DataFrame, least_ratio: float = 0.25, bin_width: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Distinct hits that cover enough of their repeat, and counts and positions in total, by class and by subclass."""
    kept = hits.filter(F.coalesce("ratio", F.lit(0.0)) >= least_ratio).dropDuplicates(["seqid", "start", "end", "strand", "name", "subclass"])
    return kept, statistics.rollup_union(kept, ["class", "subclass"], ["seqid"], bin_width)


def genes_clear_of_repeats(cds: DataFrame, hits: DataFrame, most: float = 0.6, ignore: Sequence[str] = IGNORED_REPEATS, ignore_unsure: bool = True) -> DataFrame:
    """Gene ids whose coding positions lie in repeats by less than `most`; an explicit 0 is honoured (Q6)."""
    pattern = "^(?:" + "|".join([*ignore, *(UNSURE_REPEATS if ignore_unsure else ())]) + ")$"
    covered = intervals.coverage(cds, hits.filter(~F.col("class").rlike(pattern)), ["seqid"], ["gene_id"])
    return covered.filter(F.col("share") < most).select("gene_id", "share")


def transcript_scores(cds: DataFrame, integrity: DataFrame, intron: float = 0.3, start: float = 0.5, stop: float = 0.5, first_file: float = 0.5) -> DataFrame:
    """(gene_id, transcript_id, score) from coding length, number of parts, completeness of either end, and, where cds has the column file_ord, a bonus for the first file (1)."""
    first = F.max((F.col("file_ord") == 1).cast("int")) if "file_ord" in cds.columns else F.lit(0)
    rows = cds.groupBy("gene_id", "transcript_id").agg(F.sum(F.col("end") - F.col("start") + 1).alias("len"), F.count("*").alias("n"), first.alias("first"))
    ends = F.when(F.col("integrity") == "complete", start + stop).when(F.col("integrity") == "5prime_partial", stop).when(F.col("integrity") == "3prime_partial", start).otherwise(0.0)
    bonus = F.coalesce(ends, F.lit(0.0)) + F.coalesce("first", F.lit(0)) * first_file
    return rows.join(integrity, "transcript_id", "left").select("gene_id", "transcript_id", statistics.model_score(F.col("len"), F.col("n"), intron, bonus).alias("score"))


def without_redundancy(cds: DataFrame, scores: DataFrame, most_overlap: float = 0.3) -> DataFrame:
    """Of genes whose coding parts overlap by over `most_overlap` of either, the best truncated score stays.  Every gene stands for its transcript of the best exact score."""
    best = order.best_per_group(scores, ["gene_id"], [F.desc("score"), F.col("transcript_id")])
    own = cds.join(best.select("transcript_id"), "transcript_id").select("seqid", "strand", "gene_id", "start", "end")
    both = intervals.intersection_length(own, own, ["seqid", "strand"], "gene_id", closed="strict").filter("gene_id < gene_id_r")
    length = own.groupBy("gene_id").agg(F.sum(F.col("end") - F.col("start") + 1).alias("len"))
    pairs = both.join(length, "gene_id").join(length.withColumnsRenamed({"gene_id": "gene_id_r", "len": "len_r"}), "gene_id_r")
    edges = pairs.filter(F.col("covered") / F.least("len", "len_r") > most_overlap).select(F.col("gene_id").alias("u"), F.col("gene_id_r").alias("v"))
    nodes = best.select(F.col("gene_id").alias("id"), (-F.floor("score")).alias("worse"))
    return graph.suppress(nodes, edges, ["worse"]).select(F.col("id").alias("gene_id"))


def utrs(exons: DataFrame, cds: DataFrame) -> DataFrame:
    """what exons have beyond the coding part, named by the side it lies on."""
    span = cds.groupBy("transcript_id").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    numbered = exons.withColumn("exon", F.concat_ws(":", "transcript_id", "start", "end"))
    rows = intervals.subtract(numbered, cds, ["transcript_id"], ["exon"]).join(span, "transcript_id").join(exons.select("transcript_id", "strand", "seqid").distinct(), "transcript_id")
    before = F.col("end") < F.col("first")
    return rows.filter(before | (F.col("start") > F.col("last"))).select("transcript_id", "seqid", "strand", "start", "end", F.when(before == (F.col("strand") == "+"), "five_prime_UTR").otherwise("three_prime_UTR").alias("type"))


def cleaned(cds: DataFrame, exons: DataFrame) -> DataFrame:
    """Coding parts with phases, exons, introns and UTRs of every transcript, without repeated lines."""
    cds, exons = cds.dropDuplicates(["transcript_id", "start", "end"]), exons.dropDuplicates(["transcript_id", "start", "end"])
    sign = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    coding = order.phases(cds.withColumn("len", F.col("end") - F.col("start") + 1), ["transcript_id"], [sign], "len")
    what = ["transcript_id", "seqid", "strand", "start", "end", "type", "phase"]
    none = F.lit(None).cast("int")
    rows = coding.withColumn("type", F.lit("CDS")).select(what).unionByName(exons.withColumns({"type": F.lit("exon"), "phase": none}).select(what))
    rows = rows.unionByName(intervals.introns(exons, ["transcript_id", "seqid", "strand"]).withColumns({"type": F.lit("intron"), "phase": none}).select(what))
    return rows.unionByName(utrs(exons, cds).withColumn("phase", none).select(what))


def read_evidence(reads: DataFrame, least_intron: int = 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of alignments (qname, flag, rname, pos, cigar, strand) the blocks, the depth runs and the introns with their read counts."""
    rows = reads.filter(S.primary(F.col("flag"), F.col("cigar"))).select("qname", F.col("rname").alias("seqid"), "strand", F.explode(S.alignment_blocks(F.col("pos"), F.col("cigar"))).alias("b")).select("qname", "seqid", "strand", "b.start", "b.end", "b.kind")
    blocks = rows.filter("kind = 'block'").drop("kind")
    introns = rows.filter(F.col("kind") == "intron").filter(F.col("end") - F.col("start") + 1 >= least_intron).groupBy("seqid", "strand", "start", "end").agg(F.count("*").alias("depth"))
    return blocks, intervals.depth(blocks, ["seqid", "strand"]), introns


def split_runs(runs: DataFrame, share: float = 0.05, least: int = 1, most: int = 10, least_length: int = 100, rounds: int = 50) -> DataFrame:
    """Regions of each island of depth runs, cut where the depth is under a share of the region's greatest (within least..most) until nothing changes; short pieces go."""
    islands = intervals.islands(runs, ["seqid", "strand"], slack=1)

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        runs_ = sorted(zip(pdf.start, pdf.end, pdf.depth, strict=True))
        pieces = [runs_]
        for _ in range(rounds):
            new = []
            for piece in pieces:
                limit = min(most, max(least, int(max(d for _, _, d in piece) * share + 0.5)))
                held: list = []
                for r in piece:
                    if r[2] >= limit and (not held or r[0] == held[-1][1] + 1):
                        held.append(r)
                    else:
                        if held:
                            new.append(held)
                        held = [r] if r[2] >= limit else []
                if held:
                    new.append(held)
            if new == pieces:
                break
            pieces = new
        spans = [(p[0][0], p[-1][1], max(d for _, _, d in p)) for p in pieces if p and p[-1][1] - p[0][0] + 1 >= least_length]
        return pd.DataFrame({"seqid": pdf.seqid.iloc[0], "strand": pdf.strand.iloc[0], "start": [s for s, _, _ in spans], "end": [e for _, e, _ in spans], "most": [m for _, _, m in spans]})

    return islands.groupBy("seqid", "strand", "island").applyInPandas(cut, "seqid string, strand string, start long, end long, most long")


def compatible_introns(introns: DataFrame) -> DataFrame:
    """Of introns that overlap or touch, the deepest stays."""
    rows = introns.withColumn("id", F.concat_ws(":", "seqid", "strand", "start", "end"))
    near = rows.withColumns({"start": F.col("start") - 1})
    pairs = intervals.overlap_join(near, rows, ["seqid", "strand"]).filter("id != id_r").select(F.col("id").alias("u"), F.col("id_r").alias("v"))
    kept = graph.suppress(rows.select("id", (-F.col("depth")).alias("shallow")), pairs, ["shallow"])
    return rows.join(kept.select("id"), "id", "left_semi").drop("id")


def splicing_evidence(genes: DataFrame, model_introns: DataFrame, introns: DataFrame) -> DataFrame:
    """Introns inside genes as common, reference or evidence, with the share of their depth among overlapping introns of the gene."""
    inside = intervals.contained_join(genes, introns, ["seqid", "strand"]).select("gene_id", "seqid", "strand", F.col("start_r").alias("start"), F.col("end_r").alias("end"), F.col("depth_r").alias("depth"))
    key = ["gene_id", "start", "end"]
    rows = inside.join(model_introns.select(*key).distinct().withColumn("known", F.lit(True)), key, "full_outer")
    rows = rows.withColumn("found_in", F.when(F.col("depth").isNull(), "reference").when(F.col("known"), "common").otherwise("evidence")).drop("known")
    found = rows.filter("depth is not null").withColumn("id", F.concat_ws(":", *key))
    rivals = intervals.overlap_join(found, found.select("gene_id", "start", "end", "depth"), ["gene_id"]).groupBy("id").agg(F.sum("depth_r").alias("all"))
    ratio = found.join(rivals, "id").select(*key, (F.col("depth") / F.col("all")).alias("ratio"))
    return rows.join(ratio, key, "left")


def to_genome(exons: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans (transcript_id, id, start, end) on transcripts as pieces on the genome, in order of transcription."""
    sign = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    n = (F.col("end") - F.col("start") + 1).cast("long")
    before = F.coalesce(F.sum(n).over(W.partitionBy("transcript_id").orderBy(sign).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = exons.select("transcript_id", "seqid", "strand", F.col("start").alias("es"), F.col("end").alias("ee"), before.alias("before"), n.alias("n"))
    rows = placed.join(spans, "transcript_id").withColumns({"a": F.greatest("start", F.col("before") + 1), "b": F.least("end", F.col("before") + F.col("n"))}).filter("a <= b")
    low = F.when(F.col("strand") == "-", F.col("ee") - (F.col("b") - F.col("before") - 1)).otherwise(F.col("es") + F.col("a") - F.col("before") - 1)
    return rows.select("transcript_id", "id", "seqid", "strand", low.alias("g_start"), (low + F.col("b") - F.col("a")).alias("g_end"), (F.col("a") - F.col("start")).alias("offset"))


def chained(hsps: DataFrame, most_gap: int = 50_000, most_overlap: float = 0.5) -> DataFrame:
    """High-scoring pairs of one query, target and direction chained in order of the target: the next one joins if it follows within `most_gap` and overlaps the chain's last on the query by at most `most_overlap`.  Order-dependent, so each group is one function call."""
    rows = hsps.withColumn("minus", F.col("tstart") > F.col("tend")).withColumns({"t1": F.least("tstart", "tend"), "t2": F.greatest("tstart", "tend")})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t1", "t2", "qstart", "qend"], kind="stable")
        number, last, out = -1, None, []
        for r in pdf.itertuples():
            joins = False
            if last is not None and r.t1 - last.t2 - 1 <= most_gap:
                both = min(r.qend, last.qend) - max(r.qstart, last.qstart) + 1
                forward = r.qstart <= last.qstart if r.minus else r.qstart >= last.qstart
                joins = forward and both <= most_overlap * min(r.qend - r.qstart + 1, last.qend - last.qstart + 1)
            number += not joins
            out.append(number)
            last = r
        return pdf.assign(chain=out)[["query", "target", "minus", "chain", "qstart", "qend", "t1", "t2", "pident", "alnlen", "qlen"]]

    return rows.groupBy("query", "target", "minus").applyInPandas(chain, "query string, target string, minus boolean, chain long, qstart long, qend long, t1 long, t2 long, pident double, alnlen long, qlen long")


def homolog_hits(hsps: DataFrame, least_coverage: float = 0.3, least_identity: float = 0.2, per_species: int = 2, per_region: int = 10) -> DataFrame:
    """Chains with identity and query coverage, at most so many for a species and a region.  Identities are fractions (Q11)."""
    rows = chained(hsps)
    key = ["query", "target", "minus", "chain"]
    covered = intervals.union_length(rows.select(*key, F.col("qstart").alias("start"), F.col("qend").alias("end")), key)
    hits = rows.groupBy(*key).agg(F.min("t1").alias("start"), F.max("t2").alias("end"), F.max("qlen").alias("qlen"), (F.sum(F.col("pident") * F.col("alnlen")) / F.sum("alnlen")).alias("identity")).join(covered, key)
    hits = hits.withColumn("coverage", F.col("covered") / F.col("qlen")).filter((F.col("coverage") >= least_coverage) & (F.col("identity") >= least_identity))
    regions = intervals.islands(hits.withColumnRenamed("target", "seqid"), ["seqid", "minus"], order=["query"]).withColumn("species", S.species(F.col("query")))
    return order.capped(regions, ["species"], ["seqid", "minus", "island"], [F.desc("covered"), F.desc("identity"), F.col("query"), F.col("chain")], per_species, per_region)


def prediction_classes(rows: DataFrame) -> DataFrame:
    """A (whole and no stops inside), else B, C or D by the share of the homolog that is covered."""
    share, clear = F.col("covered") / F.col("homolog_len"), F.col("inner_stops") == 0
    return rows.withColumn("class", F.when((share == 1.0) & clear, "A").when(share >= 0.8, "B").when(share >= 0.4, "C").otherwise("D"))


def ranked_predictions(rows: DataFrame) -> DataFrame:
    """Of predictions of one region and homolog the first by eight keys, then at most five for a region."""
    software = F.when(F.col("software") == "gth", 0).when(F.col("software") == "exonerate", 1).otherwise(2)
    keys = [F.desc("covered"), F.col("inner_stops"), F.desc("cds_len"), F.col("evalue"), F.desc("score"), F.desc("identity"), software, F.col("row")]
    return order.best_per_group(order.best_per_group(rows, ["region", "homolog"], keys), ["region"], keys, 5)


def selected_orfs(orfs: DataFrame, scores: DataFrame, blast: DataFrame | None = None, pfam: DataFrame | None = None, keep_longer: int = 1_000_000, single_best: bool = False, most_overlap: float = 0.1) -> DataFrame:
    """Open reading frames (id, transcript_id, strand, start, end) worth keeping.

    Kept with homology, or from `keep_longer` positions on, or with a first-frame score over 0 that the other two frames
    of the strand don't reach; of those that overlap by over `most_overlap` of the shorter, on either strand, the first by
    homology, score and length stays.  single_best: of what then stays, the longest of most homology for each transcript.
    """
    rows = orfs.withColumn("len", F.col("end") - F.col("start") + 1).join(scores, "id", "left").withColumn("homology", F.lit(0))
    for hits in (blast, pfam):
        if hits is not None:
            rows = rows.join(hits.select(F.col("query").alias("id")).distinct().withColumn("_hit", F.lit(1)), "id", "left").withColumn("homology", F.col("homology") + F.coalesce("_hit", F.lit(0))).drop("_hit")
    coding = (F.col("score_1") > 0) & (F.col("score_1") > F.greatest("score_2", "score_3"))
    rows = rows.filter((F.col("homology") > 0) | (F.col("len") >= keep_longer) | F.coalesce(coding, F.lit(False)))
    pairs = intervals.self_overlaps(rows.select("transcript_id", "id", "start", "end", "len"), ["transcript_id"], "id")
    both = intervals.nucleotides_in_common(F.col("start"), F.col("end"), F.col("start_r"), F.col("end_r"))
    edges = pairs.filter(both > most_overlap * F.least("len", "len_r")).select(F.col("id").alias("u"), F.col("id_r").alias("v"))
    nodes = rows.select("id", (-F.col("homology")).alias("a"), (-F.coalesce("score_1", F.lit(0.0))).alias("b"), (-F.col("len")).alias("c"))
    kept = rows.join(graph.suppress(nodes, edges, ["a", "b", "c"]).select("id"), "id", "left_semi")
    return order.best_per_group(kept, ["transcript_id"], [F.desc("homology"), F.desc("len"), F.col("id")]) if single_best else kept


def without_eclipsed(orfs: DataFrame) -> DataFrame:
    """Distinct frames that no longer one on their transcript and strand contains strictly."""
    rows = orfs.dropDuplicates(["transcript_id", "strand", "start", "end"])
    pairs = intervals.overlap_join(rows, rows.select("transcript_id", "strand", "start", "end"), ["transcript_id", "strand"])
    inner = pairs.filter("start_r <= start and end <= end_r and end_r - start_r > end - start").select("id").distinct()
    return rows.join(inner, "id", "left_anti")


def blast_hits(hsps: DataFrame, lengths: DataFrame | None = None, most_evalue: float = 1e-5, least_identity: float = 0.0, least_coverage: float = 0.0, top_share: float | None = None, most_hits: int | None = None) -> DataFrame:
    """A row for each query and subject: identity over all positions, union coverage of both, best score; exactly most_hits of them (Q10)."""
    key = ["query", "subject"]
    rows = hsps.filter(F.col("evalue") <= most_evalue)
    side = lambda a, b, name: intervals.union_length(intervals.normalised(rows.select(*key, F.col(a).alias("start"), F.col(b).alias("end"))), key).withColumnRenamed("covered", name)
    hits = rows.groupBy(*key).agg((F.sum(F.col("pident") * F.col("length")) / F.sum("length")).alias("identity"), F.max("bitscore").alias("bitscore"), F.min("evalue").alias("evalue"))
    hits = hits.join(side("qstart", "qend", "q_covered"), key).join(side("sstart", "send", "s_covered"), key)
    if lengths is not None:
        hits = hits.join(lengths.select(F.col("id").alias("query"), F.col("len").alias("qlen")), "query").withColumn("coverage", F.col("q_covered") / F.col("qlen")).filter(F.col("coverage") >= least_coverage)
    hits = hits.filter(F.col("identity") >= least_identity)
    if top_share is not None:
        hits = order.band(hits, ["query"], "bitscore", 1 - top_share)
    return hits if most_hits is None else order.best_per_group(hits, ["query"], [F.desc("bitscore"), F.col("evalue"), F.col("subject")], most_hits)


def domain_hits(rows: DataFrame, long_cut: float = 1e-5, short_cut: float = 1e-3, long_from: int = 80, least_coverage: float = 0.25) -> DataFrame:
    """Domains of genes with the share of the model that all their matches cover, by the E-value of the whole sequence; models from `long_from` on have a stricter limit."""
    key = ["query", "target"]
    covered = intervals.union_length(rows.select(*key, F.col("hmm_from").alias("start"), F.col("hmm_to").alias("end")), key)
    best = rows.groupBy(*key).agg(F.min("evalue").alias("evalue"), F.max("score").alias("score"), F.max("tlen").alias("tlen"), F.min("description").alias("description"))
    hits = best.join(covered, key).withColumn("coverage", F.col("covered") / F.col("tlen"))
    return hits.filter((F.col("coverage") >= least_coverage) & (F.col("evalue") <= short_cut) & ((F.col("tlen") < long_from) | (F.col("evalue") <= long_cut)))


def validated(transcripts: DataFrame, domains: DataFrame, hits: DataFrame, domain: tuple[float, float] = (1e-7, 0.5), hit: tuple[float, float, float] = (1e-12, 0.6, 0.6), both_required: bool = False) -> DataFrame:
    """Gene ids with a transcript that has rows in both tables; one with rows in one table only needs a strict row there.

    domains: (query, evalue, coverage), at most domain[0] and at least domain[1]; hits: (query, evalue, identity, coverage,
    s_coverage), at most hit[0], at least hit[1], and both coverages at least hit[2].
    """
    a = domains.groupBy(F.col("query").alias("transcript_id")).agg(F.max((F.col("evalue") <= domain[0]) & (F.col("coverage") >= domain[1])).alias("by_domain"))
    strict = (F.col("evalue") <= hit[0]) & (F.col("identity") >= hit[1]) & (F.least("coverage", "s_coverage") >= hit[2])
    b = hits.groupBy(F.col("query").alias("transcript_id")).agg(F.max(strict).alias("by_hit"))
    in_both = F.col("by_domain").isNotNull() & F.col("by_hit").isNotNull()
    good = a.join(b, "transcript_id", "full_outer").filter(in_both if both_required else in_both | F.coalesce("by_domain", "by_hit"))
    return good.join(transcripts.select("transcript_id", "gene_id"), "transcript_id").select("gene_id").distinct()


def _thresholds(models: DataFrame, p: float) -> tuple[float | None, float | None, int]:
    """The elements floor(n * p) of cds_num and cds_len, and n."""
    rows = models.filter("cds_num > 0")
    return order.element_at(rows, "cds_num", p), order.element_at(rows, "cds_len", p), rows.count()


def reliable(models: DataFrame, p: float = 0.5, least_hint: float = 40.0, least_num: int | None = None, least_len: int | None = None) -> DataFrame:
    """Models with `verdict`: keyword (kept for its keyword), augustus (too few exon hints), length or number (too short, too few parts; in this order), or other (kept).

    models: (keyword boolean, augustus boolean, exon_hint_ratio in percent or null, cds_num, cds_len).  Thresholds that
    aren't given are the elements floor(n * p) of models with the keyword, 1 part and 300 positions if these are under 10.
    """
    num, length, n = _thresholds(models.filter("keyword"), p)
    num = least_num if least_num is not None else 1 if n < 10 else num
    length = least_len if least_len is not None else 300 if n < 10 else length
    few = F.col("augustus") & (F.col("exon_hint_ratio") < least_hint)
    return models.withColumn("verdict", F.when(F.col("keyword"), "keyword").when(few, "augustus").when(F.col("cds_len") < length, "length").when(F.col("cds_num") < num, "number").otherwise("other"))


def hint_sources(models: DataFrame, p: float = 0.333) -> DataFrame:
    """models with `src`: M (excellent and complete, or filled), E (coding length and number of parts at the elements floor(n * p) of those or over), else P.  models: (excellent, filled boolean, integrity, cds_num, cds_len)."""
    sure = F.coalesce((F.col("excellent") & (F.col("integrity") == "complete")) | F.col("filled"), F.lit(False))
    num, length, _ = _thresholds(models.filter(sure), p)
    enough = (F.col("cds_num") >= F.lit(num)) & (F.col("cds_len") >= F.lit(length)) if num is not None else F.lit(True)  # no threshold, none to miss
    return models.withColumn("src", F.when(sure, "M").when(enough, "E").otherwise("P"))


def hints(models: DataFrame, parts: DataFrame, margin: int = 20) -> DataFrame:
    """Exact intron hints; exact CDS hints for models of source M, trimmed CDSpart hints for others; start and stop hints of three positions for M, start for 5prime_partial and stop for 3prime_partial."""
    rows = parts.join(hint_sources(models).select("gene_id", "src", "integrity"), "gene_id")
    what = ["gene_id", "seqid", "strand", "type", "start", "end", "src"]
    cds = rows.filter("type = 'CDS'")
    coding = cds.filter("src = 'M'").unionByName(intervals.trimmed(cds.filter("src != 'M'"), margin).withColumn("type", F.lit("CDSpart")))
    spliced = intervals.introns(cds, ["gene_id", "transcript_id", "seqid", "strand", "src"]).withColumn("type", F.lit("intron"))
    low = order.best_per_group(cds, ["gene_id"], [F.col("start"), F.col("end"), F.col("transcript_id")]).withColumn("low", F.lit(True))
    high = order.best_per_group(cds, ["gene_id"], [F.desc("start"), F.desc("end"), F.col("transcript_id")]).withColumn("low", F.lit(False))
    ends = low.unionByName(high).filter(F.col("end") - F.col("start") >= 2).withColumn("type", F.when(F.col("low") == (F.col("strand") == "+"), "start").otherwise("stop"))
    ends = ends.filter((F.col("src") == "M") | F.concat_ws(":", "integrity", "type").isin("5prime_partial:start", "3prime_partial:stop"))
    ends = ends.withColumns({"start": F.when(F.col("low"), F.col("start")).otherwise(F.col("end") - 2), "end": F.when(F.col("low"), F.col("start") + 2).otherwise(F.col("end"))})
    return coding.select(what).unionByName(spliced.select(what)).unionByName(ends.select(what)).distinct()


def hint_support(cds: DataFrame, introns: DataFrame, evidence_exons: DataFrame, evidence_introns: DataFrame) -> DataFrame:
    """For each gene the share of coding positions with evidence and the number of introns that evidence has exactly, percentages rounded half up."""
    covered = intervals.coverage(cds, evidence_exons, ["seqid", "strand"], ["gene_id"])
    key = ["seqid", "strand", "start", "end"]
    found = introns.join(evidence_introns.select(*key).distinct().withColumn("_hit", F.lit(1)), key, "left").groupBy("gene_id").agg(F.count("*").alias("n_introns"), F.count("_hit").alias("n_supported"))
    return covered.join(found, "gene_id", "left").withColumn("percent", F.floor(F.col("share") * 10000 + 0.5) / 100).fillna(0, ["n_introns", "n_supported"])


def gene_accuracy(reference: DataFrame, predicted: DataFrame) -> DataFrame:
    """Genes of the reference of which some transcript has the coding parts of a predicted one, but for the place of its start codon (the low end of the first part, or the high end of the last on the minus strand).  Both: (gene_id, seqid, strand, start, end), with transcript_id if genes have several."""
    def chains(df: DataFrame) -> DataFrame:
        t = F.col("transcript_id") if "transcript_id" in df.columns else F.lit("")
        rows = df.groupBy("gene_id", t.alias("t"), "seqid", "strand").agg(F.array_sort(F.collect_set(F.struct(F.col("start").alias("a"), F.col("end").alias("b")))).alias("ps"))
        open_ = lambda p, k: F.struct(F.when((F.col("strand") == "-") | (k > 0), p["a"]).alias("a"), F.when((F.col("strand") != "-") | (k < F.size("ps") - 1), p["b"]).alias("b"))
        return rows.select("gene_id", "seqid", "strand", F.transform("ps", open_).alias("chain"))

    own, other = chains(reference), chains(predicted).select("seqid", "strand", "chain").distinct()
    met = own.join(other, ["seqid", "strand", "chain"], "left_semi").agg(F.count_distinct("gene_id").alias("tp"))
    counts = reference.agg(F.count_distinct("gene_id").alias("standard")).join(predicted.agg(F.count_distinct("gene_id").alias("predicted"))).join(met)  # a row each
    return counts.select("standard", "predicted", "tp", F.try_divide("tp", "standard").alias("sensitivity"), F.try_divide("tp", "predicted").alias("specificity"))


def accuracy(reference: DataFrame, predicted: DataFrame) -> DataFrame:
    """Sensitivity and specificity of coding positions, coding parts and genes."""
    base = lambda df: intervals.union_length(df, ["seqid", "strand"], 100_000)
    n = lambda df: F.coalesce(F.sum("covered"), F.lit(0)).cast("long")
    # Positions in both: a + b - (a or b).
    a, b, both = (base(x).agg(n(x).alias("n")).first()["n"] for x in (reference, predicted, reference.select("seqid", "strand", "start", "end").unionByName(predicted.select("seqid", "strand", "start", "end"))))
    spark = reference.sparkSession
    rows = statistics.set_accuracy(reference, predicted, ["seqid", "strand", "start", "end"]).withColumn("level", F.lit("part"))
    rows = rows.unionByName(gene_accuracy(reference, predicted).withColumn("level", F.lit("gene")))
    position = spark.createDataFrame([(a, b, a + b - both, (a + b - both) / a if a else None, (a + b - both) / b if b else None, "position")], "standard long, predicted long, tp long, sensitivity double, specificity double, level string")
    return rows.unionByName(position)


def model_statistics(genes: DataFrame, cds: DataFrame, exons: DataFrame) -> DataFrame:
    """Number, sum, mean and upper median of gene, coding, exon, intron and intergenic lengths."""
    length = F.col("end") - F.col("start") + 1
    rows = genes.select(F.lit("gene").alias("what"), length.alias("n"))
    rows = rows.unionByName(cds.groupBy("transcript_id").agg(F.sum(length).alias("n")).select(F.lit("cds").alias("what"), "n"))
    rows = rows.unionByName(exons.select(F.lit("exon").alias("what"), length.alias("n")))
    rows = rows.unionByName(intervals.introns(exons, ["transcript_id"]).select(F.lit("intron").alias("what"), length.alias("n")))
    rows = rows.unionByName(intervals.gaps(genes, ["seqid"], ["gene_id"]).filter("gap > 0").select(F.lit("intergenic").alias("what"), F.col("gap").alias("n")))
    return rows.groupBy("what").agg(F.count("*").alias("count"), F.sum("n").alias("sum"), F.avg("n").alias("mean")).join(order.medians_of_few(rows, "what", "n"), "what")


def routed(transcripts: DataFrame, coding_reasons: DataFrame) -> DataFrame:
    """Genes as lncRNA (all transcripts without coding reason), low (all with other reasons) or coding."""
    rows = transcripts.join(coding_reasons.groupBy("transcript_id").agg(F.max(F.col("reason") == "noncoding").alias("nc"), F.count("*").alias("n")), "transcript_id", "left")
    each = rows.groupBy("gene_id").agg(F.bool_and(F.coalesce("nc", F.lit(False))).alias("all_nc"), F.bool_and(F.coalesce("n", F.lit(0)) > 0).alias("all_bad"))
    return each.select("gene_id", F.when(F.col("all_nc"), "lncRNA").when(F.col("all_bad"), "low").otherwise("coding").alias("route"))


def combined(sources: DataFrame, priority: Sequence[str] = ("augustus", "transfrag", "homolog"), least_overlap: int = 30) -> DataFrame:
    """Models that overlap by over `least_overlap` positions form a region; in each region the models of its first source stay."""
    rows = intervals.islands(sources, ["seqid", "strand"], slack=-least_overlap - 1, order=["gene_id"])
    rank = F.array_position(F.array(*map(F.lit, priority)), F.col("source"))
    rows = rows.withColumn("_rank", F.when(rank > 0, rank).otherwise(len(priority) + 1))
    rows = rows.withColumn("_first", F.min("_rank").over(W.partitionBy("seqid", "strand", "island")))
    return rows.filter("_rank = _first").drop("_rank", "_first", "island")


def extended(df: DataFrame, seq: str, start: str, end: str, code: int = 1, most: int = 3000) -> DataFrame:
    """F8 on the strand that seq is written on: `new_start`, at the furthest start codon in frame before `start` with no stop between, and `new_end`, at the first stop in frame from `end` on; null where there is none within `most`."""
    up = F.substr(F.col(seq), F.greatest(F.lit(1), F.col(start) - most).cast("int"), F.least(F.lit(most), F.col(start) - 1).cast("int"))
    trimmed = F.substr(up, (F.length(up) % 3 + 1).cast("int"), F.length(up))
    before = F.reverse(S.codons(F.upper(trimmed)))
    closed = F.array_position(F.transform(before, lambda c: c.isin(stops(code))), True)
    open_ = F.when(closed > 0, F.slice(before, F.lit(1), (closed - 1).cast("int"))).otherwise(before)
    starts = F.filter(F.transform(open_, lambda c, i: F.when(c == "ATG", i + 1)), lambda i: i.isNotNull())
    after = S.codons(F.upper(F.substr(F.col(seq), (F.col(end) + 1).cast("int"), F.lit(most))))
    stop = F.array_position(F.transform(after, lambda c: c.isin(stops(code))), True)
    return df.withColumn("new_start", (F.col(start) - 3 * F.array_max(starts)).cast("long")).withColumn("new_end", F.when(stop > 0, F.col(end) + 3 * stop).cast("long"))


def ends_filled(models: DataFrame, genome: DataFrame, code: int = 1, most: int = 3000) -> DataFrame:
    """Models (id, seqid, strand, start, end: a coding span in whole codons) with new_start and new_end, forced out to a start and a stop codon in frame on either strand; an end that finds none within `most` keeps its place, and `filled` is false.

    On the minus strand positions are counted from the other end of the reverse complement, and back.
    """
    rows = models.join(genome.select("seqid", F.col("seq").alias("_seq")), "seqid")
    n, minus = F.length("_seq").cast("long"), F.col("strand") == "-"
    turn = lambda a, b: F.when(minus, n - F.col(b) + 1).otherwise(F.col(a))
    rows = rows.withColumns({"_a": turn("start", "end"), "_b": turn("end", "start"), "_s": F.when(minus, S.revcomp(F.col("_seq"))).otherwise(F.upper("_seq"))})
    own_stop = F.substr("_s", (F.col("_b") - 2).cast("int"), F.lit(3)).isin(stops(code))
    own_start = F.substr("_s", F.col("_a").cast("int"), F.lit(3)) == "ATG"
    found = extended(rows, "_s", "_a", "_b", code, most)
    a = F.when(own_start, F.col("_a")).otherwise(F.col("new_start"))
    b = F.when(own_stop, F.col("_b")).otherwise(F.col("new_end"))
    found = found.withColumns({"filled": a.isNotNull() & b.isNotNull(), "_x": F.coalesce(a, F.col("_a")), "_y": F.coalesce(b, F.col("_b"))})
    back = found.withColumns({"new_start": F.when(minus, n - F.col("_y") + 1).otherwise(F.col("_x")), "new_end": F.when(minus, n - F.col("_x") + 1).otherwise(F.col("_y"))})
    return back.select(*models.columns, "new_start", "new_end", "filled")


def stops_included(parts: DataFrame, genome: DataFrame, code: int = 1) -> DataFrame:
    """coding parts (transcript_id, seqid, strand, start, end, phase) whose last part ends with one stop codon: it takes the next three positions if they are a stop codon that is lacking, and gives back further stop codons at its end.  Parts that don't end a whole codon, and those at a sequence's first positions on the minus strand, stay."""
    key = "transcript_id"
    minus = F.col("strand") == "-"
    way = F.when(minus, -F.col("start")).otherwise(F.col("start"))
    by = W.partitionBy(key).orderBy(way)
    placed = parts.withColumns({"_k": F.row_number().over(by), "_n": F.count("*").over(W.partitionBy(key))})
    ends = placed.groupBy(key).agg(F.max(F.when(F.col("_k") == 1, F.col("phase"))).alias("first"))
    seqs = S.spliced(parts.join(genome, "seqid"), [key]).join(ends, key)
    protein = S.translate(F.substr("seq", (F.coalesce("first", F.lit(0)) + 1).cast("int"), F.length("seq")), code)
    seqs = seqs.select(key, F.length(F.regexp_extract(protein, r"(\*+)$", 1)).alias("_stops"))
    last = placed.filter("_k = _n").select(key, "seqid", "strand", "start", "end", "phase").join(genome.select("seqid", F.col("seq").alias("_g")), "seqid").join(seqs, key)
    whole = (F.col("end") - F.col("start") + 1 - F.coalesce("phase", F.lit(0))) % 3 == 0
    after = F.when(minus, S.revcomp(F.substr("_g", F.greatest(F.lit(1), F.col("start") - 3).cast("int"), F.lit(3)))).otherwise(F.upper(F.substr("_g", (F.col("end") + 1).cast("int"), F.lit(3))))
    room = ~minus | (F.col("start") > 3)
    step = F.when(~(whole & room), 0).when(F.col("_stops") > 1, -3 * (F.col("_stops") - 1)).when((F.col("_stops") == 0) & after.isin(stops(code)), 3).otherwise(0)
    changed = placed.join(last.select(key, step.cast("long").alias("_step")), key)
    moved = F.when(F.col("_k") == F.col("_n"), F.col("_step")).otherwise(0)
    return changed.withColumns({"start": F.when(minus, F.col("start") - moved).otherwise(F.col("start")), "end": F.when(minus, F.col("end")).otherwise(F.col("end") + moved)}).select(parts.columns)



def supported(models: DataFrame, strict: bool = False, least_percent: float = 10.0, least_introns: int = 1, least_ratio: float = 0.01) -> DataFrame:
    """Models whose transcript support (percent) and, strictly, or else, whose intron support (number and ratio) reach the limits.  models: (transcript_percent, n_introns, intron_ratio)."""
    a = F.col("transcript_percent") >= least_percent
    b = (F.col("n_introns") >= least_introns) & (F.col("intron_ratio") >= least_ratio)
    return models.filter(a & b if strict else a | b)


def better_evidence(evidence: DataFrame, reference: DataFrame, overlap: float, ratios: tuple[float, float, float, float]) -> DataFrame:
    """(gene_id, why) of evidence genes to be taken: `alone` (no coding position in a reference gene), `little` (in each by under `overlap` of their coding length), `larger` (span or coding length over ratios[0] or ratios[1] times that of a reference gene that they overlap by that much), `complete` (over ratios[2] or ratios[3], and complete).

    evidence: coding parts (gene_id, seqid, strand, start, end, complete boolean); reference: the same without `complete`.
    """
    def sizes(parts: DataFrame) -> DataFrame:
        n = intervals.union_length(parts, ["gene_id"]).withColumnRenamed("covered", "len")
        return n.join(parts.groupBy("gene_id").agg((F.max("end") - F.min("start") + 1).alias("span")), "gene_id")

    key = ["seqid", "strand"]
    both = intervals.intersection_length(evidence.select(*key, "gene_id", "start", "end").distinct(), reference.select(*key, "gene_id", "start", "end").distinct(), key, "gene_id", closed="strict")
    own = sizes(evidence).join(evidence.groupBy("gene_id").agg(F.bool_or("complete").alias("complete")), "gene_id")
    pairs = both.join(own, "gene_id").join(sizes(reference).select(F.col("gene_id").alias("gene_id_r"), F.col("len").alias("len_r"), F.col("span").alias("span_r")), "gene_id_r")
    much = F.col("covered") / F.col("len") >= overlap
    larger = lambda a, b: (F.col("span") > F.col("span_r") * a) | (F.col("len") > F.col("len_r") * b)
    found = pairs.groupBy("gene_id").agg(
        F.max(F.col("covered") / F.col("len")).alias("ratio"), F.bool_or(much & larger(*ratios[:2])).alias("larger"), F.bool_or(much & larger(*ratios[2:]) & F.col("complete")).alias("longer"),
    )
    rows = own.select("gene_id").join(found, "gene_id", "left")
    why = F.when(F.coalesce("ratio", F.lit(0.0)) == 0, "alone").when(F.col("ratio") < overlap, "little").when(F.col("larger"), "larger").when(F.col("longer"), "complete")
    return rows.select("gene_id", why.alias("why")).filter("why is not null")
