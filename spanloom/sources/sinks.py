"""Lines of the formats, ready for write.text; conversion between them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sequences import revcomp, spliced, translate


def line(*cells: Column | str) -> Column:
    return F.concat_ws("\t", *[F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(".")) for c in cells])


def attribute_text(attrs: Column, first: Sequence[str] = ("ID", "Parent", "Name")) -> Column:
    """A map as k=v;k=v, the usual keys first, the others by name."""
    keys = F.concat(F.array_intersect(F.array(*map(F.lit, first)), F.map_keys(attrs)), F.array_sort(F.array_except(F.map_keys(attrs), F.array(*map(F.lit, first)))))
    return F.array_join(F.transform(keys, lambda k: F.concat_ws("=", k, attrs[k])), ";")


def gff3(genes: DataFrame, transcripts: DataFrame, parts: DataFrame) -> DataFrame:
    """(value) lines, genes by sequence, start, end, strand and id; each followed by its transcripts and their parts, numbered by type in order of transcription."""
    place = genes.select("gene_id", F.col("seqid").alias("g_seq"), F.col("start").alias("g_start"), F.col("end").alias("g_end"), F.col("strand").alias("g_strand"))
    g = genes.select("gene_id", F.lit("").alias("t"), F.lit(0).alias("depth"), F.lit(0).cast("long").alias("at"), line("seqid", "source", "type", "start", "end", "score", "strand", F.lit("."), attribute_text(F.col("attrs"))).alias("value"))
    t = transcripts.select("gene_id", F.col("transcript_id").alias("t"), F.lit(1), F.lit(0).cast("long"), line("seqid", "source", "type", "start", "end", "score", "strand", F.lit("."), attribute_text(F.col("attrs"))))
    sign = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    numbered = parts.withColumn("k", F.row_number().over(W.partitionBy("transcript_id", "type").orderBy(sign)))
    ident = F.concat(F.lit("ID="), F.col("transcript_id"), F.lit("."), F.col("type"), F.col("k"), F.lit(";Parent="), F.col("transcript_id"))
    p = numbered.select("gene_id", F.col("transcript_id"), F.lit(2), sign.cast("long"), line("seqid", F.lit("."), "type", "start", "end", F.lit("."), "strand", "phase", ident))
    rows = g.union(t).union(p).join(place, "gene_id")
    return rows.orderBy("g_seq", "g_start", "g_end", "g_strand", "gene_id", "t", "depth", "at", "value").select("value")


def fasta(df: DataFrame, width: int = 80, ident: str = "seq_id", seq: str = "seq") -> DataFrame:
    """K2."""
    body = F.regexp_replace(F.col(seq), f"(.{{{width}}})(?=.)", "$1\n")
    return df.select(F.concat(F.lit(">"), F.col(ident), F.lit("\n"), body).alias("value"))


def gtf(parts: DataFrame, source: str = "spanloom") -> DataFrame:
    """K4: exon and CDS lines, and start and stop codons of three positions, in pieces where an intron splits them."""
    names = F.concat(F.lit('gene_id "'), F.col("gene_id"), F.lit('"; transcript_id "'), F.col("transcript_id"), F.lit('";'))
    cds = parts.filter("type = 'CDS'")
    sign = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    by = W.partitionBy("transcript_id").orderBy(sign)
    length = (F.col("end") - F.col("start") + 1).cast("long")
    placed = cds.withColumn("before", F.coalesce(F.sum(length).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).withColumn("total", F.sum(length).over(W.partitionBy("transcript_id")))

    def codon(name: str, low: Column, high: Column) -> DataFrame:
        a, b = F.greatest(low, F.col("before")), F.least(high, F.col("before") + length - 1)
        piece = placed.withColumns({"a": a - F.col("before"), "b": b - F.col("before")}).filter("a <= b")
        start = F.when(F.col("strand") == "-", F.col("end") - F.col("b")).otherwise(F.col("start") + F.col("a"))
        return piece.withColumns({"s": start, "type": F.lit(name)}).withColumn("e", F.col("s") + F.col("b") - F.col("a")).select(*[c for c in parts.columns if c not in ("start", "end")], F.col("s").alias("start"), F.col("e").alias("end"))

    rows = parts.filter(F.col("type").isin("CDS", "exon")).unionByName(codon("start_codon", F.lit(0), F.lit(2))).unionByName(codon("stop_codon", F.col("total") - 3, F.col("total") - 1))
    return rows.orderBy("seqid", "gene_id", "transcript_id", "start", "type").select(line("seqid", F.lit(source), "type", "start", "end", F.lit("."), "strand", "phase", names).alias("value"))


def models_from_gtf(features: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """K3: genes, transcripts and parts from GTF lines; spans are those of their parts."""
    parts = features.filter(F.col("type").isin("CDS", "exon")).filter("gene_id is not null and transcript_id is not null").dropDuplicates(["transcript_id", "type", "start", "end"])

    def spans(keys: Sequence[str], kind: str, attrs: Column) -> DataFrame:
        rows = parts.groupBy(*keys, "seqid", "strand").agg(F.min("source").alias("source"), F.min("start").alias("start"), F.max("end").alias("end"))
        return rows.withColumns({"type": F.lit(kind), "score": F.lit("."), "attrs": attrs})

    genes = spans(["gene_id"], "gene", F.create_map(F.lit("ID"), F.col("gene_id")))
    transcripts = spans(["gene_id", "transcript_id"], "mRNA", F.create_map(F.lit("ID"), F.col("transcript_id"), F.lit("Parent"), F.col("gene_id")))
    return genes, transcripts, parts.select("transcript_id", "gene_id", "seqid", "type", "start", "end", "strand", "phase")


def bed12(parts: DataFrame) -> DataFrame:
    """K5: a line for each transcript, exons as blocks, CDS as the thick part."""
    exons = parts.filter("type = 'exon'").groupBy("transcript_id", "seqid", "strand").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("bs"))
    thick = parts.filter("type = 'CDS'").groupBy("transcript_id").agg(F.min("start").alias("cs"), F.max("end").alias("ce"))
    rows = exons.join(thick, "transcript_id", "left").withColumns({"s": F.col("bs")[0]["start"], "e": F.array_max(F.transform("bs", lambda b: b["end"]))})
    sizes, starts = F.array_join(F.transform("bs", lambda b: b["end"] - b["start"] + 1), ","), F.array_join(F.transform("bs", lambda b: b["start"] - F.col("s")), ",")
    return rows.orderBy("seqid", "s", "transcript_id").select(line("seqid", F.col("s") - 1, "e", "transcript_id", F.lit(0), "strand", F.coalesce(F.col("cs") - 1, F.col("s") - 1), F.coalesce("ce", F.col("s") - 1), F.lit(0), F.size("bs"), sizes, starts).alias("value"))


def sequences(parts: DataFrame, genome: DataFrame, kind: str = "CDS", code: int = 1) -> DataFrame:
    """K6: (seq_id, seq) of transcripts: spliced CDS or exons, or proteins."""
    own = parts.filter(F.col("type") == ("exon" if kind == "cDNA" else "CDS"))
    joined = own.join(genome.select(F.col("seq_id").alias("seqid"), "seq"), "seqid")
    rows = spliced(joined, ["transcript_id"])
    if kind == "protein":
        rows = rows.withColumn("seq", translate(F.col("seq"), code, ("ATG",)))
    return rows.select(F.col("transcript_id").alias("seq_id"), "seq")


def alignment_gff3(parts: DataFrame, source: str = "spanloom") -> DataFrame:
    """Exon lines with the place of each exon in its transcript."""
    sign = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    n = (F.col("end") - F.col("start") + 1).cast("long")
    before = F.coalesce(F.sum(n).over(W.partitionBy("transcript_id").orderBy(sign).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = parts.filter("type = 'exon'").withColumn("before", before)
    target = F.concat(F.lit("ID="), F.col("transcript_id"), F.lit(";Target="), F.concat_ws(" ", "transcript_id", F.col("before") + 1, F.col("before") + n))
    return rows.orderBy("seqid", "transcript_id", sign).select(line("seqid", F.lit(source), F.lit("cDNA_match"), "start", "end", F.lit("."), "strand", F.lit("."), target).alias("value"))


def gene_sequences(genes: DataFrame, genome: DataFrame) -> DataFrame:
    """K6: the genes' own letters."""
    rows = genes.join(genome.select(F.col("seq_id").alias("seqid"), "seq"), "seqid")
    piece = F.substr("seq", F.col("start").cast("int"), (F.col("end") - F.col("start") + 1).cast("int"))
    return rows.select(F.col("gene_id").alias("seq_id"), F.when(F.col("strand") == "-", revcomp(piece)).otherwise(piece).alias("seq"))


def by_class(df: DataFrame, path: str, column: str = "class") -> None:
    """One folder for each class (or sequence and strand), written in one pass."""
    df.write.partitionBy(column).parquet(path)
