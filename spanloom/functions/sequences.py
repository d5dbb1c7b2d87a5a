"""Scalar functions on nucleotide strings, alignments and names, as column expressions.

Codons are cut with one regular expression, so a sequence is walked once however long it is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .genetic_code import stops, table

STARTS = ("ATG",)


def revcomp(seq: Column, keep_case: bool = False) -> Column:
    """reverse complement; N stays.  By default lower case becomes upper."""
    return F.reverse(F.translate(seq, "ATCGNatcgn", "TAGCNtagcn" if keep_case else "TAGCNTAGCN"))


def codons(seq: Column, frame: int = 0) -> Column:
    """Whole codons from position `frame` on; what is left over at the end is dropped."""
    return F.regexp_extract_all(F.substring(seq, frame + 1, 2**31 - 1), F.lit("..."), F.lit(0))


def _code(number: int) -> Column:
    return F.create_map(*[F.lit(x) for pair in sorted(table(number).items()) for x in pair])


def translate(seq: Column, code: int = 1, starts: Sequence[str] = (), frame: int = 0) -> Column:
    """amino acids; unknown codons are X.  A first codon among `starts` is M."""
    amino = F.transform(codons(F.upper(seq), frame), lambda c: F.coalesce(F.try_element_at(_code(code), c), F.lit("X")))
    protein = F.array_join(amino, "")
    if starts:
        first = F.upper(F.substring(seq, frame + 1, 3)).isin(list(starts))
        protein = F.when(first, F.concat(F.lit("M"), F.substring(protein, 2, 2**31 - 1))).otherwise(protein)
    return protein


def integrity(seq: Column, code: int = 1, starts: Sequence[str] = STARTS) -> Column:
    """complete, 5prime_partial (no start), 3prime_partial (no stop) or internal."""
    first = F.upper(F.substring(seq, 1, 3)).isin(list(starts))
    last = F.upper(F.right(seq, F.lit(3))).isin(stops(code)) & (F.length(seq) >= 3)
    return F.when(first & last, "complete").when(last, "5prime_partial").when(first, "3prime_partial").otherwise("internal")


def internal_stops(seq: Column, code: int = 1) -> Column:
    """stop codons in frame but for the last codon."""
    c = codons(F.upper(seq))
    return F.size(F.filter(F.slice(c, F.lit(1), F.greatest(F.lit(0), F.size(c) - 1)), lambda x: x.isin(stops(code))))


def spliced(parts: DataFrame, keys: Sequence[str], seq: str = "seq", strand: str = "strand") -> DataFrame:
    """(keys, seq) with each row's slice [start, end] of its sequence joined in order, reversed on the minus strand."""
    piece = F.substr(F.col(seq), F.col("start").cast("int"), (F.col("end") - F.col("start") + 1).cast("int"))
    rows = parts.groupBy(*keys, strand).agg(F.array_sort(F.collect_list(F.struct("start", piece.alias("p")))).alias("ps"))
    joined = F.array_join(F.transform("ps", lambda x: x["p"]), "")
    return rows.select(*keys, F.when(F.col(strand) == "-", revcomp(joined)).otherwise(joined).alias("seq"))


def orfs(df: DataFrame, ident: str, seq: str, least_codons: int = 100, code: int = 1, starts: Sequence[str] = STARTS, both_strands: bool = True) -> DataFrame:
    """(id, strand, frame, start, end, orf) of open reading frames in three or six frames.

    A frame is cut at its stops; a piece runs from its first start codon (from its first codon, where the
    sequence's own start is open) to its stop (or the sequence's end).  Positions are 1-based on the strand.
    """
    strands = [("+", F.upper(F.col(seq)))] + ([("-", revcomp(F.col(seq)))] if both_strands else [])
    frames = F.array(*[F.struct(F.lit(s).alias("strand"), F.lit(f).alias("frame"), codons(x, f).alias("codons")) for s, x in strands for f in range(3)])
    rows = df.select(ident, F.explode(frames).alias("f")).select(ident, "f.strand", "f.frame", "f.codons").filter(F.size("codons") > 0)
    ends = F.concat(F.filter(F.transform("codons", lambda c, i: F.when(c.isin(stops(code)), i)), lambda i: i.isNotNull()), F.array(F.size("codons")))
    rows = rows.withColumn("ends", F.array_distinct(ends)).select(ident, "strand", "frame", "codons", F.posexplode("ends").alias("k", "stop"), F.col("ends").alias("all_ends"))
    begin = F.when(F.col("k") == 0, 0).otherwise(F.get("all_ends", F.col("k") - 1) + 1)
    rows = rows.withColumn("begin", begin).withColumn("piece", F.slice("codons", F.col("begin") + 1, F.greatest(F.lit(0), F.col("stop") - F.col("begin"))))
    first = F.array_position(F.transform("piece", lambda c: c.isin(list(starts))), True)
    offset = F.when(F.col("first") > 0, F.col("first") - 1).when(F.col("k") == 0, 0)
    rows = rows.withColumn("first", first).withColumn("offset", offset).filter("offset is not null")
    closed = (F.col("stop") < F.size("codons")).cast("int")
    rows = rows.withColumn("n", F.size("piece") - F.col("offset") + closed).filter(F.col("n") - closed >= least_codons)
    start = F.col("frame") + 3 * (F.col("begin") + F.col("offset")) + 1
    return rows.select(ident, "strand", "frame", start.cast("long").alias("start"), (start + 3 * F.col("n") - 1).cast("long").alias("end"), F.array_join(F.slice("codons", (F.col("begin") + F.col("offset") + 1).cast("int"), F.col("n").cast("int")), "").alias("orf"))


def cigar_operations(cigar: Column) -> Column:
    """(n, op) of a CIGAR string."""
    return F.transform(F.regexp_extract_all(cigar, F.lit("([0-9]+[MIDNSHP=X])"), F.lit(1)), lambda x: F.struct(F.substr(x, F.lit(1), F.length(x) - 1).cast("long").alias("n"), F.right(x, F.lit(1)).alias("op")))


def alignment_blocks(pos: Column, cigar: Column) -> Column:
    """(start, end, kind) of aligned blocks (M, =, X, D) and introns (N) on the reference; the span comes from the whole string."""
    step = lambda s, x: F.struct(
        (s["at"] + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["n"]).otherwise(0)).alias("at"),
        F.when(x["op"].isin("M", "D", "N", "=", "X"), F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), (s["at"] + x["n"] - 1).alias("end"), F.when(x["op"] == "N", "intron").otherwise("block").alias("kind"))))).otherwise(s["out"]).alias("out"),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
    return F.aggregate(cigar_operations(cigar), F.struct(pos.cast("long").alias("at"), none.alias("out")), step, lambda s: s["out"])


def primary(flag: Column, cigar: Column) -> Column:
    """Mapped and not secondary."""
    return (cigar != "*") & (flag.bitwiseAND(F.lit(256)) == 0)


def canonical_splice(seq: Column, start: Column, end: Column, strand: Column) -> Column:
    """GT-AG, GC-AG or AT-AC at an intron's ends, on its strand."""
    left, right = F.upper(F.substr(seq, start.cast("int"), F.lit(2))), F.upper(F.substr(seq, (end - 1).cast("int"), F.lit(2)))
    five = F.when(strand == "-", revcomp(right)).otherwise(left)
    three = F.when(strand == "-", revcomp(left)).otherwise(right)
    return F.concat_ws("-", five, three).isin("GT-AG", "GC-AG", "AT-AC")


def masked(seq: Column, ranges: Column, kind: str = "N") -> Column:
    """the sequence with sorted, disjoint ranges (start, end) as N, X or in lower case; cut at the ranges and joined again."""
    cover = lambda s: F.lower(s) if kind == "lower" else F.repeat(F.lit(kind), F.length(s))
    cut = lambda a, n: F.substr(seq, a.cast("int"), n.cast("int"))
    step = lambda s, r: F.struct((r["end"] + 1).cast("long").alias("at"), F.concat(s["out"], F.array(cut(s["at"], r["start"] - s["at"]), cover(cut(r["start"], r["end"] - r["start"] + 1)))).alias("out"))
    return F.aggregate(ranges, F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<string>").alias("out")), step, lambda s: F.concat(F.array_join(s["out"], ""), cut(s["at"], F.length(seq) - s["at"] + 1)))


def base_counts(seq: Column, both_strands: bool = True) -> dict[str, Column]:
    """The number of each base, without a row for each position."""
    up = F.upper(seq)
    n = {b: F.length(up) - F.length(F.replace(up, F.lit(b), F.lit(""))) for b in "ACGT"}
    return {b: n[b] + n["TGCA"["ACGT".index(b)]] if both_strands else n[b] for b in "ACGT"}


def clean_genome(df: DataFrame, seq: str = "seq", ident: str = "seq_id", least: int = 1000, keep: str = "(?i)^chr") -> DataFrame:
    """Upper case, other letters than ATCGN become N; the second and further sequences of an id get _1, _2 ...; then short ones go unless their name matches `keep`."""
    from pyspark.sql import Window as W

    rows = df.withColumn(seq, F.regexp_replace(F.upper(F.regexp_replace(seq, r"\s", "")), "[^ATCGN]", "N"))
    k = F.row_number().over(W.partitionBy(ident).orderBy("ord"))
    rows = rows.withColumn("_k", k - 1).withColumn(ident, F.when(F.col("_k") > 0, F.concat_ws("_", ident, "_k")).otherwise(F.col(ident))).drop("_k")
    return rows.filter((F.length(seq) >= least) | F.col(ident).rlike(keep))


def revised_fasta(df: DataFrame, protein: bool, most_unknown: float = 0.05, seq: str = "seq", ident: str = "seq_id") -> DataFrame:
    """Ids of word characters, illegal letters N or X, no closing *, few unknown letters, the first of each id."""
    from pyspark.sql import Window as W

    unknown = "X" if protein else "N"
    legal = "[^ACDEFGHIKLMNPQRSTVWYX*]" if protein else "[^ACGTN]"
    rows = df.withColumns({ident: F.regexp_replace(ident, r"\W", "_"), seq: F.regexp_replace(F.regexp_replace(F.upper(seq), r"\*$", ""), legal, unknown)})
    share = (F.length(seq) - F.length(F.replace(F.col(seq), F.lit(unknown), F.lit("")))) / F.greatest(F.lit(1), F.length(seq))
    return rows.filter(share <= most_unknown).withColumn("_k", F.row_number().over(W.partitionBy(ident).orderBy("ord"))).filter("_k = 1").drop("_k")


def is_nucleotide(df: DataFrame, seq: str = "seq", sample: int = 100, share: float = 0.9) -> bool:
    """At least `share` of the letters of the first `sample` sequences are ACGTN."""
    rows = df.orderBy("ord").limit(sample)
    n, m = rows.agg(F.sum(F.length(F.regexp_replace(F.upper(seq), "[^ACGTN]", ""))), F.sum(F.length(seq))).first()
    return bool(m) and n / m >= share


def percentage(text: Column) -> Column:
    """the first number before a % sign, over 100."""
    return F.regexp_extract(text, r"([0-9.]+)\s*%", 1).try_cast("double") / 100


def species(name: Column) -> Column:
    """the species token of an id, else the whole id."""
    found = F.regexp_extract(name, "(?i)(species[a-zA-Z0-9]+)", 1)
    return F.when(found != "", found).otherwise(name)


def unescaped(text: Column) -> Column:
    """F23."""
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def valid_protein(seq: Column) -> Column:
    """no stop but at the end."""
    return ~seq.rlike(r"\*.+")


# Least length of an open reading frame that is accepted for its length alone, by GC percentage.
ORF_BY_GC = {25: 465, 30: 510, 35: 555, 40: 590, 45: 645, 50: 749, 55: 797, 60: 927, 65: 1086, 70: 1358, 75: 1743, 80: 2422}


def least_orf(gc: Column) -> Column:
    """by the first step at or above the GC percentage; beyond all steps length alone never suffices."""
    out = F.lit(1_000_000)
    for step, length in sorted(ORF_BY_GC.items(), reverse=True):
        out = F.when(gc <= step, length).otherwise(out)
    return out


def read_budget(genome_size: int) -> int:
    """F25."""
    return int(max(50e6, 2 ** (math.log10(genome_size / 1e6) - 1) * 50e6))


def read_quota(reads: dict[str, int], budget: int) -> dict[str, int]:
    """Each library's share of the budget, all of it if there are fewer reads."""
    total = sum(reads.values())
    return {k: n if total <= budget else budget * n // total for k, n in reads.items()}


def segment_size(longest: int) -> tuple[int, int]:
    """(segment, overlap): 100 kb of overlap, or, if four times the longest gene is more, twice that gene with two leading digits and one step up; segments are ten times that."""
    overlap = 100_000
    if 4 * longest > overlap:
        overlap = 2 * longest
        step = 10 ** (len(str(overlap)) - 2)
        overlap = (overlap // step + 1) * step
    return 10 * overlap, overlap
