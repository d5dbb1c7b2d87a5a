"""Interval, order, graph and sequence operators against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from spanloom.functions import genetic_code, sequences as S
from spanloom.operators import graph, intervals, order, statistics
from spanloom.plans import pipelines
from spanloom.sources import formats, sinks


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(1)
    rows = [(f"k{rng.randint(0, 3)}", i, s, s + rng.randint(0, 60)) for i, s in enumerate(rng.randint(-50, 600) for _ in range(150))]
    return rows, spark.createDataFrame(rows, "key string, id long, start long, end long").cache()


@pytest.mark.parametrize("bin_width", [None, 7, 1000])
def test_union_length(spans, bin_width):
    rows, df = spans
    want = {k: len({x for q, _, s, e in rows if q == k for x in range(s, e + 1)}) for k in {r[0] for r in rows}}
    assert {r.key: r.covered for r in intervals.union_length(df, ["key"], bin_width).collect()} == want
    assert intervals.union_length(df.limit(0), ["key"], bin_width).count() == 0


@pytest.mark.parametrize("closed", ["inclusive", "strict"])
@pytest.mark.parametrize("width", [5, 50, 5000])
def test_overlap_join(spans, closed, width):
    rows, df = spans
    meets = (lambda a, b: a[2] <= b[3] and b[2] <= a[3]) if closed == "inclusive" else (lambda a, b: a[2] < b[3] and b[2] < a[3])
    want = sorted((a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1] and meets(a, b))
    assert sorted((r.id, r.id_r) for r in intervals.self_overlaps(df, ["key"], "id", width, closed).collect()) == want


def test_touching_intervals(spark):
    df = spark.createDataFrame([("a", 1, 1, 10), ("a", 2, 10, 20), ("a", 3, 21, 30)], "key string, id int, start long, end long")
    assert intervals.self_overlaps(df, ["key"], "id").count() == 1 and intervals.self_overlaps(df, ["key"], "id", closed="strict").count() == 0
    assert [intervals.islands(df, ["key"], k).agg(F.max("island")).first()[0] for k in (-2, 0, 1)] == [3, 2, 1]


def test_depth_subtract_tiles(spans, spark):
    rows, df = spans
    depth = {}
    for k, _, s, e in rows:
        for x in range(s, e + 1):
            depth[k, x] = depth.get((k, x), 0) + 1
    got = {(r.key, x): r.depth for r in intervals.depth(df, ["key"]).collect() for x in range(r.start, r.end + 1)}
    assert got == depth
    whole = spark.createDataFrame([(f"k{i}", i, -100, 800) for i in range(5)], "key string, gid long, start long, end long")
    left = {(r.key, x) for r in intervals.subtract(whole, df, ["key"], ["gid"]).collect() for x in range(r.start, r.end + 1)}
    assert left == {(f"k{i}", x) for i in range(5) for x in range(-100, 801)} - set(depth)
    tiles = intervals.tiles(spark.createDataFrame([(1, 1000), (1, 100), (1, 101)], "start long, end long"), 100, 10).collect()
    assert {(r.end, r.tile_start, r.tile_end) for r in tiles if r.end < 200} == {(100, 1, 100), (101, 1, 100), (101, 91, 101)} and max(r.tile_end for r in tiles) == 1000


def test_medians(spark):
    df = spark.createDataFrame([("a", x) for x in (1, 2, 3, 4)] + [("b", 7), ("c", None)], "k string, v int")
    assert {r.k: r.median for r in order.upper_median(df, ["k"], "v").collect()} == {"a": 3, "b": 7}
    big = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    assert [order.element_at(big, "v", p, 10) for p in (0.0, 0.333, 0.95, 1.0)] == [0, 333, 950, 999] and order.element_at(big.limit(0), "v", 0.5) is None


def test_suppression_equals_greedy(spark):
    rng = random.Random(3)
    edges = {tuple(sorted(rng.sample(range(80), 2))) for _ in range(150)}
    score = {k: rng.randint(0, 5) for k in range(80)}
    kept, gone = [], set()
    for k in sorted(score, key=lambda k: (-score[k], k)):
        if k not in gone:
            kept.append(k)
            gone |= {a + b - k for a, b in edges if k in (a, b)}
    nodes = spark.createDataFrame([(k, -s) for k, s in score.items()], "id long, worse long")
    pairs = spark.createDataFrame(list(edges), "u long, v long")
    assert sorted(r.id for r in graph.suppress(nodes, pairs, ["worse"]).collect()) == sorted(kept)
    left = {r.id for r in graph.prune_by_degree(nodes.select("id", F.col("worse").alias("score")), pairs).collect()}
    assert not any(a in left and b in left for a, b in edges)


def test_similar_by_kmers(spark):
    """Against the one-by-one loop: spaced 5-mers of the candidate in overlapping ones of each that stays."""
    rng = random.Random(3)
    base = ["".join(rng.choice("ACDEFGHIKLMN") for _ in range(rng.randrange(40, 200))) for _ in range(12)]
    rows = [(f"b{k}", s) for k, s in enumerate(base)] + [(f"c{k}", s[5 * (k % 3) : -(k % 4) or None]) for k, s in enumerate(base)] + [(f"d{k}", s[: len(s) // 2] + "W" * (k % 3) + s[len(s) // 2 :]) for k, s in enumerate(base)]
    rows += [("low", "AAAAA" * 20), ("short", "ACD"), ("same1", base[0]), ("none", "")]
    kept, want = [], []
    for ident, s in sorted(rows, key=lambda r: (-len(r[1]), r[0])):
        spaced = {s[i : i + 5] for i in range(0, len(s) - 4, 5)}
        if round(len(spaced) / (max(1, len(s)) / 5) * 100, 2) < 30:
            continue
        if all(round(len(spaced & m) / len(spaced) * 100, 2) <= 80 for m in kept):
            kept.append({s[i : i + 5] for i in range(len(s) - 4)})
            want.append(ident)
    got = [r.id for r in graph.similar_by_kmers(spark.createDataFrame(rows, "id string, seq string"), "id", "seq").collect()]
    assert sorted(got) == sorted(want) and len(want) < len(rows) - 8


def test_sequences(spark):
    def one(column, **values):
        return spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).first().x

    s = "ATGAAATAGNNNTTATGA"
    assert one(S.revcomp(F.col("s")), s="ATCGNa") == "TNCGAT" and one(S.revcomp(S.revcomp(F.col("s"))), s=s) == s
    assert one(S.translate(F.col("s")), s=s) == "MK*XL*" and one(S.translate(F.col("s"), 6), s="TAATGA") == "Q*" and one(S.translate(F.col("s"), starts=("CTG",)), s="CTGAAA") == "MK"
    assert [one(S.integrity(F.col("s")), s=x) for x in ("ATGTAA", "AAATAA", "ATGAAA", "AAA", "")] == ["complete", "5prime_partial", "3prime_partial", "internal", "internal"]
    assert one(S.internal_stops(F.col("s")), s=s) == 1 and one(S.internal_stops(F.col("s")), s="TAA") == 0
    blocks = one(S.alignment_blocks(F.lit(100), F.col("c")), c="5S10M2I5M3D10M100N20M")
    assert [tuple(b) for b in blocks] == [(100, 109, "block"), (110, 114, "block"), (115, 117, "block"), (118, 127, "block"), (128, 227, "intron"), (228, 247, "block")]
    ranges = F.expr("array(named_struct('start', 2L, 'end', 3L), named_struct('start', 6L, 'end', 6L))")
    assert one(S.masked(F.col("s"), ranges), s="ACGTACG") == "ANNTANG" and one(S.masked(F.col("s"), ranges, "lower"), s="ACGTACG") == "AcgTAcG"
    assert one(S.canonical_splice(F.col("s"), F.lit(3), F.lit(8), F.lit("+")), s="AAGTCCAGAA") and not one(S.canonical_splice(F.col("s"), F.lit(3), F.lit(8), F.lit("-")), s="AAGTCCAGAA")
    assert len(genetic_code.DIFFERENCES) == 24 and genetic_code.stops(1) == ["TAA", "TAG", "TGA"] and all(len(genetic_code.table(k)) == 64 for k in genetic_code.DIFFERENCES)
    assert S.read_budget(10**7) == 50_000_000 and S.read_budget(10**9) == 200_000_000 and S.segment_size(12345) == (1_000_000, 100_000) and S.segment_size(25_001) == (510_000, 51_000) and S.segment_size(60_000) == (1_300_000, 130_000) and S.read_quota({"a": 30, "b": 10}, 20) == {"a": 15, "b": 5}
    assert one(S.species(F.col("s")), s="x_speciesAb1_7") == "speciesAb1" and one(S.unescaped(F.col("s")), s="a%3Ab+c") == "a:b+c" and one(S.percentage(F.col("s")), s="x 12.5% y") == 0.125


def test_orfs_equal_a_loop(spark):
    rng = random.Random(8)
    seqs = [("s%d" % k, "".join(rng.choice("ACGT") for _ in range(rng.randint(0, 400)))) for k in range(12)]
    want = set()
    for name, seq in seqs:
        for strand, s in (("+", seq), ("-", seq[::-1].translate(str.maketrans("ACGT", "TGCA")))):
            for frame in range(3):
                codons = [s[i : i + 3] for i in range(frame, len(s) - 2, 3)]
                begin = 0
                for k in [*[i for i, c in enumerate(codons) if c in ("TAA", "TAG", "TGA")], len(codons)]:
                    piece = codons[begin:k]
                    at = piece.index("ATG") if "ATG" in piece else 0 if begin == 0 else None
                    if at is not None and len(piece) - at >= 5:
                        stop = k < len(codons)
                        a = frame + 3 * (begin + at) + 1
                        want.add((name, strand, frame, a, a + 3 * (len(piece) - at + stop) - 1))
                    begin = k + 1
    got = {(r.id, r.strand, r.frame, r.start, r.end) for r in S.orfs(spark.createDataFrame(seqs, "id string, seq string"), "id", "seq", 5).collect()}
    assert got == want


GFF = """##gff-version 3
c1\tx\tgene\t1\t100\t.\t+\t.\tID=g1;Name=a=b;Name=last
c1\tx\tmRNA\t1\t100\t.\t+\t.\tID=t1;Parent=g1
c1\tx\tCDS\t11\t20\t.\t+\t0\tID=c;Parent=t1
c1\tx\tCDS\t41\t60\t.\t+\t2\tParent=t1
c1\tx\texon\t20\t5\t.\t+\t.\tParent=t1
c1\tx\texon\t41\t90\t.\t+\t.\tParent=t1
broken line
"""


def test_gff3_models_and_writers(spark, tmp_path):
    (tmp_path / "a.gff3").write_text(GFF)
    features = formats.gff3(spark, str(tmp_path / "a.gff3"))
    genes, transcripts, parts = formats.gene_models(features)
    assert genes.first().attrs == {"ID": "g1", "Name": "last"} and transcripts.first().gene_id == "g1" and parts.count() == 4
    assert {(r.start, r.end) for r in parts.filter("type = 'exon'").collect()} == {(5, 20), (41, 90)}
    lines = [r.value for r in sinks.gff3(genes, transcripts, parts).collect()]
    assert len(lines) == 6 and lines[0].split("\t")[2] == "gene" and any("CDS\t11\t20" in x and "ID=t1.CDS1;Parent=t1" in x for x in lines[2:])
    assert sinks.bed12(parts).first().value == "c1\t4\t90\tt1\t0\t+\t10\t60\t0\t2\t16,50\t0,36"
    gtf = [r.value.split("\t") for r in sinks.gtf(parts).collect()]
    assert {(g[2], g[3], g[4]) for g in gtf if "codon" in g[2]} == {("start_codon", "11", "13"), ("stop_codon", "58", "60")}
    (tmp_path / "a.gtf").write_text("\n".join("\t".join(g) for g in gtf))
    again = sinks.models_from_gtf(formats.gtf(spark, str(tmp_path / "a.gtf")))[2]
    assert {(r.type, r.start, r.end) for r in again.collect()} == {(r.type, r.start, r.end) for r in parts.collect()}
    genome = spark.createDataFrame([("c1", "ACGT" * 30)], "seq_id string, seq string")
    cds = sinks.sequences(parts, genome).first().seq
    s = "ACGT" * 30
    assert cds == s[10:20] + s[40:60]
    rows = pipelines.cleaned(parts.filter("type = 'CDS'"), parts.filter("type = 'exon'")).collect()
    got = {(r.type, r.start, r.end, r.phase) for r in rows}
    assert {("CDS", 11, 20, 0), ("CDS", 41, 60, 2), ("intron", 21, 40, None), ("five_prime_UTR", 5, 10, None), ("three_prime_UTR", 61, 90, None)} <= got
    spots = spark.createDataFrame([("t1", "o", 10, 20)], "transcript_id string, id string, start long, end long")
    got = [(r.g_start, r.g_end, r.offset) for r in pipelines.to_genome(parts.filter("type = 'exon'"), spots).orderBy("offset").collect()]
    assert got == [(14, 20, 0), (41, 44, 7)]


def test_text_formats(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    fa = formats.fasta(spark, put("a.fa", ">s1 one > two\nACGT\nAC\n\n>s2\n" + "ACGTN" * 30 + "\n"))
    assert [(r.seq_id, len(r.seq), r.description) for r in fa.orderBy("ord").collect()] == [("s1", 6, "one > two"), ("s2", 150, "")]
    back = formats.fasta(spark, put("b.fa", "\n".join(r.value for r in sinks.fasta(fa.orderBy("ord"), 60).collect()) + "\n"))
    assert {(r.seq_id, r.seq) for r in back.collect()} == {(r.seq_id, r.seq) for r in fa.collect()}
    region = spark.createDataFrame([("r", "s2", 35, 66)], "id string, seq_id string, start long, end long")
    assert formats.fetch(region, formats.chunked(fa, 20), 20).first().seq == ("ACGTN" * 30)[34:66]
    sam = put("a.sam", "@SQ\tSN:c1\tLN:500\nr1\t0\tc1\t10\t60\t10M\t*\t0\t0\tACGT\tIIII\tXS:A:+\tNM:i:1\nr2\t256\tc1\t10\t60\t10M\t=\t0\t0\tA\tI\nr3\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    assert formats.sam_lengths(spark, sam).first().length == 500 and formats.sam(spark, sam).first().tags == {"XS": "+", "NM": "1"}
    blocks, depth, introns = pipelines.read_evidence(formats.sam(spark, sam).withColumn("strand", F.lit("+")))
    assert blocks.count() == 1 and depth.first().depth == 1 and introns.count() == 0
    out = put("a.out", "   SW\nscore\n\n  239 29.4 1.9 1.0 c1 11 20 (100) + L1 LINE/L1 1 10 (10) 1\n  239 29.4 1.9 1.0 c1 31 40 (80) C L2 DNA (0) 40 31 2\n")
    hits = formats.repeatmasker(spark, out)
    assert [(r.strand, r["class"], r.ratio) for r in hits.orderBy("start").collect()] == [("+", "LINE", 0.5), ("-", "DNA", 0.25)]
    kept, rolled = pipelines.repeats(hits)
    assert kept.count() == 2 and {(r.level, r.n, r.covered) for r in rolled.collect()} == {(0, 2, 20), (1, 1, 10), (2, 1, 10)}
    tab = formats.blast_tab(spark, put("a.tab", "q1\ts1\t90\t50\t0\t0\t1\t50\t100\t51\t1e-30\t80\nq1\ts1\t80\t50\t0\t0\t41\t90\t50\t1\t1e-10\t60\nq1\ts2\t70\t10\t0\t0\t1\t10\t1\t10\t1\t20\n"))
    hit = pipelines.blast_hits(tab, most_hits=1).collect()
    assert [(r.subject, r.identity, r.q_covered, r.s_covered) for r in hit] == [("s1", 85.0, 90, 100)]
    dom = formats.domtblout(spark, put("a.dom", "# x\nPF1 PF1.1 100 q1 - 300 1e-20 70 0.1 1 1 1e-22 1e-18 69 0.1 1 60 5 70 1 80 0.9 a long name\nPF1 PF1.1 100 q1 - 300 1e-20 70 0.1 1 1 1e-22 1e-18 69 0.1 41 90 90 140 1 80 0.9 a long name\n"))
    assert [(r.coverage, r.description) for r in pipelines.domain_hits(dom).collect()] == [(0.9, "a long name")]
    xml = put("a.xml", "<BlastOutput><Iteration><Iteration_query-def>q</Iteration_query-def><Iteration_query-len>90</Iteration_query-len><Iteration_hits><Hit><Hit_id>h</Hit_id><Hit_def>d</Hit_def><Hit_len>80</Hit_len><Hit_hsps><Hsp><Hsp_bit-score>50</Hsp_bit-score><Hsp_evalue>1e-9</Hsp_evalue><Hsp_query-from>1</Hsp_query-from><Hsp_query-to>40</Hsp_query-to><Hsp_hit-from>1</Hsp_hit-from><Hsp_hit-to>40</Hsp_hit-to><Hsp_identity>30</Hsp_identity><Hsp_align-len>40</Hsp_align-len></Hsp></Hit_hsps></Hit></Iteration_hits></Iteration></BlastOutput>")
    assert [(r.query, r.subject, r.pident) for r in formats.blast_xml(spark, xml).collect()] == [("q", "h", 75.0)]
    gb = put("a.gb", "LOCUS       g1   1000 bp  DNA\nFEATURES\n     CDS             complement(join(11..20,\n                     31..40))\n                     /gene=\"x\"\nORIGIN\n//\n")
    r = formats.genbank(spark, gb).first()
    assert (r.locus, r.length, r.minus, [tuple(p) for p in r.parts]) == ("g1", 1000, True, [(11, 20), (31, 40)])
    assert [(r.name, r.seq, r.qual) for r in formats.fastq(spark, put("a.fq", "@r1\nAC\n+\n@I\n@r2\nGT\n+\nII\n")).collect()] == [("r2", "GT", "II"), ("r1", "AC", "@I")]
    assert formats.records(spark, put("a.rec", "a\nb\n\nc excellent\n\n"), "excellent").count() == 1
    ids = formats.id_list(spark, put("a.ids", "s2 x\ns1\ns2\n"))
    assert [r.seq_id for r in formats.selected(fa, ids).collect()] == ["s2", "s1"] and formats.selected(fa, ids, reverse=True).count() == 0
    assert formats.config("[a]\nx = 1\ny = 2", "[a]\nx = 3") == {"a": {"x": "3", "y": "2"}}
    aug = formats.augustus(spark, put("a.aug", "# % of transcript supported by hints (any source): 62.5\nc1\tA\tgene\t1\t9\t.\t+\t.\tg1\n")).first()
    assert aug.support == 62.5 and aug.start == 1


def test_pipelines(spark):
    cds = spark.createDataFrame([("c", "+", "g1", "t1", 1, 100), ("c", "+", "g1", "t1", 201, 300), ("c", "+", "g2", "t2", 50, 149), ("c", "+", "g3", "t3", 1000, 1099)], "seqid string, strand string, gene_id string, transcript_id string, start long, end long")
    whole = cds.select("transcript_id", F.lit("complete").alias("integrity")).distinct()
    scores = pipelines.transcript_scores(cds, whole)
    # Two parts of 100: 200 * (1 + 0.3); complete: + 200; from the first file: + 100.
    assert {r.transcript_id: round(r.score, 6) for r in scores.collect()} == {"t1": 460.0, "t2": 200.0, "t3": 200.0}
    first = pipelines.transcript_scores(cds.withColumn("file_ord", F.lit(1)), whole.withColumn("integrity", F.lit("5prime_partial")))
    assert {r.transcript_id: round(r.score, 6) for r in first.collect()} == {"t1": 460.0, "t2": 200.0, "t3": 200.0}
    assert sorted(r.gene_id for r in pipelines.without_redundancy(cds, scores).collect()) == ["g1", "g3"]
    hits = spark.createDataFrame([("c", "LINE", 1, 100), ("c", "LINE", 50, 250), ("c", "Simple_repeat", 1000, 1099)], "seqid string, class string, start long, end long")
    assert sorted(r.gene_id for r in pipelines.genes_clear_of_repeats(cds, hits).collect()) == ["g3"]
    rows = {r.level: (r.sensitivity, r.specificity) for r in pipelines.accuracy(cds, cds.filter("gene_id != 'g3'")).collect()}
    assert rows["gene"] == (2 / 3, 1.0) and rows["part"] == (0.75, 1.0) and rows["position"] == (249 / 349, 1.0)
    orfs = spark.createDataFrame([("a", "t", "+", 1, 300), ("b", "t", "+", 100, 350), ("c", "t", "+", 400, 700), ("d", "t", "+", 1, 90)], "id string, transcript_id string, strand string, start long, end long")
    frames = spark.createDataFrame([("a", 5.0, 1.0, 1.0), ("b", 9.0, 1.0, 2.0), ("c", -1.0, 0.0, 0.0), ("d", 1.0, 3.0, 0.0)], "id string, score_1 double, score_2 double, score_3 double")
    assert sorted(r.id for r in pipelines.selected_orfs(orfs, frames).collect()) == ["b"]
    blast = spark.createDataFrame([("a",), ("c",)], "query string")
    assert sorted(r.id for r in pipelines.selected_orfs(orfs, frames, blast=blast).collect()) == ["a", "c"]
    assert [r.id for r in pipelines.selected_orfs(orfs, frames, blast=blast, single_best=True).collect()] == ["c"]
    assert sorted(r.id for r in pipelines.without_eclipsed(orfs).collect()) == ["a", "b", "c"]
    introns = spark.createDataFrame([("c", "+", 101, 200, 9), ("c", "+", 150, 220, 3), ("c", "+", 300, 400, 1)], "seqid string, strand string, start long, end long, depth long")
    assert sorted(r.start for r in pipelines.compatible_introns(introns).collect()) == [101, 300]
    genes = spark.createDataFrame([("c", "+", "g1", 1, 350)], "seqid string, strand string, gene_id string, start long, end long")
    model = spark.createDataFrame([("g1", 101, 200), ("g1", 230, 240)], "gene_id string, start long, end long")
    got = {(r.start, r.found_in, r.ratio) for r in pipelines.splicing_evidence(genes, model, introns).collect()}
    assert got == {(101, "common", 0.75), (150, "evidence", 0.25), (230, "reference", None)}
    runs = spark.createDataFrame([("c", "+", 1, 150, 100), ("c", "+", 151, 160, 1), ("c", "+", 161, 300, 50), ("c", "+", 301, 310, 9)], "seqid string, strand string, start long, end long, depth long")
    assert sorted((r.start, r.end) for r in pipelines.split_runs(runs, least=2).collect()) == [(1, 150), (161, 310)]
    hsps = spark.createDataFrame([("q", "t", 0.9, 50, 200, 1, 50, 100, 249), ("q", "t", 0.8, 50, 200, 55, 104, 400, 549), ("q", "t", 0.8, 50, 200, 1, 50, 90_000, 90_150)], "query string, target string, pident double, alnlen long, qlen long, qstart long, qend long, tstart long, tend long")
    assert sorted(r.chain for r in pipelines.chained(hsps).collect()) == [0, 0, 1] and [r.coverage for r in pipelines.homolog_hits(hsps).collect()] == [0.5]
    seq = spark.createDataFrame([("TAAATGCCCATGAAACCCGGGTTTTAG", 13, 18)], "seq string, start long, end long")
    assert tuple(pipelines.extended(seq, "seq", "start", "end").select("new_start", "new_end").first()) == (4, 27)
    sources = spark.createDataFrame([("c", "+", "g1", "homolog", 1, 100), ("c", "+", "g2", "augustus", 50, 150), ("c", "+", "g3", "transfrag", 140, 200)], "seqid string, strand string, gene_id string, source string, start long, end long")
    assert sorted(r.gene_id for r in pipelines.combined(sources).collect()) == ["g2", "g3"]


def test_pieces(spark):
    rows = spark.createDataFrame([(f"c{k}", n) for k, n in enumerate([70] * 6 + [500, 5])], "id string, len long")
    got = {r.id: r.piece for r in intervals.chunks(rows, [], "len", 100, "id").collect()}
    assert got == {"c6": 0, "c0": 1, "c1": 1, "c2": 2, "c3": 2, "c4": 3, "c5": 3, "c7": 4}
    assert intervals.chunks(rows.limit(0), [], "len", 100, "id").count() == 0


def test_hints(spark):
    models = [("m", True, False, "complete", 2, 600), ("e", False, False, "5prime_partial", 2, 700), ("p", False, False, "3prime_partial", 1, 90)]
    models = spark.createDataFrame(models, "gene_id string, excellent boolean, filled boolean, integrity string, cds_num long, cds_len long")
    parts = [("m", 1, 300), ("m", 401, 700), ("e", 1001, 1400), ("e", 1501, 1800), ("p", 2001, 2090)]
    parts = spark.createDataFrame([(g, g, "c", "-" if g == "e" else "+", "CDS", a, b) for g, a, b in parts], "gene_id string, transcript_id string, seqid string, strand string, type string, start long, end long")
    got = sorted((r.gene_id, r.type, r.start, r.end, r.src) for r in pipelines.hints(models, parts).collect())
    want = [("m", "CDS", 1, 300, "M"), ("m", "CDS", 401, 700, "M"), ("m", "intron", 301, 400, "M"), ("m", "start", 1, 3, "M"), ("m", "stop", 698, 700, "M")]
    want += [("e", "CDSpart", 1021, 1380, "E"), ("e", "CDSpart", 1521, 1780, "E"), ("e", "intron", 1401, 1500, "E"), ("e", "start", 1798, 1800, "E")]
    want += [("p", "CDSpart", 2021, 2070, "P"), ("p", "stop", 2088, 2090, "P")]
    assert got == sorted(want)


def test_gene_accuracy(spark):
    """The place of the start codon doesn't count, on either strand; one equal transcript is enough."""
    rows = "gene_id string, transcript_id string, seqid string, strand string, start long, end long"
    ref = [("a", "a1", "c", "+", 10, 20), ("a", "a1", "c", "+", 31, 40), ("b", "b1", "c", "-", 110, 120), ("b", "b1", "c", "-", 131, 140), ("d", "d1", "c", "+", 1, 9), ("d", "d2", "c", "+", 2, 12)]
    got = [("x", "x1", "c", "+", 13, 20), ("x", "x1", "c", "+", 31, 40), ("y", "y1", "c", "-", 110, 120), ("y", "y1", "c", "-", 131, 150), ("z", "z1", "c", "+", 5, 12), ("w", "w1", "c", "-", 13, 20)]
    r = pipelines.gene_accuracy(spark.createDataFrame(ref, rows), spark.createDataFrame(got, rows)).first()
    assert (r.standard, r.predicted, r.tp, r.sensitivity, r.specificity) == (3, 4, 3, 1.0, 0.75)


def test_genome_names(spark):
    rows = [(k, i, s) for k, (i, s) in enumerate([("a", "acgtx" * 300), ("a", "AC"), ("a", "ACGTN" * 300), ("Chr1", "AC"), ("b", "AC")])]
    got = [(r.seq_id, r.seq[:5]) for r in S.clean_genome(spark.createDataFrame(rows, "ord long, seq_id string, seq string")).orderBy("ord").collect()]
    assert got == [("a", "ACGTN"), ("a_2", "ACGTN"), ("Chr1", "AC")]


def test_coding_scores(spark):
    """Against a loop over positions, stop codons and frames."""
    from math import log

    rng = random.Random(5)
    seqs = {k: "".join(rng.choice("ACGT") for _ in range(n)) + e for k, (n, e) in enumerate([(30, "TAA"), (33, ""), (31, "TAG"), (6, ""), (5, ""), (0, ""), (60, "TGA"), (3, "TAA")])}
    counts, frames = {}, {}
    for s in seqs.values():
        for m in range(6):
            for i in range(m, len(s)):
                if i == len(s) - 3 and i % 3 == 0 and s[i:] in ("TAA", "TAG", "TGA"):
                    break
                if not m:
                    frames[i % 3] = frames.get(i % 3, 0) + 1
                counts[s[i - m : i + 1], i % 3] = counts.get((s[i - m : i + 1], i % 3), 0) + 1
    before = lambda w, f: counts.get((w[:-1], (f - 1) % 3), 0) if len(w) > 1 else frames.get((f - 1) % 3, 0)
    model = {(w, f): log((n + 1) / (before(w, f) + 4) / 0.25) for (w, f), n in counts.items()}

    def score(s):
        total = 0.0
        for i in range(len(s)) if len(s) >= 6 else ():
            if i == len(s) - 3 and i % 3 == 0 and s[i:] in ("TAA", "TAG", "TGA"):
                break
            total += model.get((s[max(0, i - 5) : i + 1], i % 3), 0.0)
        return total

    df = spark.createDataFrame(list(seqs.items()), "id long, seq string")
    found = statistics.coding_model(df, "seq", spark.createDataFrame([(b, 0.25) for b in "ACGT"], "base string, p double"))
    assert {(r.kmer, r.frame): round(r.loglik, 9) for r in found.collect()} == {k: round(v, 9) for k, v in model.items()}
    for r in statistics.coding_scores(df, "id", "seq", found).collect():
        s = seqs[r.id]
        minus = s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
        assert [round(r[f"score_{k}"], 6) for k in range(1, 7)] == [round(score(x[f:]), 6) for x in (s, minus) for f in range(3)]


def test_statistics(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 100]], "v double")
    assert max(r.v for r in statistics.fenced(df, "v").collect()) == 7.0
    curve = statistics.roc(spark.createDataFrame([(0.9, True), (0.8, True), (0.2, False), (0.1, False)], "s double, y boolean"), "s", F.col("y"), [0.0, 0.5, 1.0])
    assert statistics.auc(curve).first().auc == 1.0


def test_streaming(spark, tmp_path):
    from spanloom.streaming.islands import event_islands

    rows = spark.sql("select 1 u, timestamp'2024-01-01 00:00:00' ts union all select 1, timestamp'2024-01-01 00:30:00' union all select 1, timestamp'2024-01-01 05:00:00' union all select 2, timestamp'2024-01-03 00:00:00'")
    rows.write.parquet(f"{tmp_path}/in")
    stream = event_islands(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), ["u"])
    q = stream.writeStream.outputMode("append").format("memory").queryName("isles").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.u, r.n) for r in spark.sql("select * from isles").collect()) == [(1, 1), (1, 2)]


def test_elements_of_odd_tables(spark):
    """Few different values, one value of most rows, two far values: the element is exact, whatever the quantiles say."""
    rng = random.Random(9)
    tables = [[1] * 500 + [2] * 3, [5] * 300, [0] * 100 + [10**12] * 101, [rng.randrange(4) for _ in range(400)], [-1e300] + [float(k) for k in range(300)] + [1e300]]
    for values in tables:
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
        for k in (0, 1, len(values) // 2, len(values) - 2, len(values) - 1):
            assert order.element(df, "v", lambda n, k=k: k, 7) == sorted(values)[k]
    groups = spark.createDataFrame([("a", 1), ("a", 9), (None, 4), ("b", None)], "k string, v long")
    assert {r.k: r.median for r in order.medians_of_few(groups, "k", "v").collect()} == {"a": 9, None: 4, "b": None}


def test_ends_on_both_strands(spark):
    plus = "TTTTAACCATGGCCAAACCCGGGTTTTAACC"  # in frame: TAA CCATGG.. with ATG at 9 and TAA at 27
    minus = plus.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    n = len(plus)
    genome = spark.createDataFrame([("p", plus), ("m", minus)], "seqid string, seq string")
    a, b = 12, 23
    rows = [("x", "p", "+", a, b), ("y", "m", "-", n - b + 1, n - a + 1), ("z", "p", "+", 9, 29), ("w", "p", "+", 1, 3)]
    got = {r.id: (r.new_start, r.new_end, r.filled) for r in pipelines.ends_filled(spark.createDataFrame(rows, "id string, seqid string, strand string, start long, end long"), genome).collect()}
    assert plus[8:11] == "ATG" and plus[26:29] == "TAA"
    assert got["x"] == (9, 29, True) and got["y"] == (n - 29 + 1, n - 9 + 1, True) and got["z"] == (9, 29, True) and got["w"][2] is False


def test_stops_included(spark):
    part = "transcript_id string, seqid string, strand string, start long, end long, phase int"
    seq = "CCATGAAACCCTAATGAGGCCAA"  # ATG AAA CCC TAA TGA
    turned = seq.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    n = len(seq)
    genome = spark.createDataFrame([("p", seq), ("m", turned)], "seqid string, seq string")
    at = lambda t, a, b: [(f"{t}+", "p", "+", a, b, 0), (f"{t}-", "m", "-", n - b + 1, n - a + 1, 0)]
    rows = [*at("lacks", 3, 11), *at("has", 3, 14), *at("twice", 3, 17), *at("open", 3, 8), ("two+", "p", "+", 3, 5, 0), ("two+", "p", "+", 6, 11, 0)]
    got = {(r.transcript_id, r.start, r.end) for r in pipelines.stops_included(spark.createDataFrame(rows, part), genome).collect()}
    want = [("lacks", 3, 14), ("has", 3, 14), ("twice", 3, 14), ("open", 3, 8)]
    assert got == {(f"{t}+", a, b) for t, a, b in want} | {(f"{t}-", n - b + 1, n - a + 1) for t, a, b in want} | {("two+", 3, 5), ("two+", 6, 14)}


@pytest.mark.parametrize("k", [1, 3, 10])
@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_framed_kmers(spark, monkeypatch, k, piece):
    """Against a plain loop, with texts that end in the middle of a slice; no row is made for each position."""
    monkeypatch.setattr(statistics, "_SLICE", piece)
    rng = random.Random(8)
    texts = [None, "", "", "A", "AC", "ACG", "acgACGTNNACG", "日本ACGTACé\U0001f600GTACGTT", *("".join(rng.choice("ACGT" * 9 + "Nx") for _ in range(rng.randint(0, 60))) for _ in range(40))]
    df = spark.createDataFrame([(t,) for t in texts], "seq string").repartition(3)
    found = statistics.framed_kmers(df, "seq", k)
    want = {}
    for t in texts:
        for p in range(len(t or "") - k + 1):
            if set(t[p : p + k]) <= set("ACGT"):
                want[t[p : p + k], p % 3] = want.get((t[p : p + k], p % 3), 0) + 1
    rows = found.collect()
    assert {(r.kmer, r.frame): r.n for r in rows} == want and len(rows) == len(want)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()
    assert statistics.framed_kmers(df.limit(0), "seq", k).count() == 0
