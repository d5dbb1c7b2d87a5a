"""Smaller evidence operators on micro tables."""

from pyspark.sql import functions as F

from spanloom.plans import evidence as E

CDS = "seqid string, strand string, {} string, start long, end long, phase int"


def test_filters(spark):
    rows = spark.createDataFrame([("g1", "a", 200, 900, 0.5), ("g1", "b", 700, 900, 0.1), ("g2", "c", 100, 900, 0.9)], "gene_id string, transcript_id string, cds_len long, exon_len long, repeat_share double")
    kept, out = E.long_enough(rows)
    assert kept.count() == 2 and out.first().gene_id == "g2"
    assert {(r.transcript_id, r.reason) for r in E.filter_reasons(rows).collect()} == {("a", "ratio"), ("c", "ratio"), ("c", "short"), ("c", "repeat")}
    # Every transcript fails by one reason or another, none by the same.
    mixed = spark.createDataFrame([("g", "a", 200, 300, 0.0), ("g", "b", 700, 900, 0.5), ("h", "c", 200, 300, 0.0), ("h", "d", 700, 900, 0.0), ("i", "e", 0, 0, None)], "gene_id string, transcript_id string, cds_len long, exon_len long, repeat_share double")
    assert {(r.transcript_id, r.reason) for r in E.filter_reasons(mixed).collect()} == {("a", "short"), ("b", "repeat"), ("e", "ratio"), ("e", "short")}
    models = spark.createDataFrame([("g1", "a", "complete", 100.0, 0.5, 900), ("g2", "b", "complete", 100.0, 0.0, 900), ("g3", "c", "internal", 100.0, 1.0, 900)], "gene_id string, transcript_id string, integrity string, support double, transcript_ratio double, cds_len long")
    assert [r.gene_id for r in E.surely_right(models).collect()] == ["g1"]
    more = models.unionByName(spark.createDataFrame([("g2", "d", "internal", 100.0, 0.9, 900), ("g2", "e", "complete", 100.0, 0.3, 9), ("g3", "f", "complete", 100.0, 0.2, 9)], models.schema))
    assert sorted((r.gene_id, r.transcript_id) for r in E.surely_right(more).collect()) == [("g1", "a"), ("g2", "e"), ("g3", "f")]
    genes = spark.createDataFrame([("c", "+", 1, 1000), ("c", "-", 1101, 2000), ("c", "+", 2001, 3000), ("c", "+", 2001, 3000)], "seqid string, strand string, start long, end long")
    assert E.intergenic_flank(genes).first().flank == 125 and E.intergenic_flank(genes.limit(0)).first().flank == 0


def test_ends(spark):
    genes = spark.createDataFrame([("c", "+", "g", 1, 30, 0), ("c", "+", "g", 61, 90, 0), ("c", "+", "s", 1000, 1029, 0)], CDS.format("gene_id"))
    other = spark.createDataFrame([("c", "+", "e", 10, 30, 0), ("c", "+", "e", 61, 99, 0), ("c", "+", "e", 121, 150, 0), ("c", "+", "f", 994, 1050, 0)], CDS.format("evidence_id"))
    assert [tuple(r) for r in E.longer_ends(genes, other).collect()] == [("g", "e", 1, 39)]
    assert [tuple(r) for r in E.single_part_matches(genes, other).collect()] == [("s", "f", 994, 1050)]


def test_segments(spark):
    segments = spark.createDataFrame([("p", "c", 1, 100), ("q", "c", 91, 190)], "segment string, seqid string, start long, end long")
    hints = spark.createDataFrame([("c", 92, 99, "exon", "E"), ("c", 95, 105, "exon", "E")], "seqid string, start long, end long, type string, src string")
    got = E.hints_of_segments(segments, hints)
    assert {(r.segment, r.start, r.end) for r in got.collect()} == {("p", 92, 99), ("q", 2, 9), ("q", 5, 15)}
    assert {(r.start, r.end) for r in E.from_segments(got.drop("seqid").withColumn("strand", F.lit("+")), segments).collect()} == {(92, 99), (95, 105)}


def test_models(spark):
    rows = spark.createDataFrame([("a", "c", "+", ["1-2", "5-6"]), ("b", "c", "+", ["1-2"]), ("d", "c", "+", [])], "id string, seqid string, strand string, introns array<string>")
    assert {r.id: r.support for r in E.intron_multiplicity(rows).collect()} == {"a": 1, "b": 2, "d": 0}
    part = "transcript_id string, seqid string, strand string, start long, end long"
    cds = spark.createDataFrame([("t", "c", "+", 11, 20), ("t", "c", "+", 41, 50)], part)
    exons = spark.createDataFrame([("t", "c", "+", 1, 15), ("t", "c", "+", 45, 60), ("t", "c", "+", 81, 90)], part)
    assert sorted((r.start, r.end) for r in E.exons_from(cds, exons).collect()) == [(1, 20), (41, 60), (81, 90)]
    genes = spark.createDataFrame([("g", 1, 100)], "gene_id string, start long, end long")
    assert sorted((r.start, r.end) for r in E.bounded(exons.withColumn("gene_id", F.lit("g")), genes).collect()) == [(1, 15), (45, 60), (81, 100)]
    hits = spark.createDataFrame([("a", "c", "+", 1, 100, 90), ("b", "c", "+", 5, 95, 50), ("d", "c", "+", 500, 600, 10)], "id string, seqid string, strand string, start long, end long, covered long")
    assert sorted(r.id for r in E.without_contained(hits, slack=10).collect()) == ["a", "d"]


def test_sequences(spark):
    found = E.long_orfs(spark.createDataFrame([("s", "ATGAAACCCTAG")], "seq_id string, seq string"), 3, one_strand=True).filter("frame = 0").first()
    assert (found.start, found.end, found.integrity, found.protein) == (1, 12, "complete", "MKP*")
    sites = spark.createDataFrame([(k, "ACGT") for k in range(18)] + [(98, "TTTT"), (99, "GGGG")], "id long, seq string")
    even = dict.fromkeys("ACGT", 0.25)
    assert {r.id for r in E.noise_depleted(sites, even, rounds=1).collect()} == set(range(18))
    matrix = {k: dict(zip("ACGT", (0.7, 0.1, 0.1, 0.1), strict=True)) for k in range(5)}
    orfs = spark.createDataFrame([("o", 4, 60, "CCCATGCCCAAATTTAATGAAC" + "C" * 40)], "id string, start long, end long, seq string")
    assert E.refined_starts(orfs, matrix, even, before=2, after=0).first().new_start == 4
    folds = E.split_sets(spark.range(1000), "id", 5).groupBy("fold").count().collect()
    assert len(folds) == 5 and all(120 < r["count"] < 280 for r in folds)
    rep = {(r.what, r.measure): r.value for r in E.report({"x": spark.sql("select 'a' k, 1 n, 2.5 m"), "y": spark.sql("select 3 n")}).collect()}
    assert rep == {("x", "a.n"): 1.0, ("x", "a.m"): 2.5, ("y", "n"): 3.0}
