"""Document fingerprints: homomorphic multiset hashes.

A text is the multiset of its paragraphs (lines).  Each paragraph is hashed to a wide vector, and the
vectors are added lane by lane modulo powers of two, so the order of paragraphs doesn't matter and a
paragraph is inserted or deleted by adding or subtracting its vector (`combine`).  The vector has

* 2 * DENSE lanes modulo 2**31 hashed from the whole paragraph, each two with a salt of their own: they decide
  equality, and two paragraphs that collide in some lanes don't in the others, and
* SKETCH lanes of two 31-bit counters hashed from the paragraph's word triples (a triple's hash sets half
  of the counters): the cosine of two centred sketches estimates how much two texts share, and
* the number of triples.

An edited text isn't hashed again: the vector of the paragraphs that it keeps, that of the paragraphs it takes
over and that of the one or two paragraphs at the cuts are added up.

Nulls and empty texts are one empty paragraph.  Equal texts have equal fingerprints and likeness 1.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checkpoint, text_of

DENSE, SKETCH = 6, 31
_M31 = (1 << 31) - 1
_TWO = 1 | (1 << 31)
#: Documents of neighbouring ids that are put side by side, on average, and the most buckets of them.
SIDE_BY_SIDE, MOST_BUCKETS = 256, 16_384


def _triples(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.xxhash64(a, b))
    return F.zip_with(pairs, F.slice(words, F.lit(3), F.size(words)), lambda a, b: F.xxhash64(a, b))


def paragraph_hashes(p: Column) -> Column:
    """DENSE hashes of the whole paragraph, then one of every word triple; the last two words stand for shorter triples."""
    whole = F.array(*[F.xxhash64(F.lit(j), p) for j in range(DENSE)])
    return F.concat(whole, _triples(F.transform(F.split(p, " "), lambda w: F.xxhash64(w))))


def units(paragraphs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, pos, h) of rows (keys, x): each hash of each paragraph x with its place."""
    rows = paragraphs.select(*keys, paragraph_hashes(F.col("x")).alias("hs"))  # apart from the generator, which then is compiled
    return rows.select(*keys, F.posexplode("hs").alias("pos", "h"))


def lane_sums() -> list[Column]:
    """Aggregates over rows of (pos, h)."""
    part = lambda half: (F.col("h") if not half else F.shiftrightunsigned("h", 32)).bitwiseAND(F.lit(_M31))
    dense = [F.sum(F.when(F.col("pos") == j // 2, part(j % 2)).otherwise(0)).alias(f"d{j}") for j in range(2 * DENSE)]
    sketch = [F.sum(F.when(F.col("pos") < DENSE, 0).otherwise(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(_TWO)))).alias(f"s{k}") for k in range(SKETCH)]
    return [*dense, *sketch, F.sum(F.when(F.col("pos") < DENSE, 0).otherwise(1)).alias("n_units")]


def lanes() -> Column:
    """The sums as one struct (dense, sketch, n)."""
    dense = F.array(*[F.col(f"d{j}").bitwiseAND(F.lit(_M31)) for j in range(2 * DENSE)])
    counts = [c for k in range(SKETCH) for c in (F.col(f"s{k}").bitwiseAND(F.lit(_M31)), F.shiftrightunsigned(f"s{k}", 31).bitwiseAND(F.lit(_M31)))]
    return F.struct(dense.alias("dense"), F.array(*counts).alias("sketch"), F.col("n_units").alias("n"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both texts' paragraphs together (sign 1), or of a's without b's (sign -1)."""
    add = lambda x, y: (x + sign * y).bitwiseAND(F.lit(_M31))
    return F.struct(F.zip_with(a["dense"], b["dense"], add).alias("dense"), F.zip_with(a["sketch"], b["sketch"], add).alias("sketch"), (a["n"] + sign * b["n"]).alias("n"))


def as_string(f: Column) -> Column:
    hexed = F.transform(F.concat(f["dense"], f["sketch"], F.array(f["n"])), lambda x: F.lpad(F.lower(F.hex(x)), 8, "0"))
    return F.array_join(hexed, "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1: the cosine of the centred sketches, 1 for equal fingerprints."""
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
    centred = lambda f: F.transform(f["sketch"], lambda c: 2.0 * c - f["n"])
    dot = total(F.zip_with(centred(a), centred(b), lambda x, y: x * y))
    norm = F.sqrt(total(F.transform(centred(a), lambda x: x * x)) * total(F.transform(centred(b), lambda x: x * x)))
    equal = (a["dense"] == b["dense"]) & (a["n"] == b["n"])
    return F.when(equal, 1.0).when(norm == 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), dot / norm)))


def fingerprint_by(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, lanes) over all texts of each key; the sums are pre-aggregated before any shuffle."""
    paragraphs = df.select(*keys, F.explode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("x"))
    return units(paragraphs, keys).groupBy(*keys).agg(*lane_sums()).select(*keys, lanes().alias("lanes"))


def _bucket(base: DataFrame) -> Column:
    """The bucket of each row of (doc_id, h), rising with doc_id and then h, and below 0 for null ids.

    Buckets end at quantiles of the ids, so clustered ids spread evenly.  An id that holds several quantiles
    (one with very many rows), and null ids, are split by ranges of h.
    """
    n, known = base.agg(F.count("*"), F.count("doc_id")).first()
    size = lambda rows: max(1, min(MOST_BUCKETS, -(-rows // SIDE_BY_SIDE)))
    at = F.col("h") / F.lit(2.0**64) + 0.5  # 0 to 1
    own = lambda buckets: F.least(F.floor(at * buckets), buckets - 1)
    nulls = size(n - known)
    without = own(F.lit(nulls)) - nulls
    if size(known) == 1:
        return F.when(F.col("doc_id").isNull(), without).otherwise(0).cast("long")
    ends = base.agg(F.percentile_approx("doc_id", [k / size(known) for k in range(1, size(known))], 8 * size(known))).first()[0]
    places, steps = F.lit(ends), F.sequence(F.lit(1), F.lit(len(ends).bit_length()))

    def below(than) -> Column:
        """How many ends are below the row's id (than: a comparison), by bisection."""
        def step(s: Column, _: Column) -> Column:
            mid = F.floor((s["low"] + s["high"]) / 2).cast("int")
            left = than(F.get(places, mid))
            return F.when(s["low"] >= s["high"], s).otherwise(F.struct(F.when(left, mid + 1).otherwise(s["low"]).alias("low"), F.when(left, s["high"]).otherwise(mid).alias("high")))

        return F.aggregate(steps, F.struct(F.lit(0).alias("low"), F.lit(len(ends)).alias("high")), step, lambda s: s["low"])

    low, high = below(lambda x: x < F.col("doc_id")), below(lambda x: x <= F.col("doc_id"))
    inside = F.when(high - low <= 1, high).otherwise(low + 1 + own(high - low))
    return F.when(F.col("doc_id").isNull(), without).otherwise(inside).cast("long")


def _side_by_side(base: DataFrame) -> DataFrame:
    """base with a bucket of neighbouring ids, and for each bucket a guest: the first row of the bucket that follows it (in descending order; the first bucket follows the last).

    Only guests and their bucket numbers move here, never all texts; there are 2 * MOST_BUCKETS buckets at most.
    """
    bucketed = base.withColumn("bucket", _bucket(base))
    firsts = checkpoint(bucketed.groupBy("bucket").agg(F.max(F.struct("doc_id", "h")).alias("first")))
    to = F.coalesce(F.lag("bucket").over(W.orderBy(F.desc("bucket"))), F.min("bucket").over(W.partitionBy(F.lit(0))))
    edges = F.broadcast(firsts.select(F.col("bucket").alias("from"), "first", to.alias("to")))
    first = (F.col("bucket") == F.col("from")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("h") == F.col("first.h"))
    guests = bucketed.join(edges, first).select("doc_id", "text", "h", F.col("to").alias("bucket")).dropDuplicates(["bucket"])
    return bucketed.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))


#: Segments of a text: paragraphs that the edited text doesn't keep (0), that it keeps (1), that the edited text of the document before takes over (2), both (3); and new paragraphs of the edited text (4).
KEPT, TAKEN, NEW = 1, 2, 4


def op1(documents: DataFrame) -> DataFrame:
    """The query.  Rows of one doc_id are ordered by a hash of their text; null ids come last.

    Texts move once, to their bucket; the rest happens there: windows and sums keep the bucket's partitioning.
    Every paragraph is hashed once: the sums of a text's segments make its own fingerprint and its part of two edited texts'.
    """
    base = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    order = W.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("h"))
    rows = _side_by_side(base).select("bucket", "doc_id", "guest", "h", "text", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("next"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    lines = lambda c: F.char_length(c) - F.char_length(F.replace(c, F.lit("\n"), F.lit(""))) + 1
    rows = rows.select("bucket", "rn", "doc_id", "guest", "h", "text", n.cast("long").alias("n_chars"), F.substr("text", F.lit(1), n - half).alias("left"), F.substr("next", F.lit(1), half).alias("right"))
    rows = rows.select("bucket", "rn", "doc_id", "guest", "h", "text", "n_chars", F.concat("left", "right").alias("edited"), lines("left").alias("p"), lines("right").alias("q"))
    # The edited text's line p is made of both texts; its last one, if another, is a part of the next text's.
    cut = F.split("edited", "\n")
    new = F.when(F.col("q") > 1, F.array(F.get(cut, F.col("p") - 1), F.element_at(cut, -1))).otherwise(F.array(F.get(cut, F.col("p") - 1)))
    rows = rows.select("bucket", "rn", "doc_id", "guest", "text", "n_chars", F.sha2("edited", 256).alias("sha"), F.when(F.col("guest"), F.array().cast("array<string>")).otherwise(new).alias("new"), F.when(F.col("guest"), 0).otherwise(F.col("p")).alias("p"), F.lag("q").over(order).alias("q"))
    segment = lambda i: F.when(i < F.col("p") - 1, KEPT).otherwise(0) + F.when((i >= 1) & (i < F.col("q") - 1), TAKEN).otherwise(0)
    parts = F.concat(F.transform(F.split("text", "\n"), lambda x, i: F.struct(segment(i).alias("seg"), x.alias("x"))), F.transform("new", lambda x: F.struct(F.lit(NEW).alias("seg"), x.alias("x"))))
    along = ["doc_id", "guest", "n_chars", "sha"]
    rows = rows.select("bucket", "rn", *along, F.explode(parts).alias("p")).select("bucket", "rn", *along, "p.seg", "p.x")
    # What goes along is part of the key, so that all buffers are numbers and the sums stay in a hash aggregate.
    key = ["bucket", "rn", "seg", *along]
    sums = units(rows, key).groupBy(*key).agg(*lane_sums()).select("bucket", "rn", *along, F.struct("seg", lanes().alias("lanes")).alias("s"))
    sides = sums.groupBy("bucket", "rn", *along).agg(F.map_from_entries(F.collect_list("s")).alias("segs"))  # five at most
    zero = F.struct(F.array_repeat(F.lit(0).cast("long"), 2 * DENSE).alias("dense"), F.array_repeat(F.lit(0).cast("long"), 2 * SKETCH).alias("sketch"), F.lit(0).cast("long").alias("n"))
    total = lambda which: reduce(combine, [F.coalesce(F.try_element_at("segs", F.lit(k)), zero) for k in which])
    rows = sides.select("bucket", "rn", *along, total((0, 1, 2, 3)).alias("own"), total((1, 3, 4)).alias("ed"), total((2, 3)).alias("taken"))
    by = W.partitionBy("bucket").orderBy("rn")
    rows = rows.select(*along, "own", "ed", F.lead("own").over(by).alias("following"), F.lead("taken").over(by).alias("taken")).filter(~F.col("guest"))
    rows = rows.withColumn("ed", combine(F.col("ed"), F.col("taken")))
    return rows.select(
        "doc_id", "n_chars", F.col("sha").alias("edited_sha256"), as_string(F.col("own")).alias("fingerprint"), as_string(F.col("ed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("ed")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
