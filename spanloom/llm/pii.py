"""PII: base patterns, then information-theoretic sanitisation of the words that come with them.

Every e-mail address, IP address, card number and phone number found is a protected entity, and so is each
kind of them: most single entities are in one text, where nothing can be estimated, but a word can also give
away that a text holds an address or a number.  The words of the texts that hold an entity are terms; over the
whole corpus, the pointwise mutual information of term and entity, as a share of the entity's own information,
says how strongly the term discloses it (1: it gives the entity away).  Terms at or over a threshold are
generalised, at or over a higher one removed, wherever they stand in a text that holds the entity.  Entities,
terms and pairs are all counted over distinct texts, so copies of a text change nothing.

Patterns are written so that no scan is quadratic and no group recurses; they find what the base patterns
find.  Null texts are empty.  Rows of equal doc_id and text get the same result each.  Of overlapping spans all
are reported; sanitising replaces them as one, named after the first (by start, then kind).  A table without
entities, or without rows, has no terms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, own_columns, small, small_or_not, text_of

KINDS = ("email", "ip", "card", "phone", "term")
# Start of a run, or just after the last match, so that no start inside a run is tried again.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A necessary condition that is cheap to check.
_HINT = {"email": "[A-Za-z0-9._%+-]@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": "[0-9](?:[ -]?[0-9]){13}", "phone": r"\+[0-9]"}
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM = r"\p{L}{3,}+"
#: Distinct texts of an entity that must hold a term; shares of the entity's information.
MIN_SUPPORT, GENERALISE, REMOVE = 3, 0.85, 0.95


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of the value, which is computed once however often body names it (inside other lambdas too)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def find_spans(text: Column, pattern: str, keep: Callable[[Column], Column] = lambda value: F.lit(True)) -> Column:
    """(start, end, value) of the leftmost non-overlapping matches that keep accepts, in code points: lengths of what lies between and of the matches are added up.

    Places are summed up in chunks of some sqrt(n), so that a text of n matches costs n ** 1.5 steps, not n ** 2.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern), lambda p: F.char_length(p))
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(gaps) - 1), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    size = lambda x: x["gap"] + F.char_length(x["value"])
    span = lambda s, x: F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + size(x)).alias("end"), x["value"].alias("value"))
    step = lambda s, x: F.struct((s["at"] + size(x)).alias("at"), F.when(keep(x["value"]), F.concat(s["out"], F.array(span(s, x)))).otherwise(s["out"]).alias("out"))

    def in_chunks(ps: Column) -> Column:
        width = F.greatest(F.lit(32), F.ceil(F.sqrt(F.size(ps))).cast("int"))
        return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(ps) / width).cast("int") - 1)), lambda k: F.slice(ps, k * width + 1, width))

    def placed(chunks: Column) -> Column:
        starts = F.aggregate(
            F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + size(x))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
            lambda s: s["out"],
        )
        return F.flatten(F.zip_with(chunks, starts, lambda c, at: F.aggregate(c, F.struct(at.alias("at"), none.alias("out")), step, lambda s: s["out"])))

    return _let(_let(pairs, in_chunks), placed)


def _luhn(digits: Column) -> Column:
    """Every second digit from the right is doubled; digit sums must end in 0."""
    d = F.transform(F.reverse(F.split(digits, "")), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise((c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5).cast("int")))
    return F.aggregate(d, F.lit(0), lambda s, x: s + x) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.char_length(digits).between(14, 19) & _luhn(digits)
    if kind == "phone":
        return F.char_length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """All valid base matches as (start, kind number, end, value), ordered."""
    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")

    def of(k: int, kind: str) -> Column:
        kept = F.filter(find_spans(text, PATTERNS[kind]), lambda s: valid(kind, s["value"]))
        return F.when(text.rlike(_HINT[kind]), F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))).otherwise(none)

    return F.array_sort(F.concat(*[of(k, kind) for k, kind in enumerate(KINDS[:-1])]))


def without_emails(text: Column) -> Column:
    """text with a blank for each character of an e-mail address; the other entities have no letters."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS["email"]), F.lit(0))
    blanked = F.zip_with(F.split(text, PATTERNS["email"]), found, lambda g, v: F.concat(g, F.coalesce(F.repeat(F.lit(" "), F.char_length(v)), F.lit(""))))
    return F.when(text.rlike(_HINT["email"]), F.array_join(blanked, "")).otherwise(text)


def words_of(text: Column) -> Column:
    """The distinct words of the text outside its e-mail addresses, lower-cased."""
    return F.array_distinct(F.transform(F.regexp_extract_all(without_emails(text), F.lit(TERM), F.lit(0)), lambda w: F.lower(w)))


def holders(spans: DataFrame, min_support: int = MIN_SUPPORT) -> DataFrame:
    """(h, entity, n_entity): the distinct texts of each entity and kind of entity that is in enough of them to have a term."""
    name = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    each = F.array_distinct(F.concat(F.transform("base", lambda s: F.struct(name(s).alias("kind"), s["value"].alias("value"))), F.transform("base", lambda s: F.struct(name(s).alias("kind"), F.lit(None).cast("string").alias("value")))))
    rows = checkpoint(spans.filter(F.size("base") > 0).select("h", F.explode(each).alias("e")).select("h", "e.kind", "e.value").distinct())
    values, kinds = rows.filter("value is not null").select("h", F.concat_ws(":", "kind", "value").alias("entity")), rows.filter("value is null").select("h", F.col("kind").alias("entity"))
    n = lambda df: df.groupBy("entity").agg(F.count("*").alias("n_entity")).filter(F.col("n_entity") >= min_support)
    held = values.join(n(values), "entity").unionByName(kinds.join(F.broadcast(n(kinds)), "entity"))  # four kinds at most
    return checkpoint(held.select("h", "entity", "n_entity"))


def _share(total: int, n_both: str, n_entity: str, n_term: str) -> Column:
    """The pointwise mutual information of term and entity over the entity's own information."""
    n = F.lit(float(max(total, 2)))
    own = F.log2(n / F.least(F.col(n_entity), n - 1))
    return F.log2(F.col(n_both) * n / (F.col(n_entity) * F.greatest(n_term, n_both))) / own


def disclosure(spans: DataFrame, documents: DataFrame, min_support: int = MIN_SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(h, term, share): of each text with entities its disclosing terms with the highest share.  spans are (h, base, words), documents (h, text).

    A term is in at least as many texts as there are texts with it and an entity, and its share for an entity of
    n texts is at most that of a term that is in all of them.  Terms whose share would be too low even so (common
    words) are out before texts are read again, and again before pairs are made.
    """
    held = holders(spans, min_support)
    sizes = checkpoint(spans.groupBy("h").agg(F.count("*").alias("copies")))
    total, copies = sizes.count(), small(checkpoint(sizes.filter("copies > 1")))
    each = small(checkpoint(held.groupBy("h").agg(F.max("n_entity").alias("most"))))
    own = spans.filter("words is not null").dropDuplicates(["h"])
    words = checkpoint(own.join(each, "h").select("h", "most", F.explode("words").alias("term")))
    able = lambda n_term: _share(total, "most", "most", n_term) >= generalise
    terms = words.groupBy("term").agg(F.count("*").alias("n_least"), F.max("most").alias("most")).filter((F.col("n_least") >= min_support) & able("n_least"))
    terms, few = small_or_not(checkpoint(terms.select("term", "most")))
    # Each copy of a text counts as its part of one text, so that counts are summed where texts are read.
    every = documents.join(copies, "h", "left").select((1 / F.coalesce("copies", F.lit(1))).alias("part"), F.explode(words_of(F.col("text"))).alias("term"))
    if few:
        every = every.join(terms.select("term"), "term", "left_semi")
    df = every.groupBy("term").agg(F.round(F.sum("part")).cast("long").alias("n_term"))
    df = small(checkpoint(df.join(terms, "term").filter(able("n_term")).select("term", "n_term")))
    both = held.join(words.select("h", "term").join(df, "term"), "h")
    pairs = both.groupBy("entity", "term", "n_entity", "n_term").agg(F.count("*").alias("n_both")).filter(F.col("n_both") >= min_support)
    told = pairs.select("entity", "term", _share(total, "n_both", "n_entity", "n_term").alias("share")).filter(F.col("share") >= generalise)
    told = small(checkpoint(told))
    return both.join(told, ["entity", "term"]).groupBy("h", "term").agg(F.max("share").alias("share"))


def term_spans(spans: DataFrame, documents: DataFrame, min_support: int = MIN_SUPPORT, generalise: float = GENERALISE) -> DataFrame:
    """(h, terms): all spans of disclosing terms as (start, kind number, end, share), one row for a text that has any.  spans are (h, base, words), documents (h, text)."""
    told = disclosure(spans, documents, min_support, generalise)
    told = small(checkpoint(told.groupBy("h").agg(F.map_from_entries(F.collect_list(F.struct("term", "share"))).alias("told"))))
    found = find_spans(without_emails(F.col("text")), TERM, lambda w: F.map_contains_key("told", F.lower(w)))
    own = F.transform(found, lambda t: F.struct(t["start"].alias("start"), F.lit(KINDS.index("term")).alias("kind"), t["end"].alias("end"), F.element_at("told", F.lower(t["value"])).alias("share")))
    return documents.join(told, "h").select("h", own.alias("terms")).dropDuplicates(["h"])


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, h, base, words) of every row, kept in the shared folder, so that patterns run once over the texts; h tells texts apart, words is null for texts without base matches."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("base", base_spans(F.col("text")))
    return checkpoint(rows.select("doc_id", F.xxhash64("text").alias("h"), "base", F.when(F.size("base") > 0, words_of(F.col("text"))).alias("words")))


def texts_of(documents: DataFrame) -> DataFrame:
    """(h, text) of every row."""
    return documents.select(text_of().alias("text")).select(F.xxhash64("text").alias("h"), "text")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def op10(documents: DataFrame) -> DataFrame:
    """The query."""
    spans = scan(documents)
    terms = small(checkpoint(term_spans(spans, texts_of(documents))))
    rows = spans.select("doc_id", "h", "base").join(terms, "h", "left")
    plain = lambda c: F.transform(F.col(c), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    every = F.array_sort(F.concat(plain("base"), F.coalesce(plain("terms"), F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:-1])], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"))


def replaced(text: Column, spans: Column) -> Column:
    """text with each of the sorted spans (start, kind, end, share) replaced."""
    label = lambda s: F.when(s["share"] >= REMOVE, "").otherwise(F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]")))
    cut = lambda a, s: F.concat(F.substr(text, a["at"] + 1, s["start"] - a["at"]), label(s))
    step = lambda a, s: F.when(s["start"] >= a["at"], F.struct(s["end"].alias("at"), F.concat(a["out"], F.array(cut(a, s))).alias("out"))).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out")))
    done = lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1, F.char_length(text) - a["at"]))
    return F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), step, done)


def sanitise(documents: DataFrame, **limits) -> DataFrame:
    """documents with each span replaced: base matches and generalised terms by their kind in brackets, removed terms by nothing; overlapping spans become one, named after the first.  Other columns stay as they are, whatever their names; null texts stay null."""
    terms = small(checkpoint(term_spans(scan(documents), texts_of(documents), **limits)))
    rows = documents.select(F.struct(*own_columns(documents)).alias("row"), text_of().alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.join(terms, "h", "left")
    kind = "array<struct<start:int,kind:int,end:int,share:double>>"
    base = F.transform(base_spans(F.col("text")), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(0.0).alias("share")))
    rows = rows.withColumn("every", F.array_sort(F.concat(base, F.coalesce(F.col("terms").cast(kind), F.array().cast(kind)))))
    clean = F.when(F.size("every") == 0, F.col("row")["text"]).otherwise(replaced(F.col("text"), F.col("every")))
    return rows.select(*[(clean if c.lower() == "text" else F.col("row").getField(c)).alias(c) for c in documents.columns])
