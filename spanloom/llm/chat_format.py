"""Chat formatting: layouts are told apart by a hash of their nested field paths, which selects a declarative mapping into canonical turns.

A *layout* is the set of field paths that a record has, out of all paths that any mapping names; unknown
fields don't count.  Its fingerprint is the SHA-256 of the sorted paths, and selects the mapping of just these
paths; if there is none, the mapping of most paths (then the first listed) that are all there, so extra fields
with names of other mappings change nothing.  A path is there by its key: a null value counts.
A mapping lists, for each turn it makes, a role and the path of its text, or names an array of messages.

Canonical turns are formatted with marks for each turn; marks (and those of other common templates) that
occur inside texts are escaped reversibly.  All steps are Spark expressions.

Nulls: a null role or text is the empty string, a null turn sorts first, null conversation ids form one
conversation, records without a mapping give no turns (`unmapped_json` lists them with their fingerprints).  A
text that is no string is its JSON.  Ties of a turn number are ordered by role and text.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Control strings of common chat templates; each is escaped inside texts.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_sep|>", "<|im_end|>", "<|endoftext|>")
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: Between the first character of a control string and its rest.
_INSIDE = r"(?<=<)(?=/?s>|</?SYS>>|\|im_start\|>|\|im_sep\|>|\|im_end\|>|\|endoftext\|>)|(?<=\[)(?=/?INST\])"

#: name: fields, and either turns (role, path) or messages (array, role field, text field), or rows (id, order, role, text).
MAPPINGS: dict[str, dict] = {
    "turn_rows": {"rows": ("conv_id", "turn", "role", "text")},
    "messages": {"messages": ("messages", "role", "content")},
    "conversations": {"messages": ("conversations", "from", "value")},
    "instruction": {"turns": (("user", "instruction"), ("assistant", "output"))},
    "instruction_input": {"turns": (("system", "instruction"), ("user", "input"), ("assistant", "output"))},
    "prompt_completion": {"turns": (("user", "prompt"), ("assistant", "completion"))},
    "prompt_response": {"turns": (("user", "prompt"), ("assistant", "response"))},
    "question_answer": {"turns": (("user", "question"), ("assistant", "answer"))},
    "system_prompt_response": {"turns": (("system", "system"), ("user", "prompt"), ("assistant", "response"))},
}
# Other names of the three roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def mapping_paths(mapping: dict) -> tuple[str, ...]:
    if "rows" in mapping:
        return tuple(sorted(mapping["rows"]))
    if "messages" in mapping:
        array, role, text = mapping["messages"]
        return tuple(sorted((f"{array}[].{role}", f"{array}[].{text}")))
    return tuple(sorted(path for _, path in mapping["turns"]))


def fingerprint(paths: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """The nested paths of a schema's leaves; [] stands for an array's elements."""
    if isinstance(schema, T.StructType):
        return [p for f in schema.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    return [prefix]


UNIVERSE = sorted({p for m in MAPPINGS.values() for p in mapping_paths(m)})
BY_FINGERPRINT = {fingerprint(mapping_paths(m)): name for name, m in MAPPINGS.items()}


#: Names by falling number of paths, then in the order of the list.
BY_SIZE = sorted(MAPPINGS, key=lambda name: -len(mapping_paths(MAPPINGS[name])))


def select_mapping(df: DataFrame) -> str:
    """The name of the mapping for a table's layout; ValueError if there is none."""
    paths = {p for p in field_paths(df.schema) if p in set(UNIVERSE)}
    print_ = fingerprint(list(paths))
    name = BY_FINGERPRINT.get(print_) or next((n for n in BY_SIZE if paths.issuperset(mapping_paths(MAPPINGS[n]))), None)
    if name is None:
        raise ValueError(f"no mapping for the layout {print_}")
    return name


def escape(text: Column) -> Column:
    """Backslashes are doubled, and one is put after the first character of each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _INSIDE, "\\\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(_text(role).alias("role"), _text(text).alias("text"))


def _canonical_role(role: Column) -> Column:
    for other, name in ROLE_NAMES.items():
        role = F.when(role == other, name).otherwise(role)
    return role


def _message_turns(messages: Column, role: str, text: str) -> Column:
    return F.transform(messages, lambda m: _turn(_canonical_role(m[role]), m[text]))


def canonical_turns(df: DataFrame) -> DataFrame:
    """(record, turn, role, text) rows of a table in any known layout with a column per field; record is its id column `record`, or conv_id for turn rows."""
    mapping = MAPPINGS[select_mapping(df)]
    if "rows" in mapping:
        key, order, role, text = mapping["rows"]
        return df.select(F.col(key).alias("record"), F.col(order).cast("long").alias("turn"), _text(F.col(role)).alias("role"), _text(F.col(text)).alias("text"))
    if "messages" in mapping:
        array, role, text = mapping["messages"]
        turns = _message_turns(F.col(array), role, text)
    else:
        turns = F.array(*[_turn(F.lit(role), F.col(path)) for role, path in mapping["turns"]])
    return df.select("record", F.posexplode(turns).alias("turn", "t")).select("record", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def _json_text(v: Column, path: str) -> Column:
    """A field as text: strings as they are, null as null, all else as its JSON."""
    return F.when(~F.is_variant_null(_get(v, path)), F.coalesce(_get(v, path, "string"), F.to_json(_get(v, path))))


def _layouts(df: DataFrame, record: str, column: str) -> DataFrame:
    """(record, v, paths, print) of each record: its own nested paths, from all elements of its arrays, and their hash."""
    def has(path: str) -> Column:
        if "[]." not in path:
            return _get(F.col("v"), path).isNotNull()
        array, field = path.split("[].")
        return F.exists(_get(F.col("v"), array, "array<variant>"), lambda x: _get(x, field).isNotNull())

    rows = df.select(F.col(record).alias("record"), F.try_parse_json(F.col(column)).alias("v"))
    rows = rows.withColumn("paths", F.array_compact(F.array(*[F.when(has(p), F.lit(p)) for p in UNIVERSE])))
    return rows.withColumn("print", F.sha2(F.concat_ws("\n", "paths"), 256))


def _mapping_of(paths: Column, print_: Column) -> Column:
    """The name of the mapping, looked up by the fingerprint; null if there is none."""
    known = F.try_element_at(F.create_map(*[F.lit(x) for pair in BY_FINGERPRINT.items() for x in pair]), print_)
    fits = [F.when(F.size(F.array_except(F.array(*map(F.lit, mapping_paths(MAPPINGS[n]))), paths)) == 0, F.lit(n)) for n in BY_SIZE]
    return F.coalesce(known, *fits)


def canonical_turns_json(df: DataFrame, record: str, column: str) -> DataFrame:
    """The same for records of mixed layouts in a JSON column: each row's own paths are hashed, and its mapping is looked up by that hash."""
    rows, v = _layouts(df, record, column).withColumn("mapping", _mapping_of(F.col("paths"), F.col("print"))), F.col("v")
    turns = F.lit(None).cast("array<struct<turn:long,role:string,text:string>>")
    turn = lambda k, role, text: F.struct(k.cast("long").alias("turn"), *(_text(c).alias(n) for n, c in (("role", role), ("text", text))))
    message = lambda role, text: lambda m, k: turn(k, _canonical_role(_json_text(m, role)), _json_text(m, text))
    for name, mapping in MAPPINGS.items():
        if "messages" in mapping:
            array, role, text = mapping["messages"]
            made = F.transform(_get(v, array, "array<variant>"), message(role, text))
        elif "turns" in mapping:
            made = F.array(*[turn(F.lit(k), F.lit(role), _json_text(v, path)) for k, (role, path) in enumerate(mapping["turns"])])
        else:
            _, order, role, text = mapping["rows"]
            made = F.array(turn(_get(v, order, "long"), _canonical_role(_json_text(v, role)), _json_text(v, text)))
        turns = F.when(F.col("mapping") == name, made).otherwise(turns)
    return rows.select("record", F.explode(turns).alias("t")).select("record", "t.*")


def unmapped_json(df: DataFrame, record: str, column: str) -> DataFrame:
    """(record, paths, print) of the records that no mapping fits, among them those that are no JSON."""
    rows = _layouts(df, record, column)
    return rows.filter(_mapping_of(F.col("paths"), F.col("print")).isNull()).select("record", "paths", "print")


def format_turns(turns: DataFrame) -> DataFrame:
    """(record, formatted, loss_mask) of canonical turns.

    loss_mask has, for each assistant turn in order, its number, the start of its text in `formatted`
    (code points from 0), its start within the turn's segment and its escaped length.
    """
    order = W.partitionBy("record").orderBy("turn", "role", "text")
    segments = (
        turns.withColumn("n", F.row_number().over(order).cast("long") - 1)
        .withColumn("head", F.concat(F.lit(START), escape(F.col("role")), F.lit(SEP)))
        .withColumn("body", escape(F.col("text")))
        .select("record", "turn", "role", "text", "n", F.concat("head", "body", F.lit(END)).alias("seg"), F.char_length("head").alias("at"), F.char_length("body").alias("len"))
    )
    placed = segments.withColumn("start", F.coalesce(F.sum(F.char_length("seg").cast("long")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")))
    item = F.struct("n", "seg", (F.col("role") == "assistant").alias("loss"), (F.col("start") + F.col("at")).alias("start"), F.col("at").cast("long").alias("within"), F.col("len").cast("long").alias("length"))
    return placed.groupBy("record").agg(F.sort_array(F.collect_list(item)).alias("segs")).select(
        "record",
        F.array_join(F.transform("segs", lambda s: s["seg"]), "").alias("formatted"),
        F.transform(F.filter("segs", lambda s: s["loss"]), lambda s: F.struct(s["n"].alias("n"), s["start"].alias("start"), s["within"].alias("within"), s["length"].alias("length"))).alias("loss_mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped: an array of (role, text)."""
    segs = F.split(formatted, r"<\|im_end\|>")
    parts = F.transform(F.slice(segs, F.lit(1), F.size(segs) - 1), lambda s: F.split(F.substring(s, len(START) + 1, 2**31 - 1), r"<\|im_sep\|>"))
    return F.transform(parts, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    segs = F.split(formatted, r"<\|im_end\|>")
    texts = F.transform(mask, lambda m: unescape(F.substr(F.element_at(segs, m["n"].cast("int") + 1), m["within"].cast("int") + 1, m["length"].cast("int"))))
    return F.array_join(texts, "")


def digest(formatted: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted text and its mask."""
    read = formatted.select("record", F.char_length("formatted").cast("long").alias("formatted_chars"), read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return read.select(
        F.col("record").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op2(conversations: DataFrame) -> DataFrame:
    """The query: all conversations, whose layout is a table of turns, and conversation -7, a JSON record of messages whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    record = json.dumps({"messages": [{"role": "user", "content": text}, {"role": "assistant", "content": text}]})
    own = canonical_turns_json(conversations.sparkSession.createDataFrame([(-7, record)], "record long, json string"), "record", "json")
    rows = canonical_turns(conversations).withColumn("record", F.col("record").cast("long"))
    return digest(format_turns(rows.unionByName(own)))


#: The same from the table alone; formatted_chars follows from the template's lengths.
OP2_SQL = r"""
WITH c AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(role) + length(text)
    + length(regexp_replace(role || chr(10) || text, '[^\\]', '', 'g'))
    + len(regexp_extract_all(role || chr(10) || text, '</?s>|\[/?INST\]|<</?SYS>>|<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>'))
    + 12 + 10 + 10 AS chars FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  COALESCE(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
