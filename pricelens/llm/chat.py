"""Chat formatting by schema fingerprinting, in DataFrame functions only.

A layout is known by the nested field paths it uses.  The paths of a table's
schema (or, for JSON text, of each record) that any known layout uses are
hashed to a fingerprint, which selects the layout's declarative mapping to
canonical turns (conv_id, turn, role, text).  The template then marks turns,
escapes control strings inside texts reversibly, and gives the loss mask as
code point spans over the assistant texts.

Defined results: a null text or role is empty; rows of one conversation are
ordered by turn, then role, then text (nulls first), so ties and repeated rows
have one order; a null conv_id is a conversation of its own; other columns are
ignored whatever their names; an empty table gives an empty table; a schema or
record of no known layout is an error or, for JSON records, a row with a null
layout and no turns.  A conversation is one training example and becomes one
string, so its turns meet in one task.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's marks, and control strings of widespread chat
# templates, which a text must not be able to forge.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")

# Layout -> (its field paths, its mapping).  "rows": one turn a row; "list": an
# array of turns in a field; "fields": one turn a field, in the order given.
LAYOUTS = {
    "turn_rows": (("turn", "role", "text"), ("rows", "turn", "role", "text")),
    "messages": (("messages[].role", "messages[].content"), ("list", "messages", "role", "content")),
    "from_value": (("conversations[].from", "conversations[].value"), ("list", "conversations", "from", "value")),
    "prompt_completion": (("prompt", "completion"), ("fields", (("user", ("prompt",)), ("assistant", ("completion",))))),
    "prompt_response": (("prompt", "response"), ("fields", (("user", ("prompt",)), ("assistant", ("response",))))),
    "system_prompt_response": (("system", "prompt", "response"),
                               ("fields", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))))),
    "instruction_output": (("instruction", "output"), ("fields", (("user", ("instruction",)), ("assistant", ("output",))))),
    "instruction_input_output": (("instruction", "input", "output"),
                                 ("fields", (("user", ("instruction", "input")), ("assistant", ("output",))))),
}
# Names other layouts give the canonical roles.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
KNOWN_PATHS = sorted({p for paths, _ in LAYOUTS.values() for p in paths})


def fingerprint(paths) -> str:
    """Hash of the known ones among ``paths``, whatever their order."""
    return hashlib.sha256("\n".join(p for p in KNOWN_PATHS if p in set(paths)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}
# Layouts in the order they are tried where a table or record has further known
# fields: the most paths first, then as listed above.
BY_PATHS = sorted(LAYOUTS, key=lambda name: -len(LAYOUTS[name][0]))


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` stands for an array's element."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def layout_of(df: DataFrame) -> str:
    """The layout whose fingerprint the table's schema has; if it has further
    known fields, the layout with the most paths that are all there.  Names
    count whatever their case, as columns do."""
    fields = [p.lower() for p in field_paths(df.schema)]
    whole = [fingerprint(fields), *[fingerprint(LAYOUTS[name][0]) for name in BY_PATHS if set(LAYOUTS[name][0]) <= set(fields)]]
    name = next((BY_FINGERPRINT[f] for f in whole if f in BY_FINGERPRINT), None)
    if name is None:
        raise ValueError(f"no known chat layout has the fields {field_paths(df.schema)}")
    return name


def _role(role):
    names = F.create_map(*[F.lit(x) for kv in ROLE_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, role), role)


def _turns(df: DataFrame, conv_id, mapping, get) -> DataFrame:
    """Canonical turns by ``mapping``; ``get(field)`` reads a field's column."""
    kind = mapping[0]
    if kind == "rows":
        return df.select(conv_id.alias("conv_id"), get(mapping[1]).cast("bigint").alias("turn"),
                         get(mapping[2]).cast("string").alias("role"), get(mapping[3]).cast("string").alias("text"))
    if kind == "list":
        rows = df.select(conv_id.alias("conv_id"), F.posexplode(get(mapping[1])).alias("turn", "_m"))
        return rows.select("conv_id", F.col("turn").cast("bigint").alias("turn"), _role(F.col("_m").getField(mapping[2]).cast("string")).alias("role"),
                           F.col("_m").getField(mapping[3]).cast("string").alias("text"))
    turns = [F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"),
                      F.concat_ws("\n\n", *[F.nullif(get(f).cast("string"), F.lit("")) for f in fields]).alias("text"))
             for i, (role, fields) in enumerate(mapping[1])]
    return df.select(conv_id.alias("conv_id"), F.inline(F.array(*turns)))


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """The turns of a table in any known layout."""
    return _turns(df, F.col(f"`{id_col}`"), LAYOUTS[layout_of(df)][1], lambda f: F.col(f"`{f}`"))


def json_layouts(df: DataFrame, json_col: str = "record") -> DataFrame:
    """``df`` with ``layout``: the layout each JSON record's field paths select,
    those of all keys or, if no layout has them, of the keys with a value; else
    the layout with the most paths that are all among the keys.  A list has the
    keys of any of its elements."""
    v = F.try_parse_json(F.col(f"`{json_col}`"))
    names = F.create_map(*[F.lit(x) for kv in BY_FINGERPRINT.items() for x in kv])

    def has(path, kind):
        field, _, inner = path.partition("[].")
        if not inner:
            return F.try_variant_get(v, f"$.{field}", kind).isNotNull()
        return F.exists(F.try_variant_get(v, f"$.{field}", "array<variant>"), lambda e: F.try_variant_get(e, f"$.{inner}", kind).isNotNull())

    # a null is a variant, but no string
    prints = [F.sha2(F.concat_ws("\n", *[F.when(has(p, kind), F.lit(p)) for p in KNOWN_PATHS]), 256) for kind in ("variant", "string")]
    some = [F.when(reduce(lambda a, b: a & b, [F.coalesce(has(p, "variant"), F.lit(False)) for p in LAYOUTS[name][0]]), F.lit(name)) for name in BY_PATHS]
    return df.withColumn("layout", F.coalesce(*[F.try_element_at(names, p) for p in prints], *some))


def json_turns(df: DataFrame, id_col: str = "conv_id", json_col: str = "record") -> DataFrame:
    """The turns of JSON records of mixed layouts, each by its own mapping."""
    known = json_layouts(df.select(F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{json_col}`").alias("record")), "record")
    out = None
    for name, (_, mapping) in LAYOUTS.items():
        rows = known.where(F.col("layout") == name)
        if mapping[0] == "list":
            kind = f"array<struct<`{mapping[2]}`:string,`{mapping[3]}`:string>>"
            part = _turns(rows, F.col("conv_id"), mapping, lambda f, kind=kind: F.from_json(F.get_json_object("record", f"$.{f}"), kind))
        else:
            part = _turns(rows, F.col("conv_id"), mapping, lambda f: F.get_json_object("record", f"$.{f}"))
        out = part if out is None else out.unionByName(part)
    return out


def escape(text):
    """Control strings broken by a backslash after their first character; backslashes doubled."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROLS:
        text = F.replace(text, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}"))
    return text


def unescape(text):
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row a conversation: ``formatted`` and ``loss_spans``, the code point
    ranges (start, end) of the texts a model is trained on."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = turns.select("conv_id", F.concat(F.lit(TURN), escape(blank("role")), F.lit(TEXT)).alias("head"), escape(blank("text")).alias("body"),
                        (blank("role") == loss_role).alias("is_loss"), "turn", blank("role").alias("role"), blank("text").alias("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    size = F.length("head") + F.length("body") + len(END)
    rows = rows.select("conv_id", "head", "body", "is_loss", F.row_number().over(order).alias("at"),
                       (F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")).alias("start"))
    turn = F.struct("at", F.concat("head", "body", F.lit(END)).alias("piece"), "is_loss", "start", (F.col("start") + F.length("body")).alias("end"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return chats.select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
                        F.transform(F.filter("t", lambda x: x["is_loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_spans"))


def read_chats(chats: DataFrame) -> DataFrame:
    """Turns and loss texts read back from formatted chats: ``turns`` (role,
    text) in order and ``loss_text``, the texts under the mask, unescaped."""
    pieces = F.split("formatted", "<\\|end\\|>", -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    parts = F.transform(pieces, lambda p: F.split(F.substring(p, F.lit(len(TURN) + 1), F.length(p)), "<\\|text\\|>", 2))
    turns = F.transform(parts, lambda p: F.struct(unescape(p[0]).alias("role"), unescape(p[1]).alias("text")))
    spans = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return chats.withColumns({"turns": turns, "loss_text": F.array_join(spans, "")})
