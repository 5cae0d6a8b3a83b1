"""Chat formatting of heterogeneous conversation layouts, DataFrame functions only.

A record's *fingerprint* is the hash of the nested field paths it has, out of
all paths that some layout names.  Layouts are declarations: their paths and,
for each turn, where role and text come from.  The fingerprint selects the
layout; records whose fingerprint no layout has get no turns (``layout`` is
null), they are not guessed at.

Every layout ends in the same turn rows, and these in one formatted text per
conversation:

    <|turn|>role<|text|>text<|end|>\\n   for each turn

Control strings inside roles and texts are replaced by an escape character
and a digit, reversibly, so they cannot be taken for marks.  The loss mask is
a list of (start, length), in code points, of the assistant texts.

Null roles and texts are empty.  Turns are ordered by (turn, role, text),
nulls first, so ties and repeated rows have one order; a null conversation id
is a conversation of its own.  An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
ESCAPE = "␛"
#: Replaced inside texts: what opens this template's marks, and those of other common templates. Fixed values.
CONTROL = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<start_of_turn>", "<end_of_turn>")
#: Canonical names of speakers.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """``items`` is the path of a list of turns, empty where the record holds the turns itself.

    ``turns`` has (role, text path) pairs; a role that starts with $ is a path.
    ``order`` is the path of the turn's number where each record is one turn.
    """
    name: str
    turns: tuple[tuple[str, str], ...]
    items: str = ""
    order: str = ""

    def paths(self) -> frozenset[str]:
        own = {p for role, text in self.turns for p in (role.removeprefix("$") if role[0] == "$" else "", text) if p}
        return frozenset({f"{self.items}[].{p}" if self.items else p for p in own} | ({self.order} if self.order else set()))


LAYOUTS = (
    Layout("turn rows", (("$role", "text"),), order="turn"),
    Layout("messages", (("$role", "content"),), items="messages"),
    Layout("conversations", (("$from", "value"),), items="conversations"),
    Layout("prompt", (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt completion", (("user", "prompt"), ("assistant", "completion"))),
    Layout("question", (("user", "question"), ("assistant", "answer"))),
    Layout("system question", (("system", "system"), ("user", "question"), ("assistant", "answer"))),
    Layout("instruction", (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction input", (("user", "instruction"), ("user", "input"), ("assistant", "output"))),
)


def known_paths(layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    return sorted({p for x in layouts for p in x.paths()})


def digest(paths) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def schema_paths(schema: T.StructType, prefix: str = "") -> set[str]:
    """Nested field paths of a schema; [] stands for the items of a list."""
    out = set()
    for f in schema.fields:
        kind, path = f.dataType, prefix + f.name
        while isinstance(kind, T.ArrayType):
            kind, path = kind.elementType, path + "[]"
        out |= schema_paths(kind, path + ".") if isinstance(kind, T.StructType) else {path}
    return out


def by_detail(layouts: tuple[Layout, ...]) -> list[Layout]:
    """Layouts with more fields first: where several fit, the most specific one is meant."""
    return sorted(layouts, key=lambda x: -len(x.paths()))


def _select(layouts: tuple[Layout, ...], paths: set[str]) -> Layout | None:
    """The most specific layout whose fingerprint is that of its share of the fields found."""
    return next((x for x in by_detail(layouts) if digest(x.paths()) == digest(paths & set(x.paths()))), None)


def _turn(*parts: Column) -> Column:
    role, text = parts
    return F.struct(role.cast("string").alias("role"), text.cast("string").alias("text"))


def _item_turn(name: Column, role: str, text: str) -> Callable[[Column], Column]:
    """The turn of a list item, its speaker under the canonical name."""
    return lambda item: _turn(F.coalesce(name[item[role]], item[role]), item[text])


def turn_rows(df: DataFrame, conv: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv, turn, role, text) of a table whose columns have one layout.

    Columns that the layout doesn't name are ignored, also where another layout
    has them.  Raises ValueError if no layout's fields are all there.
    """
    layout = _select(layouts, schema_paths(df.schema))
    if layout is None:
        raise ValueError(f"no layout for the fields {sorted(schema_paths(df.schema))}")
    name = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    if layout.order:
        (role, text), = layout.turns
        return df.select(F.col(f"`{conv}`").alias("conv"), F.col(layout.order).cast("long").alias("turn"),
                         F.col(role[1:]).cast("string").alias("role"), F.col(text).cast("string").alias("text"))
    if layout.items:
        (role, text), = layout.turns
        turns = F.transform(F.col(layout.items), _item_turn(name, role[1:], text))
    else:
        turns = F.array(*[_turn(F.lit(role), F.col(text)) for role, text in layout.turns])
    return df.select(F.col(f"`{conv}`").alias("conv"), F.posexplode_outer(turns).alias("turn", "t")).filter("turn is not null").select(
        "conv", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def json_turns(df: DataFrame, raw: str, conv: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(conv, layout, turns) of JSON records of mixed layouts.

    The paths of each record are found (in a list: of any item), and those of
    each layout hashed and compared row by row, the most specific layout first;
    a null field counts as missing.  Records without a layout, invalid and null
    ones have null layout and turns.
    """
    layouts = tuple(x for x in layouts if not x.order)
    col = F.col(f"`{raw}`")
    there = {p: F.when(F.get_json_object(col, "$." + p.replace("[]", "[*]")).isNotNull(), F.lit(p)) for p in known_paths(layouts)}
    prints = F.array(*[F.sha2(F.concat_ws("\n", *[there[p] for p in sorted(x.paths())]), 256) for x in layouts])
    out = df.select(F.col(f"`{conv}`").alias("conv"), col.alias("raw"), prints.alias("fingerprints"))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    name = F.create_map(*[F.lit(x) for kv in ROLES.items() for x in kv])
    for x in reversed(by_detail(layouts)):
        if x.items:
            (role, text), = x.turns
            items = F.from_json("raw", f"`{x.items}` array<struct<`{role[1:]}`:string,`{text}`:string>>")[x.items]
            got = F.transform(items, _item_turn(name, role[1:], text))
        else:
            got = F.array(*[_turn(F.lit(role), F.get_json_object("raw", f"$.{text}")) for role, text in x.turns])
        mine = F.col("fingerprints")[layouts.index(x)] == digest(x.paths())
        layout, turns = F.when(mine, F.lit(x.name)).otherwise(layout), F.when(mine, got).otherwise(turns)
    return out.select("conv", layout.alias("layout"), turns.alias("turns"))


def explode_turns(records: DataFrame) -> DataFrame:
    """Turn rows of the result of json_turns."""
    return records.select("conv", F.posexplode("turns").alias("turn", "t")).select(
        "conv", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
    for k, c in enumerate(CONTROL, 1):
        text = F.replace(text, F.lit(c), F.lit(f"{ESCAPE}{k}"))
    return text


def unescape(text: Column) -> Column:
    for k in range(len(CONTROL), 0, -1):
        text = F.replace(text, F.lit(f"{ESCAPE}{k}"), F.lit(CONTROL[k - 1]))
    return F.replace(text, F.lit(ESCAPE + "0"), F.lit(ESCAPE))


def render(turns: DataFrame) -> DataFrame:
    """(conv, formatted, loss_mask) of turn rows; one shuffle by conversation.

    Turns are escaped and their lengths summed up before they are gathered;
    what is gathered for a conversation is its one output row.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv", "turn", role.alias("role"), text.alias("text"), escape(role).alias("r"), escape(text).alias("x"))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    head = F.char_length("r") + len(TURN) + len(TEXT)
    whole = head + F.char_length("x") + len(END)
    rows = rows.select(
        "conv", F.row_number().over(order).alias("pos"), F.concat(F.lit(TURN), "r", F.lit(TEXT), "x", F.lit(END)).alias("piece"),
        F.when(F.col("role") == "assistant", F.struct(
            (F.coalesce(F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + head).alias("start"),
            F.char_length("x").cast("long").alias("length"))).alias("loss"))
    parts = F.sort_array(F.collect_list(F.struct("pos", "piece", "loss")))
    return rows.groupBy("conv").agg(parts.alias("p")).select(
        "conv", F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("p", lambda x: x["loss"]), lambda x: x.isNotNull()).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv, turns, loss_text, formatted) parsed from formatted texts and their masks."""
    pieces = F.filter(F.split("formatted", r"<\|end\|>\n"), lambda x: x != "")

    def turn(piece: Column) -> Column:
        cut = F.split(F.replace(piece, F.lit(TURN), F.lit("")), r"<\|text\|>")
        return F.struct(unescape(cut[0]).alias("role"), unescape(cut[1]).alias("text"))

    masked = F.transform("loss_mask", lambda m: unescape(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    return formatted.select("conv", F.transform(pieces, turn).alias("turns"), F.array_join(masked, "").alias("loss_text"), "formatted")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(probe).alias("text"))
    got = read_back(render(turn_rows(rows.unionByName(more))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                      F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                      F.char_length("formatted").cast("long").alias("formatted_chars"))


def _sql() -> str:
    longer = " + ".join(["length(regexp_replace({0}, '[^%s]', '', 'g'))" % ESCAPE] + [
        f"(2 - {len(c)}) * ((length({{0}}) - length(replace({{0}}, '{c}', ''))) // {len(c)})" for c in CONTROL])
    marks = len(TURN) + len(TEXT) + len(END)
    return f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
g AS (
  SELECT conv_id, count(*) AS n,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length(role) + length(text) + {marks} + {longer.format("role")} + {longer.format("text")}) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       chars::BIGINT AS formatted_chars
FROM g
"""


SQL = _sql()
