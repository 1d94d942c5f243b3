"""Chat formatting: records of different layouts into canonical turns, a reversible template, a loss mask (DataFrame functions only)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
# Roles under the loss mask.
LEARNED = ("assistant",)
_TURN = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """A declarative mapping: the nested field paths of a record, its JSON schema, and its turns as an SQL expression over ``{r}``.

    ``fields`` are the paths with which records may come, several sets if some
    fields are optional; list elements are written ``[]``.
    """

    name: str
    fields: Sequence[Sequence[str]]
    schema: str
    turns: str


# Roles of other layouts and their canonical names.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bing": "assistant", "chatgpt": "assistant", "model": "assistant", "prompter": "user"}
_ROLE = "CASE t.`from` " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in ROLE_NAMES.items()) + " ELSE t.`from` END"

LAYOUTS = (
    Layout(
        "messages",
        [["messages[].content", "messages[].role"], ["messages[]"]],
        "messages array<struct<role: string, content: string>>",
        "transform({r}.messages, t -> struct(t.role AS role, t.content AS text))",
    ),
    Layout(
        "conversations",
        [["conversations[].from", "conversations[].value"], ["conversations[]"]],
        "conversations array<struct<`from`: string, value: string>>",
        "transform({r}.conversations, t -> struct(" + _ROLE + " AS role, t.value AS text))",
    ),
    Layout(
        "instruction",
        [["input", "instruction", "output"], ["instruction", "output"]],
        "instruction string, input string, output string",
        "array(struct('user' AS role, concat_ws('\\n', {r}.instruction, nullif({r}.input, '')) AS text), struct('assistant' AS role, {r}.output AS text))",
    ),
    Layout(
        "system prompt",
        [["prompt", "response", "system"]],
        "system string, prompt string, response string",
        "array(struct('system' AS role, {r}.system AS text), struct('user' AS role, {r}.prompt AS text), struct('assistant' AS role, {r}.response AS text))",
    ),
    Layout(
        "prompt",
        [["prompt", "response"]],
        "prompt string, response string",
        "array(struct('user' AS role, {r}.prompt AS text), struct('assistant' AS role, {r}.response AS text))",
    ),
    Layout(
        "completion",
        [["completion", "prompt"]],
        "prompt string, completion string",
        "array(struct('user' AS role, {r}.prompt AS text), struct('assistant' AS role, {r}.completion AS text))",
    ),
)


def fingerprint_of(paths: Column) -> Column:
    """Hash of a sorted list of nested field paths."""
    return F.sha2(F.concat_ws("\n", F.array_sort(F.array_distinct(paths))), 256)


def field_paths(record: Column) -> Column:
    """Nested field paths of a JSON record, two levels deep: ``a``, ``a.b`` for objects and ``a[].b`` for lists of objects."""
    fields = F.from_json(record, "map<string, string>")
    nested = F.transform(
        F.map_entries(fields),
        lambda e: F.when(
            F.ltrim(e["value"]).startswith("["),
            _inner(e["key"], "[]", F.flatten(F.transform(F.from_json(e["value"], "array<map<string, string>>"), lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>"))))),
        )
        .when(F.ltrim(e["value"]).startswith("{"), _inner(e["key"], "", F.map_keys(F.from_json(e["value"], "map<string, string>"))))
        .otherwise(F.array(e["key"])),
    )
    return F.flatten(nested)


def _inner(name: Column, mark: str, keys: Column) -> Column:
    """Paths of the fields inside ``name``; a list or object without fields, or one that only looks like one, is a path of its own."""
    paths = F.transform(F.array_distinct(keys), lambda k: F.concat(name, F.lit(f"{mark}."), k))
    return F.when(F.size(keys) > 0, paths).otherwise(F.array(F.concat(name, F.lit(mark))))


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Add ``layout`` and ``turns`` (array of role, text) to JSON records.

    A record's sorted field paths are hashed, and the layout registered under
    that hash gives the mapping. Fields with null values count as present. A
    text that only looks like JSON does not hide a layout's own field: paths are
    also tried one level deep. Records of no known layout, and null or
    malformed ones, have null layout and turns. Null texts count as empty and
    null roles as "". ``layout`` and ``turns`` of the input are replaced.
    """
    record = F.col(record_col)
    deep, flat = fingerprint_of(field_paths(record)), fingerprint_of(F.map_keys(F.from_json(record, "map<string, string>")))
    marked = records.withColumns({"__deep": deep, "__flat": flat})
    known = [(fingerprint_of(F.array(*map(F.lit, paths))), layout) for layout in layouts for paths in layout.fields]
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(_TURN)
    for mark, layout in reversed(known):
        is_it = (F.col("__deep") == mark) | (F.col("__flat") == mark)
        name = F.when(is_it, F.lit(layout.name)).otherwise(name)
    marked = marked.withColumn("layout", name).drop("__deep", "__flat")
    marked = marked.withColumns({f"__r{k}": F.when(F.col("layout") == layout.name, F.from_json(record, layout.schema)) for k, layout in enumerate(layouts)})
    for k, layout in enumerate(layouts):
        own = F.expr(layout.turns.replace("{r}", f"`__r{k}`")).cast(_TURN)
        turns = F.when(F.col("layout") == layout.name, own).otherwise(turns)
    clean = F.transform(turns, lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return marked.withColumn("turns", clean).drop(*[f"__r{k}" for k in range(len(layouts))])


def escape(text: Column) -> Column:
    """Reversibly break up ``<|``: a ``~`` goes in, and wherever some stand already, one more."""
    return F.regexp_replace(text, r"<(~*)\|", r"<~$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<~(~*)\|", r"<$1|")


# In a role a new line would end the header; no escaped role holds this mark itself.
_LINE = "<|nl|>"


def format_turns(turns: Column) -> Column:
    """``<|im_start|>role``, a new line, the text, ``<|im_end|>`` and a new line for every turn; control strings inside roles and texts are escaped."""
    role = lambda t: F.replace(escape(t["role"]), F.lit("\n"), F.lit(_LINE))
    each = F.transform(turns, lambda t: F.concat(F.lit(START), role(t), F.lit("\n"), escape(t["text"]), F.lit(END + "\n")))
    return F.array_join(each, "")


def read_turns(formatted: Column) -> Column:
    """The turns that ``format_turns`` wrote, unescaped, with the place of each text in the formatted string (code points, end exclusive)."""
    # Escaped roles and texts hold no "<|", so the end mark splits turns and the first new line ends the header.
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")
    head = lambda b: F.substring_index(b, "\n", 1)
    step = len(END) + 1

    def add(found: Column, block: Column) -> Column:
        start = found["at"] + F.length(head(block)) + 1
        end = found["at"] + F.length(block)
        role = unescape(F.replace(F.substring(head(block), F.lit(len(START) + 1), F.length(block)), F.lit(_LINE), F.lit("\n")))
        text = unescape(F.substring(block, F.length(head(block)) + 2, F.length(block)))
        turn = F.struct(role.alias("role"), text.alias("text"), start.alias("start"), end.alias("end"))
        return F.struct((end + step).alias("at"), F.array_append(found["turns"], turn).alias("turns"))

    none = F.array().cast("array<struct<role: string, text: string, start: int, end: int>>")
    return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), none.alias("turns")), add, lambda found: found["turns"])


def format_records(records: DataFrame, record_col: str = "record", learned: Sequence[str] = LEARNED) -> DataFrame:
    """Add ``layout``, ``formatted``, ``loss_mask`` (spans of the learned texts in ``formatted``) and ``read`` (turns read back from it).

    A record without turns is formatted as the empty string; one of unknown
    layout has null in all four.
    """
    out = canonical_turns(records, record_col)
    out = out.withColumn("formatted", format_turns(F.col("turns"))).drop("turns")
    out = out.withColumn("read", F.when(F.col("formatted").isNotNull(), read_turns(F.col("formatted"))))
    spans = F.transform(F.filter("read", lambda t: t["role"].isin(*learned)), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return out.withColumn("loss_mask", spans)


def under_mask(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(F.transform(mask, lambda m: unescape(F.substring(formatted, m["start"] + 1, m["end"] - m["start"]))), "")


def records_of(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id, record) JSON records from rows by turn, each in the layout that suits it.

    A question with its answer becomes a prompt record, with a system text
    before it a system prompt record; other conversations that open with a
    system text become a conversations record, the rest a messages record.
    Turns go by number, null numbers first, equal numbers by role and text;
    null texts and roles count as empty. A null id is an id of its own.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    each = rows.groupBy(F.col(id_col).alias("id")).agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda t: t["role"])
    plain = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    is_pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    is_system_pair = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    text = lambda k: F.get("t", F.lit(k))["text"]
    other = F.transform(
        "t",
        lambda t: F.struct(
            F.when(t["role"] == "user", "human").when(t["role"] == "assistant", "gpt").otherwise(t["role"]).alias("from"), t["text"].alias("value")
        ),
    )
    record = (
        F.when(is_pair, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(is_system_pair, F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))))
        .when(plain & (F.get("t", F.lit(0))["role"] == "system"), F.to_json(F.struct(other.alias("conversations"))))
        .otherwise(F.to_json(F.struct(F.transform("t", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content"))).alias("messages"))))
    )
    return each.select("id", record.alias("record"))
