"""Chat formatting: records of any known layout become canonical turns, and turns one training text per conversation.

*Layouts.* The field paths that a record fills are hashed into its fingerprint; a declared mapping is looked up by it and says
which fields are role, text and order. Fields that no mapping names do not count, so clashing or extra columns do no harm. A
record that fills fields of several layouts takes the first of ``PRECEDENCE`` whose fields it fills; the others are ignored. A
record with a turn number and no list of turns is a turn itself, whatever else it fills.

*Template.* ``<|turn|>role`` newline ``text<|end|>`` newline, for each turn. Inside roles and texts a backslash is doubled and a
control string gets one after its first character, so no text can open or close a turn, and reading back is exact. The loss
mask is a list of (start, length) spans of the formatted text, in code points: the body of every assistant turn.

Only DataFrame functions run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: First character of every control string of the usual templates, fixed by those formats.
CONTROL = r"<(?=\|)|<(?=/?s>)|\[(?=/?INST\])|<(?=</?SYS>>)"


@dataclass(frozen=True)
class Layout:
    """A mapping. ``each``: the list of turns, or None if the record itself holds them; ``turns``: (role, text path), where a
    role in quotes is fixed and several text paths are joined by a newline; ``names``: other names of roles."""

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...]
    optional: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    each: str | None = None
    order: str | None = None
    names: tuple[tuple[str, str], ...] = ()


_SHARED_NAMES = (("human", "user"), ("gpt", "assistant"))
LAYOUTS = (
    Layout("messages", (("role", ("content",)),), each="messages", required=("messages",), optional=("messages[].role", "messages[].content")),
    Layout("conversations", (("from", ("value",)),), each="conversations", required=("conversations",),
           optional=("conversations[].from", "conversations[].value"), names=_SHARED_NAMES),
    Layout("instruction", (("'system'", ("system",)), ("'user'", ("instruction", "input")), ("'assistant'", ("output",))),
           required=("instruction",), optional=("system", "input", "output")),
    Layout("prompt", (("'user'", ("prompt",)), ("'assistant'", ("completion",))), required=("prompt",), optional=("completion",)),
    Layout("prompt_response", (("'user'", ("prompt",)), ("'assistant'", ("response",))), required=("prompt", "response")),
    Layout("row", (("role", ("text",)),), optional=("turn", "role", "text"), order="turn"),
)

#: (layout, paths filled, paths not filled) for records whose fingerprint is no layout's own; any one of the last two will do.
PRECEDENCE = (
    ("messages", ("messages",), ()), ("conversations", ("conversations",), ()), ("row", ("role", "text"), ()), ("row", ("turn",), ()), ("instruction", ("instruction",), ()),
    ("prompt_response", ("prompt", "response"), ("completion",)), ("prompt", ("prompt",), ()), ("row", ("text",), ()), ("row", ("role",), ()),
)


def paths(schema: T.StructType) -> list[str]:
    """Field paths of a schema; ``[]`` stands for the elements of a list."""

    def below(kind: T.DataType, at: str) -> list[str]:
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return [at, *(p for f in kind.elementType.fields for p in below(f.dataType, f"{at}[].{f.name}"))]
        if isinstance(kind, T.StructType):
            return [p for f in kind.fields for p in below(f.dataType, f"{at}.{f.name}")]
        return [at]

    return [p for f in schema.fields for p in below(f.dataType, f.name)]


def _known() -> set[str]:
    return {p for x in LAYOUTS for p in (*x.required, *x.optional)}


def fingerprint(df: DataFrame) -> Column:
    """Hash of the field paths that a record fills, of those that any layout names."""

    def filled(path: str) -> Column:
        name, _, field = path.partition("[].")
        return F.exists(F.col(name), lambda x: x[field].isNotNull()) if field else F.col(name).isNotNull()

    here = [F.when(filled(p), F.lit(p)) for p in sorted(set(paths(df.schema)) & _known())]
    return F.xxhash64(F.concat_ws("\n", *here)) if here else F.xxhash64(F.lit(""))


def _variants(layout: Layout) -> list[str]:
    sets = (layout.required + c for k in range(len(layout.optional) + 1) for c in combinations(layout.optional, k))
    return ["\n".join(sorted(s)) for s in sets]


def layout_of(df: DataFrame) -> Column:
    """Name of the layout; NULL for an unknown one."""
    mark, out, top = fingerprint(df), F.when(F.lit(False), F.lit(None).cast("string")), set(df.columns)
    usable = {x.name for x in LAYOUTS if _turns(df, x) is not None}
    for layout in LAYOUTS:
        if layout.name in usable:
            out = out.when(_any_of(mark, _variants(layout)), layout.name)
    for name, some, none in PRECEDENCE:
        if name in usable and top.issuperset(some):
            wanted = [F.col(p).isNotNull() for p in some] + [F.col(p).isNull() for p in none if p in top]
            out = out.when(reduce(Column.__and__, wanted), name)
    return out


def _any_of(mark: Column, variants: list[str]) -> Column:
    return F.array_contains(F.array(*[F.xxhash64(F.lit(v)) for v in variants]), mark)


def _turn(order: Column, role: Column, text: Column) -> Column:
    return F.struct(
        order.cast("bigint").alias("turn"),
        F.coalesce(role.cast("string"), F.lit("")).alias("role"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
    )


def _renamed(role: Column, layout: Layout) -> Column:
    for old, new in layout.names:
        role = F.when(role == old, new).otherwise(role)
    return role


def _turns(df: DataFrame, layout: Layout) -> Column | None:
    top = {f.name: f.dataType for f in df.schema.fields}
    if layout.each:
        kind = top.get(layout.each)
        if not isinstance(kind, T.ArrayType) or not isinstance(kind.elementType, T.StructType):
            return None
        fields, (role, (text,)) = kind.elementType.names, layout.turns[0]
        get = lambda x, name: x[name] if name in fields else F.lit(None)
        return F.transform(F.col(layout.each), lambda x, i: _turn(i, _renamed(get(x, role), layout), get(x, text)))
    if not set(layout.required) <= set(top):
        return None
    out = []
    for i, (role, texts) in enumerate(layout.turns):
        have = [F.col(t).cast("string") for t in texts if t in top]
        if role.startswith("'"):
            if have:
                some = F.greatest(*[x.isNotNull() for x in have]) if len(have) > 1 else have[0].isNotNull()
                out.append(F.when(some, _turn(F.lit(i), F.lit(role.strip("'")), F.concat_ws("\n", *have))))
        else:
            text = have[0] if have else F.lit(None)
            order = F.col(layout.order) if layout.order in top else F.lit(None)
            out.append(_turn(order, _renamed(F.col(role) if role in top else F.lit(None), layout), text))
    return F.array_compact(F.array(*out)) if out else None


def canonical_turns(records: DataFrame, conv_id: str = "conv_id", strict: bool = False) -> DataFrame:
    """(conv_id, layout, turn, role, text), a row for each turn of every record.

    Null roles and texts are empty; a null order stays null and comes first. A record that fills fields, but none of
    the layouts, gives no rows (``without_layout`` lists them), or fails the job with ``strict``. Repeated records give repeated
    turns. Any other column is ignored.
    """
    kind = "array<struct<turn:bigint,role:string,text:string>>"
    name, turns = layout_of(records), None
    for layout in LAYOUTS:
        got = _turns(records, layout)
        if got is not None:
            this = F.col("__layout") == layout.name
            turns = F.when(this, got.cast(kind)) if turns is None else turns.when(this, got.cast(kind))
    if turns is None:
        turns = F.lit(None).cast(kind)
    if strict:
        turns = F.when(F.col("__layout").isNull() & _fills(records, conv_id), _lost(conv_id).cast(kind)).otherwise(turns)
    return (
        records.withColumn("__layout", name)
        .select(F.col(conv_id).alias("conv_id"), F.col("__layout").alias("layout"), F.explode(turns).alias("t"))
        .select("conv_id", "layout", "t.turn", "t.role", "t.text")
    )


def _fills(records: DataFrame, conv_id: str) -> Column:
    """Whether a record fills any column that a layout names."""
    named = [c for c in records.columns if c != conv_id and c in {p.partition("[].")[0] for p in _known()}]
    return reduce(Column.__or__, [F.col(c).isNotNull() for c in named], F.lit(False))


def _lost(conv_id: str) -> Column:
    return F.raise_error(F.concat(F.lit("no layout for the record of conversation "), F.coalesce(F.col(conv_id).cast("string"), F.lit("null"))))


def without_layout(records: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """The records that fill fields of layouts but match none."""
    return records.where(layout_of(records).isNull() & _fills(records, conv_id))


def escaped(x: Column) -> Column:
    return F.regexp_replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$0\\")


def unescaped(x: Column) -> Column:
    return F.regexp_replace(x, r"(?s)\\(.)", "$1")


def _escaped_role(x: Column) -> Column:
    return F.replace(escaped(x), F.lit("\n"), F.lit("\\l"))


def _unescaped_role(x: Column) -> Column:
    """Between doubled backslashes, ``\\l`` is a newline and any other backslash goes."""
    plain = lambda p: F.replace(F.replace(p, F.lit("\\l"), F.lit("\n")), F.lit("\\"), F.lit(""))
    return F.array_join(F.transform(F.split(x, r"\\\\", -1), plain), "\\")


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss_spans) of every conversation of ``turns`` (conv_id, turn, role, text).

    Turns are ordered by (turn, role, text), nulls first; repeated turns stay. A null conv_id is a conversation like any
    other. A conversation is one text, so its turns meet in one task, as any text must. An empty table gives no rows.
    """
    head = F.concat(F.lit(OPEN), _escaped_role(F.col("role")), F.lit("\n"))
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    rows = rows.withColumn("head", head).withColumn("body", escaped(F.col("text")))
    piece = F.concat("head", "body", F.lit(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        "conv_id",
        F.coalesce(F.sum(F.length(piece)).over(before), F.lit(0)).alias("at"),
        piece.alias("piece"),
        F.length("head").alias("head"),
        F.length("body").alias("size"),
        (F.col("role") == "assistant").alias("loss"),
    )
    turn = F.struct("at", "piece", "head", "size", "loss")
    whole = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    spans = F.transform(
        F.filter("turns", lambda t: t["loss"]),
        lambda t: F.struct((t["at"] + t["head"]).cast("bigint").alias("start"), t["size"].cast("bigint").alias("length")),
    )
    formatted = F.array_join(F.transform("turns", lambda t: t["piece"]), "")
    return whole.select("conv_id", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with its turns (role, text) and the unescaped text under the loss mask, taken from the text alone."""
    parts = F.split("formatted", r"<\|end\|>\n", -1)
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def parsed(p: Column) -> Column:
        line = F.substring_index(p, "\n", 1)
        role = F.substr(line, F.lit(len(OPEN) + 1))
        return F.struct(_unescaped_role(role).alias("role"), unescaped(F.substr(p, F.length(line) + 2)).alias("text"))

    under = F.transform(
        "loss_spans",
        lambda s: unescaped(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    return formatted.withColumn("turns", F.transform(parts, parsed)).withColumn("loss_text", F.array_join(under, ""))


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Counts and digests of every formatted conversation, from what reads back."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back(format_conversations(turns)).select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
