r"""Chat formatting by schema fingerprints (operator 13).

Chat records come in many layouts: prompt and response, instruction with input and output, lists of messages under several
names. A record's fingerprint is the hash of the nested field paths it fills, of those any layout knows. Each layout is a declaration:
the paths it needs, those it may have, and which path gives which turn. Its fingerprints (one for every choice of the optional
paths) select it, and its mapping turns the record into canonical turns (role, text).

The template closes every turn with a control string of its role::

    <s>[SYS]...[/SYS][INST]question[/INST]answer</s>[TURN]tool[TEXT]...[/TURN]

In roles and texts, a control string gets a backslash behind its first sign, and one that has backslashes there gets one more; reading
back takes one away. So no text holds a control string, and none arises where text and control strings meet, as these
have their opening sign in front only. The loss mask is a list of spans (start, length) in UTF-8 bytes of the formatted
text, one for every assistant turn.

All of it is column expressions within the record's row; only :func:`gather_turns` shuffles, by conversation. A
conversation is one training record, so it is one row.

Nulls: a NULL text or role counts as empty, and a NULL list as not filled. A record that fits no layout, or fills the
paths of two, keeps its row with a NULL layout, turns and formatted text. Turns of equal number go by role, then text;
repeated rows are turns of their own; rows without a number come first and those without a conversation are one conversation. Empty
lists give ``<s>``; an empty table gives an empty result. Extra columns are ignored, as are columns that only share a path's name
but hold neither text nor a list as the path says.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gazetta.functions.values import let

TURN = "struct<role:string,text:string>"
START = "<s>"
_CONTROL = r"(/?(?:s>|(?:SYS|INST|TURN|TEXT)\]))"
_PLAIN, _ESCAPED = rf"([<\[])(\\*){_CONTROL}", rf"([<\[])(\\*)\\{_CONTROL}"
_CLOSED = r"(?<=\[/SYS\]|\[/INST\]|\[/TURN\]|</s>)"


@dataclass(frozen=True)
class Part:
    """One turn: its role, and its paths: the text of the first, and of the others that are not empty, joined by line feeds."""

    role: str
    paths: tuple[str, ...]


@dataclass(frozen=True)
class Listed:
    """A list of turns: paths of role and text in its elements, and other names of roles."""

    path: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Layout:
    """What a layout needs, may have, and how its turns are made of it. A path is ``a.b`` or, within a list, ``a[].b``."""

    name: str
    needs: tuple[str, ...]
    turns: tuple[Part | Listed, ...]
    may: tuple[str, ...] = ()

    @property
    def path_sets(self) -> list[tuple[str, ...]]:
        """All sets of filled paths that select this layout."""
        chosen = itertools.chain.from_iterable(itertools.combinations(self.may, n) for n in range(len(self.may) + 1))
        return [tuple(sorted({*self.needs, *extra})) for extra in chosen]


_SYSTEM = Part("system", ("system",))
LAYOUTS = (
    Layout("turns", ("turns[]",), (Listed("turns", "role", "text"),), ("turns[].role", "turns[].text")),
    Layout("messages", ("messages[]",), (Listed("messages", "role", "content"),), ("messages[].role", "messages[].content")),
    Layout(
        "conversations",
        ("conversations[]",),
        (Listed("conversations", "from", "value", {"human": "user", "gpt": "assistant"}),),
        ("conversations[].from", "conversations[].value"),
    ),
    Layout("prompt_response", ("prompt",), (_SYSTEM, Part("user", ("prompt",)), Part("assistant", ("response",))), ("system", "response")),
    Layout("prompt_completion", ("prompt", "completion"), (_SYSTEM, Part("user", ("prompt",)), Part("assistant", ("completion",))), ("system",)),
    Layout("instruction", ("instruction",), (_SYSTEM, Part("user", ("instruction", "input")), Part("assistant", ("output",))), ("system", "input", "output")),
    Layout("question", ("question",), (_SYSTEM, Part("user", ("question",)), Part("assistant", ("answer",))), ("system", "answer")),
    Layout(
        "nested_data",
        ("data.prompt",),
        (Part("system", ("data.system",)), Part("user", ("data.prompt",)), Part("assistant", ("data.response",))),
        ("data.system", "data.response"),
    ),
    Layout("prompt_messages", ("prompt", "messages[]"), (Part("system", ("prompt",)), Listed("messages", "role", "content")), ("messages[].role", "messages[].content")),
)


def _kind(schema: T.StructType, names: Sequence[str]) -> T.DataType | None:
    """Type at a path of struct fields; None where there is none."""
    kind: T.DataType | None = schema
    for name in names:
        kind = kind[name].dataType if isinstance(kind, T.StructType) and name in kind.names else None
    return kind


def _at(names: Sequence[str]) -> Column:
    out = F.col(f"`{names[0]}`")
    for name in names[1:]:
        out = out.getField(name)
    return out


def filled(schema: T.StructType, path: str) -> Column | None:
    """Whether a record fills the path; None where its table cannot."""
    outer, listed, inner = path.partition("[]")
    names = outer.split(".")
    kind = _kind(schema, names)
    if not listed:
        return _at(names).isNotNull() if isinstance(kind, T.StringType) else None
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)):
        return None
    if not inner:
        return _at(names).isNotNull()
    own = inner.lstrip(".").split(".")
    if not isinstance(_kind(kind.elementType, own), T.StringType):
        return None
    return F.coalesce(F.exists(_at(names), lambda x: _inside(x, own).isNotNull()), F.lit(False))


def _inside(value: Column, names: Sequence[str]) -> Column:
    for name in names:
        value = value.getField(name)
    return value


def _hashed(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def fingerprint(schema: T.StructType, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Hash of the sorted paths that a record fills, of those any layout knows."""
    known = sorted({p for x in layouts for p in (*x.needs, *x.may)})
    parts = [F.when(f, F.lit(p)) for p in known if (f := filled(schema, p)) is not None]
    return _hashed(F.filter(F.array(*parts), lambda x: x.isNotNull()) if parts else F.array().cast("array<string>"))


def layout_of(schema: T.StructType, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Name of the layout that a record's fingerprint selects; NULL where none does."""
    names: dict[tuple[str, ...], str] = {}
    for layout in layouts:
        for paths in layout.path_sets:
            if paths in names:
                raise ValueError(f"{layout.name} and {names[paths]} have the paths {paths}")
            names[paths] = layout.name
    mapping = F.create_map(*[x for paths, name in names.items() for x in (_hashed(F.array(*[F.lit(p) for p in paths])), F.lit(name))])
    return let(fingerprint(schema, layouts), lambda x: F.try_element_at(mapping, x))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _mapped(schema: T.StructType, part: Part | Listed) -> Column:
    """Turns of one entry of a mapping; none where the record does not fill its paths."""
    nothing = F.array().cast(f"array<{TURN}>")
    if isinstance(part, Part):
        found = [_at(p.split(".")) for p in part.paths if filled(schema, p) is not None]
        if not found:
            return nothing
        text = F.concat_ws("\n", found[0], *[F.nullif(x, F.lit("")) for x in found[1:]])
        return F.when(found[0].isNotNull(), F.array(_turn(F.lit(part.role), text))).otherwise(nothing)
    if filled(schema, f"{part.path}[]") is None:
        return nothing

    def turn(x: Column) -> Column:
        role, text = (_inside(x, n.split(".")) if filled(schema, f"{part.path}[].{n}") is not None else F.lit(None).cast("string") for n in (part.role, part.text))
        for other, name in part.roles.items():
            role = F.when(role == other, F.lit(name)).otherwise(role)
        return _turn(role, text)

    return F.coalesce(F.transform(_at(part.path.split(".")), turn), nothing)


def canonical_turns(schema: T.StructType, layout: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """The record's turns by its layout's mapping."""
    out = F.lit(None).cast(f"array<{TURN}>")
    for x in layouts:
        turns = [_mapped(schema, part) for part in x.turns]
        out = F.when(layout == x.name, F.concat(*turns) if len(turns) > 1 else turns[0]).otherwise(out)
    return out


def escape(text: Column) -> Column:
    """No control string is left; :func:`unescape` gives the text again."""
    return F.regexp_replace(text, _PLAIN, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _piece(turn: Column) -> Column:
    """What stands before the text, the escaped text, what closes it, and whether it is learnt."""
    role = turn["role"]
    user, system, answer = role == "user", role == "system", role == "assistant"
    named = F.concat(F.lit("[TURN]"), escape(role), F.lit("[TEXT]"))
    opened = F.when(user, "[INST]").when(system, "[SYS]").when(answer, "").otherwise(named)
    closed = F.when(user, "[/INST]").when(system, "[/SYS]").when(answer, "</s>").otherwise("[/TURN]")
    return F.struct(opened.alias("opened"), escape(turn["text"]).alias("body"), closed.alias("closed"), answer.alias("loss"))


def _prefix_sums(values: Column) -> Column:
    start = F.struct(F.lit(0).cast("long").alias("sum"), F.array().cast("array<long>").alias("sums"))

    def add(held: Column, x: Column) -> Column:
        return F.struct((held["sum"] + x).alias("sum"), F.concat(held["sums"], F.array(held["sum"] + x)).alias("sums"))

    return F.aggregate(values, start, add, lambda held: held["sums"])


def running_sums(values: Column, block: int = 1024) -> Column:
    """Sums up to each element, a block of elements at a time: an array that grows is copied, so it stays short."""

    def shifted(blocks: Column) -> Column:
        ends = _prefix_sums(F.transform(blocks, F.array_max))
        before = F.slice(F.concat(F.array(F.lit(0).cast("long")), ends), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, before, lambda b, n: F.transform(b, lambda x: x + n)))

    def cut(x: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(x) - 1) / block).cast("int"))
        parts = F.transform(starts, lambda i: _prefix_sums(F.slice(x, i * block + 1, F.lit(block))))
        return F.when(F.size(x) > 0, let(parts, shifted)).otherwise(x)

    return let(values, cut)


def template(turns: Column) -> Column:
    """(formatted, loss_spans) of a list of turns."""

    def bytes_of(text: Column) -> Column:
        return F.octet_length(text).cast("long")

    def written(pieces: Column) -> Column:
        ends = running_sums(F.transform(pieces, lambda p: bytes_of(p["opened"]) + bytes_of(p["body"]) + bytes_of(p["closed"])))
        both = F.zip_with(
            pieces,
            ends,
            lambda p, end: F.struct(
                p["loss"].alias("loss"),
                F.struct((end + len(START) - bytes_of(p["closed"]) - bytes_of(p["body"])).alias("start"), bytes_of(p["body"]).alias("length")).alias("span"),
            ),
        )
        spans = F.transform(F.filter(both, lambda x: x["loss"]), lambda x: x["span"])
        text = F.array_join(F.transform(pieces, lambda p: F.concat(p["opened"], p["body"], p["closed"])), "")
        return F.struct(F.concat(F.lit(START), text).alias("formatted"), spans.alias("loss_spans"))

    return let(F.transform(turns, _piece), written)


def format_chats(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The records with (layout, chat): chat holds (formatted, loss_spans), NULL where no layout fits."""
    schema = records.schema
    named = records.select("*", layout_of(schema, layouts).alias("__layout"))
    chat = let(canonical_turns(schema, F.col("__layout"), layouts), template)
    kept = [F.col(f"`{c}`") for c in records.columns if c not in ("layout", "chat")]
    return named.select(*kept, F.col("__layout").alias("layout"), chat.alias("chat"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text again."""

    def between(piece: Column, opened: str, closed: str) -> Column:
        return unescape(F.substr(piece, F.lit(len(opened) + 1), F.length(piece) - (len(opened) + len(closed))))

    def turn(piece: Column) -> Column:
        other = let(
            F.split(F.substr(piece, F.lit(len("[TURN]") + 1), F.length(piece) - len("[TURN][/TURN]")), r"\[TEXT\]", 2),
            lambda x: F.struct(unescape(F.get(x, F.lit(0))).alias("role"), unescape(F.get(x, F.lit(1))).alias("text")),
        )
        return (
            F.when(piece.endswith("</s>"), F.struct(F.lit("assistant").alias("role"), between(piece, "", "</s>").alias("text")))
            .when(piece.endswith("[/INST]"), F.struct(F.lit("user").alias("role"), between(piece, "[INST]", "[/INST]").alias("text")))
            .when(piece.endswith("[/SYS]"), F.struct(F.lit("system").alias("role"), between(piece, "[SYS]", "[/SYS]").alias("text")))
            .otherwise(other)
        )

    pieces = F.split(F.substr(formatted, F.lit(len(START) + 1)), _CLOSED, -1)
    return F.transform(F.filter(pieces, lambda x: x != ""), turn)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""

    def cut(held: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: unescape(F.substr(held, (s["start"] + 1).cast("int"), s["length"].cast("int")).cast("string"))), "")

    return let(formatted.cast("binary"), cut)


def gather_turns(rows: DataFrame) -> DataFrame:
    """(conv_id, turns): one record per conversation, in the order of its turns."""
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))


def chat_digests(chats: DataFrame) -> DataFrame:
    """Per conversation what the formatted text and its loss mask give back, with the layout it came in."""
    text = F.col("chat.formatted")
    told = F.transform(F.col("turns"), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = chats.select(
        "conv_id", "layout", F.length(text).cast("long").alias("formatted_chars"), read_turns(text).alias("turns"), read_loss(text, F.col("chat.loss_spans")).alias("loss")
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
        "layout",
    )


def format_conversations(rows: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Formatted conversations of a table with one row per turn, and of ``more`` records with ``conv_id`` in any layout."""
    records = gather_turns(rows)
    return format_chats(records if more is None else records.unionByName(more, allowMissingColumns=True))
