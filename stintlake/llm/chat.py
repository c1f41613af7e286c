"""Chat formatting by schema fingerprints, in DataFrame functions only.

A layout is known by the hash of its nested field paths. Each fingerprint selects a declarative mapping that turns a record
of that layout into canonical turns, an array of (role, text). One template then writes any conversation: a turn is its
start marker, role, line end, text, end marker and line end. Control strings inside a role or text are escaped, so that a
marker is always a marker and what was written can be read back exactly. The loss mask covers the assistant's texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's own markers, then control strings of common chat templates, which no text may show as such.
START, END = "<|turn|>", "<|end|>"
CONTROLS = [START, END, "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
#: Doubled where it stands in a text, and single behind the first character of a control string.
ESCAPE = "\\"
ASSISTANT = "assistant"
TURNS = "array<struct<role: string, text: string>>"


@dataclass(frozen=True)
class Layout:
    """Field paths of a layout and where its turns are: ``turns`` names a role and the fields of its text; ``listed`` an
    array and its elements' role and text; ``rows`` the order, role and text of a table with one row per turn."""

    paths: tuple[str, ...]
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    listed: tuple[str, str, str] | None = None
    rows: tuple[str, str, str] | None = None
    role_names: tuple[tuple[str, str], ...] = ()


LAYOUTS = [
    Layout(("prompt", "response"), turns=(("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(("completion", "prompt"), turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout(("answer", "question"), turns=(("user", ("question",)), ("assistant", ("answer",)))),
    Layout(("prompt", "response", "system"), turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Layout(("instruction", "output"), turns=(("user", ("instruction",)), ("assistant", ("output",)))),
    Layout(("input", "instruction", "output"), turns=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Layout(("messages[].content", "messages[].role"), listed=("messages", "role", "content")),
    Layout(
        ("conversations[].from", "conversations[].value"),
        listed=("conversations", "from", "value"),
        role_names=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout(("conv_id", "role", "text", "turn"), rows=("turn", "role", "text")),
]


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """All leaf paths of a nested type; ``[]`` stands for the elements of an array."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def fingerprint(paths: Column) -> Column:
    """Hash of an array of field paths, whatever their order."""
    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"))


#: The kinds of value that a leaf of a JSON record may have; all are texts to a template.
_LEAF = r"\b(?:STRING|VOID|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\s*\d+\))(?=[,>]|$)"


def nested(paths: list[str]) -> str:
    """The shape of a record with these leaf paths, written as Spark writes the schema of a variant, leaves as ``LEAF``."""

    def shape(rests: list[str]) -> str:
        if any(r.startswith("[]") for r in rests):
            return f"ARRAY<{shape([r[2:].removeprefix('.') for r in rests])}>"
        if rests == [""]:
            return "LEAF"
        groups: dict[str, list[str]] = {}
        for r in rests:
            name = r.split(".")[0].split("[")[0]
            groups.setdefault(name, []).append(r[len(name) :].removeprefix("."))
        return "OBJECT<" + ", ".join(f"{n}: {shape(groups[n])}" for n in sorted(groups)) + ">"

    return shape(sorted(paths))


def json_shape(record: Column) -> Column:
    """The shape of a JSON record to any depth, an array's being that of all its elements; null if it is no JSON."""
    return F.regexp_replace(F.schema_of_variant(F.try_parse_json(record)), _LEAF, "LEAF")


def _text(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(""))


def _joined(parts: list[Column]) -> Column:
    """The non-empty parts with a blank line between."""
    return F.array_join(F.filter(F.array(*parts), lambda p: p != ""), "\n\n")


def _turns(layout: Layout, field) -> Column:
    """The turns of a record whose fields ``field`` gives by name."""

    def named(role: Column) -> Column:
        return reduce(lambda c, pair: F.when(role == pair[0], F.lit(pair[1])).otherwise(c), layout.role_names, role)

    if layout.listed:
        array, role, text = layout.listed
        listed = F.transform(field(array), lambda t: F.struct(named(_text(t[role])).alias("role"), _text(t[text]).alias("text")))
        return F.coalesce(listed, F.array().cast(TURNS))
    turns = [F.struct(F.lit(role).alias("role"), _joined([_text(field(f)) for f in fields]).alias("text")) for role, fields in layout.turns]
    return F.array(*turns)


def canonical(records: DataFrame, id_col: str, fields: list[str] | None = None) -> DataFrame:
    """``id`` and ``turns`` of a table in any known layout.

    The layout is that whose fingerprint the columns ``fields`` have (all but the id by default, or all). Rows of a table
    with one row per turn are put together by id, in the order of turn, role and text, null turns first; repeated rows
    are turns of their own. An unknown layout is an error.
    """
    names = fields or [c for c in records.columns if c != id_col]
    here = field_paths(records.select(*names).schema)
    with_id = [id_col, *here]
    asked = [fingerprint(F.lit(paths)) for paths in (here, with_id)] + [fingerprint(F.lit(list(x.paths))) for x in LAYOUTS]
    without, whole, *prints = records.sparkSession.range(1).select(F.array(*asked)).first()[0]
    known = dict(zip(prints, LAYOUTS))
    layout = known.get(without) or known.get(whole)
    if layout is None:
        raise ValueError(f"no mapping for the field paths {sorted(here)}")
    if not layout.rows:
        return records.select(F.col(id_col).alias("id"), _turns(layout, F.col).cast(TURNS).alias("turns"))
    order, role, text = layout.rows
    rows = records.select(F.col(id_col).alias("id"), F.struct(F.col(order).alias("o"), _text(F.col(role)).alias("role"), _text(F.col(text)).alias("text")).alias("t"))
    together = rows.groupBy("id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return together.select("id", F.transform("ts", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).cast(TURNS).alias("turns"))


def canonical_json(records: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """``id``, ``fingerprint`` and ``turns`` of JSON records of mixed layouts; no turns (null) where none is known.

    The fingerprint is the hash of all field paths down to the leaves, so a record whose fields hold more than a layout's
    (lists for texts, parts for a turn's content) has another one. What is no JSON, or names a field twice, has no turns.
    """
    fields: dict[str, str] = {}
    for layout in LAYOUTS:
        for _, names in layout.turns:
            fields |= {n: "string" for n in names}
        if layout.listed:
            array, role, text = layout.listed
            fields[array] = f"array<struct<`{role}`: string, `{text}`: string>>"
    schema = ", ".join(f"`{n}` {kind}" for n, kind in fields.items())
    rows = records.select(F.col(id_col).alias("id"), F.col(json_col).alias("json"))
    rows = rows.select("id", F.xxhash64(json_shape(F.col("json"))).alias("fingerprint"), json_shape(F.col("json")).isNotNull().alias("parsed"), F.from_json("json", schema).alias("r"))
    turns = F.lit(None).cast(TURNS)
    for layout in LAYOUTS:
        if not layout.rows:
            same = F.col("parsed") & (F.col("fingerprint") == F.xxhash64(F.lit(nested(list(layout.paths)))))
            turns = F.when(same, _turns(layout, lambda n: F.col("r")[n]).cast(TURNS)).otherwise(turns)
    return rows.select("id", "fingerprint", turns.alias("turns"))


def split_json(records: DataFrame, id_col: str, json_col: str) -> tuple[DataFrame, DataFrame]:
    """``canonical_json`` of the records with a mapping, and ``id``, ``fingerprint`` and ``json`` of all others."""
    rows = records.select(F.col(id_col).alias("id"), F.col(json_col).alias("json"))
    found = canonical_json(rows.withColumn("id", F.struct("id", "json")), "id", "json")
    known = F.col("turns").isNotNull()
    mapped = found.where(known).select(F.col("id.id").alias("id"), "fingerprint", "turns")
    return mapped, found.where(~known).select(F.col("id.id").alias("id"), "fingerprint", F.col("id.json").alias("json"))


def escaped(text: Column) -> Column:
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(c[0] + ESCAPE + c[1:])), CONTROLS, text)


def unescaped(text: Column) -> Column:
    """Undo ``escaped``: single escapes stand only inside control strings, and pairs never match one."""
    text = reduce(lambda t, c: F.replace(t, F.lit(c[0] + ESCAPE + c[1:]), F.lit(c)), CONTROLS, text)
    return F.replace(text, F.lit(ESCAPE * 2), F.lit(ESCAPE))


def escaped_role(role: Column) -> Column:
    """Like ``escaped``; a line end, which ends a role, is written as an escape and ``n``."""
    return F.replace(escaped(role), F.lit("\n"), F.lit(ESCAPE + "n"))


def unescaped_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\", -1)  # at pairs, so that what follows one is no escape
    return unescaped(F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit(ESCAPE + "n"), F.lit("\n"))), ESCAPE * 2))


def formatted(conversations: DataFrame) -> DataFrame:
    """``id``, ``text`` in the template, and ``segments``: consecutive parts of that text, each with its ``loss`` flag.

    ``conversations`` has ``id`` and ``turns``; null turns are none.
    """

    def parts(turn: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(START), escaped_role(_text(turn["role"])), F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(_text(turn["text"])).alias("text"), (_text(turn["role"]) == ASSISTANT).alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    segments = F.flatten(F.transform(F.coalesce("turns", F.array().cast(TURNS)), parts))
    rows = conversations.select("id", segments.alias("segments"))
    return rows.select("id", F.array_join("segments.text", "").alias("text"), "segments")


def read_turns(text: Column) -> Column:
    """The turns of a text in the template."""
    written = F.split(text, rf"\Q{END}\E\n", -1)

    def turn(piece: Column) -> Column:
        line = F.position(F.lit("\n"), piece)
        return F.struct(
            unescaped_role(F.substr(piece, F.lit(len(START) + 1), line - (len(START) + 1))).alias("role"),
            unescaped(F.substr(piece, line + 1)).alias("text"),
        )

    return F.transform(F.slice(written, 1, F.size(written) - 1), turn)


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def digests(chats: DataFrame) -> DataFrame:
    """What can be read back from ``formatted`` rows: counts, lengths and SHA-256 digests by conversation."""
    rows = chats.select("id", "text", read_turns(F.col("text")).alias("turns"), loss_text(F.col("segments")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return rows.select(
        "id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("text").cast("long").alias("formatted_chars"),
    )
