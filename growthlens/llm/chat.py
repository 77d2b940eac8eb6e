"""Chat formatting by schema fingerprints and declarative mappings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of the template, then those of other templates: none of them may come out of a text.
TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>"
# Where a control string begins, and what it becomes inside a text (a backslash after its first character).
ESCAPES = (
    ("\\", "\\\\"),
    ("<|", "<\\|"),
    ("</s>", "<\\/s>"),
    ("<s>", "<\\s>"),
    ("[INST]", "[\\INST]"),
    ("[/INST]", "[\\/INST]"),
    ("<<SYS>>", "<\\<SYS>>"),
    ("<</SYS>>", "<\\</SYS>>"),
    ("<start_of_turn>", "<\\start_of_turn>"),
    ("<end_of_turn>", "<\\end_of_turn>"),
)
LEARNED_ROLE = "assistant"
_TURNS = "array<struct<turn:bigint,role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How records of one layout become turns.

    ``example`` is a JSON record of the layout: its nested field paths are the
    layout's fingerprint.  Either ``items`` is the path of the message array and
    ``role``/``text`` are paths within a message, or ``fixed`` lists (role, path)
    turns of a flat record (paths that are null or empty give no turn).  ``turn``
    is the path of a record's own turn number for layouts with one turn a record
    (``role`` and ``text`` then are paths of the record).  ``roles`` renames roles.
    """

    name: str
    example: str
    items: str | None = None
    role: str = "$.role"
    text: str = "$.content"
    turn: str | None = None
    fixed: tuple[tuple[str, str], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()


_NAMES = (("human", "user"), ("gpt", "assistant"), ("model", "assistant"), ("bot", "assistant"))
LAYOUTS = (
    Layout("row", '{"turn":1,"role":"a","text":"b"}', turn="$.turn", role="$.role", text="$.text"),
    Layout("messages", '{"messages":[{"role":"a","content":"b"}]}', items="$.messages"),
    Layout("conversations", '{"conversations":[{"from":"a","value":"b"}]}', items="$.conversations", role="$.from", text="$.value", roles=_NAMES),
    Layout("instruction", '{"instruction":"a","input":"b","output":"c"}', fixed=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("instruction_short", '{"instruction":"a","output":"c"}', fixed=(("user", "$.instruction"), ("assistant", "$.output"))),
    Layout("prompt", '{"prompt":"a","completion":"b"}', fixed=(("user", "$.prompt"), ("assistant", "$.completion"))),
    Layout("prompt_system", '{"system":"s","prompt":"a","response":"b"}', fixed=(("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response"))),
)


def fingerprint(payload: Column) -> Column:
    """Hash of the nested field paths of a variant, whatever the order and the scalar types of its fields.

    Paths are read off the variant's schema; null values stand for their field,
    so nulls do not change a layout.
    """
    shape = F.schema_of_variant(payload)
    shape = F.regexp_replace(shape, r": (VOID|STRING|BIGINT|BOOLEAN|DOUBLE|DATE|VARIANT|DECIMAL\([^)]*\))", ":")
    return F.sha2(shape, 256)


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """(record_id, layout, turns) of every record (record_id, payload variant): turns is an array of turn, role, text.

    The payload's fingerprint selects the mapping.  Records of an unknown
    layout (or with a null payload) keep a null layout and no turns, so callers
    can tell and count them.  A message list that is null or empty has no turns.
    """
    known = records.withColumn("print", fingerprint(F.col("payload")))
    layout, turns = F.lit(None).cast("string"), F.expr(f"cast(array() as {_TURNS})")
    for spec in reversed(layouts):
        prints = [fingerprint(F.parse_json(F.lit(x))) for x in _variants(spec)]
        is_spec = F.coalesce(F.col("print").isin(*prints), F.lit(False))
        layout = F.when(is_spec, F.lit(spec.name)).otherwise(layout)
        turns = F.when(is_spec, _mapped(spec)).otherwise(turns)
    return known.select("record_id", layout.alias("layout"), turns.alias("turns"))


def _variants(spec: Layout) -> list[str]:
    """The example and, for message lists, the record without messages."""
    if not spec.items:
        return [spec.example]
    top = spec.items.removeprefix("$.")
    return [spec.example, f'{{"{top}":[]}}', f'{{"{top}":null}}']


def _mapped(spec: Layout) -> Column:
    def role_of(role: Column) -> Column:
        out = role
        for old, new in spec.roles:
            out = F.when(role == old, F.lit(new)).otherwise(out)
        return out

    payload = F.col("payload")

    def made(turn: Column, role: Column, text: Column) -> Column:
        return F.struct(
            turn.cast("bigint").alias("turn"),
            F.coalesce(role, F.lit("")).alias("role"),
            F.coalesce(text, F.lit("")).alias("text"),
        )

    if spec.items:
        messages = F.coalesce(
            F.try_variant_get(payload, spec.items, "array<variant>"), F.expr("cast(array() as array<variant>)")
        )
        return F.transform(
            messages,
            lambda m, i: made(
                i, role_of(F.try_variant_get(m, spec.role, "string")), F.try_variant_get(m, spec.text, "string")
            ),
        )
    if spec.turn:
        return F.array(
            made(
                F.try_variant_get(payload, spec.turn, "bigint"),
                role_of(F.try_variant_get(payload, spec.role, "string")),
                F.try_variant_get(payload, spec.text, "string"),
            )
        )
    pieces = F.array(
        *[
            made(F.lit(i), F.lit(role), F.try_variant_get(payload, path, "string"))
            for i, (role, path) in enumerate(spec.fixed)
        ]
    )
    return F.filter(pieces, lambda t: t["text"] != "")


def escaped(text: Column) -> Column:
    for old, new in ESCAPES:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_turns(turns: Column) -> Column:
    """One string of all turns: ``<|turn|>role<|text|>text<|end|>`` and a newline each, contents escaped."""
    return F.array_join(
        F.transform(
            turns,
            lambda t: F.concat(
                F.lit(TURN), escaped(t["role"]), F.lit(BODY), escaped(t["text"]), F.lit(END + "\n")
            ),
        ),
        "",
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted string."""
    pieces = F.split(formatted, F.lit("\\Q" + END + "\n\\E"), -1)
    return F.transform(
        F.slice(pieces, F.lit(1), F.size(pieces) - 1),
        lambda p: F.struct(
            unescaped(F.substring(F.split_part(p, F.lit(BODY), F.lit(1)), len(TURN) + 1, F.length(p))).alias("role"),
            unescaped(F.split_part(p, F.lit(BODY), F.lit(2))).alias("text"),
        ),
    )


def loss_spans(turns: Column, role: str = LEARNED_ROLE) -> Column:
    """(start, size) in code points of the formatted string, for the texts of ``role``; both are measured on escaped texts."""
    fixed = len(TURN) + len(BODY)
    return F.aggregate(
        turns,
        F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,size:int>>)").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + fixed + F.length(escaped(t["role"])) + F.length(escaped(t["text"])) + len(END) + 1).alias("at"),
            F.when(
                t["role"] == role,
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + fixed + F.length(escaped(t["role"]))).alias("start"),
                            F.length(escaped(t["text"])).alias("size"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
        lambda acc: acc["spans"],
    )


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(spans, lambda s: unescaped(F.substring(formatted, s["start"] + 1, s["size"]))), ""
    )


def format_chats(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """record_id, n_turns, formatted and loss spans of every record_id of ``records`` (record_id, payload variant).

    Records that share a record_id are one conversation: their turns are put in
    order by turn number (null first), then role, then text, so repeated rows
    and ties have one defined order.  Null roles and texts are empty; a null
    record_id is a conversation of its own; an empty table gives no rows.
    """
    turns = canonical_turns(records, layouts)
    whole = turns.groupBy("record_id").agg(
        F.array_sort(F.flatten(F.collect_list("turns"))).alias("turns"),
        F.count_if(F.col("layout").isNull()).alias("n_unmapped"),
    )
    return whole.select(
        "record_id", "n_unmapped",
        F.size("turns").cast("long").alias("n_turns"),
        format_turns(F.col("turns")).alias("formatted"),
        loss_spans(F.col("turns")).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each formatted conversation, from the output string and its loss spans alone."""
    turns = read_turns(F.col("formatted"))
    lines = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = masked_text(F.col("formatted"), F.col("loss_spans"))
    return formatted.select(
        "record_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
