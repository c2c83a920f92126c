"""Chat formatting in budgeted windows, all in DataFrame functions.

A turn is ``[INST] role``, a line end, its text and `` [/INST]``; an assistant's turn
is a blank, its text and ``</s>``. A window starts with ``<s>``. Where a text holds
one of these control strings, a backslash is put after its first character (and
one more if there are some already), which removing one undoes; so no text can
be taken for a mark. Backslashes and line ends in roles are escaped too.

Prefix sums of turn tokens lay a conversation on a line that is ruled in cells;
turns that begin in one cell form a span, and a turn longer than a cell a span of
its own. A cell is half of what the budget leaves beside the system turn and the
history, so a span of several turns always fits. Each span becomes a window: the
system turn, the last turns before the span as history, then the span's turns.
Only the span's assistant texts count for the loss; what a window repeats is
masked, so each assistant text is a target once. A turn that alone exceeds the
budget keeps its window whole: turns are never cut.

A conversation's turns are numbered and summed block by block, so one with very
many turns is not one task's work. Turns are ordered by number, null first, then
role and text. Null roles and texts are empty, and a null conversation id is a
conversation of its own. The first turn, if its role is ``system``, is the system
turn. Repeated rows are turns of their own. An empty table gives an empty result;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..workspace import Workspace

BUDGET, HISTORY, HISTORY_TURNS = 512, 128, 2
# Turn numbers that are numbered and summed together.
BLOCK = 256

# The template.
BEGIN, OPEN, CLOSE, END = "<s>", "[INST] ", " [/INST]", "</s>"
_KEYS = ["_none", "_conv"]
_TURN = ["_turn", "_role", "_text"]


def escape(text: Column) -> Column:
    """Break control strings inside a text."""
    marked = F.regexp_replace(text, r"<(\\*)(/?s)>", r"<\\$1$2>")
    return F.regexp_replace(marked, r"\[(\\*)(/?INST)\]", r"[\\$1$2]")


def unescape(text: Column) -> Column:
    """Undo :func:`escape`."""
    plain = F.regexp_replace(text, r"<\\(\\*)(/?s)>", "<$1$2>")
    return F.regexp_replace(plain, r"\[\\(\\*)(/?INST)\]", "[$1$2]")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # A pair of backslashes is kept apart while the line ends come back.
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def token_count(text: Column) -> Column:
    """Tokens of a turn as the windows count them: its words, and one for its marks."""
    return (F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")) + 1).cast("bigint")


def _numbered(turns: DataFrame) -> DataFrame:
    """Add ``_number`` (from 0) and ``_start`` (tokens before) within conversations."""
    block = F.coalesce(F.floor(F.col("_turn") / BLOCK), F.lit(-(1 << 60)))
    dealt = turns.withColumn("_block", block)
    inside = Window.partitionBy(*_KEYS, "_block").orderBy(*_TURN)
    local = dealt.withColumn("_place", F.row_number().over(inside)).withColumn(
        "_upto", F.sum("_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    )
    earlier = Window.partitionBy(*_KEYS).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy(*_KEYS, "_block").agg(
        F.count("*").alias("_n"), F.sum("_tokens").alias("_t")
    ).select(
        *_KEYS, "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_t_before"),
    )
    return local.join(offsets, [*_KEYS, "_block"]).select(
        *_KEYS, *_TURN, "_tokens", "_block",
        (F.col("_n_before") + F.col("_place") - 1).alias("_number"),
        (F.col("_t_before") + F.col("_upto") - F.col("_tokens")).alias("_start"),
    )


def windows(
    conversations: DataFrame,
    workspace: Workspace,
    budget: int = BUDGET,
    history: int = HISTORY,
    history_turns: int = HISTORY_TURNS,
    id_column: str = "conv_id",
) -> DataFrame:
    """``conv_id, first_turn, n_repeated, text, loss``: a row per window.

    ``first_turn`` is the number of the window's first new turn, ``n_repeated`` how
    many turns before it are repeated, ``loss`` an array of (start, length) in code
    points of ``text``.
    """
    if history >= budget:
        raise ValueError("history must be below the budget")
    kind = conversations.schema[id_column].dataType
    conv, role, text = F.col(id_column), F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = workspace.store(conversations.select(
        conv.isNull().alias("_none"), F.coalesce(conv, F.lit(0).cast(kind)).alias("_conv"),
        F.col("turn").cast("bigint").alias("_turn"), role.alias("_role"), text.alias("_text"),
        token_count(text).alias("_tokens"),
    ), "turns")
    numbered = workspace.store(_numbered(turns), "numbered-turns")

    system = numbered.filter("_number = 0 AND _role = 'system'").select(
        *_KEYS, F.col("_tokens").alias("_system")
    )
    # The system turn's size reaches the turns through the far fewer blocks.
    room = numbered.select(*_KEYS, "_block").distinct().join(system, _KEYS, "left").select(
        *_KEYS, "_block", F.coalesce("_system", F.lit(0)).alias("_system")
    )
    cell_size = F.greatest(F.lit(1), F.floor((budget - history - F.col("_system")) / 2))
    ruled = numbered.join(room, [*_KEYS, "_block"]).withColumn("_size", cell_size).withColumn(
        "_cell", F.floor(F.col("_start") / F.col("_size"))
    ).withColumn("_long", F.col("_tokens") > F.col("_size"))
    span = Window.partitionBy(*_KEYS, "_cell", "_long")
    placed = workspace.store(
        ruled.withColumn("_first", F.min("_number").over(span)).select(
            *_KEYS, "_first", "_number", "_start", "_role", "_text", "_system"
        ), "spans",
    )
    begins = placed.filter("_number = _first AND _first > 0")
    wanted = F.array_distinct(F.concat(
        F.when(F.col("_system") > 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.array().cast("array<bigint>")),
        F.filter(
            F.transform(F.sequence(F.lit(1), F.lit(history_turns)), lambda d: F.col("_first") - d)
            if history_turns else F.array().cast("array<bigint>"),
            lambda n: n >= F.when(F.col("_system") > 0, 1).otherwise(0),
        ),
    ))
    asked = begins.select(
        *_KEYS, "_first", F.col("_start").alias("_begin"), "_system", F.explode(wanted).alias("_number")
    )
    repeated = asked.join(placed.select(*_KEYS, "_number", "_start", "_role", "_text"), [*_KEYS, "_number"]).filter(
        (F.col("_begin") - F.col("_start") <= history) | ((F.col("_number") == 0) & (F.col("_system") > 0))
    )
    columns = [*_KEYS, "_first", "_number", "_role", "_text"]
    members = placed.select(*columns, F.lit(False).alias("_again")).union(
        repeated.select(*columns, F.lit(True).alias("_again"))
    )
    target = (F.col("_role") == "assistant") & ~F.col("_again")
    answer = F.col("_role") == "assistant"
    body = escape(F.col("_text"))
    shown = F.when(answer, F.concat(F.lit(" "), body, F.lit(END))).otherwise(
        F.concat(F.lit(OPEN), _escape_role(F.col("_role")), F.lit("\n"), body, F.lit(CLOSE))
    )
    parts = F.array_sort(F.collect_list(F.struct(
        "_number", "_again", shown.alias("shown"), target.alias("target"), F.char_length(body).alias("chars"),
    )))
    grouped = members.groupBy(*_KEYS, "_first").agg(parts.alias("parts"))
    start = F.struct(
        F.lit(len(BEGIN)).cast("bigint").alias("at"),
        F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"),
    )

    def add(state: Column, part: Column) -> Column:
        here = F.array(F.struct(
            (state["at"] + 1).alias("start"), part["chars"].cast("bigint").alias("length")
        ))
        return F.struct(
            (state["at"] + F.char_length(part["shown"])).cast("bigint").alias("at"),
            F.when(part["target"], F.concat(state["spans"], here)).otherwise(state["spans"]).alias("spans"),
        )

    return grouped.select(
        F.when(~F.col("_none"), F.col("_conv")).alias(id_column),
        F.col("_first").alias("first_turn"),
        F.size(F.filter("parts", lambda p: p["_again"])).alias("n_repeated"),
        F.concat(F.lit(BEGIN), F.array_join(F.transform("parts", lambda p: p["shown"]), "")).alias("text"),
        F.aggregate("parts", start, add)["spans"].alias("loss"),
    )


def parse_turns(text: Column) -> Column:
    """The turns of a formatted window as an array of (role, text)."""
    turns = F.regexp_extract_all(
        text, F.lit(r"(?s)\[INST\] .*? \[/INST\]|(?!\[INST\]) .*?</s>"), F.lit(0)
    )

    def read(turn: Column) -> Column:
        inner = F.substring(turn, F.lit(len(OPEN) + 1), F.char_length(turn) - len(OPEN) - len(CLOSE))
        cut = F.instr(inner, "\n")
        return F.when(
            F.startswith(turn, F.lit(OPEN)),
            F.struct(
                _unescape_role(F.substring(inner, F.lit(1), cut - 1)).alias("role"),
                unescape(F.substring(inner, cut + 1, F.char_length(inner))).alias("text"),
            ),
        ).otherwise(F.struct(
            F.lit("assistant").alias("role"),
            unescape(F.substring(turn, F.lit(2), F.char_length(turn) - 1 - len(END))).alias("text"),
        ))

    return F.transform(turns, read)


def digests(formatted: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """What the windows of each conversation say, read back from them.

    A digest covers a whole conversation, so this brings its texts together; the
    windows themselves never do.
    """
    turns = F.slice(parse_turns(F.col("text")), F.col("n_repeated") + 1, F.lit(1 << 30))
    learnt = F.transform("loss", lambda s: unescape(
        F.substring(F.col("text"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
    ))
    said = formatted.select(
        id_column, "first_turn", turns.alias("turns"), F.array_join(learnt, "").alias("learnt"),
        F.char_length("text").alias("chars"),
    ).select(
        id_column, "chars", F.size("turns").alias("n"), F.struct(
            "first_turn", F.array_join(F.transform(
                "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
            ), "").alias("turns"), "learnt",
        ).alias("said"),
    )
    whole = said.groupBy(id_column).agg(
        F.array_sort(F.collect_list("said")).alias("said"), F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    learnt = F.array_join(F.transform("said", lambda s: s["learnt"]), "")
    return whole.select(
        id_column, "n_turns",
        F.sha2(F.array_join(F.transform("said", lambda s: s["turns"]), ""), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("bigint").alias("loss_chars"), F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )
