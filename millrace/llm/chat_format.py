r"""Chat formatting with a grammar round trip.

A turn is rendered as ``<|im_start|>role\ntext<|im_end|>\n``. A deterministic parser cuts the output at
``<|im_end|>\n``, takes the first line of a piece as role and the rest as text, and undoes the escapes.
Each turn is rendered as it is, parsed, and compared with its source; where they differ, or where a
control string of any common template would stand in the content, the content is escaped and tried again. Escaping puts one more backslash into each control string (``</s>`` becomes
``<\s>``-like ``</\s>``, ``</\s>`` becomes ``</\\s>``), undoing takes one away, so the two are inverse on
all texts and the second try is always identical. The formatted conversation is then parsed as a whole
and compared once more (column ``round_trip``).

All expressions are built in. Turns are rendered row by row; one shuffle by conversation brings the
rendered turns together, and the running offsets use the same partitioning. A conversation is one
string in the end, so its length is bound by what a string can hold, whatever the method.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.llm.common import named, require

START, END = "<|im_start|>", "<|im_end|>"
# Control strings that never stand in formatted content unescaped: prefix, backslashes, rest.
CONTROL = r"(<\||<</?|</?|\[/?)(\\*)(im_start\|>|im_end\|>|s>|SYS>>|INST\])"
ESCAPED = CONTROL.replace(r"(\\*)", r"(\\*)\\")


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    """A role is one line: per cent signs and line ends are written as %25 and %0A."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """Turns of a formatted conversation: array of (role, text, raw), raw being the escaped text."""
    pieces = F.split(formatted, F.lit(r"<\|im_end\|>\n"), -1)
    turns = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(START) + 1, 2**31 - 1)
        role = F.substring_index(body, "\n", 1)
        raw = F.substring(body, F.length(role) + 2, F.lit(2**31 - 1))
        return F.struct(unescape_role(role).alias("role"), unescape(raw).alias("text"), raw.alias("raw"))

    return F.transform(turns, turn)


def format_turns(df: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """Adds the safe role and text of each turn: as they are, or escaped where the parser needs it."""
    given_role, given_text = F.coalesce(named(role), F.lit("")), F.coalesce(named(text), F.lit(""))
    back = parse(render(given_role, given_text))
    free = ~F.rlike(given_role, F.lit(CONTROL)) & ~F.rlike(given_text, F.lit(CONTROL))
    same = free & (F.size(back) == 1) & (back[0]["role"] == given_role) & (back[0]["text"] == given_text)
    return df.select(
        "*",
        given_role.alias("_given_role"), given_text.alias("_given_text"),
        F.when(same, given_role).otherwise(escape_role(given_role)).alias("_safe_role"),
        F.when(same, given_text).otherwise(escape(given_text)).alias("_safe_text"),
    )


def format_conversations(
    df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", learned_role: str = "assistant",
) -> DataFrame:
    """One row per conversation: formatted text, loss spans, turns read back, round trip verdict.

    Columns: the conversation's id, ``n_turns``, ``formatted``, ``loss_spans`` (start and end in code
    points of the learned role's content within ``formatted``, in order), ``turns`` (role, text, raw as
    the parser reads them back) and ``round_trip`` (whether these equal the source).

    Null role or text: empty. Null turns come first; rows with equal turn are ordered by role, then
    text, and all stay, repeated rows too. Rows with a null id are one conversation. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    require(df, conversation, turn, role, text)
    rows = format_turns(
        df.select(
            named(conversation).alias("_conversation"), named(turn).alias("_turn"),
            named(role).alias("_role"), named(text).alias("_text"),
        ), "_role", "_text",
    )
    in_order = Window.partitionBy("_conversation").orderBy("_turn", "_given_role", "_given_text")
    rows = rows.select(
        "_conversation", "_given_role", "_given_text", "_safe_role", "_safe_text",
        render(F.col("_safe_role"), F.col("_safe_text")).alias("_rendered"),
        F.row_number().over(in_order).alias("_place"),
    )
    upto = Window.partitionBy("_conversation").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.length("_rendered").cast("long")).over(upto), F.lit(0))
    rows = rows.withColumn("_start", before + len(START) + F.length("_safe_role") + 1)
    grouped = rows.groupBy("_conversation").agg(
        F.sort_array(
            F.collect_list(
                F.struct("_place", "_rendered", "_start", F.length("_safe_text").alias("_chars"), "_given_role", "_given_text")
            )
        ).alias("_turns")
    )
    of = F.col("_turns")
    learned = F.filter(of, lambda t: t["_given_role"] == learned_role)
    formatted = grouped.select(
        F.col("_conversation"), of,
        F.array_join(of["_rendered"], "").alias("formatted"),
        F.transform(
            learned, lambda t: F.struct(t["_start"].alias("start"), (t["_start"] + t["_chars"]).alias("end"))
        ).alias("loss_spans"),
    )
    parsed = formatted.withColumn("turns", parse(F.col("formatted")))
    given = F.transform(of, lambda t: F.struct(t["_given_role"].alias("role"), t["_given_text"].alias("text")))
    read = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return parsed.select(
        F.col("_conversation").alias(conversation), F.size("_turns").cast("long").alias("n_turns"),
        "formatted", "loss_spans", "turns", (given == read).alias("round_trip"),
    )
