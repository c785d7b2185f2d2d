"""Chat transcripts for training in budgeted windows, in DataFrame functions only.

Prefix sums of turn tokens cut a conversation into spans of whole turns. Every window holds the system turn, the last
turns of the span before it up to a history budget, and the turns of its own span. Only the assistant turns of its own
span are targets: what is repeated is outside the loss mask, so each assistant text is a target exactly once.

Budget: a window's own turns end inside one stretch of ``(budget - history) / 2`` tokens, so they have at most
``budget - history`` tokens if no single turn is longer than such a stretch; a longer turn is kept whole. The system
turn comes on top.

Template: ``<|turn|> role <|text|> text <|end|>`` and a line feed for each turn. In roles and texts a backslash is put before
every backslash and control string, so control strings at a marker's place never come from a text, and dropping the
escapes gives the text back.

Turns are ordered by turn, then role, then text. The system turn is the first one if its role is ``system``. Null roles and
texts are empty, rows without conv_id form one conversation, repeated rows are turns of their own, and an empty table
gives no windows. Tokens are words plus a fixed cost a turn.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from flowledger.llm.common import WORD, word_count

TURN, TEXT, END = "<|turn|> ", " <|text|> ", " <|end|>\n"
# Strings that steer this template or other common ones; none may stand unescaped in a text.
CONTROL = ("<|turn|>", "<|text|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
BUDGET = 1024
HISTORY = 256
TURN_COST = 4
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"


def _quoted(text: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|" else c for c in text)


ESCAPED = "(" + "|".join(map(_quoted, ("\\", *CONTROL))) + ")"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window (from 0), formatted, repeated (leading turns that stood before), tokens,
    loss (array of start_at, end_at: code points of ``formatted``, end exclusive). ``turns``: conv_id, turn, role, text."""
    stretch = max((budget - history) // 2, 1)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("conv_id")
    span = Window.partitionBy("conv_id", "span")
    is_system = (F.col("idx") == 0) & (F.col("role") == SYSTEM_ROLE)
    counted = (
        turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tokens", word_count(F.col("text")) + TURN_COST)
        .withColumn("idx", F.row_number().over(order) - 1)
        .withColumn("until", F.sum(F.when(is_system, 0).otherwise(F.col("tokens"))).over(so_far))
        .withColumn("slot", F.floor(F.greatest(F.col("until") - 1, F.lit(0)) / stretch))
        .withColumn("opens", F.coalesce(F.col("slot") != F.lag("slot").over(order), F.lit(False)).cast("int"))
        .withColumn("span", F.sum("opens").over(so_far))
        .withColumn("last_span", F.max("span").over(whole))
        .withColumn("span_until", F.max("until").over(span))
    )
    since = F.col("span_until") - F.col("until") + F.col("tokens")
    own = F.struct("span", F.lit(False).alias("again"))
    following = F.struct((F.col("span") + 1).alias("span"), F.lit(True).alias("again"))
    everywhere = F.transform(F.sequence(F.lit(0).cast("long"), F.col("last_span")), lambda k: F.struct(k.alias("span"), (k > 0).alias("again")))
    in_history = (F.col("span") < F.col("last_span")) & (since <= history)
    places = F.when(is_system, everywhere).when(in_history, F.array(own, following)).otherwise(F.array(own))
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    body = escape(F.col("text"))
    placed = counted.select("conv_id", "idx", "role", "tokens", head.alias("head"), body.alias("body"), F.inline(places)).withColumnRenamed("span", "window")
    inside = Window.partitionBy("conv_id", "window").orderBy("idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = F.length("head") + F.length("body") + len(END)
    ends = (F.sum(length).over(inside) - len(END)).alias("end_at")
    pieces = F.sort_array(F.collect_list(F.struct("idx", "again", "role", "start_at", "end_at", "piece")))
    targets = F.filter("pieces", lambda p: (~p.again) & (p.role == TARGET_ROLE))
    return (
        placed.select("conv_id", "window", "idx", "again", "role", "tokens", F.length("body").alias("size"), ends, F.concat("head", "body", F.lit(END)).alias("piece"))
        .withColumn("start_at", F.col("end_at") - F.col("size"))
        .groupBy("conv_id", "window")
        .agg(pieces.alias("pieces"), F.sum("tokens").alias("tokens"))
        .select(
            "conv_id",
            "window",
            F.array_join(F.transform("pieces", lambda p: p.piece), "").alias("formatted"),
            F.size(F.filter("pieces", lambda p: p.again)).alias("repeated"),
            "tokens",
            F.transform(targets, lambda p: F.struct(p.start_at.alias("start_at"), p.end_at.alias("end_at"))).alias("loss"),
        )
    )


def parsed_turns(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a window."""
    parts = F.split(formatted, _quoted(END))

    def turn(part: Column) -> Column:
        fields = F.split(part, _quoted(TEXT), 2)
        role = F.substring(fields[0], len(TURN) + 1, 2**31 - 1)
        return F.struct(unescape(role).alias("role"), unescape(fields[1]).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask of a window, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(formatted.substr((s.start_at + 1).cast("int"), (s.end_at - s.start_at).cast("int")))), "")


def chat_report(turns: DataFrame) -> DataFrame:
    """Turns and targets of every conversation as read back from its windows: counts and digests."""
    windows = format_conversations(turns)
    formatted = F.col("formatted")
    fresh = F.slice("turns", F.col("repeated") + 1, F.size("turns"))
    read = windows.select("conv_id", "window", "repeated", F.length(formatted).alias("chars"), parsed_turns(formatted).alias("turns"), loss_text(formatted, F.col("loss")).alias("loss_text")).select(
        "conv_id",
        "chars",
        F.struct(
            "window",
            F.size(fresh).alias("n"),
            F.array_join(F.transform(fresh, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").alias("turns"),
            "loss_text",
        ).alias("part"),
    )

    def joined(field: str) -> Column:
        return F.array_join(F.transform("parts", lambda p: p[field]), "")

    return (
        read.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"), F.sum("chars").alias("formatted_chars"))
        .select(
            "conv_id",
            F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p.n).alias("n_turns"),
            F.sha2(joined("turns"), 256).alias("turns_sha256"),
            F.length(joined("loss_text")).cast("long").alias("loss_chars"),
            F.sha2(joined("loss_text"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


PROBE = "</s>[INST] ok [/INST]"  # conversation -7 says only this


def with_probe(turns: DataFrame) -> DataFrame:
    """The conversations and number -7, whose texts are made of control strings."""
    rows = [F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"), F.lit(PROBE).alias("text")) for k, role in enumerate(("user", TARGET_ROLE))]
    probe = turns.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return turns.select("conv_id", "turn", "role", "text").unionByName(probe)


def report_sql() -> str:
    """The same result from the turns themselves, in DuckDB SQL; windows are counted, not built."""
    stretch = (BUDGET - HISTORY) // 2
    pattern = ESCAPED.replace("'", "''")
    size = reduce(lambda text, column: text + f" + length(regexp_replace({column}, '{pattern}', '\\\\\\1', 'g'))", ("role", "text"), str(len(TURN + TEXT + END)))
    return f"""
    WITH all_turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, '{TARGET_ROLE}', '{PROBE}')),
    numbered AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS idx,
        len(regexp_extract_all(text, '{WORD}')) + {TURN_COST} AS tokens, {size} AS size FROM all_turns),
    summed AS (
      SELECT *, idx = 0 AND role = '{SYSTEM_ROLE}' AS is_system,
        sum(CASE WHEN idx = 0 AND role = '{SYSTEM_ROLE}' THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY idx) AS until
      FROM numbered),
    spans AS (SELECT *, greatest(until - 1, 0) // {stretch} AS slot FROM summed),
    opened AS (
      SELECT *, max(until) OVER (PARTITION BY conv_id, slot) AS span_until, max(slot) OVER (PARTITION BY conv_id) AS last_slot FROM spans),
    counted AS (SELECT conv_id, count(DISTINCT slot) AS n_windows FROM opened GROUP BY conv_id)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY idx)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = '{TARGET_ROLE}'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY idx) FILTER (role = '{TARGET_ROLE}'), '')) AS loss_sha256,
      CAST(sum(size * CASE WHEN is_system THEN n_windows
        WHEN slot < last_slot AND span_until - until + tokens <= {HISTORY} THEN 2 ELSE 1 END) AS BIGINT) AS formatted_chars
    FROM opened JOIN counted USING (conv_id) GROUP BY conv_id"""
