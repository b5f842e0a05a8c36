r"""Chat formatting with prefix-target expansion, in DataFrame operations only.

A turn is written ``### Label: text</turn>`` and a newline. Inside a text the
escape character and both control strings are broken up so that neither can occur
literally (``\`` -> ``\\``, ``</turn>`` -> ``<\/turn>``, every ``#`` after two others
-> ``\#``); dropping each escape character and keeping what follows it restores the
text. The three usual roles are written with a capital; any other role r is written
``~r`` with ``\`` and ``:`` escaped as ``\\`` and ``\c``.

Every assistant turn becomes an example: all turns before it as context, then the
reply, and only the reply's text is trainable. Turns after the last reply (or all
turns, where there is no reply) form one more example without trainable text, so
that nothing of the conversation is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

END = "</turn>\n"
LABELS = {"user": "User", "assistant": "Assistant", "system": "System"}


def escaped(text: Column) -> Column:
    text = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.regexp_replace(text, "(?<=##)#", r"\\#")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def label(role: Column) -> Column:
    other = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit(":"), F.lit("\\c"))
    out = F.concat(F.lit("~"), F.replace(other, F.lit("</turn>"), F.lit("<\\/turn>")))
    for k, v in LABELS.items():
        out = F.when(role == k, F.lit(v)).otherwise(out)
    return out


def role_of(label: Column) -> Column:
    body = F.substring(label, 2, 1 << 30)
    # "\c" after an even number of escape characters stands for ":"; the others stand for what follows them
    other = F.regexp_replace(F.regexp_replace(body, r"(?s)((?:^|[^\\])(?:\\\\)*)\\c", "$1:"), r"(?s)\\([\\/])", "$1")
    for k, v in LABELS.items():
        other = F.when(label == v, F.lit(k)).otherwise(other)
    return other


def format_chat(rows: DataFrame) -> DataFrame:
    """One row per example: conv_id, example (from 0), formatted, loss_start, loss_length, trained, last.

    `rows` holds conv_id, turn, role and text; other columns are ignored. Turns are
    put in order of turn, then role, then text, nulls first; repeated rows are
    repeated turns. A null text or role counts as empty. Offsets count code points
    from 0; `loss_length` is 0 where nothing is trainable. `last` marks the example
    that holds all turns. An empty table gives no row; rows with a null conv_id are one
    conversation. All turns of a conversation meet in one task, and its examples' texts
    together grow with the square of its turns, as the method repeats what precedes.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    one = rows.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    shown = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == "assistant").alias("reply"),
            F.char_length(escaped(t["text"])).alias("points"),
            F.concat(F.lit("### "), label(t["role"]), F.lit(": "), escaped(t["text"]), F.lit(END)).alias("segment"),
        ),
    )
    one = one.select("conv_id", shown.alias("shown"))
    ends = F.filter(F.sequence(F.lit(1), F.size("shown")), lambda i: F.element_at("shown", i)["reply"] | (i == F.size("shown")))
    each = one.select("conv_id", "shown", F.posexplode(ends).alias("example", "upto"))
    target = F.element_at("shown", F.col("upto"))
    each = each.select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.array_join(F.transform(F.slice("shown", 1, F.col("upto")), lambda s: s["segment"]), "").alias("formatted"),
        target["points"].alias("points"),
        target["reply"].alias("trained"),
        (F.col("upto") == F.size("shown")).alias("last"),
    )
    length = F.when(F.col("trained"), F.col("points")).otherwise(0)
    start = F.char_length("formatted") - len(END) - F.col("points")
    return each.select("conv_id", "example", "formatted", start.alias("loss_start"), length.alias("loss_length"), "trained", "last")


def turns_of(formatted: Column) -> Column:
    """Read the turns back: array<struct<role, text>>."""
    parts = F.split(formatted, END, -1)
    head = lambda s: F.substring_index(s, ": ", 1)
    return F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda s: F.struct(
            role_of(F.substring(head(s), 5, 1 << 30)).alias("role"),
            unescaped(F.substring(s, F.char_length(head(s)) + 3, F.lit(1 << 30))).alias("text"),
        ),
    )


def digest(examples: DataFrame) -> DataFrame:
    """Per conversation: counts and digests of what is read back from the examples."""
    turns = F.when(F.col("last"), turns_of(F.col("formatted")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.when(F.col("trained"), unescaped(F.expr("substring(formatted, loss_start + 1, loss_length)"))).otherwise("")
    each = examples.withColumn("turns", turns).select(
        "conv_id", "example", F.size("turns").alias("n"), F.when(F.col("last"), F.sha2(whole, 256)).alias("sha"), loss.alias("loss"), F.char_length("formatted").alias("points")
    )
    out = each.groupBy("conv_id").agg(
        F.max("n").cast("long").alias("n_turns"),
        F.max("sha").alias("turns_sha256"),
        F.sum(F.char_length("loss")).cast("long").alias("loss_chars"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("losses"),
        F.sum("points").cast("long").alias("formatted_chars"),
    )
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", F.sha2("losses", 256).alias("loss_sha256"), "formatted_chars")


#: Beside the table's rows: the conversation whose texts hold every control string.
PROBE = r"\### Assistant: </turn> ok"

ORACLE_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
s AS (
  SELECT *, 4 + length(role) + 2 + length(text)
    + (length(text) - length(replace(text, '\', ''))) + (length(text) - length(replace(text, '</turn>', ''))) / 7
    + CASE WHEN contains(text, '###') THEN len(list_filter(range(1, length(text) + 1), lambda i: substr(text, i, 3) = '###')) ELSE 0 END
    + 8 AS points
  FROM r),
c AS (
  SELECT *, sum(points) OVER w AS upto,
         role = 'assistant' OR row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS ends
  FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(upto) FILTER (WHERE ends) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
