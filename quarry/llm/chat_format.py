"""Chat formatting with typed content parts, in DataFrame functions only.

A message's content is an array of parts: text, image, audio or document. A visitor walks them in order and flattens them into one
string: text is escaped, every attachment becomes a placeholder with its number, and its reference and the tokens that
it expands to are recorded. Turns are marked by control strings,

    [INST]role\\ntext[/INST]        any role but the assistant
    <s>assistant\\ntext</s>         the assistant; its text is what the loss mask covers

and a control string inside a text gets a backslash behind its first character (a backslash is doubled), so it can't be taken
for one and reads back as it was. Places are counted in code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ASSISTANT = "assistant"
#: Control strings of the format; those of common chat templates are escaped with them.
CONTROL = "<(?=/?s>|\\||/?SYS>)|\\[(?=/?INST\\])"
#: Tokens of attachments: side of an image patch, audio tokens a second, tokens of a document page.
PATCH, AUDIO_RATE, PAGE_TOKENS = 28, 25.0, 1024
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"({CONTROL})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_part(text: Column) -> Column:
    """Plain text as an array of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"))).cast(f"array<{PART}>")


def expanded_tokens(part: Column, patch: int = PATCH, audio_rate: float = AUDIO_RATE, page_tokens: int = PAGE_TOKENS) -> Column:
    """Tokens that an attachment takes; unknown sizes count as one patch, second or page, and unknown types as one token."""
    side = lambda x: F.greatest(F.lit(1), F.ceil(F.coalesce(x, F.lit(1)) / F.lit(patch)))
    return (
        F.when(part["type"] == "image", side(part["width"]) * side(part["height"]))
        .when(part["type"] == "audio", F.greatest(F.lit(1), F.ceil(F.coalesce(part["seconds"], F.lit(1.0)) * F.lit(audio_rate))))
        .when(part["type"] == "document", F.greatest(F.lit(1), F.coalesce(part["pages"], F.lit(1))) * F.lit(page_tokens))
        .otherwise(F.lit(1))
        .cast("long")
    )


def visit(parts: Column) -> Column:
    """The flattened string of an array of parts: text escaped, attachments as placeholders numbered within the message. Null parts
    and null texts give nothing."""
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    number = lambda i: F.size(F.filter(F.slice(parts, 1, i + 1), lambda p: F.coalesce(p["type"], F.lit("text")) != "text"))
    one = lambda p, i: F.when(F.coalesce(p["type"], F.lit("text")) == "text", escape(F.coalesce(p["text"], F.lit("")))).otherwise(F.concat(F.lit("<|"), F.regexp_replace(p["type"], "[^A-Za-z0-9_]", "_"), F.lit(":"), number(i).cast("string"), F.lit("|>")))
    return F.when((F.size(parts) == 1) & (F.coalesce(parts[0]["type"], F.lit("text")) == "text"), escape(F.coalesce(parts[0]["text"], F.lit("")))).otherwise(F.array_join(F.transform(parts, one), ""))


def attachments(parts: Column) -> Column:
    """array<struct<type, ref, tokens>> in order."""
    other = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull() & (F.coalesce(p["type"], F.lit("text")) != "text"))
    return F.transform(other, lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"), expanded_tokens(p).alias("tokens")))


def format_conversations(messages: DataFrame) -> DataFrame:
    """messages: conv_id, turn, role, parts (array of PART). One row per conv_id: formatted, loss_spans (array<struct<start, length>>, in code points
    from 0, in order), attachments, expanded_tokens, n_turns.

    Turns are in order of turn, then role, then text; null turns are first. A null conv_id is a conversation of its own; a null role is
    an empty one. Repeated rows are repeated turns."""
    role = escape(F.coalesce(F.col("role").cast("string"), F.lit("")))
    loss = F.coalesce(F.col("role") == ASSISTANT, F.lit(False))
    turns = messages.select("conv_id", "turn", role.alias("role"), loss.alias("loss"), visit(F.col("parts")).alias("body"), attachments(F.col("parts")).alias("files"))
    head = F.concat(F.when(F.col("loss"), F.lit("<s>")).otherwise(F.lit("[INST]")), F.col("role"), F.lit("\n"))
    turns = turns.withColumn("piece", F.concat(head, F.col("body"), F.when(F.col("loss"), F.lit("</s>")).otherwise(F.lit("[/INST]"))))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "body", "files")
    turns = turns.withColumn("nth", F.row_number().over(order)).withColumn("start", F.coalesce(F.sum(F.length("piece")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length(head))
    span = F.when(F.col("loss"), F.struct(F.col("start"), F.length("body").cast("long").alias("length")))
    rows = F.sort_array(F.collect_list(F.struct("nth", "piece", span.alias("span"), "files")))
    out = turns.groupBy("conv_id").agg(rows.alias("rows"))
    files = F.flatten(F.transform("rows", lambda r: r["files"]))
    return out.select(
        "conv_id", F.size("rows").cast("long").alias("n_turns"), F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"),
        F.filter(F.transform("rows", lambda r: r["span"]), lambda s: s.isNotNull()).alias("loss_spans"), files.alias("attachments"),
        F.aggregate(files, F.lit(0).cast("long"), lambda s, f: s + f["tokens"]).alias("expanded_tokens"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The digests of conversations, read from the formatted strings and their loss spans alone: conv_id, n_turns, turns_sha256 (role, \\n, text, \\n
    per turn), loss_chars, loss_sha256, formatted_chars. The string is cut at the control strings that close turns; what the mask covers
    is found by place. Costs are linear in a conversation's length."""
    cut = F.split("formatted", r"(?<=\[/INST\])|(?<=</s>)")
    pieces = formatted.select("conv_id", F.length("formatted").alias("chars"), F.posexplode(F.filter(cut, lambda x: x != "")).alias("nth", "piece"))
    opened = F.regexp_extract("piece", r"^(?:\[INST\]|<s>)", 0)
    closed = F.regexp_extract("piece", r"(?:\[/INST\]|</s>)$", 0)
    inner = F.substring(F.col("piece"), F.length(opened) + 1, F.length("piece") - F.length(opened) - F.length(closed))
    pieces = pieces.withColumn("inner", inner).withColumn("break", F.locate("\n", F.col("inner")))
    order = Window.partitionBy("conv_id").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    body = F.substring(F.col("inner"), F.col("break") + 1, F.length("inner"))
    pieces = pieces.select("conv_id", "chars", "nth", F.substring(F.col("inner"), F.lit(1), F.col("break") - 1).alias("role"), body.alias("body"), (F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0)) + F.length(opened) + F.col("break")).alias("start"))
    spans = formatted.select("conv_id", F.explode("loss_spans").alias("span")).select(F.col("conv_id").alias("span_conv"), F.col("span.start").alias("span_start"), F.col("span.length").alias("span_length"))
    pieces = pieces.join(spans, F.col("conv_id").eqNullSafe(F.col("span_conv")) & (F.col("start") == F.col("span_start")), "left")
    text = unescape(F.col("body"))
    masked = F.when(F.col("span_length").isNotNull(), unescape(F.substring(F.col("body"), F.lit(1), F.col("span_length").cast("int"))))
    rows = F.sort_array(F.collect_list(F.struct("nth", F.concat(unescape(F.col("role")), F.lit("\n"), text, F.lit("\n")).alias("said"), masked.alias("masked"))))
    out = pieces.groupBy("conv_id").agg(rows.alias("rows"), F.max("chars").cast("long").alias("formatted_chars"))
    loss = F.array_join(F.transform("rows", lambda r: F.coalesce(r["masked"], F.lit(""))), "")
    return out.select(
        "conv_id", F.size("rows").cast("long").alias("n_turns"), F.sha2(F.array_join(F.transform("rows", lambda r: r["said"]), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


def with_probe(conversations: DataFrame) -> DataFrame:
    """conversations (conv_id, turn, role, text) and conversation -1, whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    rows = F.array(*[F.struct(F.lit(-1).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text")) for t, r in enumerate(("user", ASSISTANT))])
    probe = conversations.sparkSession.range(1).select(F.explode(rows).alias("r")).select("r.*")
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).union(probe)


def oracle() -> str:
    """The digests in DuckDB SQL, straight from the rows. Only formatted_chars depends on the format: each turn has its role, its text, a line
    break, the control strings around them and the backslashes of the escape."""
    return """
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(regexp_replace(replace(text, chr(92), chr(92) || chr(92)), '<(/?s>|[|]|/?SYS>)', '<\\\\\\1', 'g'), '\\[(/?INST\\])', '[\\\\\\1', 'g') AS body FROM c)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(role) + 1 + length(body) + CASE WHEN role = 'assistant' THEN 7 ELSE 13 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id"""
