"""Chat formatting with typed content parts.

A message has parts: text, image, audio or document. A visitor flattens them in order: text is
escaped, an attachment becomes a numbered placeholder, and its reference and the tokens that it
expands to are recorded. The output has the formatted text, the spans under the loss mask and the
attachments; `read_turns` and `read_loss` get everything back from it. Only DataFrame functions run.

    <|turn:ROLE|>\\nBODY<|end|>\\n

A text can hold any control string: `\\` becomes `\\\\` and `<|` becomes `<\\|`, so an escaped text
has no `<|`; in a role `|` becomes `\\|`.

Cases: rows are ordered by turn, then role and text, a null turn first; rows that are equal are
turns of their own. A null role or text is an empty one, a null list of parts has none, a null part
counts for nothing, and a part of another type is an attachment of one token. Rows without a
conversation id are one conversation. A long text is escaped like any other, and an empty table gives
an empty result. Columns of other names take no part, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

OPEN, HEAD_END, END = "<|turn:", "|>\n", "<|end|>\n"
ASSISTANT = "assistant"
PARTS = "array<struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
#: Tokens of an attachment: an image by tiles, audio by seconds, a document by pages.
TILE, TOKENS_A_TILE, TOKENS_A_SECOND, TOKENS_A_PAGE = 512, 170, 25, 258


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def text_parts(text: Column) -> Column:
    """A plain text as a list of one part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"), *(
        F.lit(None).cast(kind).alias(name)
        for name, kind in (("ref", "string"), ("width", "int"), ("height", "int"), ("seconds", "double"), ("pages", "int"))
    )))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"] == "text", F.lit(False))


def _tokens(part: Column) -> Column:
    def or_one(value: Column) -> Column:
        return F.greatest(F.coalesce(value, F.lit(1)), F.lit(1))

    tiles = F.ceil(or_one(part["width"]) / TILE) * F.ceil(or_one(part["height"]) / TILE)
    return (
        F.when(part["type"] == "image", tiles * TOKENS_A_TILE)
        .when(part["type"] == "audio", F.ceil(or_one(part["seconds"]) * TOKENS_A_SECOND))
        .when(part["type"] == "document", or_one(part["pages"]) * TOKENS_A_PAGE)
        .otherwise(1).cast("long")
    )


def format_conversations(
    messages: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts",
) -> DataFrame:
    """(conv_id, formatted, loss, attachments) from rows of a turn with `parts` of type PARTS.

    loss: spans (start, end) in code points of the bodies of the assistant.
    attachments: (number, turn, type, ref, tokens), in the order of their placeholders.
    """
    flat = messages.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.filter(F.coalesce(F.col(parts), F.array().cast(PARTS)), lambda p: p.isNotNull()).alias("parts"),
    )
    files = F.filter("parts", lambda p: ~_is_text(p))
    in_turn_order = Window.partitionBy("conv").orderBy("turn", "role", "parts")
    so_far = in_turn_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = flat.withColumn("files", files).withColumns({
        "place": F.row_number().over(in_turn_order),
        "before": F.sum(F.size("files")).over(so_far) - F.size("files"),
    })
    texts = F.transform("parts", lambda p, i: F.when(_is_text(p), escape(F.coalesce(p["text"], F.lit("")))).otherwise(
        F.concat(
            F.lit("<|"), F.regexp_replace(F.coalesce(p["type"], F.lit("other")), "[^A-Za-z0-9]", "_"), F.lit(":"),
            (F.col("before") + F.size(F.filter(F.slice(F.col("parts"), F.lit(1), i), lambda q: ~_is_text(q)))).cast("string"),
            F.lit("|>"),
        )
    ))
    bodies = counted.withColumn("body", F.array_join(texts, "")).withColumn(
        "head", F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(HEAD_END))
    ).withColumn("piece", F.concat("head", "body", F.lit(END)))
    start = F.sum(F.length("piece")).over(Window.partitionBy("conv").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)) - F.length("piece") + F.length("head")
    placed = bodies.withColumn("start", start).select(
        "conv", "place", "piece",
        F.when(
            F.col("role") == ASSISTANT,
            F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end")),
        ).alias("span"),
        F.transform("files", lambda p, i: F.struct(
            (F.col("before") + i).alias("number"), F.col("turn").alias("turn"), p["type"].alias("type"),
            p["ref"].alias("ref"), _tokens(p).alias("tokens"),
        )).alias("files"),
    )
    whole = placed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "span", "files"))).alias("all"))
    return whole.select(
        F.col("conv").alias(conv_id),
        F.array_join(F.col("all.piece"), "").alias("formatted"),
        F.filter(F.col("all.span"), lambda s: s.isNotNull()).alias("loss"),
        F.flatten("all.files").alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; placeholders stay in the text."""
    chunks = F.slice(F.split(formatted, r"<\|turn:", -1), F.lit(2), F.greatest(F.size(F.split(formatted, r"<\|turn:", -1)) - 1, F.lit(0)))

    def turn(chunk: Column) -> Column:
        role = F.regexp_extract(chunk, r"^((?:[^\\|]++|\\.)*+)\|>\n", 1)
        head = F.length(role) + len(HEAD_END)
        body = F.substring(chunk, head + 1, F.length(chunk) - head - len(END))
        return F.struct(unescape(role).alias("role"), unescape(body).alias("text"))

    return F.transform(chunks, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def digest(conversations: DataFrame) -> DataFrame:
    """Counts and hashes of each conversation, all read back from the formatted output."""
    output = format_conversations(conversations.withColumn("parts", text_parts(F.col("text"))))
    turns = output.withColumns({
        "turns": read_turns(F.col("formatted")),
        "learned": F.array_join(read_loss(F.col("formatted"), F.col("loss")), ""),
    })
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


#: A conversation that holds what other templates use as control strings.
TRICKY = "\\### Assistant: </turn> ok"
SQL = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '{TRICKY}'), (-7, 1, 'assistant', '{TRICKY}')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(OPEN) + len(HEAD_END) + len(END)}
    + length(replace(replace(role, '\', '\\'), '|', '\|'))
    + length(replace(replace(text, '\', '\\'), '<|', '<\|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""
