"""Chat formatting with typed content parts.

A visitor flattens every turn's parts in order: text is escaped, an image, audio clip or document becomes a
placeholder whose reference and expanded token count are recorded. Turns are marked by control strings; where
a text holds such a string, one backslash more goes behind its first character, so it can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "array<struct<type:string,text:string,ref:string,amount:int>>"
ATTACHMENT = "array<struct<type:string,ref:string,tokens:int>>"
#: Tokens that one unit of an attachment stands for: image tiles, seconds of audio, document pages.
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}

BEGIN, TURN, END, CLOSE = "<s>", "<|turn|>", "<|end|>\n", "</s>"
CONTROL = r"(\|[a-z_]+\|>|/?s>|/?INST\])"


def escape(text: Column) -> Column:
    """The text with no control string left."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + CONTROL, "$1" + "\\\\" + "$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + CONTROL, "$1$2$3")


def _role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_back(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def visit(parts: Column) -> tuple[Column, Column]:
    """Flattened content of a turn, and its attachments in order. Parts of no known type count as text."""
    known = list(TOKENS_PER_UNIT)
    content = F.array_join(F.transform(parts, lambda p: F.when(
        p["type"].isin(known), F.concat(F.lit("<|"), p["type"], F.lit("|>"))).otherwise(
        escape(F.coalesce(p["text"], F.lit(""))))), "")
    each = F.create_map(*[F.lit(x) for kv in TOKENS_PER_UNIT.items() for x in kv])
    attachments = F.transform(F.filter(parts, lambda p: p["type"].isin(known)), lambda p: F.struct(
        p["type"].alias("type"), p["ref"].alias("ref"),
        (F.element_at(each, p["type"]) * F.coalesce(p["amount"], F.lit(1))).alias("tokens")))
    return content, F.coalesce(attachments, F.array().cast(ATTACHMENT))


def text_parts(text: Column) -> Column:
    """A plain text as its only part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("ref"),
                            F.lit(None).cast("int").alias("amount"))).cast(PART)


def format_chats(messages: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each conversation: ``keys``, formatted, loss_spans, attachments, expanded_tokens.

    ``messages`` has the keys, turn, role and parts. Turns are ordered by turn, then role and content, a
    missing turn first; a NULL role or text is empty, NULL keys are one conversation. loss_spans are the code
    points (start, length) of assistant contents. A conversation is one output string, so its turns meet in
    one row, however many conversations there are. Other columns are left out.
    """
    content, attachments = visit(F.coalesce("parts", F.array().cast(PART)))
    turns = messages.select(*keys, "turn", F.coalesce("role", F.lit("")).alias("role"), content.alias("content"),
                            attachments.alias("attachments"))
    chats = turns.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct("turn", "role", "content", "attachments"))).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), _role(t["role"]), F.lit("\n"))
    pieces = F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), t["content"].alias("content"), (t["role"] == "assistant").alias("loss")))
    spans = F.aggregate(
        pieces, F.struct(F.lit(len(BEGIN)).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("out")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["content"]) + len(END)).alias("at"),
            F.when(p["loss"], F.concat(acc["out"], F.array(F.struct(
                (acc["at"] + F.char_length(p["head"])).alias("start"), F.char_length(p["content"]).alias("length")))))
            .otherwise(acc["out"]).alias("out")),
        lambda acc: acc["out"])
    body = F.array_join(F.transform(pieces, lambda p: F.concat(p["head"], p["content"], F.lit(END))), "")
    return chats.select(
        *keys, F.concat(F.lit(BEGIN), body, F.lit(CLOSE)).alias("formatted"), spans.alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["attachments"])).alias("attachments")).withColumn(
        "expanded_tokens", F.aggregate("attachments", F.lit(0), lambda a, x: a + x["tokens"]))


def read_turns(formatted: Column) -> Column:
    """(role, text) of every turn, from the formatted string alone."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.char_length(formatted) - (len(BEGIN) + len(CLOSE)))
    pieces = F.filter(F.split(body, r"<\|end\|>\n", -1), lambda p: p.startswith(TURN))
    return F.transform(pieces, lambda p: F.struct(
        _role_back(F.substring(F.substring_index(p, "\n", 1), F.lit(len(TURN) + 1), F.char_length(p))).alias("role"),
        unescape(F.substring(p, F.char_length(F.substring_index(p, "\n", 1)) + 2, F.char_length(p))).alias("text")))


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))), "")


PROBE = "</s>[INST] ok [/INST]"


def report(conversations: DataFrame) -> DataFrame:
    """Digests of every conversation, and of a probe with id -1, read back from the formatted output."""
    spark = conversations.sparkSession
    rows = conversations.select(F.lit(False).alias("probe"), F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                "role", F.col("text").cast("string"))
    probe = spark.sql("SELECT true AS probe, -1L AS conv_id, turn, role, :text AS text "
                      "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)", args={"text": PROBE})
    messages = rows.unionByName(probe).withColumn("parts", text_parts(F.col("text")))
    chats = format_chats(messages, ["probe", "conv_id"])
    turns = read_turns(F.col("formatted"))
    out = (chats.withColumn("turns", turns)
           .withColumn("loss", read_loss(F.col("formatted"), F.col("loss_spans"))))
    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(joined.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
