"""Chat formatting with typed content parts (operator 6), DataFrame functions only.

A turn's content is a list of parts: text, image, audio or document. A visitor
flattens them in order: text is escaped, any other part becomes a placeholder, and
its reference and the tokens that it will expand to are recorded in order, so the
k-th placeholder of a conversation is its k-th attachment.

Template: ``<|turn:ROLE|>`` newline, content, ``<|end|>`` newline, per turn; the role
is percent-encoded. In texts a backslash is doubled, and each control string
(``<|``, ``<s>``, ``</s>``, ``[INST]``, ``[/INST]``) gets one after its first
character; after doubling, an odd run can only come from that, so both steps can
be undone and no text looks like a mark.

Rows of a conversation go by (turn, role, content), ties included; a null text or
role is empty, a null content has no parts; rows without conv_id form one
conversation of their own; an empty table gives an empty table. Extra columns are
never read. An unknown part type counts as a document, a null one as text if the
part has a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Tokens that a unit of an attachment expands to: an image tile, a second of
#: audio, a page of a document.
EXPANDS = {"image": 256, "audio": 25, "document": 700}
LOSS_ROLE = "assistant"

_OPEN, _CLOSE, _END = "<|turn:", "|>\n", "<|end|>\n"
_REST = r"\||s>|/s>|INST\]|/INST\]"

PART = "struct<type:string,text:string,ref:string,units:int>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[])(?={_REST})", r"$1\\")


def unescape(text: Column) -> Column:
    bare = F.regexp_replace(text, rf"([<\[])\\(?={_REST})", "$1")
    return F.replace(bare, F.lit("\\\\"), F.lit("\\"))


def text_part(text: Column) -> Column:
    """A content of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def _kind(part: Column) -> Column:
    bare = part["type"].isNull() & part["text"].isNotNull()
    return (F.when(bare, F.lit("text")).when(part["type"].isin("text", *EXPANDS), part["type"])
            .otherwise("document"))


def _body(parts: Column) -> Column:
    """The formatted content: runs of text parts are joined, then escaped; any other
    part is a placeholder."""
    state = F.struct(F.lit("").alias("done"), F.lit("").alias("run"))

    def step(have: Column, part: Column) -> Column:
        mark = F.concat(F.lit("<|"), _kind(part), F.lit("|>"))
        return F.when(_kind(part) == "text", F.struct(
            have["done"].alias("done"), F.concat(have["run"], F.coalesce(part["text"], F.lit(""))).alias("run"))
        ).otherwise(F.struct(F.concat(have["done"], escape(have["run"]), mark).alias("done"), F.lit("").alias("run")))

    return F.aggregate(parts, state, step, lambda have: F.concat(have["done"], escape(have["run"])))


def _attachment(part: Column) -> Column:
    per = F.lit(0)
    for kind, tokens in EXPANDS.items():
        per = F.when(_kind(part) == kind, tokens).otherwise(per)
    return F.struct(_kind(part).alias("type"), part["ref"].alias("ref"),
                    (F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(1)).cast("long") * per).alias("tokens"))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", parts_col: str = "parts") -> DataFrame:
    """``turns`` with an array of parts (type, text, ref, units) per row -> one row
    per conversation: conv_id, formatted, loss (array of (start, length) in code
    points from 1, the assistant's contents), attachments (array of (type, ref,
    tokens), in order of the placeholders) and expanded_tokens (their sum)."""
    parts = F.coalesce(F.col(f"`{parts_col}`").cast(f"array<{PART}>"), F.array().cast(f"array<{PART}>"))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), parts.alias("parts"))
    rows = rows.select(
        "conv_id", "turn", "role",
        F.concat(F.lit(_OPEN), F.url_encode("role"), F.lit(_CLOSE)).alias("mark"),
        _body(F.col("parts")).alias("body"),
        F.transform(F.filter("parts", lambda p: _kind(p) != "text"), _attachment).alias("attached"))
    order = ["turn", "role", "body", "attached"]
    line = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("mark") + F.length("body") + len(_END)
    rows = rows.withColumn("before", F.coalesce(F.sum(size).over(line), F.lit(0)))
    rows = rows.select(
        "conv_id", "before", F.concat("mark", "body", F.lit(_END)).alias("piece"), "attached",
        F.when(F.col("role") == LOSS_ROLE, F.struct(
            (F.col("before") + F.length("mark") + 1).alias("start"),
            F.length("body").cast("long").alias("length"))).alias("loss"))
    # `before` grows with every row (marks are never empty): it is the order
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(
        F.struct("before", "piece", "loss", "attached"))).alias("t"))
    attached = F.flatten(F.col("t.attached"))
    return rows.select(
        "conv_id", F.array_join("t.piece", "").alias("formatted"),
        F.filter(F.col("t.loss"), lambda x: x.isNotNull()).alias("loss"), attached.alias("attachments"),
        F.aggregate(attached, F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), unescaped."""
    pieces = F.split(formatted, r"<\|end\|>\n", -1)
    pieces = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))
    close = F.lit(_CLOSE)

    def read(p: Column) -> Column:
        at = F.instr(p, close)
        return F.struct(F.url_decode(F.substr(p, F.lit(len(_OPEN) + 1), at - len(_OPEN) - 1)).alias("role"),
                        unescape(F.substr(p, at + len(_CLOSE))).alias("text"))

    return F.transform(pieces, read)


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations, formatted and read back."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"), F.lit(odd).alias("text"))
    turns = turns.unionByName(more).withColumn("parts", text_part(F.col("text")))
    out = format_conversations(turns)
    loss = F.array_join(F.transform("loss", lambda s: unescape(
        F.substr(F.col("formatted"), s["start"].cast("int"), s["length"].cast("int")))), "")
    said = F.col("said")
    out = out.withColumn("said", read_turns(F.col("formatted"))).withColumn("under", loss)
    return out.select(
        "conv_id", F.size(said).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(said, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.length("under").cast("long").alias("loss_chars"), F.sha2("under", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "expanded_tokens")


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length('<|turn:|>') + 1 + length(url_encode(role)) + length('<|end|>') + 1 + length(text)
      + length(regexp_replace(text, '[^\\]', '', 'g'))
      + len(regexp_extract_all(text, '<\||<s>|</s>|\[INST\]|\[/INST\]')))::BIGINT AS formatted_chars,
  0::BIGINT AS expanded_tokens
FROM t GROUP BY conv_id
"""
