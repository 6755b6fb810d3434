r"""Chat formatting of typed content parts, with DataFrame functions only.

A visitor walks the parts of every turn in order and flattens them into one body: text parts become escaped text,
image, audio and document parts become a placeholder each, whose reference and expanded token count are recorded; the
leaf parts that a document part holds follow its placeholder. Turns are then joined to one string a conversation:

    <|turn|>ROLE<|body|>BODY<|end|>

Control strings inside a role or text are escaped so that none of them stays: a backslash becomes ``\0``, the ``<`` of
``<s>``, ``</s>`` and ``<|`` becomes ``\1``, the ``[`` of ``[INST]`` and ``[/INST]`` becomes ``\2``; a null role is ``\3``.
Undoing 1, 2 and then 0 gives the text back, since no escape holds another.

Defined cases: null text is empty text; null parts, an empty list and a null part add nothing; an unknown part type is
read as text; rows with equal conversation and turn are ordered by role and body, and repeated rows stay; an empty table
gives an empty result; other columns of the input are not looked at. A conversation is one string by contract, so its
rows meet in one group; nothing larger than a conversation does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
LEAF = "type:string,text:string,uri:string,width:int,height:int,seconds:double,pages:int"
PARTS = f"array<struct<{LEAF},parts:array<struct<{LEAF}>>>>"
#: Tokens that an attachment expands to: image patches of a side of so many pixels, audio frames a second, tokens a page.
PATCH, FRAMES, PAGE = 14, 25, 600


def escape(text: Column) -> Column:
    kept = F.replace(text, F.lit("\\"), F.lit("\\0"))
    kept = F.regexp_replace(kept, r"<(/?s>|\|)", r"\\1$1")
    return F.regexp_replace(kept, r"\[(/?INST\])", r"\\2$1")


def unescape(text: Column) -> Column:
    out = F.replace(F.replace(text, F.lit("\\1"), F.lit("<")), F.lit("\\2"), F.lit("["))
    return F.replace(out, F.lit("\\0"), F.lit("\\"))


def _tokens(part: Column) -> Column:
    def patches(side: str) -> Column:
        return F.ceil(F.coalesce(part[side], F.lit(0)) / PATCH)

    return (
        F.when(part["type"] == "image", patches("width") * patches("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * PAGE)
        .otherwise(0)
        .cast("long")
    )


def _leaf(part: Column) -> Column:
    return F.struct(part["type"].alias("type"), part["text"].alias("text"), part["uri"].alias("uri"), _tokens(part).alias("tokens"))


def visit(parts: Column) -> Column:
    """Parts in reading order, the leaves of a document after it; each with its expanded token count."""
    def inner(part: Column) -> Column:
        leaves = F.filter(F.coalesce(part["parts"], F.array()), lambda x: x.isNotNull())
        return F.concat(F.array(_leaf(part)), F.transform(leaves, _leaf))

    return F.flatten(F.transform(F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda x: x.isNotNull()), inner))


def flattened(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and parts to conv_id, turn, role, body, attachments and expanded_tokens."""
    seen = turns.select("conv_id", "turn", "role", visit(F.col("parts").cast(PARTS)).alias("leaves"))

    def attached(x: Column) -> Column:
        return F.coalesce(x["type"].isin("image", "audio", "document"), F.lit(False))

    def shown(x: Column) -> Column:
        return F.when(attached(x), F.concat(F.lit("<|"), x["type"], F.lit("|>"))).otherwise(escape(F.coalesce(x["text"], F.lit(""))))

    def recorded(x: Column, i: Column) -> Column:
        return F.struct(i.alias("position"), x["type"].alias("type"), x["uri"].alias("uri"), x["tokens"].alias("tokens"))

    return seen.select(
        "conv_id",
        "turn",
        "role",
        F.array_join(F.transform("leaves", shown), "").alias("body"),
        F.transform(F.filter("leaves", attached), recorded).alias("attachments"),
        F.aggregate("leaves", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("expanded_tokens"),
    )


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, parts to conv_id, formatted, mask, attachments and expanded_tokens, one row a conversation.

    ``mask`` has an entry a turn: ``skip`` characters that frame the body, ``take`` characters of the body and whether
    these are learnt, which assistant turns are.
    """
    role = F.coalesce(escape(F.col("role")), F.lit("\\3"))
    flat = flattened(turns).select("conv_id", F.struct("turn", role.alias("role"), "body", "attachments", "expanded_tokens").alias("t"))
    told = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def piece(t: Column) -> Column:
        return F.concat(F.lit(TURN), t["role"], F.lit(BODY), t["body"], F.lit(END))

    def masked(t: Column) -> Column:
        return F.struct(
            (F.char_length(t["role"]) + len(TURN) + len(BODY)).alias("skip"), F.char_length(t["body"]).alias("take"), (t["role"] == "assistant").alias("loss")
        )

    def of_turn(t: Column) -> Column:
        return F.transform(t["attachments"], lambda a: F.struct(t["turn"].alias("turn"), a["position"].alias("position"), a["type"].alias("type"), a["uri"].alias("uri"), a["tokens"].alias("tokens")))

    return told.select(
        "conv_id",
        F.array_join(F.transform("ts", piece), "").alias("formatted"),
        F.transform("ts", masked).alias("mask"),
        F.flatten(F.transform("ts", of_turn)).alias("attachments"),
        F.aggregate("ts", F.lit(0).cast("long"), lambda a, t: a + t["expanded_tokens"]).alias("expanded_tokens"),
    )


def read_back(out: DataFrame) -> DataFrame:
    """conv_id, turns (role and text, unescaped), learnt (the texts under the loss mask) from ``formatted`` and ``mask``."""
    pieces = F.split("formatted", r"<\|turn\|>")
    pieces = F.slice(pieces, 2, F.size(pieces) - 1)

    def turn(x: Column) -> Column:
        role = F.substring_index(x, BODY, 1)
        body = F.substring_index(F.substring_index(x, BODY, -1), END, 1)
        return F.struct(F.when(role != "\\3", unescape(role)).alias("role"), unescape(body).alias("text"))

    def learnt(x: Column, m: Column) -> Column:
        return F.when(m["loss"], unescape(x.substr(m["skip"] - (len(TURN) - 1), m["take"])))

    return out.select(
        "conv_id",
        "formatted",
        F.transform(pieces, turn).alias("turns"),
        F.filter(F.zip_with(pieces, "mask", learnt), lambda x: x.isNotNull()).alias("learnt"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(said).alias("text"),
    )
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(extra)
    none = {"uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    part = F.struct(F.lit("text").alias("type"), F.col("text"), *[F.lit(None).cast(k).alias(c) for c, k in none.items()], F.lit(None).cast(f"array<struct<{LEAF}>>").alias("parts"))
    back = read_back(formatted(turns.withColumn("parts", F.array(part))))
    lines = F.transform("turns", lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(F.array_join("learnt", "")).cast("long").alias("loss_chars"),
        F.sha2(F.array_join("learnt", ""), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, role IS NULL AS no_role, coalesce(text, '') AS text,
         regexp_replace(regexp_replace(replace(coalesce(text, ''), '\', '\0'), '<(/?s>|\|)', '\\1\1', 'g'), '\[(/?INST\])', '\\2\1', 'g') AS body,
         regexp_replace(regexp_replace(replace(coalesce(role, ''), '\', '\0'), '<(/?s>|\|)', '\\1\1', 'g'), '\[(/?INST\])', '\\2\1', 'g') AS r
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, body)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, body), '')) AS loss_sha256,
       sum(CASE WHEN no_role THEN 2 ELSE length(r) END + length(body) + 23)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
