"""Chat formatting with typed content parts.

A turn's content is an ordered list of parts: ``text`` parts and ``image``,
``audio`` or ``document`` attachments.  A visitor (one branch per part type)
flattens the parts, in order, into template text: texts are escaped, an
attachment becomes the placeholder ``<kind>``, its reference is recorded and
its expanded token count (what the model will put in the placeholder's place)
is computed from its size.  Turns become

    <turn:ROLE>ESCAPED CONTENT</turn>\\n

Every control string of the template starts with ``<`` or ends with ``>``.
Inside texts and roles ``\\`` is written ``\\b``, ``<`` is ``\\l`` and ``>`` is
``\\g``, so no text can look like a control string, and undoing the three
replacements in reverse order gives back the text exactly.  The loss mask covers
the content of assistant turns, as spans of code points in the output.

Cases: null text, null content and null part fields read as empty (0 tokens);
an unknown part type is kept as an empty-text part; a null role is the empty
role; rows are ordered by (turn, role, content) with null turns first, so
repeated turns keep a defined order; a null conversation id is one
conversation; an empty table gives an empty result.  A formatted conversation
is one string, so one conversation has to fit into one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import quoted

PART_TYPE = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"

# Expansion parameters: an image is cut into square patches, audio into frames a second, documents into pages.
PATCH, FRAMES_A_SECOND, TOKENS_A_PAGE = 28, 25, 512
LOSS_ROLE = "assistant"
_END = "</turn>\n"


def _replace(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def escape(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    return _replace(_replace(_replace(c, "\\", "\\b"), "<", "\\l"), ">", "\\g")


def unescape(c: Column) -> Column:
    return _replace(_replace(_replace(c, "\\g", ">"), "\\l", "<"), "\\b", "\\")


def text_parts(text: Column) -> Column:
    """A plain text as a list of one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
                            *[F.lit(None).cast(t).alias(n) for n, t in (
                                ("ref", "string"), ("width", "int"), ("height", "int"),
                                ("seconds", "double"), ("pages", "int"))])).cast(f"array<{PART_TYPE}>")


def _patches(side: Column) -> Column:
    return F.ceil(F.coalesce(side, F.lit(0)) / F.lit(PATCH)).cast("bigint")


def visit(part: Column) -> Column:
    """One part -> struct(piece, kind, ref, tokens): the visitor's branches."""
    kind = F.coalesce(part["type"], F.lit("text"))
    attached = kind.isin("image", "audio", "document")
    tokens = F.when(kind == "image", _patches(part["width"]) * _patches(part["height"])) \
        .when(kind == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES_A_SECOND).cast("bigint")) \
        .when(kind == "document", F.coalesce(part["pages"], F.lit(0)).cast("bigint") * TOKENS_A_PAGE) \
        .otherwise(F.lit(0).cast("bigint"))
    return F.struct(
        F.when(attached, F.concat(F.lit("<"), kind, F.lit(">"))).otherwise(escape(part["text"])).alias("piece"),
        F.when(attached, kind).alias("kind"),
        F.when(attached, F.coalesce(part["ref"], F.lit(""))).alias("ref"), tokens.alias("tokens"))


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 parts: Column | None = None, text_col: str = "text") -> DataFrame:
    """One row per conversation: conv, formatted, loss (array of (start, end) spans),
    attachments (array of (turn, ordinal, kind, ref, tokens), ordered), expanded_tokens.

    ``parts`` is the column of content parts (``PART_TYPE`` list); by default the
    text column is taken as one text part.
    """
    parts = text_parts(quoted(text_col)) if parts is None else F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>"))
    t = turns.select(quoted(conv_col).alias("conv"), quoted(turn_col).alias("turn"), quoted(role_col).alias("role"),
                     F.transform(parts, visit).alias("seen"))
    t = t.select("conv", "turn", "role", F.array_join(F.transform("seen", lambda x: x["piece"]), "").alias("body"),
                 F.filter("seen", lambda x: x["kind"].isNotNull()).alias("files"))
    t = t.select("conv", "turn", "role", "body", "files",
                 F.concat(F.lit("<turn:"), escape(F.col("role")), F.lit(">")).alias("head"))
    t = t.withColumn("piece", F.concat("head", "body", F.lit(_END)))
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("body")]
    w = Window.partitionBy("conv").orderBy(*order)
    # the running length and the list are both by conversation: one exchange
    t = t.withColumn("at", F.row_number().over(w)) \
        .withColumn("stop", F.sum(F.char_length("piece").cast("bigint"))
                    .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    begin = F.col("stop") - F.char_length("piece") + F.char_length("head")
    span = F.when(F.col("role") == LOSS_ROLE, F.struct(
        begin.cast("bigint").alias("start"), (begin + F.char_length("body")).cast("bigint").alias("end")))
    g = t.withColumn("span", span).groupBy("conv").agg(F.array_sort(F.collect_list(
        F.struct("at", "turn", "piece", "span", "files"))).alias("all"))
    files = F.flatten(F.transform("all", lambda x: F.transform(
        x["files"], lambda f: F.struct(x["turn"].alias("turn"), f["kind"].alias("kind"), f["ref"].alias("ref"),
                                       f["tokens"].alias("tokens")))))
    files = F.transform(files, lambda f, i: F.struct(f["turn"].alias("turn"), i.alias("ordinal"), f["kind"].alias("kind"),
                                                     f["ref"].alias("ref"), f["tokens"].alias("tokens")))
    return g.select(
        "conv", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"),
        F.filter(F.transform("all", lambda x: x["span"]), lambda s: s.isNotNull()).alias("loss"),
        files.alias("attachments")) \
        .withColumn("expanded_tokens", F.aggregate("attachments", F.lit(0).cast("bigint"),
                                                   lambda acc, f: acc + f["tokens"]))


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of struct(role, text); attachments
    stay in the text as their placeholders."""
    turns = F.filter(F.split(formatted, _END), lambda t: t != "")
    role = lambda t: F.substring_index(t, ">", 1)  # noqa: E731  "<turn:" and the role
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring(role(t), F.lit(7), F.char_length(t))).alias("role"),
        unescape(F.substring(t, F.char_length(role(t)) + 2, F.char_length(t))).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """The unescaped text under the loss mask, spans in order with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
