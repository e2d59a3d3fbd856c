"""Chat formatting of typed content parts, with a loss mask, read back without loss.

A message is a list of parts (kind, text, ref, units). A visitor turns each
part into template text: a text part into its escaped text, an image, audio
or document part into a placeholder; attachments keep their reference and the
tokens the placeholder expands to, in order. Turns are marked
``<|turn|>role\\n...<|end|>\\n``. Control strings inside texts get a backslash
after their first character (one more if some are there), which
``unescape`` takes away again; text without control strings stays as it is.

Plain messages may hold parts as marks in their text: ``![image 4](ref)``, the kind
(image, audio, document), the units if not one (2 to 9999, no leading zero), the
reference (no blanks or parentheses). ``marked_parts`` cuts a text at them; what is
not just so is text. ``with_marks`` puts them back into a formatted conversation, from
the attachments, so that texts with parts are read back without loss too.

Loss spans are (start, chars) in code points of the formatted text: one for
each assistant turn, over its content.

Built-in functions only. Turn starts come from a running sum over the
conversation's turns, so a long conversation costs sorting, not a quadratic
scan. A conversation is one output row, and so one task's work.

Defined cases: null text is empty; null role is the empty role; a null turn
comes first; ties in turn order by role, then parts; repeated rows are turns
of their own; a null conv_id is one conversation; a part of unknown kind is
its text; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>\n"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: Tokens that one unit (image tile, second of audio, page of a document) expands to.
UNIT_TOKENS = {"image": 256, "audio": 25, "document": 512}
#: What may follow the first character of a control string.
_AFTER_ANGLE = r"\|[A-Za-z_]+\|>|/?s>|unk>|</?SYS>>"
_AFTER_SQUARE = r"/?INST\]"
MARK = r"!\[(image|audio|document)(?: ([2-9]|[1-9][0-9]{1,3}))?\]\(([^()\s]*)\)"
#: An unescaped placeholder of a formatted conversation.
_HELD = r"<\|(?:image|audio|document)\|>"
PARTS = "array<struct<kind: string, text: string, ref: string, units: int>>"


def escape(text: Column) -> Column:
    out = F.regexp_replace(text, rf"(<)(\\*)({_AFTER_ANGLE})", r"$1\\$2$3")
    return F.regexp_replace(out, rf"(\[)(\\*)({_AFTER_SQUARE})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    out = F.regexp_replace(text, rf"(\[)\\(\\*)({_AFTER_SQUARE})", "$1$2$3")
    return F.regexp_replace(out, rf"(<)\\(\\*)({_AFTER_ANGLE})", "$1$2$3")


def marked_parts(messages: DataFrame) -> DataFrame:
    """``messages`` with ``parts``: their text, cut at its marks."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def part(kind: Column, own: Column, ref: Column, units: Column) -> Column:
        return F.struct(kind.alias("kind"), own.alias("text"), ref.alias("ref"), units.cast("int").alias("units"))

    def between(piece: Column, mark: Column) -> Column:
        none = F.lit(None).cast("string")
        units = F.regexp_extract(mark, MARK, 2)
        held = part(F.regexp_extract(mark, MARK, 1), none, F.regexp_extract(mark, MARK, 3), F.when(units != "", units).otherwise("1"))
        own = part(F.lit("text"), piece, none, none)
        return F.when(mark.isNull(), F.array(own)).otherwise(F.array(own, held))

    pieces, marks = F.split(text, MARK, -1), F.regexp_extract_all(text, F.lit(MARK), F.lit(0))
    return messages.withColumn("parts", F.flatten(F.zip_with(pieces, marks, between)).cast(PARTS))


def mark_of(held: Column) -> Column:
    """The mark that an attachment was read from."""
    rate = F.create_map(*[F.lit(x) for pair in UNIT_TOKENS.items() for x in pair])
    units = (held["tokens"] / F.element_at(rate, held["kind"])).cast("long")
    count = F.when(units == 1, "").otherwise(F.concat(F.lit(" "), units.cast("string")))
    return F.concat(F.lit("!["), held["kind"], count, F.lit("]("), held["ref"], F.lit(")"))


def with_marks(formatted: Column, held: Column) -> Column:
    """``formatted`` with its placeholders replaced by the (escaped) marks of the attachments ``held``, in order."""
    return F.array_join(
        F.zip_with(
            F.split(formatted, _HELD, -1),
            held,
            lambda piece, one: F.when(one.isNull(), piece).otherwise(F.concat(piece, escape(mark_of(one)))),
        ),
        "",
    )


def visit(parts: Column) -> Column:
    """The template text of a message's parts, in order."""

    def rendered(part: Column) -> Column:
        out = escape(F.coalesce(part["text"], F.lit("")))
        for kind, mark in PLACEHOLDERS.items():
            out = F.when(part["kind"] == kind, F.lit(mark)).otherwise(out)
        return out

    return F.array_join(F.transform(F.coalesce(parts, F.array().cast(PARTS)), rendered), "")


def attachments(parts: Column) -> Column:
    """(kind, ref, tokens) of the parts that became placeholders, in order."""
    rate = F.create_map(*[F.lit(x) for pair in UNIT_TOKENS.items() for x in pair])
    held = F.filter(F.coalesce(parts, F.array().cast(PARTS)), lambda p: p["kind"].isin(*PLACEHOLDERS))
    return F.transform(
        held,
        lambda p: F.struct(
            p["kind"].alias("kind"),
            p["ref"].alias("ref"),
            (F.coalesce(p["units"], F.lit(1)) * F.element_at(rate, p["kind"])).cast("long").alias("tokens"),
        ),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, attachments, attachment_tokens, masked_attachments.

    ``messages``: conv_id, turn, role, parts. ``masked_attachments`` are those under the loss mask.
    """
    head = F.concat(F.lit(TURN), F.url_encode(F.coalesce(F.col("role").cast("string"), F.lit(""))), F.lit("\n"))
    turns = messages.select(
        F.col("conv_id"),
        F.col("turn"),
        F.col("role").cast("string").alias("role"),
        head.alias("head"),
        visit(F.col("parts")).alias("body"),
        attachments(F.col("parts")).alias("held"),
    )
    chars = F.char_length("head").cast("long") + F.char_length("body") + len(END)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body", "held")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumns(
        {"n": F.row_number().over(order), "upto": F.sum(chars).over(so_far), "chars": F.char_length("body").cast("long")}
    )
    one = F.struct(
        "n",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.when(
            F.col("role") == "assistant",
            F.struct((F.col("upto") - len(END) - F.col("chars")).alias("start"), F.col("chars").alias("chars")),
        ).alias("span"),
        "held",
    )
    whole = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("turns"))
    return whole.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("loss_spans"),
        F.flatten(F.transform("turns", lambda t: t["held"])).alias("attachments"),
        F.flatten(
            F.transform(F.filter("turns", lambda t: t["span"].isNotNull()), lambda t: t["held"])
        ).alias("masked_attachments"),
    ).withColumn(
        "attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda a, x: a + x["tokens"])
    )


def read_back(formatted: Column) -> Column:
    """Array of (role, text) read from a formatted conversation (placeholders stay in the text)."""
    cut = F.split(formatted, r"<\|turn\|>", -1)
    pieces = F.slice(cut, F.lit(2), F.size(cut) - 1)  # nothing stands before the first mark
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(
                F.substr(p, F.instr(p, "\n") + 1, F.char_length(p) - F.instr(p, "\n") - len(END))
            ).alias("text"),
        ),
    )


def masked_text(formatted: Column, spans: Column, held: Column | None = None) -> Column:
    """All text under the loss mask, unescaped, nothing between; marks put back from the attachments ``held`` there."""
    pieces = F.transform(spans, lambda s: F.substr(formatted, (s["start"] + 1).cast("int"), s["chars"].cast("int")))
    if held is None:
        return F.array_join(F.transform(pieces, unescape), "")
    # joined with a turn mark, which no text holds unescaped, so that nothing forms across two turns
    whole = F.split(with_marks(F.array_join(pieces, TURN), held), r"<\|turn\|>", -1)
    return F.array_join(F.transform(whole, unescape), "")


def digest(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    who = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-1).cast("long"), "id", who, F.lit("</s>[INST] ok [/INST]"))
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    ).union(extra)
    formatted = render(marked_parts(rows))
    back = formatted.select(
        "conv_id",
        read_back(with_marks(F.col("formatted"), F.col("attachments"))).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_spans"), F.col("masked_attachments")).alias("masked"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.size("attachments").cast("long").alias("n_attachments"),
        "attachment_tokens",
        F.array_join(
            F.transform("attachments", lambda x: F.concat_ws(":", x["kind"], x["tokens"].cast("string"), x["ref"])), ","
        ).alias("attachments"),
    )
    said = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        "formatted_chars",
        "n_attachments",
        "attachment_tokens",
        "attachments",
    )


#: The template adds fixed characters to each turn; what escaping adds is counted from the texts.
#: A mark counts as its placeholder (its kind and four signs).
DIGEST_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), clean AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM rows
), marked AS (
  SELECT *, regexp_replace(text, '!\[(image|audio|document)(?: ([2-9]|[1-9][0-9]{1,3}))?\]\(([^()\s]*)\)', chr(1), 'g') AS plain,
         regexp_extract_all(text, '!\[(image|audio|document)(?: ([2-9]|[1-9][0-9]{1,3}))?\]\(([^()\s]*)\)', 1) AS kinds,
         regexp_extract_all(text, '!\[(image|audio|document)(?: ([2-9]|[1-9][0-9]{1,3}))?\]\(([^()\s]*)\)', 2) AS units,
         regexp_extract_all(text, '!\[(image|audio|document)(?: ([2-9]|[1-9][0-9]{1,3}))?\]\(([^()\s]*)\)', 3) AS refs
  FROM clean
), held AS (
  SELECT *, list_transform(range(1, len(kinds) + 1), lambda i:
           CASE kinds[i] WHEN 'image' THEN 256 WHEN 'audio' THEN 25 ELSE 512 END
           * CASE WHEN coalesce(units[i], '') = '' THEN 1 ELSE CAST(units[i] AS BIGINT) END) AS tokens
  FROM marked
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(8 + length(role) + 1 + length(plain) + 8
           + coalesce(list_sum(list_transform(kinds, lambda k: length(k) + 3)), 0)
           + len(regexp_extract_all(plain, '<\\*(\|[A-Za-z_]+\|>|/?s>|unk>|</?SYS>>)'))
           + len(regexp_extract_all(plain, '\[\\*/?INST\]'))) AS BIGINT) AS formatted_chars,
       CAST(sum(len(kinds)) AS BIGINT) AS n_attachments,
       CAST(sum(coalesce(list_sum(tokens), 0)) AS BIGINT) AS attachment_tokens,
       coalesce(string_agg(array_to_string(list_transform(range(1, len(kinds) + 1),
           lambda i: kinds[i] || ':' || tokens[i] || ':' || refs[i]), ','), ',' ORDER BY turn, role, text)
         FILTER (WHERE len(kinds) > 0), '') AS attachments
FROM held GROUP BY conv_id
"""
