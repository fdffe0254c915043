r"""Chat formatting: conversations of typed content parts become one text each, with a loss mask and a list of attachments.

A message has parts of a kind: text, image, audio, document. A visitor turns each part into what stands in the text: a text as
it is, escaped, others as a placeholder, whose reference and number of expanded tokens are recorded in the order in which they stand. A turn is
written

    <|turn|>role
    content<|end|>

Control strings inside texts (those of this template and the usual ones of others: `<|...|>`, `<s>`, `</s>`, `[INST]`, `[/INST]`, `<nl>`) get a
backslash after their first character, one more if they have some already. No control string holds `<` or `[` after its
first character, so matches can't overlap, none can begin in a text and end in the template, and one backslash less gives the text back. A line
end in a role is written `<nl>`.

All is DataFrame functions, without Python on the executors: parts are rows, places in the formatted text are a running sum
over the rows of a conversation, and one aggregation by conversation joins them (it is partitioned as the sum was, so rows are shuffled
once). The text of a conversation is one value, so one conversation must fit a task's memory.

Nulls: a null text or part list is an empty turn, a null part an empty text, a null role an empty role; a null conv_id is a conversation of its
own; null turns come first. Ties: rows of one turn are turns each, by role, then parts; rows that are equal are turns each. A part of unknown
(or null) kind has the placeholder `<|other|>` and no tokens. Missing or negative sizes count 0. Long texts: linear. An empty table gives no
rows; further columns are ignored, whatever they are called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import narrow

PARTS = "array<struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>>"
TURN, END, BREAK = "<|turn|>", "<|end|>", "<nl>"

# Control strings without their first character, which stands before the colon here: < : |...|> s> /s> nl>   [ : INST] /INST]
AFTER_ANGLE, AFTER_SQUARE = r"\\*(?:\|[^<|\[\\]*\|>|/?s>|nl>)", r"\\*/?INST\]"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, f"<(?={AFTER_ANGLE})|\\[(?={AFTER_SQUARE})", r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, f"(<)\\\\(?={AFTER_ANGLE})|(\\[)\\\\(?={AFTER_SQUARE})", "$1$2")


class Visitor:
    """What each kind of part becomes: the number of tokens that its placeholder expands to. Other rules: a subclass."""

    #: Pixels of an image patch's side, tokens of a second of audio and of a page.
    patch, per_second, per_page = 28, 25, 1024

    def text(self, part: Column) -> Column:
        return escaped(F.coalesce(part["text"], F.lit("")))

    def image(self, part: Column) -> Column:
        side = lambda n: F.ceil(F.greatest(F.coalesce(part[n], F.lit(0)), F.lit(0)) / self.patch)
        return side("width") * side("height")

    def audio(self, part: Column) -> Column:
        return F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0)) * self.per_second)

    def document(self, part: Column) -> Column:
        return F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)).cast("long") * self.per_page

    def visit(self, part: Column) -> tuple[Column, Column, Column]:
        """Kind, what stands in the text, and expanded tokens (null for a text)."""
        known = ["image", "audio", "document"]
        kind = F.when(part.isNull() | (part["kind"] == "text"), "text").when(part["kind"].isin(known), part["kind"]).otherwise("other")
        body = F.when(kind == "text", F.coalesce(self.text(part), F.lit(""))).otherwise(F.concat(F.lit("<|"), kind, F.lit("|>")))
        tokens = F.when(kind == "text", F.lit(None).cast("long"))
        for k in known:
            tokens = tokens.when(kind == k, getattr(self, k)(part).cast("long"))
        return kind, body, tokens.otherwise(F.lit(0).cast("long"))


def text_parts(text: Column) -> Column:
    """The part list of a message that is one text."""
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return F.array(F.struct(F.lit("text").alias("kind"), text.alias("text"), none("string", "ref"), none("int", "width"), none("int", "height"), none("double", "seconds"), none("int", "pages")))


def formatted(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", parts_col: str = "parts", learn: tuple[str, ...] = ("assistant",), visitor: Visitor | None = None) -> DataFrame:
    """conv_id, formatted, loss, attachments, attachment_tokens: a row for each conversation.

    loss: spans (turn_no, at, within, chars) of the texts of the roles in `learn`; attachments: (number, turn_no, kind, ref, at, tokens). Places
    are code points from 0: `at` in the formatted text, `within` from the end of the turn's marker.
    """
    rows = narrow(messages, conv=conv_col, turn=turn_col, role=role_col, parts=parts_col)
    rows = rows.select("conv", "turn", F.coalesce("role", F.lit("")).alias("role"), F.col("parts").cast(PARTS).alias("parts"))
    turns = rows.withColumn("turn_no", F.row_number().over(Window.partitionBy("conv").orderBy("turn", "role", "parts")))
    each = turns.select("conv", "turn_no", "role", F.greatest(F.size(F.coalesce("parts", F.array().cast(PARTS))), F.lit(1)).alias("of"), F.posexplode_outer("parts").alias("pos", "part"))
    pos = F.coalesce("pos", F.lit(0))
    kind, body, tokens = (visitor or Visitor()).visit(F.col("part"))
    head = F.when(pos == 0, F.concat(F.lit(TURN), F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(BREAK)), F.lit("\n"))).otherwise("")
    foot = F.when(pos == F.col("of") - 1, F.lit(END + "\n")).otherwise("")
    pieces = each.select("conv", "turn_no", pos.alias("pos"), head.alias("head"), body.alias("body"), foot.alias("foot"), kind.alias("kind"), tokens.alias("tokens"), F.col("part.ref").alias("ref"), F.col("role").isin(*learn).alias("learned"))
    pieces = pieces.withColumn("before", F.length("head").cast("long")).withColumn("chars", F.length("body").cast("long"))
    size = F.col("before") + F.col("chars") + F.length("foot")
    so_far = lambda *keys: F.sum(size).over(Window.partitionBy("conv", *keys).orderBy("turn_no", "pos").rowsBetween(Window.unboundedPreceding, 0)) - size + F.col("before")
    placed = pieces.withColumn("at", so_far()).withColumn("within", so_far("turn_no") - len(TURN))
    keep = ["turn_no", "pos", "at", "within", "chars", "kind", "tokens", "ref", "learned"]
    whole = placed.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct(*keep, F.concat("head", "body", "foot").alias("piece")))).alias("p"))
    spans = F.transform(F.filter("p", lambda x: x["learned"] & (x["kind"] == "text")), lambda x: F.struct(x["turn_no"].alias("turn_no"), x["at"].alias("at"), x["within"].alias("within"), x["chars"].alias("chars")))
    others = F.transform(F.filter("p", lambda x: x["kind"] != "text"), lambda x, i: F.struct((i + 1).alias("number"), x["turn_no"].alias("turn_no"), x["kind"].alias("kind"), x["ref"].alias("ref"), x["at"].alias("at"), x["tokens"].alias("tokens")))
    out = whole.select(F.col("conv").alias("conv_id"), F.array_join(F.transform("p", lambda x: x["piece"]), "").alias("formatted"), spans.alias("loss"), others.alias("attachments"))
    return out.withColumn("attachment_tokens", F.aggregate("attachments", F.lit(0).cast("long"), lambda n, x: n + x["tokens"]))


def _segments() -> Column:
    """The turns of a formatted text, each without its marker."""
    return F.filter(F.split("formatted", TURN.replace("|", r"\|"), -1), lambda s: s != "")


def read_back(chats: DataFrame) -> DataFrame:
    """The columns of formatted() and turns, an array of (role, text), of which text still has the placeholders of other parts; learned:
    the text under the loss mask, unescaped."""

    def turn(s: Column) -> Column:
        role = F.substring_index(s, "\n", 1)
        content = F.substring(s, F.length(role) + 2, F.length(s) - F.length(role) - 1 - len(END + "\n"))
        return F.struct(unescaped(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"), unescaped(content).alias("text"))

    under = F.transform("loss", lambda x: unescaped(F.substring(F.get("segments", x["turn_no"] - 1), x["within"].cast("int") + 1, x["chars"].cast("int"))))
    parsed = chats.withColumn("segments", _segments())
    return parsed.withColumn("turns", F.transform("segments", turn)).withColumn("learned", F.array_join(under, "")).drop("segments")


def digests(chats: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, all but the last of what is read back."""
    back = read_back(chats)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    long = lambda c: c.cast("long")
    return back.select("conv_id", long(F.size("turns")).alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"), long(F.length("learned")).alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), long(F.length("formatted")).alias("formatted_chars"))
