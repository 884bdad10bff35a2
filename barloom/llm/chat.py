"""Chat formatting with a grammar round trip, in DataFrame operations only.

Grammar::

    conversation = turn*
    turn         = "### " role ": " text " </turn>" "\\n"

The rendered text is parsed again: cut after each end of turn, the header split off at its first ": ". A
control string (### or </turn>) inside a text is an error, and a backslash stands before a character that is meant
literally. If the parsed turns are not those that were rendered, the turns that fail alone are
escaped, and if that is not enough all are. Roles are percent-encoded where they hold a sign of the grammar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, MIDDLE, END = "### ", ": ", " </turn>\n"
#: Signs of a role that are encoded; the percent sign is the first to be encoded and the last to be decoded.
ROLE_SIGNS = (("%", "%25"), (":", "%3A"), ("#", "%23"), ("<", "%3C"), ("\\", "%5C"))


def escape(text: Column) -> Column:
    """A text without control strings; ``unescape`` gives the text back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("#"), F.lit("\\#")), F.lit("</"), F.lit("<\\/"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def encode_role(role: Column) -> Column:
    for sign, code in ROLE_SIGNS:
        role = F.replace(role, F.lit(sign), F.lit(code))
    return role


def decode_role(role: Column) -> Column:
    for sign, code in reversed(ROLE_SIGNS):
        role = F.replace(role, F.lit(code), F.lit(sign))
    return role


def render_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), encode_role(role), F.lit(MIDDLE), text, F.lit(END))


def pieces(formatted: Column) -> Column:
    """The turns of a formatted conversation without their ends."""
    cut = F.split(formatted, "\\Q" + END + "\\E")
    return F.slice(cut, 1, F.size(cut) - 1)


def parse_turn(piece: Column) -> Column:
    """Role and escaped text of a turn without its end; nulls where it breaks the grammar."""
    at = F.locate(MIDDLE, piece)
    text = F.substring(piece, at + len(MIDDLE), F.length(piece))
    sound = piece.startswith(HEAD) & (at > 0) & ~text.contains("###") & ~text.contains("</turn>")
    role = decode_role(F.substring(piece, F.lit(len(HEAD) + 1), at - 1 - len(HEAD)))
    return F.struct(F.when(sound, role).alias("role"), F.when(sound, text).alias("text"))


def parse(formatted: Column) -> Column:
    """The turns (role and text) of a formatted conversation; it must end with an end of turn."""
    turns = F.transform(pieces(formatted), parse_turn)
    plain = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), unescape(t["text"]).alias("text")))
    return F.when((formatted == "") | formatted.endswith(END), plain)


def _same(formatted: Column, turns: Column) -> Column:
    """Whether a formatted conversation reads as these turns."""
    read = parse(formatted)
    pairs = F.zip_with(read, turns, lambda a, b: a["role"].eqNullSafe(b["role"]) & a["text"].eqNullSafe(b["text"]))
    return F.coalesce((F.size(read) == F.size(turns)) & F.forall(pairs, lambda x: x), F.lit(False))


def _render(turns: Column, text) -> Column:
    return F.concat_ws("", F.transform(turns, lambda t: render_turn(t["role"], text(t))))


def format_conversations(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation: its id, ``formatted``, ``level`` (0: nothing had to be escaped, 1: the turns that fail
    alone, 2: all) and ``identical``, whether it reads back as its turns.

    Turns go by number, null first, then by role and text. Null roles and texts are empty; the null id is a
    conversation of its own, and repeated rows are turns of their own. A conversation is one row.
    """
    turn = F.struct(F.col(f"`{turn_col}`").alias("turn"), F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    whole = conversations.groupBy(F.col(f"`{conv_col}`").alias("conv")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    alone = lambda t: _same(render_turn(t["role"], t["text"]), F.array(t))
    plain = whole.withColumn("plain", _render(F.col("turns"), lambda t: t["text"]))
    tried = plain.withColumn("fits", _same(F.col("plain"), F.col("turns")))
    some = _render(F.col("turns"), lambda t: F.when(alone(t), t["text"]).otherwise(escape(t["text"])))
    partly = tried.withColumn("partly", F.when(~F.col("fits"), some))
    fits = _same(F.col("partly"), F.col("turns"))
    level = F.when(F.col("fits"), 0).when(fits, 1).otherwise(2)
    done = partly.withColumn("level", level)
    every = _render(F.col("turns"), lambda t: escape(t["text"]))
    formatted = F.when(F.col("level") == 0, F.col("plain")).when(F.col("level") == 1, F.col("partly")).otherwise(every)
    out = done.select(F.col("conv").alias(conv_col), "turns", formatted.alias("formatted"), "level")
    return out.select(F.col(f"`{conv_col}`"), "formatted", "level", _same(F.col("formatted"), F.col("turns")).alias("identical"))


def loss_spans(formatted: Column, role: str = "assistant") -> Column:
    """The loss mask: spans (``start``, ``length``, in code points) of the escaped texts of this role's turns."""
    sized = F.transform(
        pieces(formatted),
        lambda p: F.struct(F.length(p).alias("n"), F.length(parse_turn(p)["text"]).alias("t"), parse_turn(p)["role"].alias("role")),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, x: Column) -> Column:
        span = F.struct((state["at"] + x["n"] - x["t"]).alias("start"), x["t"].alias("length"))
        spans = F.when(x["role"] == role, F.array_append(state["spans"], span)).otherwise(state["spans"])
        return F.struct((state["at"] + x["n"] + len(END)).alias("at"), spans.alias("spans"))

    return F.aggregate(sized, start, step)["spans"]


def masked_text(formatted: Column, spans: Column) -> Column:
    """The unescaped texts under a mask, one after the other."""
    return F.concat_ws("", F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"]))))
