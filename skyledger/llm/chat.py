"""Chat conversations as one marked string, with a mask of what is learned.

A conversation's turns hold typed parts. A visitor over the parts writes text escaped
and every other part as a placeholder, records the part as an attachment, and counts the
tokens that the placeholder will expand to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template.
START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"
PART = (
    "struct<type: string, text: string, uri: string, width: int, height: int, "
    "seconds: double, pages: int>"
)

#: Tokens of an attachment: image patches of 28 by 28 pixels, audio frames and pages.
PATCH, FRAMES_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 256


def escape(text: Column) -> Column:
    """``text`` without any control string: ``<|`` gets a backslash in between, one more
    than it had."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on the marker's line: no line break and no ``<`` in it."""
    for char, code in (("%", "%25"), ("\n", "%0A"), ("<", "%3C")):
        role = F.replace(role, F.lit(char), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for char, code in (("<", "%3C"), ("\n", "%0A"), ("%", "%25")):
        role = F.replace(role, F.lit(code), F.lit(char))
    return role


def part(kind: str, **values: Column) -> Column:
    """A part of a type; what is not given is null."""
    names = {
        "text": "string", "uri": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int",
    }
    filled = (values.get(name, F.lit(None)).cast(of).alias(name) for name, of in names.items())
    return F.struct(F.lit(kind).alias("type"), *filled).cast(PART)


def text_part(text: Column) -> Column:
    """A turn's only part: a text."""
    return F.array(part("text", text=text))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


#: A placeholder; an escaped text holds none.
_PLACEHOLDER = r"<\|[a-z0-9_]*\|>"


def _placeholder(part: Column) -> Column:
    kind = F.regexp_replace(F.lower(part["type"]), "[^a-z0-9_]", "_")
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def _body(parts: Column) -> Column:
    """What the visitor writes for the parts of a turn. Texts that follow each other are
    one, and escaped as one: a control string may begin in one part and end in the next."""
    state = lambda done, text: F.struct(done.alias("done"), text.alias("text"))
    return F.aggregate(
        parts,
        state(F.lit(""), F.lit("")),
        lambda a, part: F.when(
            _is_text(part), state(a["done"], F.concat(a["text"], F.coalesce(part["text"], F.lit(""))))
        ).otherwise(state(F.concat(a["done"], escape(a["text"]), _placeholder(part)), F.lit(""))),
        lambda a: F.concat(a["done"], escape(a["text"])),
    )


def _read_body(body: Column) -> Column:
    """The texts of a turn, unescaped, without its placeholders."""
    return F.array_join(F.transform(F.split(body, _PLACEHOLDER), unescape), "")


def _tokens(part: Column) -> Column:
    """Tokens that a placeholder expands to; at least one, also where sizes are missing."""
    side = lambda name: F.ceil(F.coalesce(part[name], F.lit(0)) / F.lit(PATCH))
    count = (
        F.when(part["type"] == "image", side("width") * side("height"))
        .when(part["type"] == "audio", F.ceil(F.coalesce(part["seconds"], F.lit(0.0)) * FRAMES_PER_SECOND))
        .when(part["type"] == "document", F.coalesce(part["pages"], F.lit(0)) * TOKENS_PER_PAGE)
        .otherwise(1)
    )
    return F.greatest(count.cast("long"), F.lit(1).cast("long"))


def _segments(turn: Column) -> Column:
    """Header, body and footer of a turn, each with whether it is learned."""
    piece = lambda text, learned: F.struct(text.alias("text"), learned.alias("learned"))
    return F.array(
        piece(F.concat(F.lit(START), escape_role(turn["role"]), F.lit("\n")), F.lit(False)),
        piece(_body(turn["parts"]), turn["role"] == LEARNED_ROLE),
        piece(F.lit(END), F.lit(False)),
    )


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", order: str = "turn", role: str = "role", parts: str = "parts"
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``mask``, ``attachments``.

    ``parts`` is an array of PART. ``mask`` has runs of (chars, learned) that add up to
    ``formatted``, three per turn; ``attachments`` has (type, uri, tokens) in the order
    of the placeholders. Turns come in order; equal ones by role, then by parts; repeated
    rows are turns of their own; a null number comes first. A null role, null parts, a
    null text are empty. Turns without a conversation are one of their own. Other
    columns are ignored. A conversation is one record and so in one task.
    """
    gathered = (
        turns.select(
            F.col(conversation),
            F.struct(
                F.col(order).alias("turn"),
                F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.filter(F.col(parts), lambda p: p.isNotNull()), F.array().cast(f"array<{PART}>")).alias("parts"),
            ).alias("entry"),
        )
        .groupBy(conversation)
        .agg(F.sort_array(F.collect_list("entry")).alias("turns"))
    )
    segments = gathered.withColumn("segments", F.flatten(F.transform("turns", _segments)))
    others = F.flatten(F.transform("turns", lambda t: F.filter(t["parts"], lambda p: ~_is_text(p))))
    return segments.select(
        conversation,
        F.array_join(F.col("segments.text"), "").alias("formatted"),
        F.transform(
            "segments", lambda s: F.struct(F.char_length(s["text"]).alias("chars"), s["learned"].alias("learned"))
        ).alias("mask"),
        F.transform(
            others, lambda p: F.struct(p["type"].alias("type"), p["uri"].alias("uri"), _tokens(p).alias("tokens"))
        ).alias("attachments"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) of every turn of a formatted conversation, unescaped. The text of a
    turn is that of its text parts; placeholders are left out.

    Escaped texts hold no marker and no placeholder, so splitting at both is exact.
    """
    marked = F.filter(F.split(formatted, f"\\Q{END}\\E"), lambda t: t != "")
    bare = F.transform(marked, lambda t: F.substring(t, len(START) + 1, F.length(t)))
    return F.transform(
        bare,
        lambda t: F.struct(
            unescape_role(F.substring_index(t, "\n", 1)).alias("role"),
            _read_body(F.substring(t, F.instr(t, "\n") + 1, F.length(t))).alias("text"),
        ),
    )


def read_learned(formatted: Column, mask: Column) -> Column:
    """The texts under the mask, unescaped and without placeholders, in order.

    Every turn has three runs; the learned one is cut out of its own turn by their
    lengths, so the work grows with the text and not with the square of it.
    """
    marked = F.split(formatted, f"\\Q{END}\\E")
    turns = F.sequence(F.lit(0), (F.size(mask) / 3).cast("int") - 1)
    learned = F.filter(turns, lambda k: F.get(mask, 3 * k + 1)["learned"])
    return F.transform(
        learned,
        lambda k: _read_body(
            F.substring(F.get(marked, k), F.get(mask, 3 * k)["chars"] + 1, F.get(mask, 3 * k + 1)["chars"])
        ),
    )
