"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every turn of the assistant becomes an example of its own: all turns before it are the context, and only
its text is trained on. A turn reads ``### role: text</turn>`` and a line feed. If a conversation does not
end with the assistant, one example without a target holds it whole, so that the examples of a conversation
always hold all its turns and the last one can be read back to the conversation.

Texts and roles are escaped so that no control string occurs in them: a backslash becomes ``\\b``, then
``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\e``, and in roles the colon that ends them ``\\c``. As every
backslash of an escaped text begins an escape, undoing the replacements in reverse gives the text back.

Turns are brought together by conversation once; examples are generated from there without another
shuffle. The output repeats the context of every example, which is the square of the turns of a conversation;
rows are generated one at a time, and a conversation has to fit one row, as its last example is one.

Defined results: a null text is an empty one, a null role an empty role; turns are ordered by turn (null
first), then role, then text (null as empty); repeated rows are turns of their own; rows without a
conversation id form one conversation without an id; a conversation without assistant has one example without
a target (loss_start and loss_end null); texts of any length stay whole; other columns are left out;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLE, END, ASSISTANT = "### ", "</turn>", "assistant"
_STOP = END + "\n"
_TEXT_ESCAPES = (("\\", "\\b"), ("###", "\\h"), (END, "\\e"))
_ROLE_ESCAPES = _TEXT_ESCAPES + ((":", "\\c"),)


def _replaced(text: Column, pairs) -> Column:
    for one, other in pairs:
        text = F.replace(text, F.lit(one), F.lit(other))
    return text


def escaped(text: Column) -> Column:
    """``text`` without any control string of the template."""
    return _replaced(text, _TEXT_ESCAPES)


def unescaped(text: Column) -> Column:
    """What :func:`escaped` was given."""
    return _replaced(text, [(b, a) for a, b in reversed(_TEXT_ESCAPES)])


def _formatted(turn: Column) -> Column:
    """A turn as it reads in an example, the code points of its escaped text, and whether it is trained on."""
    head = F.concat(F.lit(ROLE), _replaced(turn.role, _ROLE_ESCAPES), F.lit(": "))
    return F.struct(
        F.concat(head, escaped(turn.text), F.lit(_STOP)).alias("piece"),
        F.char_length(escaped(turn.text)).alias("chars"),
        (turn.role == ASSISTANT).alias("target"),
    )


def expand(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per example: key, example (number of its last turn), last, text, loss_start, loss_end.

    The mask covers the code points from ``loss_start`` (counted from 0) to before ``loss_end``.
    """
    said = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(f"`{role}`", F.lit("")).alias("role"),
        F.coalesce(f"`{text}`", F.lit("")).alias("text"),
    )
    whole = conversations.groupBy(F.col(f"`{key}`").alias("conv")).agg(F.sort_array(F.collect_list(said)).alias("said"))
    turns = whole.select("conv", F.transform("said", _formatted).alias("turns"))
    number = F.size("turns")
    ends = F.filter(F.sequence(F.lit(1), number), lambda i: F.get("turns", i - 1).target | (i == number))
    each = turns.select("conv", "turns", F.explode(ends).alias("example"))
    final = F.get("turns", F.col("example") - 1)
    examples = each.select(
        "conv",
        "example",
        (F.col("example") == number).alias("last"),
        F.array_join(F.slice("turns", F.lit(1), F.col("example")).piece, "").alias("text"),
        F.when(final.target, final.chars).alias("chars"),
    )
    end = F.char_length("text") - len(_STOP)
    return examples.select(
        F.col("conv").alias(key),
        "example",
        "last",
        "text",
        F.when(F.col("chars").isNotNull(), end - F.col("chars")).alias("loss_start"),
        F.when(F.col("chars").isNotNull(), end).alias("loss_end"),
    )


def trained_text(text: str = "text", start: str = "loss_start", end: str = "loss_end") -> Column:
    """The unescaped text under the mask of an example; null without a target."""
    masked = F.substring(F.col(f"`{text}`"), F.col(f"`{start}`") + 1, F.col(f"`{end}`") - F.col(f"`{start}`"))
    return unescaped(masked)


def turns_of(text: str = "text") -> Column:
    """The turns (role, text) that an example holds, read back from its text."""
    pieces = F.split(F.col(f"`{text}`"), F.lit(_STOP))
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # nothing follows the last end mark

    def read(piece: Column) -> Column:
        colon = F.instr(piece, ":")
        head = F.substring(piece, F.lit(len(ROLE) + 1), colon - len(ROLE) - 1)
        body = F.substring(piece, colon + 2, F.char_length(piece))
        name = _replaced(head, [(b, a) for a, b in reversed(_ROLE_ESCAPES)])
        return F.struct(name.alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, read)


def digests(examples: DataFrame, key: str = "conv_id") -> DataFrame:
    """Per conversation, all read back from its examples: turns, their digest, and the trained text."""
    line = lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))
    read = examples.select(
        F.col(f"`{key}`").alias("conv"),
        "example",
        F.char_length("text").cast("long").alias("chars"),
        trained_text().alias("loss"),
        F.when(F.col("last"), turns_of()).alias("turns"),
    )
    each = read.select(
        "conv", "example", "chars", "loss",
        F.array_size("turns").cast("long").alias("number"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("digest"),
    )
    whole = each.groupBy("conv").agg(
        F.max("number").alias("n_turns"),
        F.max("digest").alias("turns_sha256"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join("losses.loss", "")
    return whole.select(
        F.col("conv").alias(key),
        "n_turns",
        "turns_sha256",
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
