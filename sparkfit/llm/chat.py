"""Multi-party perspective rotation of conversations.

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and the others as named users; the loss mask covers
what the assistant says and its end mark. Context roles (the system prompt)
are rendered as they are, never masked in, and are nobody's perspective.

The rendering is in long form, one row per (conversation, perspective, turn) in
turn order, so a conversation of any length stays spread over the cluster and
no dialogue is collected into one task: the sample of a perspective is the
concatenation of its rows. ``assemble`` does that for windows of turns, and
``dialogues`` for windows of messages: those of a conversation are numbered by
ranges of (conversation, turn), so a part holds ``WINDOW_TURNS`` messages at most,
however many of them share a turn number, and parts of a long conversation lie in
many tasks. The parts of a perspective one after the other are its dialogue.

Nothing that is said can forge a turn: in texts every ``<|`` becomes ``<\\|``, so
that no mark begins there, and in names control characters, blanks and ``< > |``
become ``_``, so that a header is one line. Masks cover the texts as rendered.

Results for special inputs: a null text is an empty message, marked as such; a
null role is a participant named ``unknown``; a null turn comes first; a null
conversation is a conversation of its own; repeated rows are each rendered; a
conversation of context roles only has no perspective and so no rows; messages of
one turn are ordered by speaker, then by the md5 of their text; a text of any length
is rendered whole; an empty table gives an empty result; other columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfit.operators.keys import row_positions
from sparkfit.session import write_table

CONTEXT_ROLES = ("system",)
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
NOBODY = "unknown"
WINDOW_TURNS = 64
NOT_IN_NAMES = r"[\x00-\x20\x7F<>|]"


def safe_text(text: Column) -> Column:
    """The text without the beginning of a mark."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def safe_name(name: Column) -> Column:
    """The name as one word of a header."""
    return F.regexp_replace(name, NOT_IN_NAMES, "_")


def _header(speaker: Column, perspective: Column, context_roles: tuple[str, ...]) -> tuple[Column, Column, Column]:
    """Whether the speaker is the perspective, the rendered role, and the header."""
    own = speaker == perspective
    role = F.when(own, F.lit("assistant")).when(speaker.isin(*context_roles), speaker).otherwise(F.lit("user"))
    name = F.when(role == "user", F.concat(F.lit(" name="), safe_name(speaker))).otherwise(F.lit(""))
    return own, role, F.concat(F.lit(OPEN), role, name, F.lit("\n"))


def _people(said: DataFrame, context_roles: tuple[str, ...]) -> DataFrame:
    """(of, perspective): the participants of each conversation. Written, so that
    Spark can split the partitions of a join with a long conversation."""
    return write_table(said.where(~F.col("speaker").isin(*context_roles))
                       .select(F.col("conv").alias("of"), F.col("speaker").alias("perspective")).distinct(),
                       "chat-people")


def _joined(rows: Column) -> tuple[Column, Column]:
    """The text of (rendered, mask_start, mask_end) rows one after the other, and
    the ranges of it that they cover."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("masks"))
    folded = F.aggregate(rows, state, lambda s, r: F.struct(
        (s["at"] + F.char_length(r["rendered"])).alias("at"),
        F.when(r["mask_end"] > r["mask_start"], F.concat(s["masks"], F.array(F.struct(
            (s["at"] + r["mask_start"]).alias("start"), (s["at"] + r["mask_end"]).alias("end")))))
        .otherwise(s["masks"]).alias("masks")))
    return F.array_join(F.transform(rows, lambda r: r["rendered"]), ""), folded["masks"]


def numbered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, place, role, text): the messages with their places in their
    conversation, from 0."""
    # Written, so that a message keeps its number; what is ranged has no texts.
    said = write_table(conversations.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.col(role_col).alias("role"), F.col(text_col).alias("text")), "chat-messages")
    keys = said.select("conv", "turn", F.coalesce("role", F.lit(NOBODY)).alias("speaker"),
                       F.md5(safe_text(F.coalesce("text", F.lit("")))).alias("digest"), "row_no")
    placed = row_positions(keys, [F.col(c).asc_nulls_first() for c in ("conv", "turn", "speaker", "digest")], "at")
    firsts = placed.groupBy("conv").agg(F.min("at").alias("first")).withColumnRenamed("conv", "own")
    places = placed.join(firsts, F.col("conv").eqNullSafe(F.col("own"))) \
        .select("row_no", (F.col("at") - F.col("first")).alias("place"))
    return said.join(places, "row_no").select(F.col("conv").alias(conv_col), "place", F.col("role").alias(role_col),
                                              F.col("text").alias(text_col))


def rotate(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", context_roles: tuple[str, ...] = CONTEXT_ROLES) -> DataFrame:
    """(conv, perspective, turn, speaker, role, rendered, mask_start, mask_end).

    ``mask_start`` and ``mask_end`` are the code points of ``rendered`` that the
    loss covers: the text and the end mark where the speaker is the
    perspective, an empty range elsewhere."""
    said = conversations.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit(NOBODY)).alias("speaker"), safe_text(F.coalesce(text_col, F.lit(""))).alias("said"))
    people = _people(said, context_roles)
    seen = said.join(people, F.col("conv").eqNullSafe(F.col("of"))).drop("of")
    own, role, head = _header(F.col("speaker"), F.col("perspective"), context_roles)
    start = F.char_length("head").cast("bigint")
    return seen.withColumn("role", role).withColumn("head", head).select(
        F.col("conv").alias(conv_col), "perspective", F.col("turn").alias(turn_col), "speaker", "role",
        F.concat("head", "said", F.lit(CLOSE)).alias("rendered"), start.alias("mask_start"),
        F.when(own, start + F.char_length("said") + F.lit(len(CLOSE))).otherwise(start).alias("mask_end"))


def assemble(rotated: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
             window: int = WINDOW_TURNS) -> DataFrame:
    """(conv, perspective, part, n_turns, dialogue, masks): the rows of ``window``
    turn numbers joined in turn order (ties by text), and the covered ranges of the
    joined text as an array of (start, end). A part holds at most as many rows
    as there are messages with ``window`` turn numbers."""
    rows = F.sort_array(F.collect_list(F.struct(turn_col, "rendered", "mask_start", "mask_end")))
    parts = rotated.groupBy(conv_col, "perspective", F.floor(F.col(turn_col) / window).alias("part")) \
        .agg(rows.alias("rows"))
    dialogue, masks = _joined(F.col("rows"))
    return parts.select(conv_col, "perspective", "part", F.size("rows").cast("bigint").alias("n_turns"),
                        dialogue.alias("dialogue"), masks.alias("masks"))


def dialogues(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", context_roles: tuple[str, ...] = CONTEXT_ROLES,
              window: int = WINDOW_TURNS) -> DataFrame:
    """What ``assemble`` gives, in parts of ``window`` messages. Messages are
    gathered once, by (conversation, part), and rendered for each perspective in
    the row, so what is shuffled doesn't grow with the number of participants."""
    messages = numbered(conversations, conv_col, turn_col, role_col, text_col)
    said = messages.select(F.col(conv_col).alias("conv"), "place", F.coalesce(role_col, F.lit(NOBODY)).alias("speaker"),
                           safe_text(F.coalesce(text_col, F.lit(""))).alias("said"))
    people = _people(conversations.select(F.col(conv_col).alias("conv"),
                                          F.coalesce(role_col, F.lit(NOBODY)).alias("speaker")), context_roles)
    parts = said.groupBy("conv", F.floor(F.col("place") / window).alias("part")) \
        .agg(F.sort_array(F.collect_list(F.struct("place", "speaker", "said"))).alias("messages"))
    seen = parts.join(people, F.col("conv").eqNullSafe(F.col("of")))

    def render(m: Column) -> Column:
        own, _, head = _header(m["speaker"], F.col("perspective"), context_roles)
        start = F.char_length(head).cast("bigint")
        end = F.when(own, start + F.char_length(m["said"]) + F.lit(len(CLOSE))).otherwise(start)
        return F.struct(F.concat(head, m["said"], F.lit(CLOSE)).alias("rendered"), start.alias("mask_start"),
                        end.alias("mask_end"))

    dialogue, masks = _joined(F.col("rows"))
    return seen.withColumn("rows", F.transform("messages", render)).select(
        F.col("conv").alias(conv_col), "perspective", "part", F.size("rows").cast("bigint").alias("n_turns"),
        dialogue.alias("dialogue"), masks.alias("masks"))
