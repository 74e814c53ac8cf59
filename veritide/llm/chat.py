"""Multi-party perspective rotation: a dialogue once for each participant, as the assistant.

For every speaker of a conversation the dialogue is rendered with that speaker's turns as the
assistant, the turns of the other speakers as users by name, and system turns as they are. A mask
marks what is learnt from: the assistant's turns.

A conversation is rendered in parts of ``TURNS_PER_PART`` turn numbers, in order, so that no row, task or
group grows with a conversation: a part is one row for each perspective, with the text, the spans of
its turns as characters from the piece's start, and the mask of each. Joined in the order of ``part``
and ``piece`` the parts are the whole dialogue. Turns that share a turn number are ordered by speaker
and text, in a part of any size; a piece holds ``TURNS_PER_PIECE`` turns of its part in that order, so only a
part with more of them (many rows of one turn number) has pieces beyond 0.

Only DataFrame functions run. Speakers are made distinct for each conversation with a combine before
the shuffle; texts are shuffled for the parts, and once more to meet the conversation's speakers. Turns of
crowded parts are counted by value, dealt by ranges of their order and numbered by sums along the ranges,
so one part that holds most rows, or one turn that repeats, is spread over all tasks.

Edge cases: null and blank speakers are ``unknown``; a null text is an empty turn; turns without a
number come last, in a part of their own; rows without a conversation id form one conversation with a
null id; a conversation of system turns only has no perspective and gives no row; repeated rows are
turns of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veritide.llm.common import col, settled

TURNS_PER_PART = 64
TURNS_PER_PIECE = 256
# Ranges of the crowded turns for each shuffle partition; more of them spread a hot part more evenly.
RANGES_PER_PARTITION = 4
# Crowded parts up to this number are broadcast; it changes the plan, not the rows.
BROADCAST_PARTS = 100_000
SYSTEM = "system"
#: How a turn is written.
OPEN, NAME, CLOSE = "<|im_start|>", " name=", "<|im_end|>"


def rotated(
    turns: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conversation``, ``assistant`` (the participant), ``part``, ``piece``, ``n_turns``, ``text``, and of
    each turn ``starts`` and ``stops`` (characters of its content) and ``mask`` (1: learnt from)."""
    named = F.trim(F.coalesce(col(speaker), F.lit("")))
    rows = turns.select(
        col(conversation).alias("conversation"),
        col(turn).cast("long").alias("turn"),
        F.when(named == "", "unknown").otherwise(named).alias("speaker"),
        F.coalesce(col(text), F.lit("")).alias("content"),
    ).withColumn("part", F.floor(F.col("turn") / TURNS_PER_PART))
    people = (
        rows.where(F.col("speaker") != SYSTEM)
        .select("conversation", F.col("speaker").alias("assistant"))
        .distinct()
    )
    gathered = _gathered(rows)
    same = F.col("g.conversation").eqNullSafe(F.col("p.conversation"))
    both = gathered.alias("g").join(people.alias("p"), same).select("g.*", "p.assistant")
    return _written(both)


def _gathered(rows: DataFrame) -> DataFrame:
    """``conversation``, ``part``, ``piece`` and ``turns`` in order."""
    turn = F.struct(F.col("turn").isNull().alias("last"), "turn", "speaker", "content")
    counts = rows.groupBy("conversation", "part").agg(F.count("*").alias("n"))
    crowded = settled(counts.where(F.col("n") > TURNS_PER_PIECE).select("conversation", "part"))
    found = crowded.count()
    if found <= BROADCAST_PARTS:
        crowded = F.broadcast(crowded)
    same = F.col("r.conversation").eqNullSafe(F.col("c.conversation"))
    same = same & F.col("r.part").eqNullSafe(F.col("c.part"))
    few = rows.alias("r").join(crowded.alias("c"), same, "left_anti") if found else rows
    whole = (
        few.withColumn("piece", F.lit(0).cast("long"))
        .groupBy("conversation", "part", "piece")
        .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    if not found:
        return whole
    many = _in_pieces(rows.alias("r").join(crowded.alias("c"), same, "left_semi"))
    held = F.sort_array(F.collect_list(F.struct(turn.alias("turn"), "copies")))
    cut = many.groupBy("conversation", "part", "piece").agg(held.alias("held"))
    turns = F.flatten(F.transform("held", lambda h: F.array_repeat(h["turn"], h["copies"])))
    return whole.unionAll(cut.select("conversation", "part", "piece", turns.alias("turns")))


def _in_pieces(rows: DataFrame) -> DataFrame:
    """The distinct rows of crowded parts, with ``piece`` and how many ``copies`` of the row it holds.

    A piece is a row's position in its part, in the order of turn, speaker and content, by ``TURNS_PER_PIECE``.
    Equal rows are interchangeable, so nothing hangs on how files or tasks deal the rows.
    """
    ranges = RANGES_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "speaker", "content"]
    distinct = rows.groupBy("conversation", "part", *order).agg(F.count("*").alias("n"))
    # A struct is never null, and equal if its parts are.
    own = F.struct("conversation", "part").alias("own")
    dealt = distinct.repartitionByRange(ranges, "conversation", "part", *order)
    dealt = settled(dealt.select(own, *order, "n", F.spark_partition_id().alias("range")))
    before = F.sum("n").over(Window.partitionBy("own").orderBy("range")) - F.col("n")
    firsts = dealt.groupBy("own", "range").agg(F.sum("n").alias("n")).select("own", "range", before.alias("first"))
    along = Window.partitionBy("own", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    ended = dealt.withColumn("end", F.sum("n").over(along)).join(firsts, ["own", "range"])
    size = F.lit(TURNS_PER_PIECE).cast("long")
    start, stop = F.col("first") + F.col("end") - F.col("n"), F.col("first") + F.col("end")
    placed = ended.select("own.*", *order, start.alias("start"), stop.alias("stop"))
    pieces = F.sequence(F.floor(F.col("start") / size), F.floor((F.col("stop") - 1) / size))
    each = placed.withColumn("piece", F.explode(pieces))
    within = F.least("stop", (F.col("piece") + 1) * size) - F.greatest("start", F.col("piece") * size)
    return each.withColumn("copies", within.cast("int")).drop("start", "stop")


def _written(both: DataFrame) -> DataFrame:
    """Text, spans and masks of each row's ``turns`` for its ``assistant``."""
    tail = CLOSE + "\n"

    def head(t: Column) -> Column:
        name = F.concat(F.lit("user" + NAME), t["speaker"])
        own = F.when(t["speaker"] == F.col("assistant"), "assistant").otherwise(name)
        return F.concat(F.lit(OPEN), F.when(t["speaker"] == SYSTEM, SYSTEM).otherwise(own), F.lit("\n"))

    def after(done: Column, t: Column) -> Column:
        size = F.length(head(t)) + F.length(t["content"]) + len(tail)
        return F.concat(done, F.array(F.coalesce(F.get(done, F.size(done) - 1), F.lit(0)) + size))

    ends = F.aggregate("turns", F.array().cast("array<int>"), after)
    return both.withColumn("ends", ends).select(
        "conversation",
        "assistant",
        "part",
        "piece",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), t["content"], F.lit(tail))), "").alias("text"),
        F.zip_with("ends", "turns", lambda e, t: e - len(tail) - F.length(t["content"])).alias("starts"),
        F.transform("ends", lambda e: e - len(tail)).alias("stops"),
        F.transform("turns", lambda t: (t["speaker"] == F.col("assistant")).cast("int")).alias("mask"),
    )
