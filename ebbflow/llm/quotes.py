"""Quotation linking: who answers whom, from what messages quote; conversations in reply order without quotes.

A line that starts with ``>`` marks is quoted, its level is their number. Neighbouring quoted lines of one level
are a passage. A passage is normalised whole (case, blanks, line ends and marks of punctuation) and hashed, and joined
to what earlier messages of the same conversation wrote themselves: to their whole own text and to each of their
paragraphs. So a quotation that a mail program wrapped anew is found, and the order of its words counts; the earliest
message that wrote it is the original. Where no message wrote the passage whole, each of its lines votes for every
earlier message that wrote the line, and the message with most votes is the original (the earliest among equals). A
message answers the original of its shallowest linked passage (the latest among equals).

Everything is an expression of Spark; there is no group of unbounded size: a passage or paragraph is part of one
message, of all messages that wrote one the earliest is kept before the join, of messages that wrote the same of the
quoted lines the earliest stands for all, and positions come from sorted range partitions.

Defined results: a null text is empty. A message with a null conversation is kept and links to nothing. Messages
are ordered by conversation, turn, role and text, nulls first; repeated rows keep places of their own. Lines that
announce a quotation go with it. Columns of other names are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.common import materialized, with_position

# The marks before a quoted line, and lines that announce a quotation.
MARKS = r"^([ \t]*>)+[ \t]?"
ANNOUNCES = r"^(On|Le|Am|El) .*(wrote|a écrit|schrieb|escribió) ?:[ \t]*$"
KEYS = ("conv_id", "turn", "role", "text")


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normalised(line: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(line, MARKS, ""), r"[\s\p{Punct}]+", " ")
    return F.lower(F.trim(bare))


def own_text(text: Column) -> Column:
    """What a message says itself: no quoted lines, none that announce one, no blank lines at either end."""
    lines = F.split(text, "\n")

    def keeps(line: Column, at: Column) -> Column:
        announced = line.rlike(ANNOUNCES) & (level_of(F.coalesce(F.get(lines, at + 1), F.lit(""))) > 0)
        return (level_of(line) == 0) & ~announced

    return F.regexp_replace(F.array_join(F.filter(lines, keeps), "\n"), r"^\s+|\s+$", "")


def message_lines(messages: DataFrame) -> DataFrame:
    """position, conv_id, line_no, level, passage (number of the run of lines of one level), paragraph (of the run
    between blank lines), announces, said (normalised) of each line that says something."""
    lines = messages.select("position", "conv_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    lines = lines.withColumn("level", level_of(F.col("line"))).withColumn("said", normalised(F.col("line")))
    in_message = Window.partitionBy("position").orderBy("line_no")  # a group is one message
    starts = F.col("level") != F.lag("level", 1, -1).over(in_message)
    announces = (F.col("level") == 0) & (F.lead("level", 1, 0).over(in_message) > 0) & F.col("line").rlike(ANNOUNCES)
    lines = lines.withColumns({"_starts": starts, "announces": announces})
    breaks = F.col("_starts") | F.col("announces") | (F.col("said") == "")
    lines = lines.withColumns(
        {
            "passage": F.sum(F.col("_starts").cast("int")).over(in_message),
            "paragraph": F.sum(breaks.cast("int")).over(in_message),
        }
    )
    return lines.filter("said <> ''").drop("line", "_starts")


def _block() -> Column:
    """The hash of a group of lines as one text."""
    lines = F.array_sort(F.collect_list(F.struct("line_no", "said")))
    return F.sha2(F.array_join(F.transform(lines, lambda x: x["said"]), " "), 256).alias("hash")


def link_whole(lines: DataFrame) -> DataFrame:
    """position, passage, level, lines, original: the earliest message before it that wrote the whole passage."""
    own = lines.filter("level = 0 AND NOT announces")
    blocks = own.groupBy("conv_id", "position").agg(_block()).select("conv_id", "position", "hash")
    parts = own.groupBy("conv_id", "position", "paragraph").agg(_block()).select("conv_id", "position", "hash")
    first = blocks.unionByName(parts).groupBy("conv_id", "hash").agg(F.min("position").alias("_first"))
    quoted = lines.filter("level > 0").groupBy("conv_id", "position", "passage", "level").agg(_block(), F.count(F.lit(1)).alias("lines"))
    original = F.when(F.col("_first") < F.col("position"), F.col("_first")).alias("original")
    return quoted.join(first, ["conv_id", "hash"], "left").select("position", "passage", "level", "lines", original)


def link_lines(lines: DataFrame) -> DataFrame:
    """position, passage, original: the earlier message that wrote most of the lines of each passage."""
    lines = lines.withColumn("hash", F.sha2("said", 256))
    quoted = lines.filter("level > 0 AND unlinked")
    # Only what somebody quotes is looked for, and each such line once.
    wanted = quoted.select("conv_id", "hash").distinct()
    written = lines.filter("level = 0").join(wanted, ["conv_id", "hash"], "left_semi").select("conv_id", "hash", "position").distinct()
    # Of messages that wrote the same of these lines the earliest beats the others wherever they are candidates.
    held = written.groupBy("conv_id", "position").agg(F.sha2(F.array_join(F.sort_array(F.collect_set("hash")), " "), 256).alias("_held"))
    earliest = held.groupBy("conv_id", "_held").agg(F.min("position").alias("position"))
    written = written.join(earliest.select("position"), "position", "left_semi").withColumnRenamed("position", "original")
    votes = (
        quoted.join(written, ["conv_id", "hash"])
        .filter("original < position")
        .groupBy("position", "passage", "original")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.max(F.struct("n", (-F.col("original")).alias("at")))
    return votes.groupBy("position", "passage").agg((-best["at"]).alias("original"))


def link_passages(messages: DataFrame) -> DataFrame:
    """position, passage, level, lines, original (a position, null where none is found) of each quoted passage."""
    lines = message_lines(messages)
    whole = materialized(link_whole(lines))
    rest = whole.filter("original is null").select("position", "passage", F.lit(True).alias("unlinked"))
    if rest.isEmpty():
        return whole
    by_lines = link_lines(lines.join(rest, ["position", "passage"], "left")).withColumnRenamed("original", "_most")
    found = whole.join(by_lines, ["position", "passage"], "left")
    return found.withColumn("original", F.coalesce("original", "_most")).drop("_most")


def roots_of(links: DataFrame) -> DataFrame:
    """position, root, depth from position, parent: ancestors are doubled until none has a parent of its own."""
    paths = materialized(links.select("position", F.col("parent").alias("root"), F.lit(1).cast("long").alias("depth")))
    while True:
        above = paths.select(F.col("position").alias("root"), F.col("root").alias("_root"), F.col("depth").alias("_depth"))
        step = materialized(paths.join(above, "root", "left"))
        paths = step.select(
            "position",
            F.coalesce("_root", "root").alias("root"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
        )
        if step.filter("_root is not null").isEmpty():
            return paths


def link_conversations(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, turn, role, own_text, parent_turn, depth, passages, linked, max_level,
    reply_order. A thread stands where its first message stands, and in it a message follows what it answers."""
    said = messages.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    placed = with_position(said, *KEYS)
    passages = materialized(link_passages(placed))
    linked = passages.filter("original is not null")
    parents = linked.groupBy("position").agg(
        F.max(F.struct((-F.col("level")).alias("near"), F.col("original").alias("at")))["at"].alias("parent")
    )
    turns = placed.select(F.col("position").alias("parent"), F.col("turn").alias("parent_turn"))
    parents = parents.join(turns, "parent")
    roots = roots_of(parents)
    counts = passages.groupBy("position").agg(
        F.count(F.lit(1)).alias("passages"), F.count("original").alias("linked"), F.max("level").alias("max_level")
    )
    rows = (
        placed.join(counts, "position", "left")
        .join(parents.drop("parent"), "position", "left")
        .join(roots, "position", "left")
        .select(
            "position",
            "conv_id",
            "turn",
            "role",
            own_text(F.col("text")).alias("own_text"),
            "parent_turn",
            *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("depth", "passages", "linked", "max_level")],
            F.coalesce("root", "position").alias("root"),
        )
    )
    placed_again = with_position(rows.withColumnRenamed("position", "place"), "conv_id", "root", "place")
    return placed_again.withColumnRenamed("position", "reply_order").drop("root", "place")
