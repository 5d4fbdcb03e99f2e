"""Chat formatting by linking quotations (DataFrame operations only).

A message's lines are parsed into quote levels.  Quoted passages, their
paragraphs and lines are normalised and hashed, and joined to the first
message of the conversation that says the same unquoted: that is the message
replied to.  Chains of replies lead to a thread's first message by pointer
jumping; messages are ordered by thread and turn, without their quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martline.llm.common import packed, unpacked, written
from martline.operators.keys import sequence_number

#: A line's quote marks (one blank may stand before each), and the blank after them.
MARKS = r"^((?:[ \t]?>)+)[ \t]?"
#: A line that only introduces the quote below it.
ATTRIBUTION = r"(?i)^.{0,200}\b(wrote|writes|schrieb|a écrit|escribió)\s?:\s*$"
#: Messages in one row of ``transcripts``.
TRANSCRIPT_MESSAGES = 256


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """Input columns plus ``reply_text, n_quotes, parent_turn, thread_turn, depth, position, chat_text``.

    ``parent_turn`` is the earlier turn that the message quotes: that with the
    outermost quote level, then the most quoted characters, then the latest;
    null without a link.  ``thread_turn`` is the turn the chain of replies starts at (its
    own without a link) and ``depth`` the length of the chain.  ``position``
    counts a conversation's messages from 1 in the order of thread, turn and
    input.  Null texts are empty; a null conversation or turn is never linked
    and null conversations are ordered together.  Rows that repeat a turn share
    their links.  An empty table gives an empty result.  Input columns with a
    result's name are replaced.
    """
    row = F.col("_row")
    text = F.coalesce(row.getField(text_col).cast("string"), F.lit(""))
    lines = F.transform(F.split(text, "\r?\n"), lambda line: F.struct(
        F.char_length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", "")).alias("level"),
        F.regexp_replace(line, MARKS, "").alias("body")))
    base = written(packed(messages).select(
        "_row", row.getField(conv_col).alias("_conv"), row.getField(turn_col).alias("_turn"), lines.alias("_lines"),
        F.monotonically_increasing_id().alias("_at")), "message-lines")
    base = base.select("*", _own_text(F.col("_lines")).alias("_own"), _run_starts(F.col("_lines")).alias("_starts"))
    parsed = written(base.select("_row", "_conv", "_turn", "_at", "_own",
                                 _passages(F.col("_lines"), F.col("_starts")).alias("_quotes"))
                     .withColumn("_n", F.size("_quotes")), "message-quotes")
    ancestors = _ancestors(_links(parsed))
    # What is shuffled from here on leaves the parsed quotes behind.
    found = (parsed.drop("_quotes").join(ancestors, ["_conv", "_turn"], "left")
             .withColumn("_thread", F.coalesce("_first", "_turn")).withColumn("_depth", F.coalesce("_steps", F.lit(0))))
    found = sequence_number(found.select("_row", "_conv", "_thread", "_turn", "_at", "_own", "_parent", "_depth", "_n"),
                            ["_conv"], ["_thread", "_turn", "_at"], name="_position")
    return unpacked(found, {
        "reply_text": F.col("_own"), "n_quotes": F.col("_n").cast("long"), "parent_turn": F.col("_parent"),
        "thread_turn": F.col("_thread"), "depth": F.col("_depth").cast("long"), "position": F.col("_position"),
        "chat_text": F.concat(F.lit("<|"), F.coalesce(row.getField(role_col).cast("string"), F.lit("unknown")), F.lit("|>\n"),
                              F.col("_own"), F.lit("\n"))})


def transcripts(linked: DataFrame, conv_col: str = "conv_id", size: int = TRANSCRIPT_MESSAGES) -> DataFrame:
    """``conv, part, messages, transcript``: reply-ordered conversations, ``size`` messages a row at most."""
    part = F.floor((F.col("position") - 1) / size).alias("part")
    ordered = F.array_sort(F.collect_list(F.struct("position", "chat_text")))
    return (linked.groupBy(F.col(conv_col).alias("conv"), part)
            .agg(F.count("*").alias("messages"), ordered.alias("_all"))
            .select("conv", "part", "messages", F.array_join(F.transform("_all", lambda m: m["chat_text"]), "").alias("transcript")))


def _own_text(lines: Column) -> Column:
    """The lines without quote marks, but for those that introduce a quote, trimmed."""
    own = F.filter(lines, lambda x, i: (x["level"] == 0) & ~(
        x["body"].rlike(ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)))
    return F.regexp_replace(F.array_join(F.transform(own, lambda x: x["body"]), "\n"), r"\A\s+|\s+\z", "")


def _run_starts(lines: Column) -> Column:
    """Where the quote level changes."""
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: (i == 0) | (
        F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))


def _passages(lines: Column, starts: Column) -> Column:
    """Runs of lines of one quote level, level 0 left out."""
    runs = F.transform(starts, lambda s, j: F.struct(
        F.get(lines, s)["level"].alias("level"),
        F.array_join(F.transform(F.slice(lines, s + 1, F.coalesce(F.get(starts, j + 1), F.size(lines)) - s),
                                 lambda x: x["body"]), "\n").alias("text")))
    return F.filter(runs, lambda r: r["level"] > 0)


def _units(text: Column) -> Column:
    """The normalised text as a whole, its paragraphs and its lines."""
    clean = lambda t: F.trim(F.regexp_replace(F.lower(t), r"\s+", " "))
    parts = F.transform(F.concat(F.split(text, r"\n\s*\n"), F.split(text, r"\n")), clean)
    return F.array_distinct(F.concat(F.array(clean(text)), parts))


def _hash(unit: Column) -> Column:
    """MD5 as 16 bytes: units meet by hash alone, and their number is far below 2**64."""
    return F.unhex(F.md5(unit))


def _links(parsed: DataFrame) -> DataFrame:
    """``_conv, _turn, _parent`` of turns whose quotes are found."""
    said = (parsed.filter("_conv IS NOT NULL AND _turn IS NOT NULL")
            .select("_conv", "_turn", F.explode(_units(F.col("_own"))).alias("_unit")).filter("_unit <> ''")
            .groupBy("_conv", _hash(F.col("_unit")).alias("_hash")).agg(F.min("_turn").alias("_said")))
    quoted = (parsed.filter("_conv IS NOT NULL AND _turn IS NOT NULL")
              .select("_conv", "_turn", F.explode("_quotes").alias("q"))
              .select("_conv", "_turn", F.col("q.level").alias("_level"), F.explode(_units(F.col("q.text"))).alias("_unit"))
              .filter("_unit <> ''")
              .groupBy("_conv", "_turn", _hash(F.col("_unit")).alias("_hash"))
              .agg(F.min("_level").alias("_level"), F.max(F.char_length("_unit")).alias("_chars")))
    met = quoted.join(said, ["_conv", "_hash"]).filter("_said < _turn")
    weighed = met.groupBy("_conv", "_turn", "_said", "_level").agg(F.sum("_chars").alias("_chars"))
    best = F.max(F.struct((-F.col("_level")).alias("l"), F.col("_chars").alias("c"), F.col("_said").alias("s")))
    return weighed.groupBy("_conv", "_turn").agg(best.alias("b")).select("_conv", "_turn", F.col("b.s").alias("_parent"))


def _ancestors(links: DataFrame) -> DataFrame:
    """``_conv, _turn, _parent, _first, _steps``: each chain's first turn, by doubling the step until none moves.

    A parent is always an earlier turn, so chains end; rounds are the
    logarithm of the longest one.  Each round is written.
    """
    state = written(links.select("_conv", "_turn", "_parent", F.col("_parent").alias("_first"), F.lit(1).cast("long").alias("_steps")),
                    "reply-chains")
    while True:
        ahead = state.select("_conv", F.col("_turn").alias("_first"), F.col("_first").alias("_next"), F.col("_steps").alias("_more"))
        moved = written(state.join(ahead, ["_conv", "_first"], "left").select(
            "_conv", "_turn", "_parent", F.coalesce("_next", "_first").alias("_first"),
            (F.col("_steps") + F.coalesce("_more", F.lit(0))).alias("_steps"), F.col("_next").isNotNull().alias("_moved")), "reply-chains")
        state = moved.drop("_moved")
        if moved.filter("_moved").isEmpty():
            return state
