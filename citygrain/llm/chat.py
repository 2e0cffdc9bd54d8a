"""Chat formatting: budgeted windows over the turns of a conversation, native expressions only.

Prefix sums of the turns' tokens cut a conversation into spans of whole turns: the sums are divided into
stretches of the room that a window has, and a turn across the end of a stretch is a span of its own. Every
span becomes a window: the system turn, a limited history of turns before the span, then the span's own
turns. The loss mask covers the own assistant turns only, so a target that is repeated as history is masked.
A turn goes to its span and to the few spans that repeat it, so no task gathers a conversation here; only
``digests``, which are over whole conversations, do.

A turn is written ``<|role|>``, line feed, text, ``</s>``, line feed. Control strings inside roles
and texts are broken by a backslash and 1, backslashes become backslash and 0, so that reading back
is exact for every text.

Defined results: null roles and texts are empty ones; a null conversation is a conversation of its
own; turns are ordered by turn (null first), role and text, repeated rows stay; a turn above the
budget is a span of its own, never cut; the system turn is the first one with that role, wherever it stands,
and the windows that begin behind it carry it; an empty table gives an empty result; further columns don't
matter, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Tokens (words and two marks) of a window, and of the history repeated in it.
BUDGET = 512
HISTORY = 96

#: Strings with a meaning for templates in use; none may stand in a formatted text by accident.
CONTROL = ("<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
END = "</s>\n"


def escaped(text: Column) -> Column:
    """A text without control strings, from which ``unescaped`` makes the same text again."""
    out = F.replace(text, F.lit("\\"), F.lit("\\0"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\1" + mark[1:]))
    return out


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\1"), F.lit("")), F.lit("\\0"), F.lit("\\"))


def _opening(role: Column) -> Column:
    return F.concat(F.lit("<|"), F.replace(escaped(role), F.lit("\n"), F.lit("\\2")), F.lit("|>\n"))


def _tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")) + 2


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row per window: conv_id, window, formatted, new_from, loss (spans of code points).

    ``new_from`` is where the window's own turns begin in ``formatted``, from 0; what comes before,
    the system turn and the history, has been in an earlier window. ``loss`` holds (start, length)
    pairs, from 0. With the system turn at the front and the history full, own turns get what is left
    of the budget.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = conversations.select("conv_id", turn.alias("t"))
    rows = rows.select("conv_id", "t", _tokens(F.col("t.text")).cast("long").alias("tokens"))
    c = F.col
    so_far = Window.partitionBy("conv_id").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    written = F.concat(_opening(c("t.role")), escaped(c("t.text")), F.lit(END))
    system = F.struct((c("end") - c("tokens")).alias("begin"), "tokens", written.alias("written"))
    rows = rows.withColumn("end", F.sum("tokens").over(so_far)).withColumn("begin", c("end") - c("tokens"))
    rows = rows.withColumn("system", F.first(F.when(c("t.role") == "system", system), ignorenulls=True).over(so_far))
    rows = rows.withColumn("room", F.greatest(F.lit(1).cast("long"), F.lit(budget - history) - F.coalesce("system.tokens", F.lit(0))))
    # Turns of one stretch of the prefix sums are a span; a turn that reaches across its end is one of its own.
    first, last = F.floor(c("begin") / c("room")), F.floor((c("end") - 1) / c("room"))
    rows = rows.withColumn("stretch", F.struct("room", F.when(first == last, first).otherwise(-1 - c("begin")).alias("no")))
    in_order = Window.partitionBy("conv_id").orderBy("begin")
    rows = rows.withColumn("starts", F.coalesce(c("stretch") != F.lag("stretch").over(in_order), F.lit(True)))
    rows = rows.withColumn("window", F.sum(c("starts").cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    # The spans that a turn is history of: those that begin within so many tokens behind it.
    behind = in_order.rangeBetween(1, max(history, 1))
    later = F.collect_list(F.when(c("starts"), c("window"))).over(behind) if history > 0 else F.array().cast("array<int>")
    kept = F.struct("begin", "t.role", _opening(c("t.role")).alias("open"), escaped(c("t.text")).alias("body"))
    turns = rows.select(
        "conv_id", "window", kept.alias("kept"),
        F.when(c("starts") & (c("system.begin") < c("begin")), c("system")).alias("system"),
        F.when((c("system.begin") == c("begin")), F.array().cast("array<int>")).otherwise(later).alias("later"),
    )
    own = turns.select("conv_id", "window", F.lit(True).alias("fresh"), "kept", "system")
    past = turns.select("conv_id", F.explode("later").alias("window"), F.lit(False).alias("fresh"), "kept", F.lit(None).alias("system"))
    # Dealt out by span, or a long conversation would stay in the task that numbered its turns.
    spans = own.union(past).repartition("conv_id", "window").groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(F.when(~c("fresh"), c("kept")))).alias("old"),
        F.array_sort(F.collect_list(F.when(c("fresh"), c("kept")))).alias("new"),
        F.first("system", ignorenulls=True).alias("system"),
    )
    text = lambda turns: F.array_join(F.transform(turns, lambda t: F.concat(t.open, t.body, F.lit(END))), "")
    spans = spans.withColumns({"before": F.concat(F.coalesce("system.written", F.lit("")), text("old")), "own": text("new")})
    marks = F.aggregate(
        "new",
        F.struct(F.char_length("before").cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")),
        lambda state, t: F.struct(
            (state.at + F.char_length(t.open) + F.char_length(t.body) + len(END)).cast("long").alias("at"),
            F.when(
                t.role == "assistant",
                F.concat(
                    state.spans,
                    F.array(
                        F.struct(
                            (state.at + F.char_length(t.open)).cast("long").alias("start"), F.char_length(t.body).cast("long").alias("length")
                        )
                    ),
                ),
            )
            .otherwise(state.spans)
            .alias("spans"),
        ),
        lambda state: state.spans,
    )
    return spans.select(
        "conv_id",
        "window",
        F.concat("before", "own").alias("formatted"),
        F.char_length("before").alias("new_from"),
        marks.alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns, as an array of (role, text), of formatted text."""
    pieces = F.filter(F.split(formatted, "</s>\n"), lambda piece: piece != "")
    return F.transform(
        pieces,
        lambda piece: F.struct(
            unescaped(F.replace(F.substr(F.split_part(piece, F.lit("|>\n"), F.lit(1)), F.lit(3)), F.lit("\\2"), F.lit("\n"))).alias("role"),
            unescaped(F.substr(piece, F.locate("|>\n", piece).cast("int") + 3)).alias("text"),
        ),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from them alone."""
    own = F.substr("formatted", F.col("new_from") + 1)
    lost = F.array_join(
        F.transform("loss", lambda span: unescaped(F.substr(F.col("formatted"), (span.start + 1).cast("int"), span.length.cast("int")))), ""
    )
    parts = formatted.select(
        "conv_id", F.struct("window", read_turns(own).alias("turns"), lost.alias("lost")).alias("part"), F.char_length("formatted").alias("chars")
    )
    grouped = parts.groupBy("conv_id").agg(
        F.array_sort(F.collect_list("part")).alias("parts"), F.sum("chars").cast("long").alias("formatted_chars")
    )
    turns = F.flatten(F.transform("parts", lambda part: part.turns))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    lost = F.array_join(F.transform("parts", lambda part: part.lost), "")
    return grouped.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(lost).cast("long").alias("loss_chars"),
        F.sha2(lost.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
