"""Chat formatting in budgeted windows.

A conversation is cut into windows of whole turns by prefix sums of turn tokens.  Every window after the
first repeats the opening system turn and a limited history of the turns before it; repeated turns are
context only, so their assistant texts are left out of the loss mask and every target is learnt once.

Template: ``<s>[INST]role[/INST]text</s>`` for each turn.  Control strings inside a text are escaped by
one backslash after their first character (``<\\/s>``, ``[\\/INST]``; text that already looks like that
gets one more), which ``unescape`` undoes exactly.

Budget: a window takes turns whose start falls into the same cell of half the free budget, and a turn
longer than that stands alone, so new turns stay within the free budget unless one turn is larger; such
a turn is kept whole.  The window of a turn follows from prefix sums alone, without a sequential pass.

Defined results: NULL text or role is empty; a NULL turn comes first, ties are ordered by role and text
and repeated rows are repeated turns; a NULL conversation id is one conversation; other columns are ignored.
Prefix sums are taken in two steps (turn ranges of 1,024, then inside a range), so a conversation of any
length is not one task's work.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardgrid.session import staged

OPEN, MIDDLE, CLOSE = "<s>[INST]", "[/INST]", "</s>"
RANGE = 1024
FRAME_TOKENS = 4  # what the marks and the role of a turn cost


def escape(text: Column) -> Column:
    """Break up control strings, reversibly."""
    return F.regexp_replace(F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1"), r"\[(\\*/?INST\])", r"[\\$1")


def unescape(text: Column) -> Column:
    """Undo ``escape``."""
    return F.regexp_replace(F.regexp_replace(text, r"<\\(\\*/?s>)", "<$1"), r"\[\\(\\*/?INST\])", "[$1")


def word_tokens(text: Column) -> Column:
    """The default measure of a text: its words."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))


def _turns(conversations: DataFrame, tokens: Callable[[Column], Column]) -> DataFrame:
    """Turns with their number and the tokens before them in the conversation."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = conversations.select(
        F.col("conv_id").alias("_conv"),
        F.col("turn").alias("_turn"),
        F.coalesce("role", F.lit("")).alias("_role"),
        text.alias("_text"),
        F.floor(F.col("turn") / RANGE).alias("_range"),
    ).withColumn("_tokens", (tokens(F.col("_text")) + FRAME_TOKENS).cast("long"))
    order = Window.partitionBy("_conv").orderBy(F.col("_range").asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        base.groupBy("_conv", "_range")
        .agg(F.count("*").alias("_n"), F.sum("_tokens").alias("_sum"))
        .select(
            F.col("_conv").alias("_c"),
            F.col("_range").alias("_r"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
        )
    )
    inside = Window.partitionBy("_conv", "_range").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    running = inside.rowsBetween(Window.unboundedPreceding, -1)
    numbered = base.withColumn("_row", F.row_number().over(inside)).withColumn("_in", F.coalesce(F.sum("_tokens").over(running), F.lit(0)))
    return numbered.join(
        ranges, F.col("_conv").eqNullSafe(F.col("_c")) & F.col("_range").eqNullSafe(F.col("_r"))
    ).select(
        "_conv", "_role", "_text", "_tokens",
        (F.col("_n_before") + F.col("_row") - 1).alias("_no"),
        (F.col("_sum_before") + F.col("_in")).alias("_start"),
    )


def format_conversations(
    conversations: DataFrame,
    budget: int = 1024,
    history: int = 256,
    tokens: Callable[[Column], Column] = word_tokens,
    system_role: str = "system",
    target_role: str = "assistant",
) -> DataFrame:
    """Windows: conv_id, window, formatted, n_repeated, n_new, n_tokens, loss_spans.

    ``loss_spans`` are (start, end) code points in ``formatted``; the first ``n_repeated`` turns of a
    window are repeated context.  ``budget`` counts the new turns, the history and the system turn.
    """
    # Written once: windows, history and system turns all read the numbered turns.
    turns = staged(_turns(conversations, tokens), "turns")
    head = turns.where((F.col("_no") == 0) & (F.col("_role") == system_role)).select(
        F.col("_conv").alias("_c"), F.col("_text").alias("_head"), F.col("_tokens").alias("_head_tokens")
    )
    cell = F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.coalesce("_head_tokens", F.lit(0))) / 2))
    placed = (
        turns.join(head, F.col("_conv").eqNullSafe(F.col("_c")), "left")
        .withColumn("_cell", cell)
        .withColumn("_alone", F.col("_tokens") > F.col("_cell"))
        .withColumn("_slot", F.floor(F.col("_start") / F.col("_cell")))
        # A turn that stands alone parts the turns before it in its cell from those after it.
        .withColumn("_side", F.when(F.col("_alone"), F.lit(1)).otherwise(F.lit(0)))
    )
    # Within one cell at most one turn that stands alone can start (it fills the rest of the cell), and it is the last.
    first = placed.groupBy("_conv", "_slot", "_side").agg(
        F.min("_no").alias("_first"),
        F.min("_start").alias("_from"),
        F.first("_head_tokens").alias("_head_tokens"),
    )
    new = placed.select("_conv", "_slot", "_side", "_no", "_role", "_text", "_tokens", F.lit(False).alias("_again"))
    again = _repeated(first, turns, history)
    retained = first.where((F.col("_first") > 0) & F.col("_head_tokens").isNotNull()).select(
        F.col("_conv").alias("_wc"), "_slot", "_side"
    ).join(head, F.col("_wc").eqNullSafe(F.col("_c"))).select(
        F.col("_wc").alias("_conv"), "_slot", "_side", F.lit(0).cast("long").alias("_no"),
        F.lit(system_role).alias("_role"), F.col("_head").alias("_text"), F.col("_head_tokens").alias("_tokens"), F.lit(True).alias("_again"),
    )
    rows = new.unionByName(again).unionByName(retained)
    lists = rows.groupBy("_conv", "_slot", "_side").agg(
        F.array_sort(F.collect_list(F.struct("_no", "_again", "_role", "_text", "_tokens"))).alias("_turns")
    )
    return _rendered(lists, target_role)


def _repeated(first: DataFrame, turns: DataFrame, history: int) -> DataFrame:
    """Turns that start within ``history`` tokens before a window, the opening turn apart if it is retained.

    An equi-join on cells of ``history`` tokens: a window looks into its own cell and the one before.
    """
    if history <= 0:
        wanted = first.where(F.lit(False)).select("_conv", "_slot", "_side", F.explode(F.array(F.lit(0))).alias("_h"), "_from", "_first", "_head_tokens")
    else:
        at = F.floor(F.col("_from") / history)
        wanted = first.where(F.col("_first") > 0).select(
            "_conv", "_slot", "_side", "_from", "_first", "_head_tokens", F.explode(F.array(at, at - 1)).alias("_h")
        )
    earlier = turns.select(
        F.col("_conv").alias("_c"), F.col("_start").alias("_s"), F.col("_no"), F.col("_role"), F.col("_text"), F.col("_tokens"),
        F.floor(F.col("_start") / max(history, 1)).alias("_hc"),
    )
    return wanted.join(
        earlier,
        F.col("_conv").eqNullSafe(F.col("_c"))
        & (F.col("_h") == F.col("_hc"))
        & (F.col("_no") < F.col("_first"))
        & (F.col("_s") >= F.col("_from") - history)
        & ~((F.col("_no") == 0) & F.col("_head_tokens").isNotNull()),
    ).select("_conv", "_slot", "_side", "_no", "_role", "_text", "_tokens", F.lit(True).alias("_again"))


def _rendered(lists: DataFrame, target_role: str) -> DataFrame:
    marks = len(OPEN) + len(MIDDLE)
    pieces = lists.withColumn(
        "_pieces",
        F.transform(
            "_turns",
            lambda t: F.struct(
                t["_no"].alias("no"), t["_again"].alias("again"), escape(t["_role"]).alias("role"), escape(t["_text"]).alias("text"),
                (t["_role"] == target_role).alias("target"), t["_tokens"].alias("tokens"),
            ),
        ),
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        begin = acc["at"] + marks + F.length(p["role"])
        end = begin + F.length(p["text"])
        learnt = p["target"] & ~p["again"]
        spans = F.when(learnt, F.concat(acc["spans"], F.array(F.struct(begin.alias("start"), end.alias("end"))))).otherwise(acc["spans"])
        return F.struct((end + len(CLOSE)).cast("long").alias("at"), spans.alias("spans"))

    return pieces.select(
        F.col("_conv").alias("conv_id"),
        F.element_at(F.filter("_pieces", lambda p: ~p["again"]), 1)["no"].alias("first_turn"),
        F.array_join(
            F.transform("_pieces", lambda p: F.concat(F.lit(OPEN), p["role"], F.lit(MIDDLE), p["text"], F.lit(CLOSE))), ""
        ).alias("formatted"),
        F.size(F.filter("_pieces", lambda p: p["again"])).alias("n_repeated"),
        F.size(F.filter("_pieces", lambda p: ~p["again"])).alias("n_new"),
        F.aggregate("_pieces", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("n_tokens"),
        F.aggregate("_pieces", start, step)["spans"].alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted window as an array of (role, text), texts unescaped."""
    parts = F.split(formatted, r"</s>")
    turns = F.slice(parts, 1, F.size(parts) - 1)
    return F.transform(
        turns,
        lambda t: F.struct(
            unescape(F.substring(F.substring_index(t, MIDDLE, 1), len(OPEN) + 1, 2**30)).alias("role"),
            unescape(F.substring(t, F.locate(MIDDLE, t) + len(MIDDLE), 2**30)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """Unescaped texts under the loss mask, in order."""
    return F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: turn count, digests of turns and of loss texts, sizes."""
    read = windows.select(
        "conv_id", "first_turn",
        F.slice(read_turns(F.col("formatted")), F.col("n_repeated") + 1, F.greatest(F.col("n_new"), F.lit(1))).alias("_new"),
        read_loss(F.col("formatted"), F.col("loss_spans")).alias("_loss"),
        F.length("formatted").cast("long").alias("_chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("first_turn", "_new", "_loss"))).alias("_w"), F.sum("_chars").alias("formatted_chars")
    )
    turns = F.flatten(F.transform("_w", lambda w: w["_new"]))
    loss = F.array_join(F.flatten(F.transform("_w", lambda w: w["_loss"])), "")
    return whole.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
