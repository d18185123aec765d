"""Quotations in messages: which message a reply quotes, and conversations in reply order without quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, stored

#: Marks before a quoted line: one ``>`` for each level, with blanks between.
MARKS = r"^[ \t]*>[> \t]*"
#: Words of a passage.
WORDS = 4
#: Characters of a conversation's messages that may meet in one group; a longer one is dealt out by passage.
GROUP_CHARS = 1 << 22


def levels(text: Column) -> Column:
    """Lines of a text as an array of (level, line): how often a line is quoted, and what it says without its marks."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, MARKS, 0)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"), F.substr(line, F.length(marks) + 1).alias("line")
        )

    return F.transform(lines, parsed)


def normal(text: Column) -> Column:
    """Lower case, letters and digits only, one space between words."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def passage_key(line: Column) -> Column:
    """Hash of a normalised line, null if nothing is left of it."""
    plain = normal(line)
    return F.when(plain != "", F.xxhash64(plain))


def quoting(messages: DataFrame) -> DataFrame:
    """``messages`` (conv_id, turn, text) as mail: each quotes the one before it, with what that one quotes.

    Lines of the message before come with ``>``, lines of the one before that with ``>>``, then the message's own.
    """
    one = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("said")
    )
    out = messages
    for back in (1, 2):
        earlier = one.select(
            F.struct("conv_id", (F.col("turn") + back).alias("turn")).alias("to"), F.col("said").alias(f"said{back}")
        )
        out = out.withColumn("at", F.struct("conv_id", "turn")).join(earlier, F.col("at") == F.col("to"), "left").drop("at", "to")

    def marked(column: str, marks: str) -> Column:
        return F.transform(F.split(column, "\n"), lambda x: F.concat(F.lit(marks + " "), x))

    nothing = F.array().cast("array<string>")
    lines = F.concat(
        F.coalesce(marked("said2", ">>"), nothing), F.coalesce(marked("said1", ">"), nothing),
        F.split(F.coalesce("text", F.lit("")), "\n"),
    )
    return out.withColumn("text", F.array_join(lines, "\n")).drop("said1", "said2")


def passage_lists(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passages: hashes of what each row says at each level of quotation, each once.

    A passage is a line, or ``WORDS`` words in a row, whatever lines they stand in, so that a quotation whose lines were wrapped anew has passages
    in common with what it quotes. All words in a row are taken, whatever the length of the text.
    """
    lines = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", levels(F.col("text")).alias("lines"))
    by_level = lines.select("*", F.explode(F.array_distinct(F.col("lines.level"))).alias("level"))
    own = F.filter("lines", lambda x: x["level"] == F.col("level"))
    by_level = by_level.select("conv_id", "turn", "level", F.transform(own, lambda x: x["line"]).alias("own"))
    words = F.split(normal(F.array_join("own", " ")), " ")
    by_level = by_level.withColumn("words", F.filter(words, lambda w: w != ""))
    n = F.size("words")
    starts = F.sequence(F.lit(1), F.greatest(n - (WORDS - 1), F.lit(1)))
    rows = F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice("words", i, WORDS), " ")))
    whole = F.filter(F.transform("own", passage_key), lambda h: h.isNotNull())
    found = F.when(n > 0, F.concat(whole, rows)).otherwise(whole)
    return by_level.select("conv_id", "turn", "level", F.array_distinct(found).alias("passages"))


def passages(messages: DataFrame) -> DataFrame:
    """conv_id, turn, level, passage: ``passage_lists`` one by one; what rows of one conv_id and turn say comes once."""
    return passage_lists(messages).select("conv_id", "turn", "level", F.explode("passages").alias("passage")).distinct()


def gathered(messages: DataFrame) -> DataFrame:
    """conv_id, deal, turn, level, passage, partitioned by conv_id and deal, so that equal passages of one conversation are in one partition.

    Hashes travel as lists, one for each row and level. Only a conversation of more than ``GROUP_CHARS`` is dealt out
    passage by passage, by their hashes. There are no more of them than the texts have such lengths, so they are sent to all tasks.
    """
    sizes = messages.groupBy("conv_id").agg(F.sum(F.length("text")).alias("chars")).filter(F.col("chars") > GROUP_CHARS)
    long = sizes.select(F.col("conv_id").alias("long_id"), F.ceil(F.col("chars") / GROUP_CHARS).alias("deals"))
    lists = passage_lists(messages).join(F.broadcast(long), F.col("conv_id") == F.col("long_id"), "left")
    one = F.transform("passages", lambda p: F.struct(F.pmod(p, "deals").alias("deal"), F.array(p).alias("passages")))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("deal"), F.col("passages")))
    dealt = lists.select("conv_id", "turn", "level", F.explode(F.when(F.col("deals").isNull(), whole).otherwise(one)).alias("x"))
    dealt = dealt.select("conv_id", "x.deal", "turn", "level", "x.passages").repartition("conv_id", "deal")
    return dealt.select("conv_id", "deal", "turn", "level", F.explode("passages").alias("passage"))


def parents(messages: DataFrame) -> DataFrame:
    """conv_id, turn, parent_turn, n_linked: the message that a message quotes, and how many passages they share.

    What a message quotes at level k, its parent says at level k - 1. Each quoted passage belongs to the latest earlier
    message of the conversation that says it at that level; the parent is the message to which most belong, the latest of equal ones. The
    speakers of one passage of one conversation are gone through in order of turn; of rows of one message that quote it, one counts.
    """
    said, asked = (F.struct(F.col("level").alias("level"), F.lit(1).alias("says")), F.struct((F.col("level") - 1).alias("level"), F.lit(0).alias("says")))
    roles = F.explode(F.when(F.col("level") > 0, F.array(said, asked)).otherwise(F.array(said))).alias("as")
    met = gathered(messages).select("conv_id", "deal", "passage", "turn", roles).select("conv_id", "deal", "as.level", "passage", "turn", "as.says")
    in_order = Window.partitionBy("conv_id", "deal", "level", "passage").orderBy("turn", "says")
    last = F.last(F.when(F.col("says") == 1, F.col("turn")), ignorenulls=True).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    again = F.coalesce((F.lag("turn").over(in_order) == F.col("turn")) & (F.lag("says").over(in_order) == 0), F.lit(False))
    votes = met.select("conv_id", "turn", "says", last.alias("origin"), again.alias("again"))
    votes = votes.filter("says = 0 AND origin IS NOT NULL AND NOT again").groupBy("conv_id", "turn", "origin").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy("conv_id", "turn").agg(F.max(F.struct("n", "origin")).alias("best")).select(
        "conv_id", "turn", F.col("best.origin").alias("parent_turn"), F.col("best.n").alias("n_linked")
    )


def threads(messages: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, turn, thread_root, depth of each message: pointers to ancestors are doubled until all reach a message without parent.

    A row whose pointer has arrived is not joined any more, so a few long threads do not make all others go along.
    """
    ids = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    paths = ids.join(links, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.coalesce("parent_turn", "turn").alias("thread_root"),
        F.col("parent_turn").isNotNull().cast("long").alias("depth"),
    )
    paths = stored(paths.withColumn("moved", F.col("depth") > 0), "threads")
    while not paths.filter("moved").isEmpty():
        above = paths.select(
            F.struct("conv_id", "turn").alias("at"), F.col("thread_root").alias("next_root"), F.col("depth").alias("more")
        )
        rows = paths.filter("moved").drop("moved").withColumn("to", F.struct("conv_id", F.col("thread_root").alias("turn")))
        rows = rows.join(above, F.col("to") == F.col("at")).select(
            "conv_id", "turn", F.col("next_root").alias("thread_root"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("next_root") != F.col("thread_root")).alias("moved"),
        )
        further = stored(paths.filter("NOT moved").unionAll(rows), "threads")
        drop(paths)
        paths = further
    return paths.drop("moved")


def conversations(messages: DataFrame) -> DataFrame:
    """Every row of ``messages`` (conv_id, turn, role, text) without its quotes, and its place in the replies.

    conv_id, turn, role, text (own lines only), n_quoted (quoted lines of any level), n_linked (passages it
    shares with its parent), parent_turn (null: starts a thread), thread_root and depth. In the order
    conv_id, thread_root, depth, turn each reply comes behind what it answers. A null text is empty. Rows with a
    null conv_id or turn have no parent and no thread. Rows with the same conv_id and turn are one
    message for links and are all returned.
    """
    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    links = stored(parents(rows), "links")
    known = threads(rows, links).join(links, ["conv_id", "turn"], "left")
    known = known.select(F.struct("conv_id", "turn").alias("of"), "thread_root", "depth", "parent_turn", "n_linked")
    parsed = rows.withColumn("lines", levels(F.col("text"))).withColumn("at", F.struct("conv_id", "turn"))
    own = F.filter("lines", lambda x: x.level == 0)
    return parsed.join(known, F.col("at") == F.col("of"), "left").select(
        "conv_id", "turn", "role", F.array_join(F.transform(own, lambda x: x.line), "\n").alias("text"),
        (F.size("lines") - F.size(own)).cast("long").alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "parent_turn", "thread_root", "depth",
    )
