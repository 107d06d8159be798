"""Quotation linking: which message a message answers, found by the passages it quotes.

A line's quote level is the number of ``>`` it begins with. Lines of one level that follow
each other are a passage; passages and their single lines are normalised (lower case, white
space to one space), hashed, and joined to the hashes of what messages say themselves: their
whole own text and each of its lines. The original of a quote is the first message of the
conversation that says it, before the quoting one; failing that, a whole passage or a line of ``LEAST_LINE``
characters may come from another conversation. A message answers the message from which most of its first-level quoted text comes.
Following the answers back gives each message the root of its thread and its depth, and
``(conv_id, root_turn, depth, turn)`` is the reply order of a conversation.

Everything is DataFrame functions. What is joined to is one row for each hash, made by partial aggregation, so
a passage that a third of all messages share is a single row; the quoting side can be split
by adaptive execution. Threads are followed by doubling steps: as many rounds as the
logarithm of the longest chain.

Defined results: null text counts as empty; identical rows are one message, ``n_rows`` says how
many they were; messages that share conversation and turn but differ are kept apart, and the
answered turn means any of them; quotes in rows with a null conversation or turn are taken out but not linked;
blank quotes link to nothing; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import stored, table

LEVEL = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?i)^.{0,200}\b(wrote|schrieb|escribió|a écrit) ?:[ \t]*$"
#: Shorter lines are said in too many conversations to name another one; inside their own they have a first speaker.
LEAST_LINE = 20
KEY = ["conv_id", "turn", "message"]


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, LEVEL, 0), "[^>]", ""))


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def hashed(text: Column) -> Column:
    return F.sha2(normal(text), 256)


def messages(df: DataFrame) -> DataFrame:
    """One row for each different message; ``message`` tells apart those of one turn."""
    df = df.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    df = df.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n_rows"))
    return df.withColumn("message", F.sha2(F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"}), 256))


def without_quotes(text: Column) -> Column:
    """What a message says itself: its lines of level 0 but for "... wrote:" right before a quote."""
    lines = F.split(text, "\n")
    kept = F.filter(
        F.transform(lines, lambda line, i: F.struct(line.alias("line"), (F.get(lines, i + 1).rlike(LEVEL) & line.rlike(ATTRIBUTION)).alias("introduces"))),
        lambda x: ~x["line"].rlike(LEVEL) & ~F.coalesce(x["introduces"], F.lit(False)),
    )
    own = F.array_join(F.transform(kept, lambda x: x["line"]), "\n")
    return F.when(text.rlike(f"(?m){LEVEL}"), F.trim(own, F.lit(" \n\r\t"))).otherwise(text)


def said(own: DataFrame) -> DataFrame:
    """(conv_id, turn, hash) of every whole own text and of its lines, and whether it may name another conversation."""
    lines = F.filter(F.split("own", "\n"), lambda line: normal(line) != "")
    wide = F.transform(lines, lambda line: F.struct(hashed(line).alias("hash"), (F.length(normal(line)) >= LEAST_LINE).alias("wide")))
    whole = F.array(F.struct(hashed(F.col("own")).alias("hash"), F.lit(True).alias("wide")))
    units = F.array_distinct(F.concat(whole, wide))
    return own.where(F.trim("own") != "").select("conv_id", "turn", F.explode(units).alias("unit")).select("conv_id", "turn", "unit.hash", "unit.wide")


def quoted(msgs: DataFrame) -> DataFrame:
    """Quoted passages: level, number in the message, size, and the hashes of the whole and of its lines."""
    lines = msgs.where(F.col("text").rlike(f"(?m){LEVEL}")).select(*KEY, F.posexplode(F.split("text", "\n")).alias("at", "line"))
    lines = lines.withColumn("level", level_of(F.col("line"))).withColumn("line", F.trim(F.regexp_replace("line", LEVEL, "")))
    here = W.partitionBy(*KEY).orderBy("at")
    lines = lines.withColumn("starts", (F.col("level") != F.lag("level", 1, -1).over(here)).cast("int"))
    lines = lines.withColumn("passage", F.sum("starts").over(here)).where("level > 0")
    passages = lines.groupBy(*KEY, "passage", "level").agg(F.sort_array(F.collect_list(F.struct("at", "line"))).alias("lines"))
    each = F.transform("lines", lambda x: x["line"])
    whole = F.array_join(each, "\n")
    rows = passages.select(*KEY, "passage", "level", whole.alias("whole"), F.explode(F.array_distinct(F.concat(F.array(whole), each))).alias("unit"))
    wide = (F.col("unit") == F.col("whole")) | (F.length(normal(F.col("unit"))) >= LEAST_LINE)
    return rows.where(normal(F.col("unit")) != "").select(*KEY, "passage", "level", F.length("unit").alias("size"), hashed(F.col("unit")).alias("hash"), wide.alias("wide"))


def linked(quotes: DataFrame, units: DataFrame) -> DataFrame:
    """Each quote with the turn of its original, or with the conversation it was first said in."""
    here = units.groupBy("conv_id", "hash").agg(F.min("turn").alias("original_turn"))
    anywhere = units.where("conv_id is not null and wide").groupBy("hash").agg(F.min("conv_id").alias("first_conv"), F.max("conv_id").alias("last_conv"))
    found = quotes.join(here, ["conv_id", "hash"], "left").join(anywhere, "hash", "left")
    inside = F.col("original_turn") < F.col("turn")
    other = F.when(F.col("first_conv") != F.col("conv_id"), F.col("first_conv")).when(F.col("last_conv") != F.col("conv_id"), F.col("last_conv"))
    return found.withColumn("original_turn", F.when(inside, F.col("original_turn"))).withColumn("other_conv", F.when(F.col("wide") & ~F.coalesce(inside, F.lit(False)), other))


def answers(links: DataFrame) -> DataFrame:
    """The answered turn of each message, and its numbers of quotes."""
    totals = links.groupBy(*KEY).agg(
        F.countDistinct("passage").alias("n_quotes"),
        F.countDistinct(F.when(F.col("original_turn").isNotNull(), F.col("passage"))).alias("n_linked"),
        F.countDistinct(F.when(F.col("other_conv").isNotNull(), F.col("passage"))).alias("n_elsewhere"),
        F.max("level").alias("max_level"),
    )
    weights = links.where("original_turn is not null").groupBy(*KEY, "level", "original_turn").agg(F.sum("size").alias("size"))
    best = weights.groupBy(*KEY).agg(F.max(F.struct(-F.col("level"), "size", "original_turn"))["original_turn"].alias("reply_to_turn"))
    return totals.join(best, KEY, "left")


def threads(edges: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn, depth) for every turn that answers one, by doubling.

    An answered turn is earlier than the answer, so there are no circles.
    """
    steps = edges.select("conv_id", "turn", F.col("reply_to_turn").alias("root_turn"), F.lit(1).alias("depth"))
    steps = stored(steps, "threads")
    while True:
        after = steps.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("next"), F.col("depth").alias("more"))
        joined = steps.join(after, ["conv_id", "root_turn"], "left")
        moved = joined.select("conv_id", "turn", F.coalesce("next", "root_turn").alias("root_turn"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("next").isNotNull().alias("moved"))
        moved = stored(moved, "threads")
        steps = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return steps


def link_quotations(conversations: DataFrame) -> DataFrame:
    """Every message without its quotes, with the turn it answers and its place in the reply order."""
    msgs = messages(conversations)
    own = msgs.withColumn("own", without_quotes(F.col("text")))
    replies = stored(answers(linked(quoted(msgs), said(own))), "replies")
    edges = replies.where("reply_to_turn is not null").groupBy("conv_id", "turn").agg(F.max("reply_to_turn").alias("reply_to_turn"))
    placed = threads(edges)
    same = [F.col(f"m.{k}").eqNullSafe(F.col(f"r.{k}")) for k in KEY]
    numbers = ("n_quotes", "n_linked", "n_elsewhere", "max_level")
    out = own.alias("m").join(replies.alias("r"), same, "left").select("m.*", "r.reply_to_turn", *[f"r.{c}" for c in numbers])
    out = out.join(placed, ["conv_id", "turn"], "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in (*numbers, "depth")]
    return out.select("conv_id", "turn", "role", F.col("own").alias("text"), "n_rows", "reply_to_turn", F.coalesce("root_turn", "turn").alias("root_turn"), *zero)


def op2_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotations(table(spark, sf_dir, "conversations"))
