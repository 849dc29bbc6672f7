"""Multi-party perspective rotation of dialogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

OPEN, CLOSE, BREAK = "<|im_start|>", "<|im_end|>", "\n"
#: Turns rendered into one row; a longer dialogue continues in further rows.
PART_TURNS = 512
SYSTEM, ASSISTANT = "system", "assistant"
#: Columns that make a dialogue, a speaker and, with their dialogue, a turn: null and its stand-in are told apart, so
#: that equal keys join.
_DIALOGUE, _SPEAKER = ["conv", "none"], ["named", "speaker"]
_ORDER = ["turn", *_SPEAKER, "digest"]
_TURN = [*_DIALOGUE, *_ORDER]


def rotate_perspectives(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """Renders each dialogue once for every participant: that speaker as assistant, all others as named users.

    turns has conv_id, turn, role (the speaker) and text; other columns are ignored. Returns conv_id, perspective,
    part, part_start, n_turns, text and loss_spans: text is the rendered part, loss_spans the [start, end) code
    points in it that the speaker said (with the closing marker), the only ones to train on. A part is part_turns
    turns, however they are numbered; the parts of one (conv_id, perspective) joined are the whole dialogue, and
    part_start counts the code points before a part. So no task ever holds a whole long dialogue.

    Which part a turn is in, who speaks and where parts start follows from keys and lengths alone, which are sorted as
    a whole and counted by range, so that a dialogue with a third of all turns is many tasks' work. Texts are shuffled
    twice: to their keys, where repeats go, and to their part.

    Defined cases: turns are ordered by (turn, speaker, MD5 of the text), nulls first; a row that repeats another in
    all four columns is one turn. A null role is a speaker of its own, with a null perspective and no name, a null text
    is an empty one, a null turn comes before all others, a null conv_id is a dialogue of its own. System turns are
    rendered in each perspective, but system is no participant: a dialogue with nothing else gives no rows. Markers in
    texts and speakers are broken up ("<|" becomes "< |") and line ends in speakers become spaces, so neither can forge
    a turn.
    """
    content = F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|"), F.lit("< |"))
    said = turns.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("none"),
        F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"),
        F.col("role").isNotNull().alias("named"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("speaker"),
        content.alias("content"),
    ).withColumn("digest", F.md5("content"))
    placed = written(_numbered(said.select(*_TURN, F.length("content").cast("long").alias("n")).distinct(), part_turns), "turns")
    texts = said.groupBy(*_TURN).agg(F.first("content").alias("content")).join(placed.select(*_TURN, "part"), _TURN)
    parts = texts.groupBy(*_DIALOGUE, "part").agg(F.array_sort(F.collect_list(F.struct(*_ORDER, "content"))).alias("turns"))

    own = lambda t: (t["named"] == F.col("own_named")) & (t["speaker"] == F.col("own_speaker"))
    pieces = F.transform("turns", lambda t: F.struct(_rendered(t, own(t)).alias("text"), F.length(t["content"]).alias("n"), own(t).alias("own")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))
    rows = parts.join(_places(placed), [*_DIALOGUE, "part"]).withColumn("pieces", pieces)
    return rows.select(
        F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
        F.when(F.col("own_named"), F.col("own_speaker")).alias("perspective"),
        "part", "part_start",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda x: x["text"]), "").alias("text"),
        F.aggregate("pieces", start, _with_span)["spans"].alias("loss_spans"),
    )


def _numbered(keys: DataFrame, part_turns: int) -> DataFrame:
    """keys (distinct turns) with their part. All are sorted by range; a turn's place in its dialogue is its place in
    its range and the dialogue's turns in the ranges before."""
    ranges = written(keys.repartitionByRange(*_TURN).withColumn("range", F.spark_partition_id()), "ranges")
    here = [*_DIALOGUE, "range"]
    before = Window.partitionBy(*_DIALOGUE).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy(*here).agg(F.count("*").alias("size")).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(*here).orderBy(*_ORDER)) - 1
    numbered = ranges.withColumn("place", place).join(sizes, here)
    return numbered.select(*_TURN, "n", F.floor((F.col("before") + F.col("place")) / F.lit(part_turns)).cast("long").alias("part"))


def _name(named: Column, speaker: Column) -> Column:
    """How a speaker is announced to the others."""
    shown = F.translate(F.replace(speaker, F.lit("<|"), F.lit("< |")), "\r\n", "  ")
    return F.when(~named, F.lit("user")).when(speaker == SYSTEM, F.lit(SYSTEM)).otherwise(F.concat(F.lit("user name="), shown))


def _rendered(t: Column, own: Column) -> Column:
    head = F.when(own, F.lit(ASSISTANT)).otherwise(_name(t["named"], t["speaker"]))
    return F.concat(F.lit(OPEN), head, F.lit(BREAK), t["content"], F.lit(CLOSE + BREAK))


def _with_span(acc: Column, x: Column) -> Column:
    """One piece on: where the text is, and the spans to train on."""
    end = acc["at"] + F.length(x["text"])
    span = F.struct((end - F.lit(len(CLOSE + BREAK)) - x["n"]).alias("start"), (end - F.lit(len(BREAK))).alias("end"))
    return F.struct(end.alias("at"), F.when(x["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))


def _places(placed: DataFrame) -> DataFrame:
    """For each part and perspective (own_named, own_speaker) where it starts, from lengths alone."""
    part = [*_DIALOGUE, "part"]
    name, marks = F.length(_name(F.col("named"), F.col("speaker"))), len(OPEN + BREAK + CLOSE + BREAK)
    by_speaker = placed.groupBy(*part, *_SPEAKER).agg(F.count("*").alias("k"), F.sum("n").alias("n"))
    sizes = by_speaker.groupBy(*part).agg(F.sum(F.col("k") * (name + marks) + F.col("n")).alias("size"))
    as_own = [F.col(c).alias(f"own_{c}") for c in _SPEAKER]
    speakers = by_speaker.where(~F.col("named") | (F.col("speaker") != SYSTEM)).select(*_DIALOGUE, *as_own).distinct()
    less = by_speaker.select(*part, *as_own, (F.col("k") * (name - len(ASSISTANT))).alias("less"))
    all_parts = sizes.join(speakers, _DIALOGUE).join(less, [*part, "own_named", "own_speaker"], "left").withColumn("size", F.col("size") - F.coalesce("less", F.lit(0)))
    before = Window.partitionBy(*_DIALOGUE, "own_named", "own_speaker").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return all_parts.select(*part, "own_named", "own_speaker", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("part_start"))
