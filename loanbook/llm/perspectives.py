"""Chat training data from dialogues of several parties, once from each party's perspective.

For every participant the dialogue is rendered with that speaker as assistant and all others as
named users; only the speaker's own turns are trained on. Narrators (system) keep their role
and have no perspective. A rendering stays a table of segments with their offsets, so a
dialogue may be of any length: offsets are sums over bands of turns, then within a band.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from loanbook.llm.shared import keep

#: Turns of a band.
BAND = 1024
BEGIN, END = "<|im_start|>", "<|im_end|>"
NARRATORS = ("system",)
UNKNOWN = "unknown"


def _safe(text: Column) -> Column:
    """A text cannot hold the format's markers."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _name(role: Column) -> Column:
    """A name stays on the line of the head."""
    return F.replace(F.replace(_safe(F.coalesce(role, F.lit(UNKNOWN))), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def rotated(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", narrators: tuple[str, ...] = NARRATORS) -> DataFrame:
    """(conv_id, perspective, turn, speaker, role, segment, start, length, train_start, train_length).

    A row for each participant of a dialogue and each of its turns. Segments in the order of
    start are the rendering; start and length count characters. The characters train_start to
    train_start + train_length of an assistant's segment, its text and end marker, are trained on;
    train_length is 0 for all others. Turns with equal numbers come in the order of speaker and text, a null
    number first. A null role is the speaker 'unknown', a null text empty, null dialogue ids are one
    dialogue; repeated rows are turns of their own. In names and texts "<|" becomes "< |", and in names line ends become \\n and \\r. There are as many rows
    as participants times turns, since each reads the whole dialogue. Long texts are not cut. A dialogue of narrators
    only and an empty table give no rows. Other columns are not read.
    """
    said = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        _name(F.col(role_col)).alias("speaker"), _safe(F.coalesce(F.col(text_col), F.lit(""))).alias("text"))
    party = keep(said.where(~F.col("speaker").isin(*narrators)).select(F.col("conv_id").alias("c"), F.col("speaker").alias("perspective"))
                 .distinct(), "party")
    role = (F.when(F.col("speaker") == F.col("perspective"), "assistant")
            .when(F.col("speaker").isin(*narrators), "system").otherwise("user"))
    head = F.concat(F.lit(BEGIN), "role", F.when(F.col("role") == "user", F.concat(F.lit(" name="), "speaker")).otherwise(""), F.lit("\n"))
    body = F.concat("text", F.lit(END))
    views = (said.join(party, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c").withColumn("role", role)
             .withColumn("head", F.length(head).cast("long")).withColumn("segment", F.concat(head, body, F.lit("\n")))
             .withColumn("length", F.length("segment").cast("long")).withColumn("band", F.floor(F.col("turn") / BAND)))
    bands = views.groupBy("conv_id", "perspective", "band").agg(F.sum("length").alias("size"))
    before = Window.partitionBy("conv_id", "perspective").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    bases = keep(bands.select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("band").alias("b"),
                              F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "bases")
    within = (Window.partitionBy("conv_id", "perspective", "band").orderBy("turn", "speaker", "text")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = views.withColumn("inside", F.coalesce(F.sum("length").over(within), F.lit(0)))
    same = (F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & F.col("band").eqNullSafe(F.col("b")))
    start = F.col("base") + F.col("inside")
    own = F.col("role") == "assistant"
    return placed.join(bases, same).select(
        "conv_id", "perspective", "turn", "speaker", "role", "segment", start.alias("start"), "length",
        F.when(own, start + F.col("head")).otherwise(start).alias("train_start"),
        F.when(own, F.length("text") + len(END)).otherwise(0).cast("long").alias("train_length"))


def dialogues(segments: DataFrame) -> DataFrame:
    """(conv_id, perspective, text, masks): whole renderings, for dialogues that fit into a row.

    masks are the trained spans as structs of start and length, in order.
    """
    rows = segments.groupBy("conv_id", "perspective").agg(
        F.sort_array(F.collect_list(F.struct("start", "segment", "train_start", "train_length"))).alias("x"))
    spans = F.filter("x", lambda s: s.train_length > 0)
    return rows.select("conv_id", "perspective", F.concat_ws("", "x.segment").alias("text"), F.transform(
        spans, lambda s: F.struct(s.train_start.alias("start"), s.train_length.alias("length"))).alias("masks"))
