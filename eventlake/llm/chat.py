"""Chat formatting in budgeted windows of whole turns.

Prefix sums of turn tokens place every turn in a window. A window opens with the conversation's
system turn and the last turns before it, up to a limit; only its own turns carry loss, so a turn is
a target once however often it is shown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.llm.common import stored

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
BUDGET = 2048              # tokens a window aims at
HISTORY = BUDGET // 8      # of which repeated turns
BYTES_PER_TOKEN, TURN_TOKENS = 4, 4
TARGET = "assistant"
# Control strings of this and other templates are broken up by a backslash after their first character.
CONTROL = r"(<)(\||/?s>|</?SYS>>)|(\[)(/?INST\])"


def escape(text: Column) -> Column:
    """``text`` without any control string; ``unescape`` gives it back."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), CONTROL, r"$1$3\\$2$4")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _head(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.replace(escape(role), F.lit("\n"), F.lit("\\\n")), F.lit("\n"))


def turn_tokens(text: Column) -> Column:
    """An estimate from the text's size, so that no tokenizer has to run.

    Bytes beyond ASCII count in full: a byte-level vocabulary may have no longer token for them.
    """
    ascii_bytes = F.char_length(F.regexp_replace(text, r"[^\x00-\x7F]", ""))
    return F.ceil(ascii_bytes / BYTES_PER_TOKEN) + F.octet_length(text) - ascii_bytes + TURN_TOKENS


def _with_prefix_sums(turns: DataFrame) -> DataFrame:
    """``turns`` with ``start``: tokens of the conversation before the turn.

    Turns are range-partitioned by conversation and turn, which cuts a long conversation into several
    tasks. Sums run within (conversation, part); one total per part carries them across parts.
    """
    count = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["turn", "role", "text"]
    parts = stored(turns.repartitionByRange(count, "conv_id", *order).withColumn("part", F.spark_partition_id()))
    within = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("conv_id", "part").agg(F.sum("tokens").alias("total")).select(
        F.col("conv_id").alias("conv_"), F.col("part").alias("part_"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("carried"))
    summed = parts.withColumn("inside", F.coalesce(F.sum("tokens").over(within), F.lit(0)))
    same = F.col("conv_id").eqNullSafe(F.col("conv_")) & (F.col("part") == F.col("part_"))
    return summed.join(totals, same).select("conv_id", "turn", "role", "text", "tokens",
                                            (F.col("inside") + F.col("carried")).alias("start"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window, formatted, repeated, loss), one row per window, numbered from 0 with gaps.

    ``repeated`` counts the leading turns shown again, ``loss`` holds (start, length) in code points
    of the targets inside ``formatted``. A window keeps to the budget unless a single turn takes more
    than half of its share; turns are never cut. Null texts and roles count as empty, null
    conversation ids as one conversation, turns of equal number are ordered by role and text (null
    numbers first), and repeated rows stay repeated. Other columns are not read.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = _with_prefix_sums(turns.withColumn("tokens", turn_tokens(F.col("text")).cast("long")))
    placed = placed.withColumn("is_system", (F.col("start") == 0) & (F.col("role") == "system"))
    placed = stored(placed)
    system = placed.where("is_system").select(F.col("conv_id").alias("conv_"), F.col("text").alias("system"),
                                              F.col("tokens").alias("system_tokens"))
    same = F.col("conv_id").eqNullSafe(F.col("conv_"))
    sizes = placed.join(system.select("conv_", "system_tokens"), same, "left").select(
        "conv_id", "turn", "role", "text", "is_system", F.coalesce("system_tokens", F.lit(0)).alias("head"),
        "start")
    share = F.floor(F.greatest(F.lit(budget / 4), budget - history - F.col("head")) / 2)
    sizes = sizes.withColumn("share", share).withColumn("start", F.col("start") - F.col("head"))
    own = F.greatest(F.lit(0), F.floor(F.col("start") / F.col("share")))
    shown_next = ~F.col("is_system") & (F.col("start") + min(history, budget // 8) >= (own + 1) * F.col("share"))
    shown = F.concat(F.array(F.struct(own.alias("window"), F.lit(True).alias("own"))),
                     F.when(shown_next, F.array(F.struct((own + 1).alias("window"), F.lit(False).alias("own"))))
                     .otherwise(F.array().cast("array<struct<window:bigint,own:boolean>>")))
    rows = sizes.select("conv_id", "turn", "role", "text", "start", "is_system", F.explode(shown).alias("w"))
    turn = F.struct(F.col("start"), F.col("turn"), F.col("role"), F.col("text"), F.col("w.own").alias("own"))
    grouped = rows.groupBy("conv_id", F.col("w.window").alias("window")).agg(
        F.min(F.when(F.col("w.own"), F.col("start"))).alias("first"), F.array_sort(F.collect_list(turn)).alias("turns"),
        F.max("is_system").alias("has_system")).where(F.col("first").isNotNull())
    kept = grouped.withColumn("turns", F.filter("turns", lambda t: t["own"] | (
        t["start"] >= F.col("first") - min(history, budget // 8))))
    kept = kept.join(system.select("conv_", "system"), same, "left")
    again = F.col("system").isNotNull() & ~F.col("has_system")
    pieces = F.transform("turns", lambda t: F.struct(_head(t["role"]).alias("head"), escape(t["text"]).alias("body"),
                                                      (t["own"] & (t["role"] == TARGET)).alias("target"), t["own"].alias("own")))
    front = F.array(F.struct(_head(F.lit("system")).alias("head"), escape(F.col("system")).alias("body"),
                             F.lit(False).alias("target"), F.lit(False).alias("own")))
    built = kept.select("conv_id", "window", F.when(again, F.concat(front, pieces)).otherwise(pieces).alias("pieces"))
    none = F.array().cast("array<struct<start:int,length:int>>")

    def mark(s: Column, p: Column) -> Column:
        body = s["at"] + F.char_length(p["head"])
        span = F.array(F.struct(body.alias("start"), F.char_length(p["body"]).alias("length")))
        return F.struct((body + F.char_length(p["body"]) + len(CLOSE)).alias("at"),
                        F.when(p["target"], F.concat(s["loss"], span)).otherwise(s["loss"]).alias("loss"))

    loss = F.aggregate("pieces", F.struct(F.lit(0).alias("at"), none.alias("loss")), mark, lambda s: s["loss"])
    return built.select(
        "conv_id", "window",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.size(F.filter("pieces", lambda p: ~p["own"])).alias("repeated"), loss.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, window, turns, loss_text, formatted_chars): the new turns (role, text) and the targets of each window."""
    parts = F.filter(F.split("formatted", r"<\|im_start\|>", -1), lambda p: p != "")
    new = F.slice(parts, F.col("repeated") + 1, F.greatest(F.size(parts) - F.col("repeated"), F.lit(0)))
    body = r"(?s)^([^\\\n]*+(?:\\.[^\\\n]*+)*+)\n(.*)<\|im_end\|>\n$"
    turns = F.transform(new, lambda p: F.struct(unescape(F.regexp_extract(p, body, 1)).alias("role"),
                                                unescape(F.regexp_extract(p, body, 2)).alias("text")))
    loss = F.array_join(F.transform("loss", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["length"]))), "")
    return formatted.select("conv_id", "window", turns.alias("turns"), loss.alias("loss_text"),
                            F.char_length("formatted").alias("formatted_chars"))


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from its windows: number and digest of turns and targets, and size.

    A digest covers a whole conversation, so what is read back of it is put together in one row.
    """
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = read_back(formatted).select("conv_id", "formatted_chars", F.size("turns").alias("n"), F.struct(
        "window", lines.alias("lines"), F.col("loss_text").alias("loss")).alias("part"))
    whole = back.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"), F.sum("formatted_chars").cast("long").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"))
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.transform("parts", lambda p: p["lines"]), ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")
