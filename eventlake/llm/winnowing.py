"""Benchmark decontamination by winnowing.

Every window of ``SPAN`` words keeps the k-gram with the least hash, so any shared run of ``SPAN``
words keeps the same k-gram on both sides. Fingerprints of documents and items are joined, and each
hit is extended word by word along both texts, which also rules out equal hashes of unequal words.
Item texts shorter than a window are one window of their own length, kept whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventlake.llm.common import alnum_words, bind, fresh, stored, text_key
from eventlake.operators.joins import BROADCAST_ROWS

SPAN, GRAM = 13, 5
SHARE = 20                 # contaminated from one word in so many
PLACE_BITS = 30            # a packed fingerprint: hash above, place of the k-gram below
PLACE_MASK = (1 << PLACE_BITS) - 1


def _packed(words: Column, gram: int, span: int) -> Column:
    """Distinct packed fingerprints of all windows; of equal hashes in a window the first is kept."""
    def of(held: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(1), F.size(held) - gram + 1), lambda i: F.xxhash64(
            F.slice(held, i, gram)).bitwiseAND(F.lit(~PLACE_MASK)).bitwiseOR(i.cast("long")))
        if span == gram:
            return grams
        return bind(grams, lambda g: F.array_distinct(F.transform(
            F.sequence(F.lit(1), F.size(g) - (span - gram)), lambda i: F.array_min(F.slice(g, i, span - gram + 1)))))

    return F.when(F.size(words) >= span, bind(words, of)).otherwise(F.array().cast("array<bigint>"))


def _fingerprints(words: Column, classes: list[tuple[int, int]]) -> Column:
    def of(gram: int, span: int) -> Column:
        return F.transform(_packed(words, gram, span), lambda p: F.struct(F.lit(span).alias("span"), p.alias("packed")))

    each = [of(*c) for c in classes]
    return each[0] if len(each) == 1 else F.concat(*each)


def _around(words: Column, span: Column, gram: Column, at: Column) -> tuple[Column, Column]:
    """The words before the k-gram at ``at`` (nearest first) and those from it on."""
    back = F.least(at - 1, span - gram)
    return F.reverse(F.slice(words, at - back, back)), F.slice(words, at, span)


def _run(left: Column, right: Column) -> Column:
    """How many first elements agree."""
    unequal = F.array_position(F.zip_with(left, right, lambda a, b: a.eqNullSafe(b)), False).cast("int")
    return F.when(unequal == 0, F.size(left)).otherwise(unequal - 1)


def _gram_of(span: Column) -> Column:
    return F.when(span == SPAN, F.lit(GRAM)).otherwise(span)


def _spread(rows: DataFrame) -> DataFrame:
    """One row per fingerprint with its hash, place and the words around it."""
    return rows.withColumn("hash", F.col("packed").bitwiseAND(F.lit(~PLACE_MASK))).withColumn(
        "at", F.col("packed").bitwiseAND(F.lit(PLACE_MASK)).cast("int"))


def _item_side(benchmark: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    items = benchmark.select("item_id", alnum_words(F.col("text")).alias("words")).where(F.size("words") > 0)
    short = items.where(F.size("words") < SPAN).select(F.size("words").alias("n")).distinct().collect()
    classes = [(GRAM, SPAN)] + sorted((r["n"], r["n"]) for r in short)  # at most SPAN - 1 short lengths
    own = F.filter(_fingerprints(F.col("words"), classes), lambda f: f["span"] == F.least(F.lit(SPAN), F.size("words")))
    rows = _spread(items.select("item_id", "words", F.explode(own).alias("f")).select("item_id", "words", "f.*"))
    before, after = _around(F.col("words"), F.col("span"), _gram_of(F.col("span")), F.col("at"))
    rows = rows.select("item_id", F.col("span").alias("item_span"), F.col("hash").alias("item_hash"),
                       before.alias("item_before"), after.alias("item_after"))
    return stored(rows.groupBy("item_span", "item_hash", "item_before", "item_after").agg(
        F.collect_set("item_id").alias("items"))), classes


def overlaps(docs: DataFrame, benchmark: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_key, n_words, n_hit, items, contaminated), one row per document.

    ``n_hit`` counts the document's words inside any occurrence of an item window, ``items`` lists
    the items that have one. A document is contaminated if at least one word in ``SHARE`` is hit.
    Null, empty and wordless texts have no words and no hits; so has every text when the benchmark
    is empty. Repeated rows stay repeated, items without an id count hits but are not listed, and
    other columns are not read. A benchmark with more fingerprints than ``broadcast_rows`` is joined
    by a shuffle, for which every fingerprint brings the words around it.
    """
    items, classes = _item_side(benchmark)
    texts = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), alnum_words(F.col("text")).alias("words"))
    whole = F.struct(F.lit(0).alias("span"), F.xxhash64("doc_id", "text_key").alias("packed"))
    rows = texts.select("doc_id", "text_key", "words", F.explode(F.concat(
        F.array(whole), _fingerprints(F.col("words"), classes))).alias("f")).select("doc_id", "text_key", "words", "f.*")
    rows = _spread(rows).withColumn("n", F.size("words"))
    before, after = _around(F.col("words"), F.col("span"), _gram_of(F.col("span")), F.col("at"))
    around = [F.when(F.col("span") > 0, before).alias("before"), F.when(F.col("span") > 0, after).alias("after")]
    same = (F.col("span") == F.col("item_span")) & (F.col("hash") == F.col("item_hash"))
    plain = ["doc_id", "text_key", "span", "hash", "at", "n"]
    met = (F.col("span") == 0) | F.col("items").isNotNull()
    if items.limit(broadcast_rows + 1).count() <= broadcast_rows:
        # only hits take the words around them along
        met = rows.join(F.broadcast(items), same, "left").where(met).select(
            *plain, "items", "item_before", "item_after", *around)
    else:
        met = rows.select(*plain, *around).join(items, same, "left").where(met)
    hit = F.col("items").isNotNull()
    runs = met.select("doc_id", "text_key", "span", "at", "items", "n",
                      F.when(hit, _run(F.col("before"), F.col("item_before"))).alias("left"),
                      F.when(hit, _run(F.col("after"), F.col("item_after"))).alias("right"))
    true_hit = (F.col("right") >= _gram_of(F.col("span"))) & (F.col("left") + F.col("right") >= F.col("span"))
    part = F.struct((F.col("at") - F.col("left")).alias("first"), (F.col("at") + F.col("right") - 1).alias("last"))
    docs_hit = runs.groupBy("doc_id", "text_key").agg(
        F.sum((F.col("span") == 0).cast("long")).alias("copies"), F.max("n").cast("long").alias("n_words"),
        F.array_sort(F.collect_set(F.when(true_hit, part))).alias("parts"),
        F.array_distinct(F.flatten(F.collect_set(F.when(true_hit, F.col("items"))))).alias("items"))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total"))
    covered = F.aggregate("parts", start, lambda s, p: F.struct(
        F.greatest(s["end"], p["last"]).alias("end"),
        (s["total"] + F.greatest(p["last"] - F.greatest(p["first"] - 1, s["end"]), F.lit(0))).alias("total")),
        lambda s: s["total"])
    counted = docs_hit.select("doc_id", "text_key", "n_words", covered.alias("n_hit"), "items", "copies")
    return counted.select("doc_id", "text_key", "n_words", "n_hit", "items",
                          ((F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words"))).alias("contaminated"),
                          F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated documents, all columns as they are."""
    key, id_, key_ = fresh(docs, "text_key"), fresh(docs, "found_id"), fresh(docs, "found_key")
    found = overlaps(docs, benchmark).where("contaminated").select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key_)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(key) == F.col(key_))
    return docs.withColumn(key, text_key(F.col("text"))).join(found, same, "left_anti").drop(key)
