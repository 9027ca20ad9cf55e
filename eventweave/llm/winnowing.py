"""Document fingerprints by winnowing, in DataFrame functions only.

A text's tokens are its lower-cased words. Every run of ``gram`` tokens has a rolling hash;
of each window of ``window`` successive hashes the least is kept, the rightmost one on ties,
with its position. Any passage of ``window + gram - 1`` tokens that two texts share puts a
common hash into both fingerprints. A kept entry is one long: the upper 36 bits of the hash,
then 2^28 - 1 less the position, so that the plain minimum prefers the rightmost. Hashes of
longer runs and minima of longer windows come from those of half the length, so a text costs
a few linear passes over arrays.

Defined cases: null and blank texts have no entries; texts shorter than a gram have one, the
hash of all their tokens; fewer hashes than a window count as one window; two empty
fingerprints are alike (1), an empty and another are not (0); repeated rows fingerprint
alike; an empty table gives no rows; extra columns are ignored by ``edited_fingerprints``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.frames import need, no_text_as_empty

GRAM, WINDOW = 5, 16
POSITION_BITS = 28
_LAST = (1 << POSITION_BITS) - 1
#: Rows of one stretch of doc_ids, and the most stretches (a broadcast table of that size).
STRETCH, CELLS, SPLITS = 500, 1 << 14, 64


def _pairs(a: Column, b: Column, step: int, fn) -> Column:
    """fn(a[i], b[i + step]) for all i that have both."""
    n = F.greatest(F.size(b) - step, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(step + 1), n), fn)


def with_fingerprint(df: DataFrame, text: str, out: str, *, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """``df`` with ``out``: the kept entries of ``text`` in order of position."""
    words = F.trim(F.lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(" \t\n\x0b\x0c\r"))
    df = df.withColumn("_w", F.split(words, "[\\x20\\t-\\r]+"))
    df = df.withColumn("_h", F.when((F.size("_w") == 1) & (F.col("_w")[0] == ""), F.array().cast("array<bigint>"))
                       .otherwise(F.transform("_w", lambda x: F.xxhash64(x)))).drop("_w")
    df = df.withColumn("_g", F.col("_h"))
    have = 1
    while have < gram:                                  # runs of `have` tokens -> longer ones
        more = min(have, gram - have)
        other = F.col("_g") if more == have else F.col(f"_g{more}")
        if gram & have:
            df = df.withColumn(f"_g{have}", F.col("_g"))
        df = df.withColumn("_g", _pairs(F.col("_g"), other, have, lambda x, y: F.xxhash64(x, y)))
        have += more
    short = F.when(F.size("_h") > 0, F.array(F.xxhash64(F.col("_h")))).otherwise(F.col("_h"))
    df = df.withColumn("_g", F.when(F.size("_g") > 0, F.col("_g")).otherwise(short)).drop("_h", *[f"_g{1 << i}" for i in range(8)])
    keyed = F.transform("_g", lambda x, i: F.shiftleft(F.shiftright(x, POSITION_BITS), POSITION_BITS).bitwiseOR(F.lit(_LAST) - i.cast("bigint")))
    df = df.withColumn("_g", keyed).withColumn("_m", F.col("_g"))
    have = 1
    while have < window:
        step = min(have, window - have)
        df = df.withColumn("_m", _pairs(F.col("_m"), F.col("_m"), step, lambda x, y: F.least(x, y)))
        have += step
    least = F.when(F.size("_g") > 0, F.array(F.array_min("_g"))).otherwise(F.col("_g"))
    return df.withColumn(out, F.array_distinct(F.when(F.size("_m") > 0, F.col("_m")).otherwise(least))).drop("_g", "_m")


def hashes(entries: str) -> Column:
    return F.array_distinct(F.transform(entries, lambda v: F.shiftright(v, POSITION_BITS)))


def entries_text(entries: str) -> Column:
    """The entries as hexadecimal words: 36 bits of hash, 28 bits of position from the end."""
    return F.array_join(F.transform(entries, lambda v: F.hex(v)), " ")


def positions(entries: str) -> Column:
    """(hash, position) of every entry."""
    return F.transform(entries, lambda v: F.struct(F.shiftright(v, POSITION_BITS).alias("hash"), (F.lit(_LAST) - v.bitwiseAND(F.lit(_LAST))).alias("position")))


def with_likeness(df: DataFrame, a: str, b: str, out: str) -> DataFrame:
    """Shared hashes over all hashes of two fingerprints."""
    df = df.withColumn("_a", hashes(a)).withColumn("_b", hashes(b)).withColumn("_n", F.size(F.array_intersect("_a", "_b")))
    every = F.size("_a") + F.size("_b") - F.col("_n")
    return df.withColumn(out, F.when(every == 0, F.lit(1.0)).otherwise(F.col("_n") / every)).drop("_a", "_b", "_n")


def with_next(rows: DataFrame, key: str, values: list[str], tie: str) -> DataFrame:
    """``rows`` with ``next_<value>``: the row after it in descending ``key`` (nulls last, ties
    by ``tie``); the first row follows the last.

    Keys are cut into stretches of about ``STRETCH`` rows (equal-width cells, dense ones cut
    again; rows without a key are a cell that is cut by ``tie``); every stretch also gets the first
    row of the one that follows, and the rest is one shuffle and a window inside each stretch."""
    wide = F.col(key).cast("decimal(20,0)")
    low, high, n = rows.agg(F.min(wide), F.max(wide), F.count(F.lit(1))).first()
    if not n:
        return rows.select("*", *[F.col(v).alias(f"next_{v}") for v in values])
    low, high = (0, 0) if low is None else (int(low), int(high))
    width = (high - low) // max(1, min(CELLS, n // STRETCH)) + 1
    cell = F.coalesce(F.floor((wide - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)")).cast("int"), F.lit(-1))
    back = F.negative(F.col(tie).cast("decimal(20,0)"))
    keyed = rows.withColumn("_cell", cell).withColumn("_place", F.coalesce(wide, back))      # falls along the order, without a key too
    most = F.greatest(F.lit(SPLITS), F.floor(F.col("_n") * CELLS / F.lit(n)))                # a cell with many rows may have many
    cells = (keyed.groupBy("_cell").agg(F.min("_place").alias("_lo"), F.max("_place").alias("_hi"), F.count(F.lit(1)).alias("_n"))   # <= CELLS + 1 rows
             .withColumn("_k", F.least(most, F.ceil(F.col("_n") / (2 * STRETCH))).cast("decimal(20,0)"))
             .withColumn("_step", F.floor((F.col("_hi") - F.col("_lo")) / F.col("_k")).cast("decimal(20,0)") + 1).select("_cell", "_lo", "_step"))
    sub = F.floor((F.col("_place") - F.col("_lo")) / F.col("_step")).cast("int")
    dealt = keyed.join(F.broadcast(cells), "_cell").withColumn("_sub", sub).withColumn("_rank", F.struct("_place", back)).drop("_lo", "_step")
    ends = dealt.groupBy("_cell", "_sub").agg(F.max("_rank").alias("_first"))       # <= CELLS * (SPLITS + 1) + 1 rows
    inside = Window.partitionBy("_cell").orderBy("_sub")
    top = ends.groupBy("_cell").agg(F.max("_sub").alias("_top"), F.min("_sub").alias("_bottom"))
    over = Window.orderBy("_cell")                                                  # <= CELLS + 1 rows
    last = top.agg(F.min(F.struct("_cell", "_bottom"))).first()[0]                   # the stretch before the first is the last
    lowest = F.struct(F.lit(last["_cell"]).alias("c"), F.lit(last["_bottom"]).alias("s"))
    around = top.select("_cell", F.lead(F.struct(F.col("_cell").alias("c"), F.col("_bottom").alias("s"))).over(over).alias("_above"))
    guests = (ends.withColumn("_up", F.lead("_sub").over(inside)).join(around, "_cell")
              .select("_cell", "_sub", "_first", F.when(F.col("_up").isNotNull(), F.struct(F.col("_cell").alias("c"), F.col("_up").alias("s")))
                      .otherwise(F.coalesce(F.col("_above"), lowest)).alias("_to")))
    own = F.struct(F.col("_cell").alias("c"), F.col("_sub").alias("s"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("_to.c").alias("c"), F.col("_to.s").alias("s"), F.lit(1).alias("guest"))
    sent = (dealt.join(F.broadcast(guests), ["_cell", "_sub"])
            .withColumn("_at", F.explode(F.when(F.col("_rank") == F.col("_first"), F.array(own, guest)).otherwise(F.array(own))))
            .select(*rows.columns, F.col("_at.c").alias("_c"), F.col("_at.s").alias("_s"), F.col("_at.guest").alias("_guest")))
    order = Window.partitionBy("_c", "_s").orderBy("_guest", F.desc_nulls_last(key), tie)
    return (sent.select("*", *[F.lead(v).over(order).alias(f"next_{v}") for v in values])
            .filter("_guest = 0").drop("_c", "_s", "_guest"))


def edited_fingerprints(docs: DataFrame, *, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is replaced by the
    beginning of the next document's text, and their likenesses. Besides the digests, the
    entries are returned as ``entries`` and ``edited_entries``."""
    need(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), no_text_as_empty())
    rows = with_fingerprint(rows, "text", "entries", gram=gram, window=window).withColumn("tie", F.xxhash64("text"))
    rows = with_next(rows, "doc_id", ["text", "entries"], "tie")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))).drop("text", "next_text", "tie")
    rows = with_fingerprint(rows, "edited", "edited_entries", gram=gram, window=window)
    rows = with_likeness(with_likeness(rows, "entries", "edited_entries", "near_edited"), "entries", "next_entries", "near_next")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "entries", "edited_entries", "near_edited", "near_next")
