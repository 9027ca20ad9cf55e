"""Mixing sources to target weights, in DataFrame functions only.

Documents are counted into cells (source, language, topic). Iterative proportional fitting
rakes the token weight of the cells to the target of each marginal in turn, ``sweeps`` times
over all of them. A cell's factor, raked over counted tokens, divided by the largest factor,
is the probability with which each of its documents is kept, so kept tokens follow the targets
in expectation and no document is needed twice. The draw is a hash of doc_id: it does not
depend on partitioning, and a rerun keeps the same documents.

So the cell that is rarest against its target sets the kept share of the whole corpus. With
``budget`` (tokens) the draw keeps that many tokens in expectation instead: a cell's weight is
capped at its tokens in every step of the raking, so the others make up for cells that are kept
whole, and the probability is min(1, c * factor) with c solved over the cells. Values with too
few tokens for their target then fall short of it. The registered query has no budget.

Targets are shares proportional to tokens^alpha of each value (alpha 1 keeps the corpus, 0
makes values equal), or a table of shares. Cells are aggregated before any shuffle by them;
raking only handles cells.

Defined cases: null source, language or topic count as the value "(none)"; null and blank
texts have no tokens: they take part in the draw with their cell's probability, 1 if the
whole cell has no tokens; equal doc_ids (null among them) are drawn alike; an empty table
gives no rows; extra columns are kept by ``mix`` (its own names are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventweave.llm.frames import need, stored

NONE = "(none)"
DIMENSIONS = ("source", "lang", "topic")
#: Fixed parameters of the registered query.
ALPHAS = {"source": 0.5, "lang": 0.7, "topic": 0.8}
SWEEPS, SEED = 8, "mix-1"


def words(text: str = "text") -> Column:
    """Number of words of a text."""
    trimmed = F.trim(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[\\x20\\t-\\r]+"))).cast("long")


def topic(text: str = "text") -> Column:
    """What a text looks like, from marks that it holds."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return (F.when(t.contains(" | "), "table").when(t.contains("License"), "legal")
            .when(t.contains("@"), "contact").when(F.char_length(t) < 500, "short").otherwise("prose"))


def targets(cells: DataFrame, dimension: str, alpha: float) -> DataFrame:
    """(dimension, share): tokens^alpha of each value, of their sum."""
    tokens = cells.groupBy(dimension).agg(F.sum("tokens").alias("t")).withColumn("p", F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), F.lit(alpha))).otherwise(0.0))
    every = tokens.agg(F.sum("p")).first()[0]
    return tokens.select(dimension, (F.col("p") / F.lit(every) if every else F.lit(0.0)).alias("share"))


def rake(cells: DataFrame, shares: dict[str, DataFrame], *, sweeps: int = SWEEPS, budget: float | None = None) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``factor``, raked weight over tokens. Each step scales
    the cells of a value to its target; the sums are windows over the cells of the value. With a
    ``budget`` targets are tokens of it, and no cell weighs more than its tokens."""
    for d, share in shares.items():
        cells = cells.join(share.withColumnRenamed("share", f"_{d}"), d)
    cells = cells.withColumn("w", F.col("tokens").cast("double"))
    for _ in range(sweeps):
        for d in shares:
            total = F.sum("w").over(Window.partitionBy(d))
            goal = F.col("w") * F.col(f"_{d}") / total
            if budget is not None:
                goal = F.least(goal * F.lit(float(budget)), F.col("tokens").cast("double"))
            cells = cells.withColumn("w", F.when(total > 0, goal).otherwise(0.0))
    return cells.withColumn("factor", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens"))).drop("w", *[f"_{d}" for d in shares])


def scale(raked: DataFrame, budget: float) -> float:
    """c for which the cells' tokens times min(1, c * factor) sum to ``budget``, infinite if they
    cannot. Every round keeps at least one more cell whole; it ends when none is added."""
    c, whole = 0.0, -1
    weight = F.col("factor") * F.col("tokens")
    while True:
        full = F.col("factor") * F.lit(c) >= 1
        n, kept, rest = raked.filter("factor > 0").agg(F.count_if(full), F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, weight))).first()
        if not rest:
            return float("inf")
        if n == whole:
            return c
        c, whole = (float(budget) - (kept or 0)) / rest, n


def draw(doc_id: str, seed: str) -> Column:
    """A number in [0, 1) from a hash of the id: 32 bits of its MD5."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(NONE)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def mix(docs: DataFrame, *, alphas: dict[str, float] | None = None, shares: dict[str, DataFrame] | None = None, sweeps: int = SWEEPS,
        seed: str = SEED, tokens: Column | None = None, topic_of: Column | None = None, budget: float | None = None) -> DataFrame:
    """``docs`` with ``topic, n_tokens, weight`` (the cell's factor over the mean one),
    ``probability`` and ``selected``; source, lang and topic are given as they were raked.
    ``budget``: tokens to keep in expectation; None keeps the most at which no cell is capped."""
    if budget is not None and not budget > 0:
        raise ValueError("budget must be positive")
    need(docs, "doc_id", "text", "source", "lang")
    own = docs.drop("topic", "n_tokens", "weight", "probability", "selected")
    known = (own.withColumn("n_tokens", words() if tokens is None else tokens).withColumn("topic", topic() if topic_of is None else topic_of)
             .withColumns({d: F.coalesce(F.col(d).cast("string"), F.lit(NONE)) for d in DIMENSIONS}))
    cells = stored(known.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    shares = shares or {d: targets(cells, d, a) for d, a in (alphas or ALPHAS).items()}
    raked = stored(rake(cells, shares, sweeps=sweeps, budget=budget), "raked-cells")
    most, mean = raked.agg(F.max("factor"), F.sum(F.col("factor") * F.col("tokens")) / F.sum("tokens")).first()

    def part_of(whole: float | None) -> Column:
        return F.round(F.coalesce(F.col("factor") / F.lit(whole), F.lit(1.0)) if whole else F.lit(1.0), 9)
    chance = part_of(most)
    if budget is not None:
        c = scale(raked, budget)
        part = F.least(F.lit(1.0), F.col("factor") * F.lit(c)) if c != float("inf") else F.when(F.col("factor") > 0, 1.0).otherwise(F.col("factor"))
        chance = F.round(F.coalesce(part, F.lit(1.0)), 9)
    cell = raked.select(*DIMENSIONS, part_of(mean).alias("weight"), chance.alias("probability"))
    return known.join(cell, list(DIMENSIONS)).withColumn("selected", draw("doc_id", seed) < F.col("probability"))


def oracle_sql(alphas: dict[str, float], sweeps: int, seed: str) -> str:
    """DuckDB SQL for ``doc_id, source, lang, topic, n_tokens, weight, probability, selected``."""
    word = r"[^\x20\x09-\x0D]+"
    known = f"""SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
      CASE WHEN contains(coalesce(text, ''), ' | ') THEN 'table' WHEN contains(coalesce(text, ''), 'License') THEN 'legal'
           WHEN contains(coalesce(text, ''), '@') THEN 'contact' WHEN length(coalesce(text, '')) < 500 THEN 'short' ELSE 'prose' END AS topic,
      len(regexp_extract_all(coalesce(text, ''), '{word}')) AS n_tokens FROM documents"""
    steps = [f"known AS ({known})", "cells AS (SELECT source, lang, topic, sum(n_tokens)::BIGINT AS tokens FROM known GROUP BY ALL)"]
    for d, a in alphas.items():
        steps.append(f"t_{d} AS (SELECT {d}, CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {a}) ELSE 0 END AS p FROM cells GROUP BY {d})")
        steps.append(f"s_{d} AS (SELECT {d}, p / sum(p) OVER () AS share FROM t_{d})")
    steps.append("w0 AS (SELECT cells.*, tokens::DOUBLE AS w FROM cells)")
    i = 0
    for _ in range(sweeps):
        for d in alphas:
            steps.append(f"w{i + 1} AS MATERIALIZED (SELECT x.* REPLACE (CASE WHEN sum(w) OVER (PARTITION BY x.{d}) > 0 THEN w * share / sum(w) OVER (PARTITION BY x.{d}) ELSE 0 END AS w) "
                         f"FROM w{i} x JOIN s_{d} ON x.{d} = s_{d}.{d})")
            i += 1
    steps.append(f"f AS (SELECT *, CASE WHEN tokens > 0 THEN w / tokens END AS factor FROM w{i})")
    steps.append("""cell AS (SELECT source, lang, topic, round(coalesce(factor / (SELECT sum(factor * tokens) / sum(tokens) FROM f), 1), 9) AS weight,
      round(coalesce(factor / (SELECT max(factor) FROM f), 1), 9) AS probability FROM f)""")
    return f"""WITH {', '.join(steps)}
    SELECT doc_id, source, lang, topic, n_tokens, round(weight, 6) AS weight, round(probability, 6) AS probability,
      ('0x' || substr(md5('{seed}:' || coalesce(doc_id::VARCHAR, '{NONE}')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 < probability AS selected
    FROM known JOIN cell USING (source, lang, topic)"""
