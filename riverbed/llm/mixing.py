"""Temperature mixing of sources, realised as budgeted block permutations.

Weights are source token shares raised to an exponent and normalised. Exponent
1 keeps the corpus's own mix, 0 makes all sources equal. It is bisected to the
smallest value (the flattest mix) that keeps a limit: either the entropy of the
weights is at most a target, or no source is repeated more than a number of
times within the budget. Unless told otherwise, the target lies ``FLATTEN`` of
the way from the corpus's own entropy to that of an even mix, so sources of
different sizes always get an exponent between 0 and 1. Both only ever decide on sums over sources, so each
round of the search is one aggregation that tries 32 exponents at once; no
list of sources is held on the driver.

The budget of each source is dealt out in passes: whole passes over the source,
then part of one. The last pass takes the source's blocks (of about
``block_tokens`` tokens and at most about ``BLOCK_ROWS`` documents, by hash of
the document) in the order of a permutation
keyed by seed, source and pass, until its tokens are used up; in the block that
straddles the budget, documents are taken in hashed order while they fit.
Running sums go over 1024 ranges of the permutation first, then over the blocks
of a range, then over the documents of one block, so a source with a third of
all rows is never sorted in one task.

Defined cases: a NULL text has no tokens (and is drawn with its block); a NULL
source is a source of its own; sources without tokens get no weight and are
drawn once per whole pass like any other (a single pass); repeated rows are
rows of their own; an empty table gives an empty result. Columns other than
id, text and source are carried by the pipeline stage only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import stage_table

ROUNDS, GRID = 4, 32
MAX_EXPONENT = 8.0
RANGES = 1024
BLOCK_TOKENS = 100_000
BLOCK_ROWS = 20_000
MAX_EPOCHS = 4.0
FLATTEN = 0.5
SEED = 17


def token_counts(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """(rid, doc_id, source, n_tokens): whitespace words of the whole text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("n_tokens"))


def _measure(shares: DataFrame, alphas: list[float], budget: float | None, whole: bool) -> list[tuple]:
    """(entropy, most repetitions) of the mix at each exponent: one job."""
    p = F.col("tokens") / F.col("total")
    sums = []
    for i, a in enumerate(alphas):
        x = F.pow(p, F.lit(a))
        sums += [F.sum(x).alias(f"z{i}"), F.sum(x * F.log(p) * a).alias(f"l{i}"),
                 F.max(x / p).alias(f"m{i}"), F.min(x / p).alias(f"n{i}")]
    row = shares.agg(*sums).first()
    total = shares.select("total").first()
    out = []
    for i, _ in enumerate(alphas):
        z = row[f"z{i}"]
        entropy = math.log(z) - row[f"l{i}"] / z
        if whole:  # the least drawn source is drawn once
            most = row[f"m{i}"] / row[f"n{i}"]
        else:
            most = row[f"m{i}"] / z * budget / total[0]
        out.append((entropy, most))
    return out


def find_exponent(sources: DataFrame, target_entropy: float | None = None, max_epochs: float | None = None,
                  budget: float | None = None) -> float:
    """Smallest exponent in [0, 1] whose mix keeps the limits (the upper end
    if none does); with a target entropy the search goes up to MAX_EXPONENT,
    as a target below the corpus's own entropy needs an exponent over 1.
    ``sources``: (source, tokens > 0, total). Without a budget, the budget is
    the least that draws every source whole once."""
    lo, hi = 0.0, 1.0 if target_entropy is None else MAX_EXPONENT

    def fits(entropy, most):
        return (target_entropy is None or entropy <= target_entropy + 1e-12) and (
            max_epochs is None or most <= max_epochs * (1 + 1e-12))

    for _ in range(ROUNDS):
        grid = [lo + (hi - lo) * i / (GRID - 1) for i in range(GRID)]
        ok = [fits(*m) for m in _measure(sources, grid, budget, budget is None)]
        if ok[0]:
            return grid[0]
        first = next((i for i, x in enumerate(ok) if x), None)
        if first is None:
            return hi
        lo, hi = grid[first - 1], grid[first]
    return hi


def flattened_entropy(live: DataFrame, flatten: float) -> float:
    """The entropy ``flatten`` of the way from that of the sources' own shares
    to that of as many even ones."""
    p = F.col("tokens") / F.col("total")
    own, n = live.agg(-F.sum(p * F.log(p)), F.count(F.lit(1))).first()
    return own + flatten * (math.log(n) - own)


def mixing_weights(counts: DataFrame, target_entropy: float | None = None,
                   max_epochs: float | None = MAX_EPOCHS, budget: float | None = None,
                   flatten: float | None = FLATTEN):
    """(sources, exponent): per source tokens, rows, weight, whole passes and
    the tokens of the last pass."""
    by = counts.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    by = stage_table(by, "mix-sources")
    total = by.agg(F.sum("tokens")).first()[0] or 0
    live = by.filter("tokens > 0").withColumn("total", F.lit(float(total or 1)))
    if not total:
        return by.select("source", "tokens", "rows", F.lit(0.0).alias("weight"), F.lit(1).cast("bigint").alias("passes"),
                         F.lit(0.0).alias("rest")), 1.0
    if target_entropy is None and flatten is not None:
        target_entropy = flattened_entropy(live, flatten)
    alpha = find_exponent(live, target_entropy, max_epochs, budget)
    x = F.pow(F.col("tokens") / F.lit(float(total)), F.lit(alpha))
    z, least = live.agg(F.sum(x), F.min(x / F.col("tokens"))).first()
    scale = budget / z if budget is not None else 1.0 / least  # tokens drawn per unit of x
    drawn = F.when(F.col("tokens") > 0, x * F.lit(float(scale)) / F.col("tokens")).otherwise(F.lit(1.0))
    # A draw within a millionth of a whole pass is that whole pass.
    passes = F.floor(drawn + F.lit(1e-6))
    rest = F.greatest(drawn - passes, F.lit(0.0)) * F.col("tokens")
    return by.select("source", "tokens", "rows", F.when(F.col("tokens") > 0, x / F.lit(float(z))).otherwise(0.0)
                     .alias("weight"), passes.cast("bigint").alias("passes"),
                     F.when(rest < 1e-6 * F.col("tokens"), 0.0).otherwise(rest).alias("rest")), alpha


def _hash(*cols: Column) -> Column:
    return F.xxhash64(*cols)


def draw(docs: DataFrame, target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS,
         budget: float | None = None, block_tokens: int = BLOCK_TOKENS, seed: int = SEED,
         flatten: float | None = FLATTEN) -> DataFrame:
    """One row per draw: rid, doc_id, source, n_tokens, weight, epoch (0-based
    pass over the source) and block."""
    counts = stage_table(token_counts(docs), "mix-tokens")
    sources, _ = mixing_weights(counts, target_entropy, max_epochs, budget, flatten)
    n_blocks = F.greatest(F.ceil(F.col("tokens") / block_tokens), F.ceil(F.col("rows") / BLOCK_ROWS), F.lit(1))
    sources = stage_table(sources.withColumn("n_blocks", n_blocks.cast("bigint")).drop("rows"), "mix-plan")
    plan = sources.withColumnRenamed("source", "s")
    rows = counts.join(plan, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("block", F.pmod(_hash(F.lit(seed), "source", "doc_id", "rid"), F.col("n_blocks")))
    whole = rows.filter("passes > 0").select(
        "rid", "doc_id", "source", "n_tokens", "weight",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("passes") - 1)).alias("epoch"), "block")
    # The last, partial pass: running sums over ranges, blocks, documents.
    part = rows.filter("rest > 0")
    order = _hash(F.lit(seed + 1), "source", "passes", "block")
    blocks = (part.groupBy("source", "passes", "rest", "block").agg(F.sum("n_tokens").alias("t"))
              .withColumn("place", order)
              .withColumn("range", F.shiftright(F.col("place"), 54)))
    blocks = stage_table(blocks, "mix-blocks")
    ranges = blocks.groupBy(F.col("source").alias("rs"), F.col("range").alias("rr")).agg(F.sum("t").alias("rt"))
    up = Window.partitionBy("rs").orderBy("rr").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before_range", F.coalesce(F.sum("rt").over(up), F.lit(0))).drop("rt")
    inside = Window.partitionBy("source", "range").orderBy("place", "block").rowsBetween(
        Window.unboundedPreceding, -1)
    begin = F.col("before_range") + F.coalesce(F.sum("t").over(inside), F.lit(0))
    taken = (blocks.join(ranges, F.col("source").eqNullSafe(F.col("rs")) & (F.col("range") == F.col("rr")))
             .withColumn("begin", begin).filter(F.col("begin") < F.col("rest"))
             .select(F.col("source").alias("ts"), F.col("block").alias("tb"),
                     (F.col("rest") - F.col("begin")).alias("room"),
                     (F.col("begin") + F.col("t") <= F.col("rest")).alias("all")))
    drawn = part.join(taken, F.col("source").eqNullSafe(F.col("ts")) & (F.col("block") == F.col("tb")))
    keep = ["rid", "doc_id", "source", "n_tokens", "weight", F.col("passes").alias("epoch"), "block"]
    one = Window.partitionBy("source", "block").orderBy(_hash(F.lit(seed + 2), "doc_id", "rid"), "rid")
    edge = (drawn.filter("NOT all").withColumn("upto", F.sum("n_tokens").over(one))
            .filter(F.col("upto") <= F.col("room")))
    return whole.unionByName(drawn.filter("all").select(*keep)).unionByName(edge.select(*keep))
