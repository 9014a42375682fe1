"""Benchmark decontamination by spaced seeds (operator 7).

A spaced seed is a fixed mask over consecutive tokens: tokens under a 1 are
hashed, those under a 0 are ignored, so a substituted word between sampled
positions leaves the hash unchanged, and a few different masks cover most
substitution patterns.  Hashes of all windows of the corpus stream past the
benchmark's table of hashes; each hit is extended along its diagonal over the
whole item.  It counts where the best run of aligned tokens (+1 a match, -2 a
substitution) reaches ``MIN_SCORE``, or where the whole item stands there with
at most one substitution for every ``TOKENS_A_SUBSTITUTION`` tokens before the last.

The masks find nearly every such item of 13 tokens or more (measured by
enumeration in the tests).  A shorter one is sampled by all runs of half its
tokens, one of which a single substitution leaves whole; items of fewer than
``MIN_ITEM_TOKENS`` tokens are common phrases anywhere else and count where
they are a document's whole text.

The benchmark's hashes are broadcast only in blocks of at most
``BLOCK_HASHES`` rows; a larger benchmark takes several passes.  The corpus is
never shuffled: only hits are, after their diagonal's tokens are cut out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.quality_rules import words_of
from riskframe.session import write_checkpoint_table

#: Fixed masks: eight sampled tokens in a span of at most twelve.
MASKS = ("11011011011", "111010010111", "110100110111")
MIN_SCORE, MISMATCH = 12, -2
#: Whole items may differ in one token for each so many before their last: none up to 7 tokens, one up to 14, two up to 21.
TOKENS_A_SUBSTITUTION = 7
#: Items up to this length are sampled by runs of half their tokens, and shorter ones than the second by the whole.
SHORT_ITEM, WHOLE_BELOW = 12, 8
#: Items of fewer tokens must be a document's whole text.
MIN_ITEM_TOKENS = 6
BLOCK_HASHES = 500_000


def _tokens(text: Column) -> Column:
    """Hashes of the folded words without punctuation; words of punctuation alone are dropped."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}\x20\x09-\x0D]++", "")
    return F.transform(words_of(plain), lambda w: F.xxhash64(w))


def _windows(mask: str) -> Column:
    """Per window start, the hash of the tokens that ``mask`` samples."""
    at = [i for i, bit in enumerate(mask) if bit == "1"]
    tokens = F.col("tokens")
    return F.when(F.size(tokens) >= len(mask), F.transform(
        F.sequence(F.lit(0), F.size(tokens) - len(mask)),
        lambda s: F.xxhash64(F.lit(mask), *(F.get(tokens, s + i) for i in at)))).otherwise(F.array().cast("array<bigint>"))


def _run_length(n):
    """Tokens of the runs that sample a short item of ``n`` tokens."""
    return F.when(n < WHOLE_BELOW, n).otherwise(F.floor(n / 2)).cast("int")


def _hits(docs: DataFrame, items: DataFrame, masks: list[str], runs: list[int]) -> DataFrame:
    """Rows (doc_id, item, diagonal, near): near holds the document's tokens facing the item; ``runs``: run lengths of short items."""
    longest = max(map(len, masks))
    kinds = [*((m, 0) for m in masks), *(("1" * k, k) for k in runs)]
    masks = [m for m, _ in kinds]
    test = items.select("item", "tokens", F.size("tokens").alias("n")).select(
        "item", "n", F.explode(F.array(*(
            F.struct(F.lit(k).alias("run"), _windows(m).alias("hashes")) for m, k in kinds))).alias("w")).select(
        "item", "n", "w.run", F.posexplode_outer("w.hashes").alias("item_at", "hash")).filter(
        F.col("hash").isNotNull() & F.when(F.col("run") == 0, F.col("n") >= longest).otherwise(
            (F.col("n") <= SHORT_ITEM) & (_run_length(F.col("n")) == F.col("run")))).drop("run")
    test = write_checkpoint_table(test, "seeds")
    rows = test.count()
    blocks = max(1, -(-rows // BLOCK_HASHES))
    wide = docs.withColumn("windows", F.concat(*(_windows(m) for m in masks)))
    counts = [F.greatest(F.size("tokens") - (len(m) - 1), F.lit(0)) for m in masks]
    # The outer form keeps the optimizer from testing the windows' size (and so hashing them) once more below.
    opened = wide.select("doc_id", "tokens", *(c.alias(f"_c{i}") for i, c in enumerate(counts)),
                         F.posexplode_outer("windows").alias("_at", "hash"))
    start, below = F.col("_at"), F.lit(0)
    for i in range(len(masks)):
        start = F.when(F.col("_at") >= below, F.col("_at") - below).otherwise(start)
        below = below + F.col(f"_c{i}")
    found = []
    for b in range(blocks):
        part = test if blocks == 1 else test.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b)
        hit = opened.join(F.broadcast(part), "hash").withColumn("diagonal", start - F.col("item_at"))
        found.append(hit.select("doc_id", "item", "diagonal", F.slice(
            "tokens", F.greatest(F.col("diagonal"), F.lit(0)) + 1, F.col("n") + F.least(F.col("diagonal"), F.lit(0))).alias("near")))
    return reduce(DataFrame.union, found)


def _best_run(mine: str, theirs: str, skip: Column) -> Column:
    """Best score of a run of aligned tokens, with its end and length (Kadane over +1 / MISMATCH), and all matches."""
    zero = F.struct(F.lit(0).alias("hits"), F.lit(0).alias("run"), F.lit(0).alias("len"), F.lit(0).alias("best"), F.lit(0).alias("end"), F.lit(0).alias("width"))
    same = F.transform(mine, lambda t, i: F.struct((F.get(theirs, i + skip) == t).alias("same"), i.alias("i")))
    def step(a, x):
        run = a["run"] + F.when(x["same"], 1).otherwise(MISMATCH)
        dead, better = run <= 0, run > a["best"]
        width = a["len"] + 1
        return F.struct((a["hits"] + F.when(x["same"], 1).otherwise(0)).alias("hits"), F.when(dead, 0).otherwise(run).alias("run"), F.when(dead, 0).otherwise(width).alias("len"),
                        F.when(better, run).otherwise(a["best"]).alias("best"),
                        F.when(better, x["i"] + 1).otherwise(a["end"]).alias("end"),
                        F.when(better, width).otherwise(a["width"]).alias("width"))
    return F.aggregate(same, zero, step)


def contaminated(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS,
                 min_score: int = MIN_SCORE) -> DataFrame:
    """Rows (doc_id, item_id, score, first_token, last_token), one per document and item found in it.

    Tokens are words folded and stripped of punctuation; positions count them.
    Reads doc_id and text, item_id and text, so other columns may have any
    name.  NULL or empty texts and items and rows without an id match nothing;
    items of fewer than ``MIN_ITEM_TOKENS`` tokens match documents that hold
    nothing else.  Of several places of an item the one with the best score is
    given, the later one of equal scores.  Repeated rows give one result; an
    empty table an empty one.
    """
    items = write_checkpoint_table(
        benchmark.filter("item_id is not null").select(F.col("item_id").alias("item"), _tokens(F.col("text")).alias("tokens"))
                 .filter(F.size("tokens") > 0).distinct(), "items")
    size = F.size("tokens")
    lengths = [r[0] for r in items.select(size.alias("n")).filter(F.col("n") <= SHORT_ITEM).distinct().collect()]  # 12 at most
    runs = sorted({n if n < WHOLE_BELOW else n // 2 for n in lengths if n >= MIN_ITEM_TOKENS})
    base = docs.filter("doc_id is not null").select("doc_id", _tokens(F.col("text")).alias("tokens"))
    hits = _hits(base, items.filter(size >= MIN_ITEM_TOKENS), list(masks), runs)
    # Each item's tokens face the document's: one row per document, item and diagonal.
    lined = (hits.groupBy("doc_id", "item", "diagonal").agg(F.first("near").alias("near"))
             .join(items, "item"))
    skip = F.greatest(-F.col("diagonal"), F.lit(0))
    whole = F.col("run.hits") >= size - F.floor((size - 1) / TOKENS_A_SUBSTITUTION)
    scored = lined.withColumn("run", _best_run("near", "tokens", skip)).filter((F.col("run.best") >= min_score) | whole)
    end = F.greatest(F.col("diagonal"), F.lit(0)) + F.col("run.end")
    found = scored.select("doc_id", F.col("item").alias("item_id"), F.struct(
        F.col("run.best").alias("score"), (end - F.col("run.width")).alias("first"), end.alias("last")).alias("s"))
    if any(n < MIN_ITEM_TOKENS for n in lengths):
        tiny = items.filter(size < MIN_ITEM_TOKENS).select(F.col("item").alias("item_id"), "tokens")
        found = found.unionByName(base.filter(size < MIN_ITEM_TOKENS).join(tiny, "tokens").select(
            "doc_id", "item_id", F.struct(size.alias("score"), F.lit(0).alias("first"), size.alias("last")).alias("s")))
    return found.groupBy("doc_id", "item_id").agg(F.max("s").alias("s")).select(
        "doc_id", "item_id", F.col("s.score").cast("long").alias("score"),
        F.col("s.first").cast("long").alias("first_token"), F.col("s.last").cast("long").alias("last_token"))
