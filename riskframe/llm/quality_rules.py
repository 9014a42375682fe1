"""Quality rules: fixed rules and robust multivariate outliers (operator 5).

Word statistics are column expressions over one text.  Documents that pass the
fixed rules are judged by a minimum-covariance-determinant estimate of their
language and source: concentration steps keep the three quarters of a group
nearest to the current centre, re-estimate centre and covariance from them,
and repeat.  Several starts (``STARTS``) take the first steps; the one whose
kept rows have the least determinant takes the rest.  The estimate of a group
is blended with its language's, and that with the one of all rows, by
r / (r + ``SHRINK``), so groups of any size are treated alike (r counts the
rows beyond twice the number of statistics: fewer have no robust estimate).
The squared Mahalanobis distance of the transformed statistics, scaled to its
chi-square median, rejects far documents.

All group work is sums (map-side combined) and counts of fixed-width bins, so
a source that holds a third of all rows is no larger than any other in a
shuffle, and the same rows always give the same estimates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.session import write_checkpoint_table

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 8, 20, 30
#: Share of a group that a concentration step keeps, steps of every start, further steps of the best one, and
#: the rows of a group whose own estimate counts as much as its language's.
KEEP, FIRST_STEPS, STEPS, SHRINK = 0.75, 2, 3, 10
#: First distances: coordinate medians with the noise floor as spread, with the median deviations, with the sign covariance.
STARTS = ("floor", "deviation", "sign")
#: Chi-square with four degrees of freedom: median, and the rejection point (p = 5e-7), chosen by both error rates
#: on labelled rows (README): short clean texts scatter more than a normal law allows, junk starts at about 35.
CHI2_MEDIAN, CHI2_CUT = 3.3567, 35.0
#: Transformed statistics and the spread below which a difference means nothing (sampling noise of short texts).
STATS = {"s_word": 0.08, "s_symbol": 0.10, "s_upper": 0.10, "s_repeat": 0.15}
_BINS_PER_UNIT, _COARSE = 64, 32
_GROUP = ["g_level", "g_lang", "g_source"]


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for NULL."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def with_word_stats(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_upper, n_dup_lines, n_repeat_words to (doc_id, text, ...)."""
    body = F.coalesce("text", F.lit(""))
    bare = without(body, SPACES)
    lines = F.filter(F.split(body, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    k = REPEAT_WINDOW
    staged = (docs.withColumn("_hash", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)))
              .withColumn("_lines", lines)
              .withColumn("_grams", F.when(F.size("_hash") >= k, F.transform(
                  F.sequence(F.lit(1), F.size("_hash") - (k - 1)), lambda i: F.xxhash64(F.slice("_hash", i, k))))))
    again = F.size(F.array_distinct("_grams")) < F.size("_grams")
    staged = staged.withColumn("_sorted", F.when(again, F.array_sort(F.transform(
        "_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: x["h"] == F.get("_sorted", j)["h"]
    repeated = F.array_sort(F.transform(
        F.filter("_sorted", lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False))),
        lambda x: x["i"]))
    covered = F.aggregate(
        repeated, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(k), i + k - a["end"])).alias("n"), (i + k).alias("end")),
        lambda a: a["n"])
    return staged.select(
        *docs.columns, F.size("_hash").cast("long").alias("n_words"), F.length(bare).cast("long").alias("word_chars"),
        (F.length(body) - F.length(without(body, SYMBOLS))).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(bare, r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _share(a: str, b: str) -> Column:
    """Arcsine root of a share: its spread hardly depends on its size."""
    return F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / F.greatest(F.col(b), F.lit(1)))))


def _quantile(rows: DataFrame, keys: list[str], value: Column, share: float, name: str) -> DataFrame:
    """Per key, the upper edge of the first bin at which ``share`` of the rows is reached.

    Counts per bin give counts per coarse bin; the running sum goes over those
    and then over the bins of the coarse bin that reaches the share.
    """
    # Written, so that the counts are dealt by key and bin and not, for the windows' sake, by key alone.
    bins = write_checkpoint_table(
        rows.groupBy(*keys, F.floor(value * _BINS_PER_UNIT).alias("_bin")).agg(F.count("*").alias("_n")), "mcd-bins")
    coarse = bins.groupBy(*keys, F.floor(F.col("_bin") / _COARSE).alias("_coarse")).agg(F.sum("_n").alias("_m"))
    all_of = Window.partitionBy(*keys)
    coarse = (coarse.withColumn("_upto", F.sum("_m").over(all_of.orderBy("_coarse"))).withColumn("_all", F.sum("_m").over(all_of))
              .filter((F.col("_upto") >= share * F.col("_all")) & (F.col("_upto") - F.col("_m") < share * F.col("_all")))
              .select(*keys, "_coarse", (F.col("_upto") - F.col("_m")).alias("_below"), "_all"))
    fine = bins.withColumn("_coarse", F.floor(F.col("_bin") / _COARSE)).join(coarse, [*keys, "_coarse"])
    run = F.col("_below") + F.sum("_n").over(all_of.orderBy("_bin"))
    return fine.withColumn("_run", run).filter(F.col("_run") >= share * F.col("_all")).groupBy(*keys).agg(
        ((F.min("_bin") + 1) / _BINS_PER_UNIT).alias(name))


def _pairs() -> list[tuple[str, str]]:
    names = list(STATS)
    return [(x, y) for i, x in enumerate(names) for y in names[:i + 1]]


def _moments(rows: DataFrame, keys: list[str], weight: Column) -> DataFrame:
    """Rows, centre and covariance of the kept rows per key: n, m_*, c_*."""
    w = F.when(weight, 1.0).otherwise(0.0)
    sums = [F.sum(w).alias("n")] + [F.sum(w * F.col(x)).alias(f"t_{x}") for x in STATS] + [
        F.sum(w * F.col(x) * F.col(y)).alias(f"t_{x}_{y}") for x, y in _pairs()]
    n = F.col("n")
    return rows.groupBy(*keys).agg(*sums).select(
        *keys, "n", *((F.col(f"t_{x}") / n).alias(f"m_{x}") for x in STATS),
        *((F.col(f"t_{x}_{y}") / n - F.col(f"t_{x}") / n * F.col(f"t_{y}") / n).alias(f"c_{x}_{y}") for x, y in _pairs()))


def _factored(fit: DataFrame) -> DataFrame:
    """Add the Cholesky factor l_* of the covariance plus the noise floor, and its log determinant."""
    for i, x in enumerate(STATS):
        for j, y in enumerate(list(STATS)[:i + 1]):
            left = F.col(f"c_{x}_{y}") + (STATS[x] ** 2 if i == j else 0.0)
            for z in list(STATS)[:j]:
                left = left - F.col(f"l_{x}_{z}") * F.col(f"l_{y}_{z}")
            cell = F.sqrt(F.greatest(left, F.lit(STATS[x] ** 2 / 2))) if i == j else left / F.col(f"l_{y}_{y}")
            fit = fit.withColumn(f"l_{x}_{y}", cell)
    return fit.withColumn("log_det", 2 * sum(F.log(F.col(f"l_{x}_{x}")) for x in STATS))


def _distance(rows: DataFrame, fit: DataFrame, keys: list[str]) -> DataFrame:
    """Add d2, the squared Mahalanobis distance under ``fit`` (forward substitution)."""
    used = [*(f"m_{x}" for x in STATS), *(f"l_{x}_{y}" for x, y in _pairs())]
    out = rows.join(fit.select(*keys, *used), keys)
    for i, x in enumerate(STATS):
        left = F.col(x) - F.col(f"m_{x}")
        for y in list(STATS)[:i]:
            left = left - F.col(f"l_{x}_{y}") * F.col(f"_u_{y}")
        out = out.withColumn(f"_u_{x}", left / F.col(f"l_{x}_{x}"))
    return out.select(*rows.columns, sum(F.col(f"_u_{x}") ** 2 for x in STATS).alias("d2"))


def _per_stat(rows: DataFrame, keys: list[str], value, name: str) -> DataFrame:
    """Per key, the median of ``value(stat)`` of every statistic, as columns ``name_stat``."""
    long = rows.select(*keys, F.explode(F.array(*(F.struct(F.lit(x).alias("stat"), value(x).alias("value")) for x in STATS))).alias("e"))
    mid = _quantile(long.select(*keys, "e.*"), [*keys, "stat"], F.col("value"), 0.5, "mid")
    return mid.groupBy(*keys).agg(*(F.max(F.when(F.col("stat") == x, F.col("mid"))).alias(f"{name}_{x}") for x in STATS))


def _starts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start, m_*, c_*) of every start."""
    centre = write_checkpoint_table(_per_stat(rows, keys, F.col, "m"), "mcd-medians")
    spread = _per_stat(rows.join(centre, keys), keys, lambda x: F.abs(F.col(x) - F.col(f"m_{x}")), "s")
    centre = write_checkpoint_table(centre.join(spread, keys), "mcd-centres")
    diagonal = lambda name, size: centre.select(
        *keys, F.lit(name).alias("start"), *(f"m_{x}" for x in STATS), *((size(x) if x == y else F.lit(0.0)).alias(f"c_{x}_{y}") for x, y in _pairs()))
    wide = rows.join(centre, keys)
    unit = {x: (F.col(x) - F.col(f"m_{x}")) / F.greatest(F.col(f"s_{x}"), F.lit(STATS[x])) for x in STATS}
    length = F.sqrt(sum(u * u for u in unit.values()))
    signed = wide.select(*keys, *((F.when(length > 0, u / length).otherwise(0.0) * F.greatest(F.col(f"s_{x}"), F.lit(STATS[x]))).alias(x)
                                  for x, u in unit.items()))
    sign = _moments(signed, keys, F.lit(True)).select(*keys, *(f"c_{x}_{y}" for x, y in _pairs())).join(
        centre.select(*keys, *(f"m_{x}" for x in STATS)), keys)
    return diagonal("floor", lambda x: F.lit(0.0)).unionByName(
        diagonal("deviation", lambda x: (1.4826 * F.col(f"s_{x}")) ** 2)).unionByName(sign.withColumn("start", F.lit("sign")))


def _concentrate(rows: DataFrame, fit: DataFrame, keys: list[str]) -> DataFrame:
    """One step: centre and covariance of the ``KEEP`` share of each group that is nearest under ``fit``."""
    far = _distance(rows, fit, keys)
    log_d2 = F.log(F.col("d2") + 1e-6)
    # Per-group tables are written before they meet rows: with a known size, a small one is broadcast and no row moves.
    edge = write_checkpoint_table(_quantile(far, keys, log_d2, KEEP, "edge"), "mcd-edges")
    return write_checkpoint_table(_factored(_moments(far.join(edge, keys), keys, log_d2 <= F.col("edge"))), "mcd")


def mcd_fits(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key the minimum-covariance-determinant estimate: n (rows), m_*, c_*, and the start that it comes from."""
    several = rows.withColumn("start", F.explode(F.array(*map(F.lit, STARTS))))
    fit = write_checkpoint_table(_factored(_starts(rows, keys)), "mcd-starts")
    for _ in range(FIRST_STEPS):
        fit = _concentrate(several, fit, [*keys, "start"])
    order = F.array_position(F.array(*map(F.lit, STARTS)), F.col("start"))
    best = fit.groupBy(*keys).agg(F.min(F.struct("log_det", order.alias("place"), "start")).alias("b")).select(*keys, F.col("b.start").alias("start"))
    fit = write_checkpoint_table(fit.join(best, [*keys, "start"]), "mcd-best")
    for _ in range(STEPS):
        fit = _concentrate(rows, fit, keys)
    whole = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return write_checkpoint_table(fit.drop("n").join(whole, keys).join(best, keys), "mcd-fits")


def _blended(table: DataFrame, columns: list[str]) -> DataFrame:
    """(g_lang, g_source, columns) of the groups: each level mixed with the one above it."""
    def mix(own: DataFrame, above: DataFrame, on: list[str]) -> DataFrame:
        up = above.select(*on, *(F.col(c).alias(f"_{c}") for c in columns))
        n = F.greatest(F.col("n") - 2 * len(STATS), F.lit(0))   # fewer rows have no robust estimate of their own
        joined = own.join(up, on) if on else own.join(F.broadcast(up))     # one row of all
        return joined.select("g_lang", "g_source", "n", *(((n * F.col(c) + SHRINK * F.col(f"_{c}")) / (n + SHRINK)).alias(c) for c in columns))
    level = lambda k: table.filter(F.col("g_level") == k)
    return mix(level(0), mix(level(1), level(2), []), ["g_lang"]).drop("n")


def _levels(rows: DataFrame) -> DataFrame:
    """Every row three times: in its language and source, in its language, among all."""
    none = F.lit("")
    group = lambda k, lang, source: F.struct(F.lit(k).alias("g_level"), lang.alias("g_lang"), source.alias("g_source"))
    return rows.withColumn("_g", F.explode(F.array(
        group(0, F.col("lang"), F.col("source")), group(1, F.col("lang"), none), group(2, none, none)))).select("*", "_g.*").drop("_g")


def mcd_distances(passed: DataFrame) -> DataFrame:
    """Add d2: the squared distance to the blended MCD centre of the row's language and source, scaled so that its
    median (blended alike) is the chi-square's."""
    rows = write_checkpoint_table(_levels(passed.select("lang", "source", *STATS)), "judged")
    fit = _blended(mcd_fits(rows, _GROUP), [*(f"m_{x}" for x in STATS), *(f"c_{x}_{y}" for x, y in _pairs())])
    fit = write_checkpoint_table(_factored(fit).withColumnsRenamed({"g_lang": "lang", "g_source": "source"}), "mcd-blended")
    far = write_checkpoint_table(_distance(passed, fit, ["lang", "source"]), "distances")
    log_d2 = F.log(F.col("d2") + 1e-6)
    wide = _levels(far.select("lang", "source", "d2"))
    half = _quantile(wide, _GROUP, log_d2, 0.5, "half").join(wide.groupBy(*_GROUP).agg(F.count("*").alias("n")), _GROUP)
    half = _blended(write_checkpoint_table(half, "mcd-halves"), ["half"]).withColumnsRenamed({"g_lang": "lang", "g_source": "source"})
    half = write_checkpoint_table(half, "mcd-scales")
    scale = F.greatest(F.exp("half"), F.lit(CHI2_MEDIAN / 4)) / CHI2_MEDIAN
    return far.join(half, ["lang", "source"]).withColumn("d2", F.col("d2") / scale).drop("half")


def judge(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    Reads doc_id, text, lang and source only, so other columns may have any
    name.  NULL texts have no words and fail; NULL languages or sources form
    groups of their own; a group of few rows is judged mostly by the estimate
    of its language, and a language of few rows by that of all.  Repeated rows
    give equal rows; an empty table an empty result.
    """
    base = docs.select("doc_id", "text", F.coalesce("lang", F.lit("")).alias("lang"),
                       F.coalesce("source", F.lit("")).alias("source"))
    stats = write_checkpoint_table(with_word_stats(base).drop("text"), "word-stats")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    stats = (stats.withColumn("base_failed", failed)
             .withColumn("s_word", F.log(F.greatest(F.col("word_chars"), F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1))))
             .withColumn("s_symbol", _share("n_symbols", "word_chars"))
             .withColumn("s_upper", _share("n_upper", "word_chars"))
             .withColumn("s_repeat", _share("n_repeat_words", "n_words")))
    judged = mcd_distances(stats.filter(~F.col("base_failed")))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return (judged.select(*out, (F.col("d2") <= CHI2_CUT).alias("kept"), F.col("d2").alias("distance"))
            .unionByName(stats.filter("base_failed").select(
                *out, F.lit(False).alias("kept"), F.lit(None).cast("double").alias("distance"))))
