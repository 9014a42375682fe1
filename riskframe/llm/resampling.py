"""Target-distribution importance resampling over hashed word runs (operator 13).

A feature is a run of one or two consecutive words; its bucket is the crc32
of its UTF-8 bytes modulo the number of buckets.  Texts never become lists of
strings: every piece of a block of texts gets an Aho-Corasick automaton over
its distinct words, each bounded by a delimiter on either side and carrying
two payloads, the word's crc32 and its length.  One scan emits a payload for
every occurrence, and the crc32 of a two-word run is composed from adjacent
payloads: moving a crc over n more bytes is linear, so it is a few table
look-ups for the powers of two that make up n.  A dictionary lives as long as
its piece (``PIECE`` bytes), so memory does not grow with the vocabulary.

Counts per bucket are summed per task, then by Spark; the bucket table (at
most ``BUCKETS`` rows) is the only thing that returns to the workers.  Scores
are weight plus seeded Gumbel noise, whole numbers, so ranking needs one
number per distinct score and a window inside each score only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.words import slices, text_bytes
from riskframe.session import write_checkpoint_table

BUCKETS, SEED, MIN_WORDS, PERCENT = 10_000, 7, 20, 25
#: Bytes of text under one dictionary; a word that crosses the border stays whole.
PIECE = 4 << 20

#: Words are runs of 0-9, a-z (A-Z folded) and every byte of a non-ASCII character; other bytes delimit.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _zero_byte_tables() -> np.ndarray:
    """``t[k]`` moves a crc32 over 2^k zero bytes: four tables of 256 entries, one for each byte of the crc."""
    unit = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        unit = np.where(unit & 1, (unit >> 1) ^ np.uint32(0xEDB88320), unit >> 1)
    byte = np.arange(256, dtype=np.uint32)
    step = np.stack([unit, byte, byte << 8, byte << 16])  # c -> unit[c & 255] ^ (c >> 8)
    tables = []
    for _ in range(31):
        tables.append(step)
        step = _move(step, step)
    return np.stack(tables)


def _move(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255] ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])


_ZEROS = _zero_byte_tables()


def compose(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of two byte strings one after the other, from their own crc32s and the second's length."""
    moved = first.astype(np.uint32)
    for k in range(int(length.max()).bit_length() if len(length) else 0):
        at = np.flatnonzero((length >> k) & 1)
        moved[at] = _move(_ZEROS[k], moved[at])
    return moved ^ second.astype(np.uint32)


def _pieces(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, piece) with a delimiter at both ends; ``data`` starts and ends with one."""
    at = 0
    while at < len(data) - 1:
        cut = data.find(b" ", min(at + PIECE, len(data) - 1))
        yield at, data[at:cut + 1]
        at = cut


def payloads(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(crc32, length, end offset) of every word of folded ``data``, in order."""
    crcs, lengths, ends = [], [], []
    for offset, piece in _pieces(data):
        known = [w for w in set(piece.split(b" ")) if w]
        if not known:
            continue
        crc = np.array([zlib.crc32(w) for w in known], np.uint32)
        length = np.array([len(w) for w in known], np.int64)
        scan = ahocorasick.Automaton()
        for i, w in enumerate(known):  # Latin-1 keeps one character per byte
            scan.add_word(f" {w.decode('latin-1')} ", i)
        scan.make_automaton()
        found = np.fromiter(chain.from_iterable(scan.iter(piece.decode("latin-1"))), np.int64).reshape(-1, 2)
        crcs.append(crc[found[:, 1]])
        lengths.append(length[found[:, 1]])
        ends.append(found[:, 0] + offset)
    if not crcs:
        return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(crcs), np.concatenate(lengths), np.concatenate(ends)


def features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every feature of an Arrow text column, and the words of each row."""
    raw, offs = text_bytes(column)
    rows = len(offs) - 1
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    # Each text gets a delimiter after it, and one stands before the first.
    data = np.full(len(raw) + rows + 1, 32, np.uint8)
    data[np.arange(len(raw)) + 1 + np.repeat(np.arange(rows), np.diff(offs))] = raw
    crc, length, end = payloads(data.tobytes().translate(_FOLD))
    row = np.searchsorted(offs[1:] + np.arange(rows) + 1, end)
    pair = np.flatnonzero(row[1:] == row[:-1])
    space = np.full(len(pair), zlib.crc32(b" "), np.uint32)
    joined = compose(crc[pair], space, np.ones(len(pair), np.int64))
    joined = compose(joined, crc[pair + 1], length[pair + 1])
    both = np.concatenate([crc, joined]).astype(np.int64) % buckets
    return both, np.concatenate([row, row[pair]]), np.bincount(row, minlength=rows)


def _count(batches, buckets: int):
    total = np.zeros(buckets, np.int64)
    for b in slices(batches, "text"):
        total += np.bincount(features(b.column("text"), buckets)[0], minlength=buckets)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def _weigh(batches, gains: np.ndarray):
    for b in slices(batches, "text"):
        bucket, row, words = features(b.column("text"), len(gains))
        n = np.bincount(row, minlength=len(b)).astype(np.int64)
        total = np.zeros(len(b), np.int64)
        np.add.at(total, row, gains[bucket])
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(n), pa.array(words.astype(np.int64)), pa.array(total // np.maximum(n, 1))],
            names=["doc_id", "n_features", "n_words", "weight"])


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all features of ``text``; buckets without a feature are absent."""
    return texts.select("text").mapInArrow(partial(_count, buckets=buckets), "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, s, t, gain) for every bucket: floor(1000 ln) of the smoothed target share over the smoothed corpus share."""
    spark = docs.sparkSession
    both = (bucket_counts(docs, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(bucket_counts(target, buckets).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .unionByName(spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"),
                                                     F.lit(0).cast("long").alias("t")))
            .groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")))
    d = lambda c: F.col(c).cast("double")
    whole = lambda c: F.sum(c).over(Window.partitionBy()).cast("double")  # noqa: E731  over ``buckets`` rows
    return both.select("bucket", "s", "t", F.floor(1000.0 * F.ln(
        (d("t") + 1) * (whole("s") + buckets) / ((d("s") + 1) * (whole("t") + buckets)))).cast("long").alias("gain"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Draw ``percent`` of the documents so that they resemble ``target``, without replacement.

    Per document: doc_id, n_features, n_words, weight (floored mean gain of its
    features, 0 without one), score (weight plus the Gumbel noise of its id),
    rank (from 1 by falling score, ties by doc_id; NULL where not drawn).
    Among the documents with at least ``min_words`` words, floor(percent/100 of
    them) are drawn.  Only ``text`` (and ``doc_id`` of ``docs``) are read, so
    other columns may have any name.  NULL and empty texts have no feature; a
    NULL id takes the noise of an empty id and ranks after equal scores;
    repeated rows each count and are drawn on their own; empty tables give an
    empty result, an empty target gains that depend on the corpus alone.
    """
    # At most ``buckets`` rows, whatever the input.
    table = np.zeros(buckets, np.int64)
    for r in bucket_gains(docs, target, buckets).select("bucket", "gain").collect():
        table[r.bucket] = r.gain
    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", "text").mapInArrow(
        partial(_weigh, gains=table), f"doc_id {kind}, n_features long, n_words long, weight long")
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256),
                               1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000.0 * F.ln(-F.ln((noise + 0.5) / 4294967296.0)))
    scored = write_checkpoint_table(weighed.withColumn("score", (F.col("weight") + gumbel).cast("long")), "resampling")

    # Scores are whole numbers between fixed bounds (gains below 1000 ln 2^63, noise below 1000 ln 2^33): a small table.
    able = F.col("n_words") >= min_words
    counts = scored.filter(able).groupBy("score").agg(F.count("*").alias("n"))
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "score", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above"),
        F.floor(F.sum("n").over(Window.partitionBy()) * percent / 100).alias("drawn")).filter("above < drawn")
    named = scored.join(F.broadcast(counts), "score", "left").withColumn("chance", able & F.col("above").isNotNull())
    within = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), "n_features", "weight")
    place = F.col("above") + F.row_number().over(within)
    columns = ["doc_id", "n_features", "n_words", "weight", "score", "rank"]
    top = named.filter("chance").withColumn("place", place).withColumn(
        "rank", F.when(F.col("place") <= F.col("drawn"), F.col("place")).cast("long"))
    rest = named.filter("not chance").withColumn("rank", F.lit(None).cast("long"))
    return top.select(columns).unionByName(rest.select(columns))
