"""Repeated-substring removal by Rabin-Karp window hashes (operator 6).

Every window of 20 words gets two independent rolling hashes.  Windows are
dealt to parts by the first, each map block sending one packed row per part
(56 bits of the first hash and 24 of the second, positions as byte planes)
instead of a row per window.  A window that occurs again inside a block is
settled there and sends its place only, straight to its document's group: a
window that a third of all rows hold costs one hash per block, and its places
spread over all tasks.  In a part, all occurrences but the smallest (doc_id,
start) are repeats.  Their starts go back, packed per group of documents, to
one row per document, where overlapping windows merge into maximal removal
intervals.

The part count follows the corpus size, so a part holds about two million
windows at any size.  The part is a function of the first hash's 64 bits, so
two different windows are taken for one with probability 2^-88 (64 + 24 bits).
"""

from __future__ import annotations

import hashlib
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskframe.llm.words import (by_part, edges, from_planes, gram_hashes, mix, slices, text_bytes, to_planes, window_starts,
                                 word_hashes, word_spans)
from riskframe.session import write_checkpoint_table

WINDOW = 20
CHARS_PER_PART = 12_000_000
BLOCK_BYTES = 8 << 20
_LOW24 = np.uint64((1 << 24) - 1)
_SECOND_SALT = np.uint64(0x51AFD7ED558CCD5B)
_PART_SALT = np.uint64(0x8CB92BA72F3D8DD7)
_BLOBS = ("hashes", "first_docs", "first_runs", "first_gaps", "again_docs", "again_runs", "again_gaps")


def _pack_places(doc: np.ndarray, pos: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(doc, position) pairs sorted by both -> runs per document, positions as gaps."""
    if not len(doc):
        return b"", b"", b""
    new = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    gap = np.diff(pos, prepend=0)
    gap[new] = pos[new]
    return (to_planes(np.diff(doc[new], prepend=0), "<i8"),
            to_planes(np.diff(new, append=len(doc)), "<u4"), to_planes(gap, "<u4"))


def _unpack_places(docs: bytes, runs: bytes, gaps: bytes) -> tuple[np.ndarray, np.ndarray]:
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    run, gap = from_planes(runs, "<u4").astype(np.int64), from_planes(gaps, "<u4").astype(np.int64)
    total = np.cumsum(gap)
    first = np.cumsum(run) - run
    return np.repeat(np.cumsum(from_planes(docs, "<i8")), run), total - np.repeat(total[first] - gap[first], run)


def _first_places(h: np.ndarray, g: np.ndarray, doc: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by (hashes, doc, pos) and, along it, whether an entry has equal hashes at a smaller place."""
    order = np.lexsort((pos, doc, g, h))
    h, g, doc, pos = h[order], g[order], doc[order], pos[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    return order, (doc != doc[head]) | (pos != pos[head])


def _group(doc: np.ndarray, parts: int) -> np.ndarray:
    """The part that gathers a document's repeated starts."""
    return (mix(doc.view(np.uint64)) % np.uint64(parts)).astype(np.int64)


def _deal(h, g, doc, pos, parts: int):
    """Packed rows of one block, one for each part that has a window or a place; ``g`` is the second hash."""
    order, again = _first_places(h, g, doc, pos)
    h, g, doc, pos = h[order], g[order], doc[order], pos[order]
    part = np.where(again, _group(doc, parts), (mix(h ^ _PART_SALT) % np.uint64(parts)).astype(np.int64))
    order = np.lexsort((pos, doc, again, part))
    h, g, doc, pos, again, part = (x[order] for x in (h, g, doc, pos, again, part))
    edge = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(part)]
    rows = []
    for s, e in zip(edge[:-1].tolist(), edge[1:].tolist()):
        cut = s + int(np.searchsorted(again[s:e], True))
        bits = np.hstack([h[s:cut].view(np.uint8).reshape(-1, 8)[:, :7], g[s:cut].view(np.uint8).reshape(-1, 4)[:, :3]])
        rows.append((int(part[s]), bits.tobytes(), *_pack_places(doc[s:cut], pos[s:cut]), *_pack_places(doc[cut:e], pos[cut:e])))
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                      names=["part", *_BLOBS])


def _windows(batches, window: int, parts: int):
    held, size = [], 0
    for b in slices(batches, "text"):
        words, rows = word_hashes(b.column("text"))
        start, row = window_starts(rows, window)
        if len(start):
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            offset = b.column("offset").to_numpy(zero_copy_only=False)
            if int(offset.max()) + len(words) >= 1 << 32:
                raise ValueError("the different texts of one id hold 2^32 characters or more")
            second = (gram_hashes(mix(words ^ _SECOND_SALT), window)[start] & _LOW24).astype(np.uint32)
            held.append((gram_hashes(words, window)[start], second, ids[row], offset[row] + start - rows[:-1][row]))
            size += b.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield _deal(*map(np.concatenate, zip(*held)), parts)
            held, size = [], 0
    if held:
        yield _deal(*map(np.concatenate, zip(*held)), parts)


def _repeats(_, rows: list[dict], parts: int) -> pa.RecordBatch:
    """One part: every place whose window also starts earlier, packed for each group of documents."""
    hashes, docs, poss, rest_doc, rest_pos = [], [], [], [], []
    for r in rows:
        doc, pos = _unpack_places(r["first_docs"], r["first_runs"], r["first_gaps"])
        wide = np.zeros((len(doc), 16), np.uint8)
        bits = np.frombuffer(r["hashes"], np.uint8).reshape(-1, 10)
        wide[:, :7], wide[:, 8:11] = bits[:, :7], bits[:, 7:]
        hashes.append(wide.view(np.uint64).reshape(-1, 2))
        docs.append(doc)
        poss.append(pos)
        doc, pos = _unpack_places(r["again_docs"], r["again_runs"], r["again_gaps"])
        rest_doc.append(doc)
        rest_pos.append(pos)
    h, doc, pos = map(np.concatenate, (hashes, docs, poss))
    order, again = _first_places(h[:, 0], h[:, 1], doc, pos)
    take = order[again]
    doc, pos = np.concatenate([doc[take], *rest_doc]), np.concatenate([pos[take], *rest_pos])
    group = _group(doc, parts)
    order = np.lexsort((pos, doc, group))
    doc, pos, group = doc[order], pos[order], group[order]
    cuts = edges(group)
    packed = [_pack_places(doc[s:e], pos[s:e]) for s, e in cuts]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(group[s]) for s, _ in cuts], pa.int32())] +
        [pa.array([x[i] for x in packed], pa.binary()) for i in range(3)], names=["part", "docs", "runs", "gaps"])


def _documents(_, rows: list[dict]) -> pa.RecordBatch:
    """One group of documents: the repeated starts of each, as gaps."""
    doc, pos = map(np.concatenate, zip(*(_unpack_places(r["docs"], r["runs"], r["gaps"]) for r in rows)))
    order = np.lexsort((pos, doc))
    doc, pos = doc[order], pos[order]
    cuts = edges(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array([int(doc[s]) for s, _ in cuts], pa.int64()),
         pa.array([to_planes(np.diff(pos[s:e], prepend=0), "<u4") for s, e in cuts], pa.binary())],
        names=["doc_id", "starts"])


def _remove(batches, window: int):
    for b in slices(batches, "text"):
        data, offs = text_bytes(b.column("text"))
        start, end, rows = word_spans(data, offs)
        raw = data.tobytes()
        starts, offset, out = b.column("starts").to_pylist(), b.column("offset").to_numpy(zero_copy_only=False), []
        for i, blob in enumerate(starts):
            s, n = int(rows[i]), int(rows[i + 1] - rows[i])
            gone = np.zeros(n + 1, np.int64)
            if blob:
                at = np.unique(np.cumsum(from_planes(blob, "<u4").astype(np.int64))) - offset[i]
                at = at[(at >= 0) & (at + window <= n)]
                gone[at] += 1
                gone[at + window] -= 1
            covered = np.cumsum(gone)[:n] > 0
            step = np.diff(np.r_[False, covered, False].astype(np.int8))
            spans = list(zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()))
            kept = np.flatnonzero(~covered) + s
            text = b" ".join(raw[x:y] for x, y in zip(start[kept].tolist(), end[kept].tolist()))
            out.append((n, int(covered.sum()), hashlib.sha256(text).hexdigest(),
                        [{"start": x, "end": y} for x, y in spans], text.decode("utf-8", "replace")))
        cols = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2]),
             pa.array(cols[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(cols[4])],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "intervals", "kept_text"])


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_removed, kept_sha256, intervals (word start, end exclusive), kept_text.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name.
    NULL texts are empty; documents shorter than the window keep every word;
    rows with a NULL doc_id keep every word and hide no other.  Identical rows
    (same id and text) stand at the same place, so neither is earlier; the
    different texts of one id count as one document, one after the other in the
    order of their hashes (no window crosses them; at 2^32 characters of one id
    it raises).  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("t"), "text")
    rows = write_checkpoint_table(base.select("doc_id", "t", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("chars")), "rows")
    chars = rows.agg(F.sum("chars")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // CHARS_PER_PART))
    base = base.join(_offsets(rows), ["doc_id", "t"], "left").withColumn("offset", F.coalesce("offset", F.lit(0).cast("long")))
    blobs = ", ".join(f"{c} binary" for c in _BLOBS)
    dealt = base.filter("doc_id is not null").select("doc_id", "offset", "text").mapInArrow(
        partial(_windows, window=window, parts=parts), f"part int, {blobs}")
    found = dealt.repartitionById(parts, "part").sortWithinPartitions("part").mapInArrow(
        partial(by_part, settle=partial(_repeats, parts=parts)), "part int, docs binary, runs binary, gaps binary")
    starts = found.repartitionById(parts, "part").sortWithinPartitions("part").mapInArrow(
        partial(by_part, settle=_documents), "doc_id long, starts binary")
    starts = write_checkpoint_table(starts, "repeats")
    return base.join(starts, "doc_id", "left").select("doc_id", "offset", "text", "starts").mapInArrow(
        partial(_remove, window=window),
        "doc_id long, n_words long, n_removed long, kept_sha256 string, "
        "intervals array<struct<start:long,end:long>>, kept_text string")


def _offsets(rows: DataFrame) -> DataFrame:
    """(doc_id, t, offset) of ids with several texts: where each text starts among its id's words (counted by characters).

    A written table, so that its size is known before the corpus meets it: where no id repeats it is empty.
    """
    many = rows.filter("doc_id is not null").groupBy("doc_id").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).filter("lo < hi")
    texts = rows.join(many.select("doc_id"), "doc_id", "left_semi").groupBy("doc_id", "t").agg(F.max("chars").alias("chars"))
    before = Window.partitionBy("doc_id").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    return write_checkpoint_table(texts.select("doc_id", "t", F.coalesce(F.sum(F.col("chars") + 1).over(before), F.lit(0)).alias("offset")),
                                  "offsets")
