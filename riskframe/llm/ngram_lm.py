"""Interpolated modified Kneser-Ney language model (operator 8).

Tokens are the words of a text (A-Z folded) and one end mark.  Counting runs
in Spark.  A first exchange numbers the vocabulary: a word is sent as its part
and place there.  Then one exchange for each order from the highest down: blocks of text
send their distinct n-grams with counts, dealt by n-gram hash, so the commonest
context's n-grams spread over all parts; each part merges them, stores a shard
of sorted hashes (five or six bytes each below their buckets), distinct rows of sums and a place among them
for each hash (two bits to sixteen, exceptions aside), and sends sums for the n-grams one word shorter
(as suffix: count and distinct predecessors; as context: followers' total and
number by multiplicity), which the next exchange deals by their hash, down to
the words.  Shards are plain ``.npy`` arrays in the shared folder; scoring
workers memory-map them and look up the n-grams of about a million tokens at a
time in hash order, each once: the n-gram that ends at a token is the context of
the next.  A lookup walks a shard forwards and no process ever loads the model.
Sorting, where most of the time goes, is of plain integers: an n-gram's places
among the words, or the upper bits of its hash, with its place in the lowest bits.
Only the counts of counts, a handful of numbers, reach the driver.

``p(w|h) = max(c(hw) - D(c), 0) / c(h) + gamma(h) p(w|h')`` with modified
discounts D1, D2, D3+ of each order; ``c`` is the count at the highest order
and in n-grams that start with the begin mark (nothing can precede them), else
the number of distinct predecessors.  Words are interpolated with the uniform
distribution over the vocabulary and one unknown word.  The shared folder must
be one that every worker can open as a path.
"""

from __future__ import annotations

import math
import mmap
import os
import uuid
from functools import partial
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.words import by_part, edges, mix, slices, word_hashes
from riskframe.session import ensure_checkpoint_dir, write_checkpoint_table

#: Hashes of the two marks; any fixed values that are not hashes of short words do.
BEGIN, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
BLOCK_BYTES, BLOCK_WORDS, SCORE_WORDS = 16 << 20, 4 << 20, 1 << 20
CHARS_PER_PART = 24_000_000
_PAIR = np.uint64(0xD1342543DE82EF95)
#: Sums of an n-gram: count, distinct predecessors, and as a context followers' total, followers of 1, 2, more.
STATS = ("c", "a", "t", "n1", "n2", "n3")
_SCHEMA = "part int, words binary, at array<binary>, kinds binary, kind binary, facts array<long>"


def _gram_hash(grams: np.ndarray) -> np.ndarray:
    """Hash of each row's words; a single word is its own hash."""
    h = grams[:, 0]
    for j in range(1, grams.shape[1]):
        h = mix(h * _PAIR + grams[:, j])
    return h


def _tokens(column: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram that ends at each token, place of the token in its row, row): rows end with END and start after BEGINs."""
    words, rows = word_hashes(column, lower=True)
    n = len(column)
    size = np.diff(rows) + 1
    ends = np.cumsum(size) - 1
    token = np.empty(len(words) + n, np.uint64)
    token[ends] = END
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner] = words
    place = np.arange(len(token)) - np.repeat(ends - size + 1, size)
    return _grams(token, place, order, BEGIN), place, np.repeat(np.arange(n), size)


def _grams(token: np.ndarray, place: np.ndarray, order: int, begin) -> np.ndarray:
    """The n-gram that ends at each token, filled up with ``begin`` at the start of a row."""
    grams = np.full((len(token), order), begin, token.dtype)
    grams[:, -1] = token
    for back in range(1, order):
        has = np.flatnonzero(place >= back)
        grams[has, order - 1 - back] = token[has - back]
    return grams


def _order(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of hashes in sorted order, sorted hashes): upper bits and place are sorted as one integer, then the few ties among upper bits."""
    bits = np.uint64(max(len(h), 1).bit_length())
    order = (np.sort((h >> bits << bits) | np.arange(len(h), dtype=np.uint64)) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    had = h[order]
    if (had[1:] < had[:-1]).any():
        order = order[np.argsort(had, kind="stable")]
        had = h[order]
    return order, had


def _heads(ordered: np.ndarray) -> np.ndarray:
    """First place of each run of equal values."""
    head = np.ones(len(ordered), bool)
    head[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(head)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values, axis=None)
    return values[_heads(values)]


def _places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct values, place of each value among them); values repeat often."""
    coded = pa.array(values).dictionary_encode()
    found = coded.dictionary.to_numpy(zero_copy_only=False)
    order = np.argsort(found, kind="stable")
    rank = np.empty(len(found), np.int64)
    rank[order] = np.arange(len(found))
    return found[order], rank[coded.indices.to_numpy(zero_copy_only=False)]


def _key(columns) -> tuple[np.ndarray, int]:
    """(one integer for each row of columns from 0 up, in the order of the rows, the bits it takes)."""
    key, bits = None, 0
    for x in columns:
        width = int(x.max(initial=0)).bit_length()
        if bits + width > 63:
            key = _places(key)[1]
            bits = int(key.max(initial=0)).bit_length()
        if bits + width > 63:
            x = _places(x)[1]
            width = int(x.max(initial=0)).bit_length()
        key, bits = x.astype(np.int64) if key is None else key << width | x, bits + width
    return key, bits


def _merge(grams: np.ndarray, sums: list[np.ndarray] | None) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted distinct n-grams (places among words), the columns of sums of equal ones added up; without sums each row counts one."""
    n, width = grams.shape[1], int(grams.max(initial=0)).bit_length()
    if n * width < 64:  # an n-gram is one integer
        key, bits = grams[:, 0].astype(np.int64), n * width
        for x in grams.T[1:]:
            key = key << width | x
    else:
        key, bits = _key(grams.T)
    more = len(key).bit_length()
    if sums is None and n * width < 64:
        order, key = None, np.sort(key)
    elif bits + more < 64:
        both = np.sort(key << more | np.arange(len(key)))
        order, key = both & ((1 << more) - 1), both >> more
    else:
        order = np.argsort(key)
        key = key[order]
    head = _heads(key)
    if n * width < 64:
        one = key[head]
        grams = np.stack([(one >> width * (n - 1 - j) & ((1 << width) - 1)).astype(grams.dtype) for j in range(n)], axis=1)
    else:
        grams = grams[order[head]]
    if sums is None:
        return grams, [_small(np.diff(head, append=len(key)))]
    return grams, [_small(np.add.reduceat(x[order].astype(np.int64), head)) for x in sums]


def _small(x: np.ndarray) -> np.ndarray:
    """Counts in as few bytes as the largest one takes."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


def _part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Contiguous hash ranges, so a shard's queries are one slice of the sorted hashes."""
    return ((h >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _pack(values: np.ndarray, dtype: str) -> bytes:
    """Integers as byte planes, each compressed by itself: a plane has its own frequencies, one of zeros takes nothing."""
    values = np.ascontiguousarray(values, dtype).view(f"<u{np.dtype(dtype).itemsize}")
    some = int(np.bitwise_or.reduce(values, initial=0))
    blobs = [pa.compress((values >> 8 * s).astype(np.uint8).tobytes(), codec="zstd", asbytes=True) if some >> 8 * s & 255 else b""
             for s in range(values.itemsize)]
    return np.array([len(values), *map(len, blobs)], "<u4").tobytes() + b"".join(blobs)


def _unpack(blob: bytes, dtype: str) -> np.ndarray:
    n, *sizes = np.frombuffer(blob, "<u4", 1 + np.dtype(dtype).itemsize).tolist()
    out, end = np.zeros(n, f"<u{np.dtype(dtype).itemsize}"), 4 + 4 * len(sizes)
    for s, size in enumerate(sizes):
        end += size
        if size:
            out |= np.frombuffer(pa.decompress(blob[end - size:end], n, codec="zstd"), np.uint8).astype(out.dtype) << 8 * s
    return out.view(dtype)


def _vocabulary(batches, parts: int):
    """Packed rows of a block's distinct words, one for each part of the vocabulary."""
    def deal(held):
        words = _distinct(np.concatenate([np.array([BEGIN, END]), *held]))
        runs = edges(part := _part_of(words, parts))
        return pa.RecordBatch.from_arrays(
            [pa.array([int(part[s]) for s, _ in runs], pa.int32()),
             pa.array([_pack(np.diff(words[s:e], prepend=np.uint64(0)), "<u8") for s, e in runs], pa.binary())], names=["part", "words"])
    held, size = [], 0
    for b in slices(batches, "text"):
        held.append(_distinct(word_hashes(b.column("text"), lower=True)[0]))
        size += len(held[-1])
        if size >= BLOCK_WORDS:
            yield deal(held)
            held, size = [], 0
    if held:
        yield deal(held)


def _vocabulary_shard(part: int, rows: list[dict], folder: str) -> pa.RecordBatch:
    words = _distinct(np.concatenate([np.cumsum(_unpack(r["words"], "<u8"), dtype=np.uint64) for r in rows]))
    _store(folder, f"v-{part}", words)
    return pa.RecordBatch.from_arrays([pa.array([len(words)], pa.int64())], names=["words"])


def _codes(folder: str, parts: int, words: np.ndarray) -> np.ndarray:
    """Part and place in the vocabulary of sorted words (all are in it); codes have the order of the words."""
    out = np.empty(len(words), np.int64)
    for s, e in edges(part := _part_of(words, parts)):
        out[s:e] = (part[s] << 32) + np.searchsorted(_map(folder, f"v-{part[s]}"), words[s:e])
    return out


def _words(folder: str, codes: np.ndarray) -> np.ndarray:
    """Words of sorted codes."""
    out = np.empty(len(codes), np.uint64)
    for s, e in edges(part := codes >> 32):
        out[s:e] = _map(folder, f"v-{part[s]}")[codes[s:e] & 0xFFFFFFFF]
    return out


def _by_rank(grams: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` words in the order of how often ``grams`` use them, by powers of two; words of the same power stay in their order."""
    seen = np.bincount(grams.ravel(), minlength=n)
    return np.argsort((64 - np.frexp(seen)[1]).astype(np.uint8), kind="stable")


def _steps(at: np.ndarray) -> list[np.ndarray]:
    """Columns of sorted n-grams as differences to the n-gram before, while all words before are the same."""
    out, head = [], np.zeros(len(at), bool)
    head[:1] = True
    for x in at.T:
        step = np.where(head, x, np.diff(x, prepend=0))
        out.append(step)
        head = head | (step != 0)
    return out


def _deal(words: np.ndarray, codes: np.ndarray, grams: np.ndarray, sums: list[np.ndarray] | None, parts: int, facts: list[int]) -> pa.RecordBatch:
    """Packed rows, one for each part: the codes of its words once, n-grams as places among them, distinct rows of sums (the missing ones are 0) and each n-gram's place among those."""
    by = _by_rank(grams, len(words))
    words, codes = words[by], codes[by]
    rank = np.empty(len(by), np.int32)
    rank[by] = np.arange(len(by))
    grams, sums = _merge(rank[grams], sums)
    kinds, kind = _kinds(sums)
    kinds = np.pad(kinds, ((0, 0), (0, len(STATS) - kinds.shape[1])))
    part = _part_of(_gram_hash(words[grams]), parts)
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")  # n-grams stay sorted in each part
    part, rows = part[order], []
    new = np.empty(max(len(words), len(kinds)), np.int32)
    for s, e in edges(part):
        mine, has = grams[order[s:e]], kind[order[s:e]]
        own = _distinct(mine)
        new[own] = np.arange(len(own))
        at = new[mine]
        used = _distinct(has)
        new[used] = np.arange(len(used))
        rows.append((int(part[s]), _pack(np.diff(codes[own], prepend=0), "<i8"), [_pack(x, "<u4") for x in _steps(at)],
                     _pack(kinds[used].ravel(), "<i8"), _pack(new[has], "<u4"),
                     facts if not rows else [0] * len(facts)))
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays(
        [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.list_(pa.binary())),
         *(pa.array(x, pa.binary()) for x in cols[3:-1]), pa.array(cols[-1], pa.list_(pa.int64()))],
        names=["part", "words", "at", "kinds", "kind", "facts"])


def _undeal(r: dict) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """(codes, n-grams as places among them, (distinct rows of sums, each n-gram's place among those)) of a packed row."""
    at = [_unpack(x, "<u4").astype(np.int64) for x in r["at"]]
    head = np.zeros(len(at[0]), bool)  # where an n-gram's first words are not those of the one before
    head[:1] = True
    for x in at:
        total = np.cumsum(x)
        new, start = x != 0, np.maximum.accumulate(np.where(head, np.arange(len(x)), 0))
        x[:] = total - (total - x)[start]
        head |= new
    kinds = _unpack(r["kinds"], "<i8").reshape(-1, len(STATS))
    return np.cumsum(_unpack(r["words"], "<i8")), np.stack(at, axis=1, dtype=np.int32, casting="unsafe"), (kinds, _unpack(r["kind"], "<u4"))


def _count(batches, folder: str, parts: int, order: int):
    def deal(held):
        token, place = map(np.concatenate, zip(*held))
        words, at = _places(np.concatenate([np.array([BEGIN]), token]))
        grams = _grams(at[1:].astype(np.int32), place, order, at[0])
        return _deal(words, _codes(folder, parts, words), grams, None, parts, [0] * (4 * order + 3))
    held, size = [], 0
    for b in slices(batches, "text"):
        grams, place, _ = _tokens(b.column("text"), 1)
        held.append((grams[:, 0], place))
        size += b.column("text").nbytes
        if size >= BLOCK_BYTES:
            yield deal(held)
            held, size = [], 0
    if held:
        yield deal(held)


def _store(folder: str, name: str, array: np.ndarray) -> None:
    """Write once under a private name, then rename: a retried or doubled task leaves a whole file."""
    path = f"{folder}/{name}.{uuid.uuid4().hex}"
    with open(path, "wb") as f:
        np.save(f, array)
    os.replace(path, f"{folder}/{name}.npy")


def _store_hashes(folder: str, name: str, h: np.ndarray) -> None:
    """Sorted hashes below their buckets of four or more on average: 32 bits and the last 16, or 8 where 24 bits name a bucket; the start of each bucket."""
    span, bits = int(h[-1] - h[0]) if len(h) else 0, 16
    while bits < 30 and (span >> 63 - bits) * 4 < len(h):
        bits += 1
    rest = 8 if bits >= 24 else 16
    top = (h >> np.uint64(64 - bits)).astype(np.int64)
    first = int(top[0]) if len(h) else 0
    starts = np.searchsorted(top, np.arange(first, int(top[-1]) + 2 if len(h) else 1))
    _store(folder, name.format("b"), np.concatenate([[bits, first], starts]).astype(np.min_scalar_type(max(len(h), first, bits))))
    _store(folder, name.format("m"), (h >> np.uint64(rest)).astype(np.uint32))
    _store(folder, name.format("l"), h.astype(np.uint8 if rest == 8 else np.uint16))


def _map(folder: str, name: str) -> np.ndarray:
    """A stored array of one dimension, mapped; its header is read by its fixed form, a parse costs more than a lookup."""
    with open(f"{folder}/{name}.npy", "rb") as f:
        whole = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    start = 10 + int.from_bytes(whole[8:10], "little")
    return np.frombuffer(whole, whole[10:start].split(b"'")[3].decode(), offset=start)


def _seek(folder: str, name: str, keys: np.ndarray) -> np.ndarray:
    """Place of each sorted key among stored hashes, -1 where absent."""
    buckets, mid, low = (_map(folder, name.format(x)) for x in "bml")
    out = np.full(len(keys), -1)
    if not len(mid):
        return out
    shift = np.uint64(8 * low.itemsize)
    top = (keys >> np.uint64(64 - int(buckets[0]))).astype(np.int64) - int(buckets[1])
    inside = np.flatnonzero((top >= 0) & (top < len(buckets) - 3))
    lo, end = (buckets[top[inside] + x].astype(np.int64) for x in (2, 3))
    want, rest = (keys[inside] >> shift).astype(np.uint32), keys[inside].astype(low.dtype)
    hi, last = end, len(mid) - 1
    for _ in range(int((hi - lo).max(initial=0)).bit_length()):
        half = (lo + hi) >> 1
        right = (mid[np.minimum(half, last)] < want) & (lo < hi)
        lo, hi = np.where(right, half + 1, lo), np.where(right, hi, half)
    while len(inside):  # hashes that differ in their last bits only stand side by side
        at = np.minimum(lo, last)
        same = (lo < end) & (mid[at] == want)
        hit = same & (low[at] == rest)
        out[inside[hit]] = lo[hit]
        more = same & ~hit
        inside, lo, end, want, rest = (x[more] for x in (inside, lo + 1, end, want, rest))
    return out


def _kinds(sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows of columns of sums, place of each row among them)."""
    found, at = _places(_key(sums)[0])
    some = np.empty(len(found), np.int64)
    some[at] = np.arange(len(at))
    return np.stack([x[some].astype(np.int64) for x in sums], axis=1), at


def _store_kinds(folder: str, name: str, kinds: np.ndarray, at: np.ndarray) -> None:
    """Distinct rows, the most frequent first, and each n-gram's place among them in 2, 4, 8 or 16 bits; the last code says that it is one of the exceptions, which are listed with their places."""
    seen = np.bincount(at, minlength=len(kinds))
    by = np.argsort(-seen, kind="stable")
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    at, seen = rank[at], seen[by]
    bits = min((2, 4, 8, 16), key=lambda b: b * len(at) / 8 + 8 * seen[(1 << b) - 1:].sum())
    odd = np.flatnonzero(at >= (1 << bits) - 1)
    code, per = np.minimum(at, (1 << bits) - 1).astype(np.uint16 if bits > 8 else np.uint8), max(8 // bits, 1)
    code = np.pad(code, (0, -len(code) % per)).reshape(-1, per)
    _store(folder, name.format("p"), np.bitwise_or.reduce(code << np.arange(per, dtype=code.dtype) * code.dtype.type(bits), axis=1))
    _store(folder, name.format("x"), np.concatenate([[bits], odd, at[odd]]).astype(np.uint32))
    _store(folder, name.format("s"), kinds[by].astype(np.min_scalar_type(int(kinds.max(initial=0)))).ravel())


def _kinds_at(folder: str, name: str, at: np.ndarray) -> np.ndarray:
    """Places among the distinct rows of the n-grams at these places."""
    code, odd = _map(folder, name.format("p")), _map(folder, name.format("x"))
    bits, n = int(odd[0]), len(odd) // 2
    per, last = max(8 // bits, 1), (1 << bits) - 1
    got = (code[at // per] >> (at % per * bits).astype(code.dtype) & code.dtype.type(last)).astype(np.int64)
    rare = np.flatnonzero(got == last)
    got[rare] = odd[1 + n + np.searchsorted(odd[1:1 + n], at[rare].astype(np.uint32))]
    return got


def _shard(part: int, rows: list[dict], folder: str, parts: int, k: int, order: int) -> pa.RecordBatch:
    """Merge a part's k-grams into a shard; return the sums of their suffixes and contexts, dealt by hash.

    ``facts`` adds up along the way: four counts of counts of each order, then tokens, vocabulary and the
    number of distinct predecessors of all words.
    """
    facts = np.sum([r["facts"] for r in rows], axis=0)
    own, grams, sums = zip(*map(_undeal, rows))
    codes = _distinct(np.concatenate(own))
    words = _words(folder, codes)
    grams = np.concatenate([np.searchsorted(codes, o).astype(np.int32)[g] for o, g in zip(own, grams)])
    by, h = _order(_gram_hash(words[grams]))
    head = _heads(h)
    h, grams = h[head], grams[by[head]]
    # At the highest order all sums but the counts are 0.
    sums = [_small(np.add.reduceat(np.concatenate([kinds[:, j][kind] for kinds, kind in sums])[by], head))
            for j in range(1 if k == order else len(STATS))]
    begin = words == BEGIN
    begun = begin[grams[:, 0]] & (k > 1)
    # Padded with more than one BEGIN: an n-gram of a lower order on its way down.
    whole = ~(begun & begin[grams[:, min(1, k - 1)]])
    c, seen = sums[0], sums[0] > 0
    count = c if k == order else np.where(begun, c, sums[1])
    table = [x[whole] for x in (count, *sums[2:], *([c] if k == 1 else []))]
    _store_hashes(folder, f"{k}-{{}}-{part}", h[whole])
    _store_kinds(folder, f"{k}-{{}}-{part}", *_kinds(table))
    facts[4 * k - 4:4 * k] += [int((count[whole & seen] == i).sum()) for i in (1, 2, 3, 4)]
    if k == 1:
        facts[-3:] += [int(x.sum(dtype=np.int64)) for x in (c, seen, count)]
        return pa.RecordBatch.from_arrays([pa.array([facts.tolist()], pa.list_(pa.int64()))], names=["facts"])
    # Suffixes give counts and predecessors, contexts the sums of followers.
    n, m = len(c), int(whole.sum())
    after = [np.concatenate([x, np.zeros(m, x.dtype)]) for x in (c, whole)]
    before = [np.concatenate([np.zeros(n, x.dtype), x[whole]]) for x in (count, count == 1, count == 2, count >= 3)]
    return _deal(words, codes, np.concatenate([grams[:, 1:], grams[whole, :-1]]), after + before, parts, facts.tolist())


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from counts of counts; an absent count falls back to 0.5, 1, 1.5."""
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.1), k - 0.05) for x, k in zip(d, (1, 2, 3)))


def _discount(c: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.where(c >= 3, d[2], np.where(c == 2, d[1], np.where(c == 1, d[0], 0.0)))


def _worth(table: np.ndarray, d: list[tuple[float, float, float]]) -> list[np.ndarray]:
    """Columns of rows of sums: the discounted count, and below the highest order the followers' total, what their discounts leave to this order, the plain count of words.

    ``d`` are the discounts of this order and, if any, the next: the followers' own.
    """
    table = table.astype(np.int64)
    c = table[:, 0]
    return [np.maximum(c - _discount(c, d[0]), 0), *table.T[1:2], *(table[:, 2:5] @ np.array(x) for x in d[1:]), *table.T[5:]]


def _find(folder: str, k: int, parts: int, keys: np.ndarray, width: int, d: list[tuple[float, float, float]]) -> list[np.ndarray]:
    """Worth of the sums of sorted k-gram hashes from memory-mapped shards; 0 where absent (a missing shard is an empty one)."""
    out = [np.zeros(len(keys)) for _ in _worth(np.zeros((1, width)), d)]
    for s, e in edges(part := _part_of(keys, parts)):
        name = f"{k}-{{}}-{part[s]}"
        if not os.path.exists(f"{folder}/{name.format('b')}.npy"):
            continue
        at = _seek(folder, name, keys[s:e])
        hit = np.flatnonzero(at >= 0)
        table, kind = _map(folder, name.format("s")).reshape(-1, width), _kinds_at(folder, name, at[hit])
        for x, y in zip(out, _worth(table if len(table) < len(kind) else table[kind], d)):
            x[s + hit] = y[kind] if len(table) < len(kind) else y
    return out


def _score(batches, folder: str, parts: int, order: int, totals: dict):
    types, vocab, total = totals["types"], totals["vocab"], totals["tokens"]
    d = totals["d"]
    rest = sum(map(math.prod, zip(d[0], totals["a"]))) / types if types else 1.0

    def score(held):
        ids, marks, token, place = zip(*held)
        token, place = np.concatenate(token), np.concatenate(place)
        words, at = _places(np.concatenate([np.array([BEGIN]), token]))
        kept, follows, left, raw = (x[at] for x in _find(folder, 1, parts, words, 6, d[:2]))
        raw = raw[1:]
        p = kept[1:] / max(types, 1) + rest / (vocab + 1)
        # A token's context is the n-gram that ends at the token before, a first token's the mark.
        follows, left = (np.where(place == 0, x[0], x[:-1]) for x in (follows, left))
        grams = _grams(token, place, order, BEGIN)
        for k in range(2, order + 1):
            by, h = _order(_gram_hash(grams[:, order - k:]))
            found = []
            for x in _find(folder, k, parts, h, 1 if k == order else 5, d[k - 1:k + 1]):
                found.append(np.empty_like(x))
                found[-1][by] = x
            # Near the start of a text the n-gram is shorter than k: the lower order stands.
            p = np.where((follows > 0) & (place + 2 >= k), (found[0] + left * p) / np.maximum(follows, 1), p)
            if k < order:
                follows, left = (np.concatenate([x[:1], x[:-1]]) for x in found[1:])
        base = np.log10((raw + 0.5) / (total + 0.5 * (vocab + 1)))
        start = np.flatnonzero(place == 0)  # each row has a token, its end
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(ids), pa.concat_arrays(marks), pa.array(np.diff(start, append=len(place))),
             pa.array(np.add.reduceat((raw > 0).astype(np.int64), start)), pa.array(np.full(len(start), total, np.int64)),
             pa.array(np.add.reduceat(base, start)), pa.array(np.add.reduceat(np.log10(p), start))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    held, size = [], 0
    for b in slices(batches, "text"):
        grams, place, _ = _tokens(b.column("text"), 1)
        held.append((b.column("doc_id"), b.column("held_out"), grams[:, 0], place))
        size += len(place)
        if size >= SCORE_WORDS:
            yield score(held)
            held, size = [], 0
    if held:
        yield score(held)


def _model_folder(spark) -> str:
    where = urlparse(ensure_checkpoint_dir(spark))
    if where.scheme not in ("", "file"):
        raise ValueError(f"the model needs a shared folder that workers can open as a path, not {where.scheme}://")
    folder = f"{where.path.rstrip('/')}/lm-{uuid.uuid4().hex}"
    os.makedirs(folder)
    return folder


def score_texts(docs: DataFrame, held_out=None, order: int = 2) -> DataFrame:
    """Train on rows where ``held_out`` is false, score all: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score (log10) of a model of n-grams up to ``order`` words (2 at least).

    ``held_out`` is a boolean column expression (default: crc32 of the id's
    text modulo 5 is 1; a NULL id counts as training).  NULL texts are empty:
    one end mark.  Only ``doc_id`` and ``text`` are read.  An empty table gives
    an empty result; without training rows all tokens are unknown.
    """
    if order < 2:
        raise ValueError(f"order must be 2 or more, not {order}")
    spark = docs.sparkSession
    if held_out is None:
        held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    base = docs.select("doc_id", "text", held_out.alias("held_out")).withColumn("doc_id", F.col("doc_id").cast("long"))
    chars = base.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars * order // (2 * CHARS_PER_PART)))
    folder = _model_folder(spark)
    train = base.filter(~F.col("held_out")).select("text")
    # Numbering the words first: n-grams are then sent as small numbers.
    train.mapInArrow(partial(_vocabulary, parts=parts), "part int, words binary").repartition(parts, "part").sortWithinPartitions(
        "part").mapInArrow(partial(by_part, settle=partial(_vocabulary_shard, folder=folder)), "words long").agg(F.sum("words")).first()
    sums = train.mapInArrow(partial(_count, folder=folder, parts=parts, order=order), _SCHEMA)
    for k in range(order, 0, -1):
        sums = sums.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(
            partial(by_part, settle=partial(_shard, folder=folder, parts=parts, k=k, order=order)),
            _SCHEMA if k > 1 else "facts array<long>")
    facts = write_checkpoint_table(sums, "word-facts")
    got = facts.agg(*(F.coalesce(F.sum(F.col("facts")[i]), F.lit(0)) for i in range(4 * order + 3))).first()
    tokens, vocab, types = got[-3:]
    totals = {"tokens": tokens, "vocab": vocab, "types": types, "a": (got[0], got[1], vocab - got[0] - got[1]),
              "d": [discounts(*got[4 * k:4 * k + 4]) for k in range(order)]}
    return base.mapInArrow(partial(_score, folder=folder, parts=parts, order=order, totals=totals),
                           "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                           "base_score double, score double")
