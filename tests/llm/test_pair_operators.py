"""Hard negatives, signature-tree join and importance resampling against brute force."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import hard_negatives as H
from riskframe.llm import resampling as R
from riskframe.llm import signature_join as S

FOLD = {i: i + 32 for i in range(65, 91)}


# ---------------------------------------------------------------- importance resampling

def _runs(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def _buckets(text, n=R.BUCKETS):
    return [zlib.crc32(f.encode()) % n for f in _runs(text)[1]]


@pytest.mark.parametrize("piece", [4 << 20, 3, 40])
def test_payloads_compose_to_every_bucket(monkeypatch, piece):
    monkeypatch.setattr(R, "PIECE", piece)
    rng = np.random.default_rng(3)
    texts = ["Hello World foo_bar  a", None, "", "é ü日本 ABC-def 99 É", " ", "x" * 5000 + " y " + "z" * 70,
             " ".join(f"w{i}" for i in rng.integers(0, 60, 400))]
    bucket, row, words = R.features(pa.array(texts), R.BUCKETS)
    for i, t in enumerate(texts):
        assert sorted(bucket[row == i].tolist()) == sorted(_buckets(t)) and words[i] == len(_runs(t)[0])


def test_compose_is_crc32_of_the_whole():
    rng = np.random.default_rng(4)
    left = [rng.bytes(int(n)) for n in rng.integers(0, 50, 40)]
    right = [rng.bytes(int(n)) for n in rng.integers(0, 3000, 40)]
    crc = lambda parts: np.array([zlib.crc32(p) for p in parts], np.uint32)
    got = R.compose(crc(left), crc(right), np.array([len(p) for p in right]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right)]


def _resampled(docs, target, percent, min_words):
    s, t = np.zeros(R.BUCKETS), np.zeros(R.BUCKETS)
    for texts, counts in ((docs, s), (target, t)):
        for _, text in texts:
            for b in _buckets(text):
                counts[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + R.BUCKETS) / ((s[b] + 1) * (t.sum() + R.BUCKETS)))) for b in range(R.BUCKETS)]
    rows = []
    for d, text in docs:
        own = _buckets(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(_runs(text)[0])))
    able = sorted((r for r in rows if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[:percent * len(able) // 100]
    rank = {id(r): i + 1 for i, r in enumerate(drawn)}
    return sorted(((r[0], *r[1:4], rank.get(id(r))) for r in rows), key=str)


def test_resample_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"W{w}" for w in rng.integers(0, 40 + 10 * (i % 7), int(rng.integers(0, 30))))) for i in range(120)]
    docs += [(7, docs[7][1]), (None, docs[9][1]), (500, None), (501, ""), (502, "long " * 30000)]
    target = [(1, "W1 W2 W3 W4"), (2, None), (3, "W1 W2")]
    frame = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, bucket int, score int").repartition(5)
    got = R.resample(frame, spark.createDataFrame(target, "item_id long, text string"), min_words=5).select(
        "doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in got), key=str) == _resampled(docs, target, R.PERCENT, 5)


def test_resample_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, none).count() == 0
    got = R.resample(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), none, min_words=1).collect()
    assert [(r.doc_id, r.n_features, r["rank"]) for r in got] == [(1, 3, None)]


# ---------------------------------------------------------------- signature trees

def _shingles(text, width=S.WIDTH):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)])


def _components(docs, percent=S.PERCENT):
    sets = [_shingles(t) for _, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(docs[i][0]), find(docs[j][0])
                root[max(x, y)] = min(x, y)
    return sorted(((d, len(s), None if d is None else find(d)) for (d, _), s in zip(docs, sets)), key=str)


def _texts(rng, families=12, size=14, words=70):
    docs = []
    for f in range(families):
        base = [f"f{f}w{i}" for i in range(int(rng.integers(5, words)))] + (["common"] * 3 + [f"c{i}" for i in range(25)])
        for _ in range(size):
            text = list(base)
            for at in rng.integers(0, len(text), int(rng.integers(0, 4))):
                text[at] = f"x{rng.integers(0, 10**6)}"
            docs.append((len(docs), " ".join(text)))
    return docs


@pytest.mark.parametrize("block", [S.BLOCK, 5])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)  # small blocks: most tokens need the second round
    docs = _texts(np.random.default_rng(6))
    long_text = " ".join(f"l{i}" for i in range(30000))
    docs += [(1000, None), (1001, ""), (1002, " \t "), (1003, "One two"), (1004, "one  TWO"), (1005, "two"), (None, docs[0][1]), (None, None),
             (1006, long_text), (1007, long_text + " end"), (3, docs[3][1]),
             # ids that repeat with different texts tie their components together
             (1008, docs[20][1]), (1008, "quite another text of its own"), (5, "words of a second text"), (1009, "words of a second text")]
    frame = spark.createDataFrame([(d, t, 0, 0) for d, t in docs], "doc_id long, text string, component int, node int").repartition(6)
    got = S.jaccard_components(frame)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _components(docs)


def test_join_of_an_empty_table(spark):
    assert S.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_second_round_gives_a_pair_at_its_first_common_token():
    row = lambda node, component, earlier: {"node": node, "n": 3, "component": component,
                                            "fine": np.array([1, 2, 3], np.uint16).tobytes(), "earlier": earlier}
    one, two = [row(1, 1, []), row(2, 2, []), row(3, 1, [])], [row(1, 1, [10]), row(2, 2, [10]), row(4, 4, [])]
    block = pa.list_(pa.struct([("node", pa.int64()), ("n", pa.int64()), ("component", pa.int64()), ("fine", pa.binary()),
                                ("earlier", pa.list_(pa.int64()))]))
    batch = lambda m, o, itself: pa.RecordBatch.from_arrays(
        [pa.array([m], block), pa.array([o], block), pa.array([itself])], names=["members", "others", "itself"])
    batches = [batch(one, one, True), batch(two, two, True), batch([row(5, 5, [10, 11])], two, False)]
    got = [(r["a"], r["b"]) for b in S._second_round(batches, S.PERCENT, S.FINE, S.shared_tokens(S.FINE, S.PERCENT)) for r in b.to_pylist()]
    assert sorted(got) == [(1, 2), (1, 4), (2, 3), (2, 4), (4, 5)]  # 1 and 2 once; 5 met 1 and 2 at token 10


def test_walk_loses_no_pair():
    rng = np.random.default_rng(7)
    need = S.shared_tokens(S.TOKENS, S.PERCENT)
    sets = []
    for f in range(30):
        base = rng.integers(0, 1 << 40, int(rng.integers(3, 60)))
        sets += [np.unique(np.where(rng.random(len(base)) < 0.04, rng.integers(0, 1 << 40, len(base)), base)) for _ in range(9)]
    sizes = np.array([100, 1, len(sets) - 101])
    forest = S.Forest(sizes, np.arange(len(sets)), np.array([len(s) for s in sets]), np.arange(len(sets)), S._bitmaps(sets, S.BITS), S.TOKENS)
    found = {(min(x, y), max(x, y)) for i, j, _ in S.walk(forest, forest, S.PERCENT, S.TOKENS, need, mirrored=True)
             for x, y in zip(forest.node[i].tolist(), forest.node[j].tolist())}
    block = np.repeat(np.arange(3), sizes)
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if block[i] == block[j]]
    linked = {(i, j) for i, j in pairs
              if 100 * len(np.intersect1d(sets[i], sets[j])) >= S.PERCENT * len(np.union1d(sets[i], sets[j]))}
    assert linked and linked <= found and len(found) < 0.3 * len(pairs)


# ---------------------------------------------------------------- hard negatives

def test_hilbert_curve_visits_every_cell_by_unit_steps():
    bits, dims = 3, 3
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = H.hilbert_index(cells, bits)
    assert sorted(place.tolist()) == list(range(1 << bits * dims))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_bounds_hold_every_inner_product():
    rng = np.random.default_rng(8)
    rows, anchors = rng.integers(-300, 300, (64, 9)), rng.integers(-300, 300, (20, 9))
    least, most = H.score_bounds(anchors, rows.min(0)[None], rows.max(0)[None])
    scores = H.inner_products(anchors, rows)
    assert (scores >= least).all() and (scores <= most).all()


def test_inner_products_beyond_doubles():
    a = np.array([[3_000_000_001, -7]], np.int64)
    assert H.inner_products(a, a).tolist() == [[3_000_000_001 ** 2 + 49]]
    big = np.array([[9 * 10 ** 18]], np.int64)
    assert H.inner_products(big, big).tolist() == [[np.iinfo(np.int64).max]]


def _mined(rows, every=100):
    kept = {}
    for v, e, label in rows:
        if v is None or e is None or label is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        kept[v, (label + 1) % 10 if v % 7 == 0 else label, tuple(math.floor(256 * x) for x in e)] = 1
    out = []
    for av, al, aq in kept:
        if av % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(aq, q)), v, label) for v, label, q in kept if v != av)
        for p, pid, _ in [r for r in scored if r[2] == al][:5]:
            inside = [r for r in scored if r[2] != al and 80 * -p <= 100 * -r[0] <= 100 * -p]
            out += [(av, pid, k + 1, r[1], -p, -r[0]) for k, r in enumerate(inside[:5])]
    return sorted(out)


def _vectors():
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(400):
        v = centres[i % 6] + 0.25 * rng.normal(size=16)
        rows.append((i * 5, np.float32(v / np.linalg.norm(v)).tolist(), int(rng.integers(0, 3))))
    rows += [(3000 + i, rows[0][1], i % 3) for i in range(40)]  # ties
    rows += [rows[3], rows[20], (4000, None, 1), (4001, rows[1][1], None), (None, rows[1][1], 1), (4003, [None] * 16, 1),
             (4004, [float("nan")] * 16, 1), (4005, [float("inf")] + [0.0] * 15, 1), (4006, rows[2][1][:9], 2), (4100, [], 1),
             (100, rows[8][1], 2)]  # an anchor's id again, with another vector
    return rows


@pytest.mark.parametrize("block_rows", [1024, 16])
def test_hard_negatives_equal_brute_force(spark, block_rows):
    rows = _vectors()
    frame = spark.createDataFrame([(v, e, c, 0, 0) for v, e, c in rows],
                                  "vec_id long, embedding array<float>, label int, block int, score int").repartition(4)
    got = H.hard_negatives(frame, block_rows=block_rows)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == _mined(rows)


def test_zone_maps_leave_blocks_unread(spark):
    rng = np.random.default_rng(10)
    near = [(i, (np.eye(8)[i % 8] + 0.01 * rng.normal(size=8)).tolist(), i % 2) for i in range(0, 8000, 5)]
    frame = spark.createDataFrame(near, "vec_id long, embedding array<double>, label int")
    blocks, dims = H.build_blocks(H.clean_vectors(frame).distinct(), block_rows=50)
    zones = blocks.groupBy(H.F.lit(0).cast("long").alias("shard")).agg(
        H.F.collect_list(H.F.struct("block", "low", "high", "labels", "counts")).alias("zones"))
    packs = blocks.filter(H.F.size("anchor_ids") > 0).select(
        H.F.col("block").alias("pack"), H.F.array(H.F.struct("block", "anchor_ids", "anchor_labels", "anchor_vectors", "floors")).alias("anchors"))
    read = H._read_by(packs, blocks, zones, 1, dims, False).count()
    assert 0 < read < 0.5 * blocks.count() * packs.count()


def test_hard_negatives_of_an_empty_table(spark):
    assert H.hard_negatives(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
