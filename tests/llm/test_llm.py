"""Operators against brute force, and the cases that every operator defines: NULLs, empty and
very long texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from riskframe.llm import (decontaminate, html_extract, near_dedup, ngram_lm, packing, pii, quality_classifier,
                           quality_rules, substring_dedup, url_filter)

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BASE = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    (1, BASE), (2, BASE), (3, BASE.replace("w30 ", "x ").replace("w3 ", "W3 ")), (4, None), (5, ""), (6, " \t\n"), (7, "one two three"),
    (8, "ONE two three"), (9, "mail a@b.co.uk or 10.0.0.1, card 4111 1111 1111 1111, call +1 (555) 123-4567"),
    (10, "é😀 x@y.zz\u00a0q " + "the " * 400), (11, " ".join(f"u{i}" for i in range(25)) + " " + BASE), (11, " ".join(f"u{i}" for i in range(25)) + " " + BASE),
    (None, BASE), (12, "long" * 20_000), (13, "###!! " * 30 + "\nA B\nA B"), (14, " ".join(f"v{i % 37}" for i in range(3000))),
]
#: Extra columns whose names operators use inside.
CLASH = "id, n, value, component, tokens, starts, part, bucket, rows, label, _words, _grams, held_out, sketch"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame([(d, t, "en", None if d == 5 else "s") for d, t in TEXTS], "doc_id long, text string, lang string, source string")
    return frame.selectExpr("*", *(f"'x' AS {c.strip()}" for c in CLASH.split(",")))


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(t):
    return WORD.findall(t or "")


def test_pii(spark, docs, sample):
    def brute(t):
        t, out = t or "", []
        rules = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                 "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
        for rank, (kind, rule) in enumerate(rules.items()):
            for m in re.finditer(rule, t):
                d = re.sub("[^0-9]", "", m[0])
                odd = sum((v - 9 if v > 9 else v) for v in (int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))))
                if {"email": True, "ip": kind != "ip" or all(int(x) < 256 for x in m[0].split(".")),
                        "card": 12 <= len(d) <= 19 and odd % 10 == 0, "phone": 9 <= len(d) <= 15}[kind]:
                    out.append((m.start(), rank, kind, m.end()))
        return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out)).encode()).hexdigest(), Counter(k for _, _, k, _ in out)
    hard = ["a@b.c.@d.e a@b.c_x@d.ee", "1.2.3.4.5.6.7.8 256.1.1.1.1", "1" * 20_000, "a." * 20_000 + "@b.c", "0001.2.003.255", "+1" + "(" * 9_000]
    frame = docs.select("doc_id", "text").union(sample.select("doc_id", "text")).union(
        spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string"))
    got = sorted((r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_pii(frame).collect())
    want = sorted((h, c["email"], c["ip"], c["card"], c["phone"]) for h, c in (brute(r.text) for r in frame.collect()))
    assert got == want
    assert pii.find_pii(docs.limit(0)).count() == 0
    iban = spark.createDataFrame([(1, "iban GB82 WEST 1234 5698 7654 32, not GB82WEST12345698765433; a@b.cc")], "doc_id long, text string")
    assert pii.find_pii(iban).first().spans == "iban:5:32,email:62:68"
    assert pii.redact(iban).first().text == "iban <IBAN>, not GB82WEST12345698765433; <EMAIL>"
    assert [r.text for r in pii.redact(docs.filter("doc_id in (4, 5)")).collect()] == [None, ""]


def test_iban_with_words_around(spark):
    texts = ["IBAN GB82 WEST 1234 5698 7654 32 BIC ABCDGB2L", "DE89 3704 0044 0532 0130 00 EUR 500",
             "PO12 ORDER 1234 DE89 3704 0044 0532 0130 00 GB82WEST12345698765432", "GB82 WEST 1234 5698 7654 3 BIC", "NO9386011117947"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.spans for r in pii.find_pii(frame).orderBy("doc_id").collect()] == [
        "iban:5:32", "iban:0:27", "iban:16:43,iban:44:66", "", "iban:0:15"]
    assert [r.text for r in pii.redact(frame).orderBy("doc_id").collect()] == [
        "IBAN <IBAN> BIC ABCDGB2L", "<IBAN> EUR 500", "PO12 ORDER 1234 <IBAN> <IBAN>", texts[3], "<IBAN>"]


def test_quality_rules(docs, sample):
    frame = docs.select("doc_id", "text", "lang", "source").union(sample.select("doc_id", "text", "lang", "source"))
    def brute(t):
        t, w = t or "", words(t)
        seen = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        gone = {j for i in range(len(w) - 7) if seen[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(gone),
                len(w) < 20 or 100 * len(gone) > 30 * len(w))
    got = quality_rules.judge(frame).collect()
    assert Counter((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == Counter(
        brute(r.text) for r in frame.collect())
    assert not any(r.kept for r in got if r.base_failed)
    labels = {r.doc_id: r.quality for r in sample.sparkSession.read.parquet(f"{SF}/labels.parquet").collect()}
    clean = [r.kept for r in got if labels.get(r.doc_id) == 1 and r.doc_id and r.doc_id > 14 and not r.base_failed]
    assert sum(clean) >= 0.98 * len(clean)
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_quality_rules_error_rates(spark):
    corpus, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.judge(corpus).filter("not base_failed").select("doc_id", "kept").distinct()
    rows = got.join(labels.select("doc_id", "quality").distinct(), "doc_id").collect()
    junk, good = ([r.kept for r in rows if r.quality == q] for q in (0, 1))
    assert len(junk) >= 20 and sum(not k for k in junk) >= 0.95 * len(junk)
    assert sum(good) >= 0.98 * len(good)


def test_quality_rules_small_sources(spark):
    """A small source is judged by its own language, a language with few rows by all rows."""
    def text(i, loud):
        r = random.Random(i)
        words = ("".join(r.choices("abcdefgh", k=r.randint(2, 8))) for _ in range(60))
        return " ".join(w.upper() if loud else w for w in words)
    rows = [("aa", "big", text(i, False)) for i in range(120)] + [("bb", "big", text(i, True)) for i in range(60)]
    rows += [("aa", f"s{i % 3}", text(i, False)) for i in range(45)] + [("bb", "s", text(i, True)) for i in range(10)]
    rows += [("bb", "s", text(0, False)), ("cc", "s", text(1, False)), ("cc", "s", "|#$%& " * 3 + text(1, True))]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, lang string, source string, text string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge(frame).collect()}
    assert len(kept) == len(rows)
    small = [kept[i] for i, r in enumerate(rows) if r[:2] == ("bb", "s")]
    assert small == [True] * 10 + [False]
    assert [kept[i] for i, r in enumerate(rows) if r[0] == "cc"] == [True, False]


def test_substring_dedup(docs, sample):
    for frame in (docs.select("doc_id", "text"), sample.select("doc_id", "text"), docs.limit(0)):
        rows = frame.collect()
        first = {}
        for d, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
            w = words(t)
            for i in range(len(w) - 19):
                first.setdefault(tuple(w[i:i + 20]), (d, i))
        want = Counter()
        for d, t in (r[:2] for r in rows):
            w = words(t)
            gone = {j for i in range(len(w) - 19) if d is not None and first[tuple(w[i:i + 20])] != (d, i) for j in range(i, i + 20)}
            kept = " ".join(x for i, x in enumerate(w) if i not in gone)
            want[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
        got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(frame).collect())
        assert got == want


def test_near_duplicates(spark, docs, sample):
    copies = [(100_000 + i, " ".join(f"c{j if (i * 7 + j) % 29 or i % 3 == 0 else -i}" for j in range(120))) for i in range(40)]
    frame = docs.select("doc_id", "text").union(sample.select("doc_id", "text").filter("doc_id > 14")).union(
        spark.createDataFrame(copies, "doc_id long, text string"))
    rows = frame.collect()
    sets = {}
    for r in rows:
        w = words((r.text or "").translate(LOW))
        if r.doc_id is not None:
            sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {d: d for d in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = near_dedup.near_duplicates(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), find(r.doc_id), r.doc_id == find(r.doc_id))
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_language_model(docs):
    rows = docs.select("doc_id", "text").collect()
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    toks = [(r.doc_id, [*words((r.text or "").translate(LOW)), None]) for r in rows]
    pair, uni = Counter(), Counter()
    for d, t in toks:
        if not held(d):
            pair.update(zip([0, *t], t))
            uni.update(t)
    follow, kinds, before = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
    for (v, w), c in pair.items():
        follow[v] += c
        kinds[v][min(c, 3) - 1] += 1
        before[w] += 1
    d2, d1 = (ngram_lm.discounts(*(Counter(x.values())[k] for k in (1, 2, 3, 4))) for x in (pair, before))
    cut = lambda c, d: d[min(c, 3) - 1] if c else 0.0
    types, n, vocab = sum(before.values()), sum(uni.values()), len(uni)
    rest = sum(cut(c, d1) for c in before.values()) / types
    def p(v, w):
        p1 = max(before[w] - cut(before[w], d1), 0) / types + rest / (vocab + 1)
        if not follow[v]:
            return p1
        return max(pair[v, w] - cut(pair[v, w], d2), 0) / follow[v] + sum(map(math.prod, zip(kinds[v], d2))) / follow[v] * p1
    for v in (0, "w1", "the"):
        assert sum(p(v, w) for w in [*uni, "unknown"]) == pytest.approx(1)
    want = {(d, tuple(t)): (held(d), len(t), sum(uni[w] > 0 for w in t), n,
                            sum(math.log10((uni[w] + .5) / (n + .5 * (vocab + 1))) for w in t),
                            sum(math.log10(p(v, w)) for v, w in zip([0, *t], t))) for d, t in toks}
    got = {r.doc_id: r for r in ngram_lm.score_texts(docs).collect()}
    for (d, _), (h, size, known, train, base, score) in want.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, size, known, train)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    assert ngram_lm.score_texts(docs.limit(0)).count() == 0


@pytest.mark.parametrize("order", [3, 4])
def test_language_model_of_higher_order(docs, order):
    rows = docs.select("doc_id", "text").collect()
    texts = [(r.doc_id, [0, *words((r.text or "").translate(LOW)), None]) for r in rows]
    train = [t for d, t in texts if d is None or zlib.crc32(str(d).encode()) % 5 != 1]
    raw = [Counter(tuple(t[i:i + k]) for t in train for i in range(len(t) - k + 1)) for k in range(1, order + 1)]
    counts = raw[-1:]
    for k in range(order - 1, 0, -1):
        before = Counter(g[1:] for g in raw[k])
        counts.insert(0, Counter({g: c if g[0] == 0 else before[g] for g, c in raw[k - 1].items() if k > 1 or g != (0,)}))
    cuts = [ngram_lm.discounts(*(Counter(x.values())[i] for i in (1, 2, 3, 4))) for x in counts]
    cut = lambda c, d: d[min(c, 3) - 1] if c else 0.0
    follow = [defaultdict(list) for _ in counts]
    for x, f in zip(counts, follow):
        for g, c in x.items():
            f[g[:-1]].append(c)
    vocab = len(counts[0])
    def p(h, w):
        k = len(h)
        low = p(h[1:], w) if k else 1 / (vocab + 1)
        after = follow[k][h]
        if not after:
            return low
        c = counts[k][(*h, w)]
        return (max(c - cut(c, cuts[k]), 0) + sum(cut(x, cuts[k]) for x in after) * low) / sum(after)
    for h in ((0,), (0, "w0"), ("w1", "w2"), ("the", "the"), ("v3",)):
        assert sum(p(h, w) for w in [*(g[0] for g in counts[0]), "unknown"]) == pytest.approx(1)
    got = {r.doc_id: r.score for r in ngram_lm.score_texts(docs, order=order).collect()}
    for d, t in texts:
        assert got[d] == pytest.approx(sum(math.log10(p(tuple(t[max(0, i - order + 1):i]), t[i])) for i in range(1, len(t))))
    assert ngram_lm.score_texts(docs.limit(0), order=order).count() == 0


def test_language_model_shards_find_all_hashes_in_six_bytes(tmp_path):
    rng = np.random.default_rng(3)
    h = np.unique(np.concatenate([rng.integers(0, 1 << 64, 5000, np.uint64), (np.uint64(77) << np.uint64(50)) + np.arange(300, dtype=np.uint64)]))
    have, none = h[::2], h[1::2]
    ngram_lm._store_hashes(str(tmp_path), "2-{}-0", have)
    assert ngram_lm._seek(str(tmp_path), "2-{}-0", have).tolist() == list(range(len(have)))
    assert (ngram_lm._seek(str(tmp_path), "2-{}-0", none) == -1).all()
    ngram_lm._store_hashes(str(tmp_path), "2-{}-1", have[:0])
    assert (ngram_lm._seek(str(tmp_path), "2-{}-1", none) == -1).all()
    assert sum((tmp_path / f"2-{x}-0.npy").stat().st_size for x in "ml") <= 6 * len(have) + 300


def test_language_model_exchange_is_small(spark, tmp_path):
    rng = np.random.default_rng(4)
    texts = pa.array([" ".join(f"w{w}" for w in rng.zipf(1.3, 300) % 50000) for _ in range(400)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    rows = [r for b in ngram_lm._vocabulary([batch], 4) for r in b.to_pylist()]
    for part in range(4):
        ngram_lm._vocabulary_shard(part, [r for r in rows if r["part"] == part], str(tmp_path))
    sent = [r for b in ngram_lm._count([batch], str(tmp_path), 4, 3) for r in b.to_pylist()]
    tokens = ngram_lm._tokens(texts, 3)[0]
    size = sum(len(v) for r in sent for v in (r["words"], *r["at"], r["kinds"], r["kind"]))
    assert size < 7 * len(np.unique(tokens, axis=0))  # eight bytes for each word and four for each place before
    back = np.concatenate([ngram_lm._words(str(tmp_path), np.sort(o))[np.argsort(np.argsort(o))][g] for o, g, _ in map(ngram_lm._undeal, sent)])
    assert (np.unique(back, axis=0) == np.unique(tokens, axis=0)).all()


def test_language_model_reads_each_shard_once_for_many_slices(tmp_path, monkeypatch):
    texts = pa.array([" ".join(f"{w}{'x' * 2000}" for w in range(500)) for _ in range(7)] + [None, ""])
    batch = pa.RecordBatch.from_arrays([texts, pa.array(range(9), pa.int64()), pa.array([False] * 9)], names=["text", "doc_id", "held_out"])
    asked, find = [], ngram_lm._find
    monkeypatch.setattr(ngram_lm, "_find", lambda folder, k, *a: asked.append(k) or find(folder, k, *a))
    totals = {"types": 0, "vocab": 0, "tokens": 0, "a": (0, 0, 0), "d": [(0.5, 1.0, 1.5)] * 3}
    rows = [r for b in ngram_lm._score([batch], str(tmp_path), 4, 3, totals) for r in b.to_pylist()]
    assert asked == [1, 2, 3]  # seven slices of text, one walk over the shards of each order
    assert [(r["doc_id"], r["n_tokens"], r["score"]) for r in rows] == [(i, 501 if i < 7 else 1, 0.0) for i in range(9)]


def test_language_model_kinds_take_few_bits(tmp_path):
    rng = np.random.default_rng(5)
    for n, size in ((0, 0), (1, 1), (5000, 2), (100_000, 900), (100_000, 50_000)):
        at = np.unique(np.minimum(rng.zipf(1.6, n), max(size, 1)), return_inverse=True)[1]
        kinds = np.arange(3 * (at.max(initial=-1) + 1)).reshape(-1, 3)
        ngram_lm._store_kinds(str(tmp_path), "2-{}-0", kinds, at)
        table, asked = ngram_lm._map(str(tmp_path), "2-s-0").reshape(-1, 3), rng.permutation(n)
        assert (table[ngram_lm._kinds_at(str(tmp_path), "2-{}-0", asked)] == kinds[at[asked]]).all()
    kinds, at = np.arange(3000).reshape(-1, 3), np.where(rng.random(100_000) < 0.99, 0, rng.integers(0, 1000, 100_000))
    ngram_lm._store_kinds(str(tmp_path), "2-{}-1", kinds, at)
    assert sum((tmp_path / f"2-{x}-1.npy").stat().st_size for x in "px") < 0.4 * len(at)  # two bytes for each place before


def test_language_model_merges_wide_keys():
    rng = np.random.default_rng(6)
    for top in (1, 50, 1 << 22, 1 << 30):  # the last two do not fit into one integer
        grams = rng.choice(rng.integers(0, top, 40), (5000, 3)).astype(np.int32)
        sums = [rng.integers(0, 1 << 40, 5000), rng.integers(0, 3, 5000).astype(np.uint8)]
        want, inverse, seen = np.unique(grams, axis=0, return_inverse=True, return_counts=True)
        got, (count,) = ngram_lm._merge(grams, None)
        assert (got == want).all() and (count == seen).all()
        got, totals = ngram_lm._merge(grams, sums)
        for x, y in zip(sums, totals):
            total = np.zeros(len(want), np.int64)
            np.add.at(total, inverse, x)
            assert (got == want).all() and (total == y).all()
    h = np.r_[rng.integers(0, 1 << 64, 5000, np.uint64), np.arange(5000, dtype=np.uint64), np.arange(70, dtype=np.uint64)]
    order, ordered = ngram_lm._order(h)
    assert (ordered == np.sort(h)).all() and (h[order] == ordered).all() and len(set(order.tolist())) == len(h)


def test_decontaminate(spark, docs):
    item = " ".join(f"q{i}" for i in range(30))
    tests = spark.createDataFrame([(1, item), (2, "alpha beta gamma delta epsilon zeta eta"), (3, None), (4, "too short"), (None, item)],
                                  "item_id long, text string")
    more = spark.createDataFrame([
        (50, "Start " + item + ", end."), (51, item.replace("q7", "X").replace("q19", "y").upper()), (52, " ".join(item.split()[5:22])),
        (53, " ".join(item.split()[:8])), (54, "so alpha, beta gamma delta epsilon zeta ETA."), (55, "alpha beta gamma delta epsilon zeta"),
    ], "doc_id long, text string")
    got = decontaminate.contaminated(docs.select("doc_id", "text").union(more), tests).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(50, 1), (51, 1), (52, 1), (54, 2)]
    assert {r.doc_id: (r.score, r.first_token, r.last_token) for r in got}[50] == (30, 1, 31)
    assert decontaminate.contaminated(docs.limit(0), tests).count() == 0
    assert decontaminate.contaminated(more, tests.limit(0)).count() == 0


def test_decontaminate_in_blocks(spark, monkeypatch):
    bench, corpus = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "documents"))
    whole = sorted(decontaminate.contaminated(corpus, bench).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_HASHES", 1000)
    assert whole and sorted(decontaminate.contaminated(corpus, bench).collect()) == whole


def test_packing(docs):
    lengths, counts = [1, 2, 5, 9, 10, 40], [5, 1, 4, 2, 7, 1]
    def padding(bounds):
        return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))
    for k in (1, 2, 3, 6, 9):
        best = min(padding([*c, 40]) for j in range(min(k, 6)) for c in itertools.combinations(lengths[:-1], j))
        bounds = packing.best_boundaries(lengths, counts, k)
        assert len(bounds) <= k and padding(bounds) == best
    rows = packing.pack(docs, max_len=64, buckets=4, budget=256).collect()
    total = Counter()
    for r in rows:
        total[r.doc_id] += r.n_tokens
        assert r.n_tokens <= r.padded_len and r.first_token == 64 * r.chunk
    want = Counter()
    for d, t in TEXTS:
        want[d] += len(words(t)) + 1
    assert total == want
    fill = Counter((r.bucket, r.batch) for r in rows)
    assert all(n * next(r.padded_len for r in rows if r.bucket == b) <= 256 for (b, _), n in fill.items())
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)
    assert packing.pack(docs.limit(0)).count() == 0


def test_html(spark):
    cases = {
        "<body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p>One <b>two</b><br>three<p>Four</p></article><div class=ad>Buy</div>": "T & U\nOne two three\nFour",
        "<header>Site</header><main><h1>Hello</h1><p>Body text</p><form><p>Sign up</p></form></main><aside><p>side</p></aside><footer><p>foot</p></footer>": "Hello\nBody text",
        '<div id="main"><h2>News</h2><p>Short.</p></div><div class="cookie-banner"><p>We use cookies</p></div><section id="comments"><p>Great post, I liked it a lot</p></section>': "News\nShort.",
        "<script>var a='<p>x</p>'</script><style>p{}</style>": "", "": "",
    }
    frame = spark.createDataFrame([(i, None, h, "x") for i, h in enumerate(cases)] + [(99, "u", None, "x"), (99, "u", None, "x"), (100, None, "<div>" * 3000 + "<p>deep words</p>", "x")],
                                  "page_id long, url string, html string, text string")
    got = html_extract.extract(frame).collect()
    assert [r.text for r in got][:len(cases)] == list(cases.values())
    assert all(r.n_chars == len(r.text) for r in got) and [r.text for r in got if r.page_id == 99] == ["", ""]
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_html_unclosed_dropped_elements():
    story = "<article><h1>Title</h1><p>Some words that make a paragraph of a story.</p></article>"
    want = "Title\nSome words that make a paragraph of a story."
    for html in (f"<head><title>T</title><body>{story}", f"<html><head><meta charset=x><title>T</title>{story}",
                 f"<head><title>T<body>{story}", f"<head><noscript><link></head><body>{story}",
                 f"<body><div><noscript><img src=x>Turn on scripts</div>{story}", f"<body><noscript><img src=x>{story}",
                 f"<body><object><object></object>not this</object>{story}",
                 *(f"<body><div><{tag}>not this</div>{story}" for tag in ("iframe", "svg", "object", "canvas")),
                 *(f"<body><{tag}>not this{story}" for tag in ("iframe", "svg", "object", "canvas"))):
        assert html_extract.main_text(html)[0] == want, html
    assert html_extract.main_text("<head><style>p{}</style><script>var a='<body><p>x</p>'</script></head>")[0] == ""


def test_html_sum_product_is_exact():
    """Marginals equal those from summing over all labellings."""
    t = html_extract._Tree("<div class=content><h1>Ab</h1><div><p>Some words</p><a>x</a></div></div><nav><p>Menu</p></nav>")
    _, pair, _ = html_extract.model()
    zones = html_extract._zones(t)
    own = [None] + [html_extract._potential(html_extract._features(t, i, zones[i])) for i in range(1, len(t.tag))]
    mass, yes = 0.0, [0.0] * len(t.tag)
    for y in itertools.product((0, 1), repeat=len(t.tag) - 1):
        y = (0, *y)
        p = math.exp(sum(own[i][y[i]] + pair[y[t.parent[i]]][y[i]] for i in range(1, len(y))))
        mass += p
        yes = [a + p * b for a, b in zip(yes, y)]
    assert html_extract.marginals(t)[1:] == pytest.approx([a / mass for a in yes[1:]], abs=1e-9)


def test_urls(spark):
    cases = [(1, None, "", "", None, None), (2, "none", "", "", None, None), (3, "HTTP://A.B.COM/x", "a.b.com", "/x", "com/", "allow"),
             (4, "http://www.Example.com/en/1?q", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
             (5, "http://m.example.com/en/1", "m.example.com", "/en/1", "example.com/en/", "block"), (6, "x://net#f", "net", "", None, None),
             (7, "http://a.net/es/q", "a.net", "/es/q", "net/es/", "block"), (8, "http://b.org/?u=http://net/es/", "b.org", "/", None, "allow"),
             (9, "http://m.casino-win.example.org/de/1", "m.casino-win.example.org", "/de/1", None, "block"),
             (9, "http://m.casino-win.example.org/de/1", "m.casino-win.example.org", "/de/1", None, "block")]
    frame = spark.createDataFrame([(i, u, "x", "x") for i, u, *_ in cases], "page_id long, url string, host string, _features string")
    for r, c in zip(url_filter.judge_urls(frame).orderBy("page_id").collect(), cases):
        assert (r.page_id, r.host, r.path, r.rule) == (c[0], *c[2:5]) and r.verdict in ("allow", "block")
        assert c[5] is None or r.verdict == c[5]
    assert url_filter.judge_urls(frame.limit(0)).count() == 0


def test_quality_classifier(spark, docs):
    corpus, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality_classifier.score_quality(corpus, labels).collect()}
    truth = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert sum(a == b for a, b in truth) >= 0.97 * len(truth)
    odd = quality_classifier.score_quality(docs, labels.limit(0)).collect()
    assert len(odd) == len(TEXTS) and all(r.score == 0.5 and r.predicted == 0 for r in odd)
    assert quality_classifier.score_quality(docs.limit(0), labels).count() == 0
