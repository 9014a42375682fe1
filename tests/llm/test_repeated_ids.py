"""Ids that repeat with different texts: no text stands for another one."""

import hashlib
import re

from riskframe.llm import near_dedup, substring_dedup


def _words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


def test_substring_dedup_keeps_an_ids_other_texts(spark):
    a, b, c = _words("a", 60), _words("b", 40), _words("c", 45)
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c + " tail"), (4, b), (5, c), (None, a), (2, b), (6, None), (6, "short")]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, offset int").repartition(4)
    got = substring_dedup.remove_repeats(frame).collect()
    assert len(got) == len(rows)
    left = {}
    for r in got:
        left.setdefault((r.doc_id, r.n_words), []).append((r.n_removed, r.kept_text))
    assert left[1, 60] == [(0, a)] and left[2, 60] == [(60, "")]
    assert left[2, 40] == [(0, b), (0, b)]                   # the same row twice stands at one place
    assert left[4, 40] == [(40, "")] and left[5, 45] == [(45, "")]
    # The two texts of id 3 are one document: what they share stays once.
    removed = {n: left[3, n][0][0] for n in (45, 46)}
    assert sorted(removed.values()) == [0, 45]
    for r in got:
        assert r.kept_sha256 == hashlib.sha256((r.kept_text or "").encode()).hexdigest()


def test_removal_equals_brute_force_with_repeated_ids(spark):
    import random
    rng = random.Random(1)
    passages = [_words(f"p{k}x", 30) for k in range(4)]
    rows = []
    for i in range(60):
        own = " ".join(f"d{i}w{j}" for j in range(rng.randrange(0, 40)))
        rows.append((rng.randrange(0, 25), f"{own} {rng.choice(passages)} {own[::-1]}"))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    t = {r.text: r.t for r in frame.selectExpr("text", "xxhash64(text) AS t").collect()}
    starts, first = [], {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0], t[r[1]])):
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        gone = set()
        for i in range(len(words) - 19):
            key = tuple(words[i:i + 20])
            if first.setdefault(key, (doc, text, i)) != (doc, text, i):
                gone.update(range(i, i + 20))
        starts.append(((doc, text), len(gone)))
    want = dict(starts)
    got = substring_dedup.remove_repeats(frame).select("doc_id", "n_words", "n_removed").collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == sorted(
        (d, len(re.findall(r"[^\x20\x09-\x0D]+", x)), want[d, x]) for d, x in rows)


def test_near_duplicates_join_all_texts_of_an_id(spark):
    a, b, c, d = (_words(p, 60) for p in "abcd")
    rows = [(1, a), (2, a), (2, b), (4, b + " z"), (5, c), (6, c), (7, d), (7, c), (8, _words("e", 30)), (9, None), (9, d), (None, a)]
    frame = spark.createDataFrame([(x, y, 1) for x, y in rows], "doc_id long, text string, t int").repartition(3)
    got = near_dedup.near_duplicates(frame).collect()
    parts = {}
    for r in got:
        if r.doc_id is not None and r.n_shingles:
            parts.setdefault(r.doc_id, set()).add(r.component_id)
    assert parts == {1: {1}, 2: {1}, 4: {1}, 5: {5}, 6: {5}, 7: {5}, 8: {8}, 9: {5}}
    assert sorted((r.doc_id or 0, r.kept) for r in got) == sorted(
        (x or 0, True if x is None or (x == 9 and y is None) else x in (1, 5, 8)) for x, y in rows)
