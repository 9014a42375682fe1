"""Every pipeline stage and the whole run on small tables, against plain Python."""

import re
from collections import Counter

import pytest

import corpus_pipeline as P
from riskframe.llm import quality_classifier

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PASSAGE = "the quick harbour master counted forty two small boats before the storm came in from the western islands that night"
MAIL = "write to someone@example.org for more"


def _frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", None if t is None else len(t)) for d, t in rows], SCHEMA).repartition(3)


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return tmp_path


def _words(prefix, n):
    return " ".join(f"{prefix}{i}" for i in range(n))


ROWS = [(1, _words("a", 40)), (2, _words("a", 40) + " z"), (3, f"{_words('b', 20)} {PASSAGE} {_words('c', 9)}"), (4, PASSAGE.upper() + "!"),
        (5, f"{_words('d', 30)} {MAIL}"), (6, None), (7, ""), (None, _words("a", 40)), (None, PASSAGE), (8, _words("long", 30000)),
        (9, "short one"), (9, "short one"), (10, MAIL)]


def _texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_decontamination_drops_documents_with_a_passage(spark, tables):
    got = P.decontamination(spark, _frame(spark, ROWS), str(tables))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert _texts(got) == sorted((r for r in ROWS if r[0] not in (3, 4)), key=str)


def test_personal_data_is_replaced_and_counted_again(spark, tables):
    got = P.personal_data(spark, _frame(spark, ROWS), str(tables))
    masked = [(d, t and t.replace("someone@example.org", "<EMAIL>")) for d, t in ROWS]
    assert _texts(got) == sorted(masked, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.collect())
    assert got.schema["n_chars"].dataType == _frame(spark, ROWS).schema["n_chars"].dataType


def test_packing_keeps_every_token(spark, tables):
    got = P.packed(spark, _frame(spark, ROWS), str(tables)).collect()
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
        assert 0 < r.n_tokens <= r.padded_len
    want = Counter()
    for d, t in ROWS:
        want[d] += len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1
    assert tokens == want
    places = [(r.bucket, r.batch, r.slot) for r in got]
    assert len(set(places)) == len(places)


def test_quality_keeps_what_the_rules_accept(spark, tables, monkeypatch):
    rules = quality_classifier.Rules(-1.0, ((3.0, (("log_words", ">", 2.0),)), (-9.0, (("symbol", ">", 0.2),))))
    monkeypatch.setattr(quality_classifier, "fit_rules", lambda docs, labels: rules)
    rows = [*ROWS, (20, "#$% " * 30), (21, "a b c")]
    got = P.quality(spark, _frame(spark, rows), str(tables))
    assert _texts(got) == sorted(((d, t) for d, t in rows if t and len(t.split()) >= 7 and "#" not in t), key=str)


def test_compiled_rules_equal_direct_evaluation(spark, tables):
    rules = quality_classifier.Rules(0.3, ((1.5, (("log_words", ">", 2.5), ("digit", "<=", 0.4))), (-0.7, (("alone", ">", 0.9),)), (0.2, (("upper", "<=", 0.0),))))
    stats = quality_classifier.with_stats(_frame(spark, ROWS).select("doc_id", "text"))
    import math
    for r in stats.withColumn("got", rules.score()).collect():
        total = rules.bias + sum(w for w, terms in rules.rules if all(
            (r[n] <= cut if op == "<=" else r[n] > cut) for n, op, cut in terms))
        assert r.got == pytest.approx(1 / (1 + math.exp(-total)), rel=1e-12)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_empty_tables(spark, tables, name):
    assert dict(P.STAGES)[name](spark, _frame(spark, ROWS).limit(0), str(tables)).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES[:-1]])
def test_extra_columns_with_clashing_names(spark, tables, name):
    extra = _frame(spark, ROWS[:8]).selectExpr("*", "1 AS score", "2 AS row", "3 AS spans", "4 AS item", "5 AS component_id", "6 AS kept", "7 AS t")
    got = dict(P.STAGES)[name](spark, extra, str(tables))
    assert got.columns == extra.columns and got.count() > 0


def test_run_applies_all_stages_in_order(spark, tables):
    _frame(spark, ROWS).write.parquet(f"{tables}/documents.parquet")
    got = P.run(spark, str(tables)).collect()
    # No labels: all pass quality.  2 repeats 1; of the rows (9, "short one") one stays; 3 and 4 hold the passage.
    left = [(d, t) for d, t in ROWS if d not in (2, 3, 4)]
    left.remove((9, "short one"))
    want = Counter()
    for d, t in left:
        want[d] += len(re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("someone@example.org", "<EMAIL>"))) + 1
    tokens = Counter()
    for r in got:
        tokens[r.doc_id] += r.n_tokens
    assert tokens == want
