"""Every operator of the survey's inventory as a query over the driver's tables.

Each function takes (spark, sf_dir) and returns a DataFrame whose column
names equal those of the matching SQL in :mod:`riskframe.plans.oracle`.
Computed doubles are snapped to 36 significant bits (:func:`snap`) so that
a value hash ignores summation order.  Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from riskframe.functions.names import standardize_columns
from riskframe.functions.numeric import safe_ratio
from riskframe.operators import clean, corr, curves, encode, profile, rollup, sampling, stattests
from riskframe.operators.features import engineer_features
from riskframe.operators.ordered import average_ranks
from riskframe.plans.inputs import (
    CUSTOMER_MAIN, CUSTOMER_SENTINEL, LINEITEM_MISSING, LINEITEM_SCORES,
    LINEITEM_TEXT_NUMBERS, ORDERS_PLACEHOLDERS, applicants, derived, table,
)
from riskframe.spec import CORR_PRUNE_THRESHOLD, TableSpec

LI_FEATURES = ["l_quantity", "l_price_m", "l_discount", "l_tax"]
SCORE_COLS = ["discount_score", "tax_score", "quantity_score"]


def snap(c, bits: int = 36, floor_exp: int = -40):
    """Round to ``bits`` significant bits (and to a multiple of 2**floor_exp near
    zero).  Two engines' results differ in the last ulps with summation order,
    and decimal-valued data often lands exactly on a decimal half-way point (a
    mean of 0.0499185) where those ulps round apart; a binary grid relative to
    the magnitude has no such ties.  ``+ 0.0`` folds -0.0 into 0.0."""
    q = F.greatest(F.pow(F.lit(2.0), F.floor(F.log2(F.abs(c))) - F.lit(bits)),
                   F.lit(2.0 ** floor_exp))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.floor(c / q + F.lit(0.5)) * q) + F.lit(0.0)


def round_doubles(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[snap(F.col(f"`{f.name}`")).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in skip
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def _stamp(name: str):
    """A timestamp as text, so that both engines' rows compare alike."""
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss")


# ---- 2.B cleaning -------------------------------------------------------------

def q_standardize_columns(spark: SparkSession, sf: str) -> DataFrame:
    return standardize_columns(table(spark, sf, "orders").withColumn("o_orderdate", _stamp("o_orderdate")))


def q_clean_placeholders(spark, sf):
    o = derived(spark, sf, ORDERS_PLACEHOLDERS)
    return clean.normalize_placeholders(o, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


def q_impute_unknown(spark, sf):
    o = clean.normalize_placeholders(derived(spark, sf, ORDERS_PLACEHOLDERS), ["o_orderpriority"])
    return clean.impute_constant(o, ["o_orderpriority"]).select("o_orderkey", "o_orderpriority")


def q_clean_coerce_numeric(spark, sf):
    t = clean.normalize_placeholders(derived(spark, sf, LINEITEM_TEXT_NUMBERS), ["t95", "t80"])
    out, _ = clean.coerce_numeric_like(t, ["t95", "t80"])
    return out


def q_impute_median(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING).select("l_orderkey", "l_linenumber", "l_price_m")
    out, _, _ = clean.impute_median(li.withColumn("filled", F.col("l_price_m").isNull()), ["l_price_m"])
    price = F.when(F.col("filled"), snap(F.col("l_price_m"))).otherwise(F.col("l_price_m"))
    return out.withColumn("l_price_m", price).drop("filled")


def q_dedupe_rows(spark, sf):
    li = table(spark, sf, "lineitem")
    doubled = li.unionByName(li.where(F.col("l_orderkey") % 10 == 0))
    out, _ = clean.drop_exact_duplicates(doubled)
    return out.withColumn("l_shipdate", _stamp("l_shipdate"))


def q_missing_profile(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    o = clean.normalize_placeholders(derived(spark, sf, ORDERS_PLACEHOLDERS), ["o_orderpriority"])
    return round_doubles(profile.missing_profile(li).unionByName(profile.missing_profile(o)))


def q_clean_log(spark, sf):
    o = derived(spark, sf, ORDERS_PLACEHOLDERS)
    _, log = clean.clean_table(o, "orders", TableSpec("O_ORDERKEY", "TARGET"))
    rows = [(k, float(v)) for k, v in log.items() if isinstance(v, (int, float))]
    rows.append(("numeric_columns_converted", float(len(log["numeric_columns_converted"]))))
    return spark.createDataFrame(rows, "metric string, value double")


def q_safe_ratio(spark, sf):
    li = table(spark, sf, "lineitem")
    return round_doubles(li.select("l_orderkey", "l_linenumber",
                                   safe_ratio("l_extendedprice", "l_discount").alias("price_per_discount")))


def q_sentinel_flag(spark, sf):
    c = derived(spark, sf, CUSTOMER_SENTINEL)
    out, _, _ = clean.sentinel_flag(c, "DAYS_EMPLOYED")
    return round_doubles(out)


def q_engineer_features(spark, sf):
    a = applicants(spark, sf)
    a, _, _ = clean.sentinel_flag(a, "DAYS_EMPLOYED", count=False)
    out, created, _ = engineer_features(a)
    return round_doubles(out.select("SK_ID_CURR", *created))


def q_drop_constant_columns(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING).withColumn("const_col", F.lit(1.0))
    out, _ = clean.drop_constant_columns(li, ["l_quantity", "l_discount", "l_tax", "const_col"])
    return out


def q_class_filter(spark, sf):
    c = derived(spark, sf, CUSTOMER_MAIN)
    return clean.class_filter(c, "target", 1).select("c_custkey", "c_acctbal")


# ---- 2.D roll-ups and joins ----------------------------------------------------

def _orders_rollup(spark, sf, numeric=("o_orderkey", "o_totalprice"), categorical=()):
    o = table(spark, sf, "orders")
    return rollup.rollup(o, "o_custkey", "ord", list(numeric), list(categorical))


def q_rollup_numeric(spark, sf):
    return round_doubles(_orders_rollup(spark, sf))


def q_rollup_category_share(spark, sf):
    o = clean.normalize_placeholders(derived(spark, sf, ORDERS_PLACEHOLDERS), ["o_orderpriority"])
    return round_doubles(rollup.rollup(o, "o_custkey", "ord", [], ["o_orderstatus", "o_orderpriority"]))


def q_rollup_join(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    c = c.unionByName(c.withColumn("c_custkey", -F.col("c_custkey")))   # ids without orders
    r = rollup.rollup(table(spark, sf, "orders"), "o_custkey", "ord", ["o_totalprice"], ["o_orderstatus"])
    r = r.withColumnRenamed("o_custkey", "c_custkey")
    return round_doubles(rollup.join_rollups(c, [r], "c_custkey"), skip=("c_acctbal",))


def merged_customers(spark, sf) -> DataFrame:
    """customer LEFT JOIN orders roll-up LEFT JOIN lineitem roll-up (the task-1 shape)."""
    c = derived(spark, sf, CUSTOMER_MAIN).select("c_custkey", "c_nationkey", "target")
    o = table(spark, sf, "orders")
    ro = rollup.rollup(o, "o_custkey", "ord", ["o_totalprice"], ["o_orderstatus", "o_orderpriority"],
                       ).withColumnRenamed("o_custkey", "c_custkey")
    flags = ["l_returnflag", "l_linestatus"]
    li = table(spark, sf, "lineitem")
    levels = rollup.discover_levels(li, flags)   # before the join, which then runs once
    li = li.join(o.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rl = rollup.rollup(li, "o_custkey", "li",
                       ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                       flags, levels).withColumnRenamed("o_custkey", "c_custkey")
    return rollup.join_rollups(c, [ro, rl], "c_custkey")


def q_target_correlations(spark, sf):
    m = merged_customers(spark, sf)
    feats = [x for x in m.columns if x not in ("c_custkey", "target")]
    r = corr.target_correlations(m, feats, "target")
    return round_doubles(corr.order_by_strength(r))


def q_top_correlations(spark, sf):
    r = q_target_correlations(spark, sf)
    return corr.order_by_strength(r.where(F.col("pearson_corr_with_target").isNotNull())).limit(5)


# ---- 2.D statistics ------------------------------------------------------------

def q_class_balance(spark, sf):
    return round_doubles(profile.class_balance(derived(spark, sf, CUSTOMER_MAIN), "target"))


def q_describe_numeric(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    return round_doubles(profile.describe_numeric(li, LI_FEATURES))


def q_quantiles(spark, sf):
    from riskframe.operators.quantiles import quantile_frame
    return round_doubles(quantile_frame(derived(spark, sf, LINEITEM_MISSING), LI_FEATURES, [0.01, 0.25, 0.5, 0.75, 0.99]))


def q_distinct_counts(spark, sf):
    o = clean.normalize_placeholders(derived(spark, sf, ORDERS_PLACEHOLDERS), ["o_orderpriority"])
    return profile.distinct_counts(o, ["o_orderstatus", "o_orderpriority", "o_custkey"])


def q_feature_variance(spark, sf):
    return round_doubles(profile.feature_variance(derived(spark, sf, LINEITEM_MISSING), LI_FEATURES))


def q_binary_column_check(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    return profile.binary_columns(li, ["is_r", "l_discount", "l_quantity"])


def q_class_histogram(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    h = profile.class_histogram(li, "l_price_m", "is_r", bins=40)
    return round_doubles(h)


def q_correlation_matrix(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    m = corr.correlation_matrix(li, LI_FEATURES + ["l_linenumber"])
    return round_doubles(m.drop("i", "j"))


PRUNE_SQL_COLS = """
    l_extendedprice AS a,
    2.0 * l_extendedprice + 1.0 AS b,
    -l_extendedprice AS c,
    l_quantity AS d,
    l_discount AS e,
    l_quantity + l_tax AS f,
    l_extendedprice + 1000.0 * l_discount AS g"""


def q_correlation_prune(spark, sf):
    from riskframe.plans.inputs import _split_select
    li = table(spark, sf, "lineitem").selectExpr(*_split_select(PRUNE_SQL_COLS))
    m = corr.correlation_matrix(li, li.columns)
    return corr.correlation_prune(m, CORR_PRUNE_THRESHOLD)


def q_spearman(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    return round_doubles(corr.spearman_with_target(li, LI_FEATURES, "is_r"))


def q_mann_whitney(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    return round_doubles(stattests.mann_whitney_stats(li, LI_FEATURES, "is_r"))


def q_mann_whitney_p(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    return round_doubles(stattests.mann_whitney(li, LI_FEATURES, "is_r"))


CHI_SQL = """
SELECT c.c_custkey, CAST(c.c_acctbal < 0 AS INT) AS target, c.c_mktsegment,
       n.n_name, r.r_name,
       CASE WHEN c.c_nationkey < 12 THEN 'LOW' ELSE 'HIGH' END AS nation_band
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""


def _chi_input(spark, sf):
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    # nation and region are dimension tables of 25 and 5 rows
    return (c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
            .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
            .select("c_custkey", (F.col("c_acctbal") < 0).cast("int").alias("target"),
                    "c_mktsegment", "n_name", "r_name",
                    F.when(F.col("c_nationkey") < 12, "LOW").otherwise("HIGH").alias("nation_band")))


CHI_COLS = ["c_mktsegment", "n_name", "r_name", "nation_band"]


def q_chi_square(spark, sf):
    return round_doubles(stattests.chi_square_stats(_chi_input(spark, sf), CHI_COLS, "target"))


def q_chi_square_p(spark, sf):
    return round_doubles(stattests.chi_square(_chi_input(spark, sf), CHI_COLS, "target"))


def q_cluster_profile(spark, sf):
    c = derived(spark, sf, CUSTOMER_MAIN).withColumn("CLUSTER_ID", F.col("c_nationkey") % 3)
    from riskframe.operators.cluster import cluster_profile
    return round_doubles(cluster_profile(c, "CLUSTER_ID", ["c_acctbal", "c_nationkey"], "target"))


def q_kmeans_distance(spark, sf):
    from riskframe.operators.cluster import distances_to_centres, cluster_profile
    c = derived(spark, sf, CUSTOMER_MAIN).withColumn("CLUSTER_ID", F.col("c_nationkey") % 3)
    feats = ["c_acctbal", "c_nationkey"]
    centres_df = cluster_profile(c, "CLUSTER_ID", feats, None).orderBy("CLUSTER_ID")
    centres = [[r[f] for f in feats] for r in centres_df.collect()]   # k rows
    return round_doubles(distances_to_centres(c, feats, centres).select(
        "c_custkey", *[f"DIST_TO_CLUSTER_{i}" for i in range(len(centres))]))


def q_class_weights(spark, sf):
    from riskframe.operators.model import class_weight_table
    return round_doubles(class_weight_table(derived(spark, sf, CUSTOMER_MAIN), "target"))


# ---- 2.E / 2.K ranks and curves --------------------------------------------------

def q_avg_rank(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    ranks = average_ranks(li, [], "l_extendedprice", groups_hint=1).select("l_extendedprice", "avg_rank")
    return round_doubles(li.join(ranks, "l_extendedprice").drop("l_extendedprice"))


def _scores(spark, sf):
    s = derived(spark, sf, LINEITEM_SCORES)
    return curves.scores_long(s, SCORE_COLS, "y")


def q_roc_points(spark, sf):
    return round_doubles(curves.roc_points(_scores(spark, sf), groups_hint=3), skip=("threshold",))


def q_pr_points(spark, sf):
    return round_doubles(curves.pr_points(_scores(spark, sf), groups_hint=3), skip=("threshold",))


def q_ranking_metrics(spark, sf):
    return round_doubles(curves.ranking_metrics(_scores(spark, sf), groups_hint=3))


def q_confusion(spark, sf):
    return round_doubles(curves.confusion_metrics(_scores(spark, sf), 0.5))


# ---- 2.I sampling ------------------------------------------------------------------

def q_sample_n(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return sampling.sample_n(c, 300, "c_custkey", 42)


def q_stratified_split(spark, sf):
    c = derived(spark, sf, CUSTOMER_MAIN).select("c_custkey", "target")
    return sampling.stratified_split(c, "c_custkey", "target", 0.2, 5, 42)


# ---- 2.J encoding, clipping, scaling --------------------------------------------------

ENCODE_SQL_COLS = """
    o_orderkey, o_totalprice, o_orderstatus,
    CASE WHEN o_totalprice > 100000 THEN 'HIGH' ELSE 'LOW' END AS o_size,
    CAST(o_custkey AS STRING) AS o_cust_text"""


def q_encode_categoricals(spark, sf):
    from riskframe.plans.inputs import _split_select
    o = clean.normalize_placeholders(derived(spark, sf, ORDERS_PLACEHOLDERS), ["o_orderpriority"])
    o = o.selectExpr(*_split_select(ENCODE_SQL_COLS), "o_orderpriority")
    enc = encode.CategoryEncoder.fit(o, ["o_orderstatus", "o_size", "o_cust_text", "o_orderpriority"])
    return enc.transform(o)


WINSOR_COLS = ["l_quantity", "l_price_m", "l_discount", "l_tax", "is_r"]


def q_winsorize(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    w = encode.Winsorizer.fit(li, WINSOR_COLS)
    return round_doubles(w.transform(li).select("l_orderkey", "l_linenumber", *WINSOR_COLS))


def q_standard_scale(spark, sf):
    li = derived(spark, sf, LINEITEM_MISSING)
    s = encode.StandardScaler.fit(li, WINSOR_COLS)
    return round_doubles(s.transform(li).select("l_orderkey", "l_linenumber", *WINSOR_COLS))


# ---- 2.K / 2.L results and reports ---------------------------------------------------
# "Models" are the three score columns of LINEITEM_SCORES, evaluated on a stratified
# 80/20 split of all lineitem rows (id = order-line-part-supplier, which is unique) with
# per-fold CV metrics on the training rows: a results table computed from data.

def score_results(spark, sf) -> DataFrame:
    from riskframe.operators import report
    s = derived(spark, sf, LINEITEM_SCORES).withColumn(
        "row_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    # four metric pipelines read the split: write it once to the shared folder
    from riskframe.session import write_checkpoint_table
    split = write_checkpoint_table(sampling.stratified_split(s, "row_id", "y", 0.2, 5, 42), "split")
    from riskframe.operators.longform import to_long
    lf = to_long(split, SCORE_COLS, keep=["y", "is_test", "fold"], feature="model", value="score")
    # One ordered pass: the test rows and every fold of a model are groups of the same counts.
    named = lf.select(F.concat_ws("|", "model", F.coalesce("fold", F.lit(-1)).cast("string")).alias("model"), "score", "y")
    every = write_checkpoint_table(curves.ranking_metrics(named, groups_hint=18).join(curves.confusion_metrics(named, 0.5), "model"), "metrics")
    part = F.split("model", r"\|")
    every = every.withColumn("fold", part[1].cast("int")).withColumn("model", part[0])
    test_m = every.where("fold = -1").drop("fold")
    folds = every.where("fold >= 0").select("model", "fold", "roc_auc", "f1")
    return report.results_long(test_m, folds)


def q_results_table(spark, sf):
    return round_doubles(score_results(spark, sf))


def q_comparison_table(spark, sf):
    from riskframe.operators import report
    return round_doubles(report.comparison_table(score_results(spark, sf), digits=None))


def q_model_selection(spark, sf):
    from riskframe.operators import report
    r = report.rank_models(report.selection_scores(score_results(spark, sf)))
    return round_doubles(r.select("model", "weighted_score", "rank", "selected"))


def q_score_contributions(spark, sf):
    from riskframe.operators import report
    return round_doubles(report.score_contributions(score_results(spark, sf)))


def q_runner_up_margin(spark, sf):
    from riskframe.operators import report
    return round_doubles(report.runner_up_margin(score_results(spark, sf)))


def q_metric_leaderboard(spark, sf):
    from riskframe.operators import report
    return round_doubles(report.leaderboard(score_results(spark, sf), "test_pr_auc"))


def q_screening_quadrant(spark, sf):
    from riskframe.operators import report
    return round_doubles(report.screening_quadrant(score_results(spark, sf)))


# ---- 2.J / 2.K fitted models (no SQL oracle: iterative fits) --------------------------

EMBED_DIMS = 64


def _embedding_columns(spark, sf) -> tuple[DataFrame, list[str]]:
    e = table(spark, sf, "embeddings")
    names = [f"e{i:02d}" for i in range(EMBED_DIMS)]
    return e.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n)
                                         for i, n in enumerate(names)]), names


def _projection(spark, sf):
    from riskframe.plans.explore import fit_projection
    e, names = _embedding_columns(spark, sf)
    return fit_projection(e, names, "vec_id"), e


def q_pca_project(spark, sf):
    proj, e = _projection(spark, sf)
    return proj.transform(e, "vec_id").select("vec_id", F.round("PCA_1", 6).alias("PCA_1"), F.round("PCA_2", 6).alias("PCA_2"))


def q_kmeans_assign(spark, sf):
    proj, e = _projection(spark, sf)
    return proj.transform(e, "vec_id").select("vec_id", "CLUSTER_ID", "DIST_TO_CLUSTER_0",
                                              "DIST_TO_CLUSTER_1", "DIST_TO_CLUSTER_2")


def q_unsupervised_summary(spark, sf):
    """Sample size, variance shares, k-means inertia and cluster sizes."""
    proj, e = _projection(spark, sf)
    scored = proj.transform(e, "vec_id")
    sizes = scored.groupBy("CLUSTER_ID").count().orderBy("CLUSTER_ID").collect()   # k rows
    rows = [("pca_explained_pc1", float(proj.explained[0])),
            ("pca_explained_pc2", float(proj.explained[1])),
            ("pca_explained_total", float(sum(proj.explained[:2]))),
            ("kmeans_inertia", float(proj.inertia)),
            ("n_features", float(len(proj.features)))]
    rows += [(f"cluster_{r['CLUSTER_ID']}_rows", float(r["count"])) for r in sizes]
    return spark.createDataFrame(rows, "metric string, value double")


def q_kmeans_k_selection(spark, sf):
    from riskframe.operators.cluster import kmeans_k_selection
    proj, e = _projection(spark, sf)
    x, names = proj.prepare(e)
    rows = kmeans_k_selection(x.select("vec_id", *names), names, id_col="vec_id")
    return spark.createDataFrame([(r["k"], float(r["inertia"]), r["silhouette_score"], r["silhouette_squared"]) for r in rows],
                                 "k int, inertia double, silhouette_score double, silhouette_squared double")


def q_kmeans_certificate(spark, sf):
    """Every row is assigned to its nearest centre, and every centre is its rows' mean."""
    from riskframe.operators.cluster import assign_clusters, kmeans_certificate
    proj, e = _projection(spark, sf)
    x, names = proj.prepare(e)
    assigned = assign_clusters(x.select(*names), names, proj.centres).select(*names, "CLUSTER_ID")
    return kmeans_certificate(assigned, names, proj.centres)


def q_silhouette(spark, sf):
    """Euclidean silhouette of each sampled embedding, with its label as the cluster."""
    from riskframe.operators.cluster import silhouette_rows
    e, names = _embedding_columns(spark, sf)
    return silhouette_rows(e, names, "label", "vec_id").select(
        F.col("id").alias("vec_id"), "cluster", F.round("silhouette", 9).alias("silhouette"))


def _model_run(spark, sf, cv_models=None):
    from riskframe.operators.model import default_models
    from riskframe.plans.modeling import run_models
    return run_models(applicants(spark, sf), TableSpec(), default_models(), cv_models)


def _feature_plan(spark, sf, by_importance=False):
    from riskframe.operators.model import tree_importance
    from riskframe.plans.modeling import fit_features
    rank = (lambda df, feats: tree_importance(df, feats, "TARGET", id_col="SK_ID_CURR")) if by_importance else None
    return fit_features(applicants(spark, sf), importance_model=rank)


def q_model_results(spark, sf):
    return _model_run(spark, sf).results


def q_model_comparison(spark, sf):
    return _model_run(spark, sf).comparison


def q_second_booster(spark, sf):
    """K5: results of the boosted model with 63 leaves, all folds and the held-out split."""
    from riskframe.operators.model import second_booster_spec
    from riskframe.plans.modeling import run_models
    return run_models(applicants(spark, sf), TableSpec(), [second_booster_spec()]).results


def q_top_importances(spark, sf):
    """Importances of the models fitted on the training rows; no fold is fitted."""
    from riskframe.operators.report import top_importances
    return top_importances(_model_run(spark, sf, []).importances, 30)


def q_selected_features(spark, sf):
    plan, _ = _feature_plan(spark, sf, by_importance=True)
    rows = [(f, i) for i, f in enumerate(plan.kept)]
    return spark.createDataFrame(rows, "feature string, position int")


def q_feature_log(spark, sf):
    return _feature_plan(spark, sf)[0].log_frame(spark)


def q_pipeline_snapshot(spark, sf):
    """The feature counts of the run log."""
    from riskframe.operators.report import pipeline_snapshot
    return pipeline_snapshot(_feature_plan(spark, sf)[0].log_frame(spark))


# ---- 2.A sources and the preparation stage ---------------------------------------------

def _scratch(spark, name: str) -> str:
    import uuid
    from riskframe.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q_csv_roundtrip(spark, sf):
    """Customer written as header CSV to the shared scratch folder,
    read back as text, names standardized, numeric-looking columns typed by content."""
    from riskframe.sources.tables import read_csv_table, write_csv
    base = _scratch(spark, "csv")
    write_csv(table(spark, sf, "customer"), f"{base}/customer.csv")
    raw = read_csv_table(spark, base, "customer.csv")
    typed, _ = clean.coerce_numeric_like(clean.normalize_placeholders(raw))
    return typed


def q_prepared_customers(spark, sf):
    """Task-1 shape on the driver tables: clean customer, orders and lineitem,
    roll orders and lineitem up per customer, left-join both to the customers."""
    from riskframe.plans.prepare import prepare
    c = derived(spark, sf, CUSTOMER_MAIN)
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    li = (table(spark, sf, "lineitem")
          .join(o.select(F.col("o_orderkey").alias("l_orderkey"), "c_custkey"), "l_orderkey"))
    merged, _ = prepare(c, {"ORD": o, "LI": li}, TableSpec("C_CUSTKEY", "TARGET"))
    return merged


def q_prepare_log(spark, sf):
    from riskframe.plans.prepare import prepare
    c = derived(spark, sf, CUSTOMER_MAIN)
    o = table(spark, sf, "orders").withColumnRenamed("o_custkey", "c_custkey")
    _, log = prepare(c, {"ORD": o, "BUREAU": None}, TableSpec("C_CUSTKEY", "TARGET"))
    return log


# ---- remaining inventory items ---------------------------------------------------------

NON_FINITE_SQL_COLS = """
    l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 17 = 0 THEN CAST('Infinity' AS DOUBLE)
         WHEN l_orderkey % 19 = 0 THEN CAST('-Infinity' AS DOUBLE)
         WHEN l_orderkey % 23 = 0 THEN CAST('NaN' AS DOUBLE)
         ELSE l_tax END AS l_tax_nf"""


def q_non_finite_to_null(spark, sf):
    """NaN and +-Inf become NULL at ingest."""
    from riskframe.plans.inputs import _split_select
    li = table(spark, sf, "lineitem").selectExpr(*_split_select(NON_FINITE_SQL_COLS))
    return clean.non_finite_columns_to_null(li, ["l_tax_nf"])


def q_fill_zero(spark, sf):
    """Last-resort 0 for missing numeric values."""
    li = derived(spark, sf, LINEITEM_MISSING).select("l_orderkey", "l_linenumber", "l_price_m")
    return clean.fill_zero(li, ["l_price_m"])


def q_distinct_ids(spark, sf):
    """D3: a support table with nothing to aggregate rolls up to its distinct ids."""
    o = table(spark, sf, "orders").select("o_custkey")
    return rollup.rollup(o, "o_custkey", "ord", [], [])


def q_sample_per_class(spark, sf):
    """At most n rows per class in seeded hash order (the reference caps
    each class at 15,000 rows for its plots; n = 200 here)."""
    li = derived(spark, sf, LINEITEM_SCORES).withColumn(
        "row_id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return sampling.sample_n(li, 200, "row_id", 42, target="y").select("row_id", "y")


def q_feature_metadata(spark, sf):
    """Per feature -- selected, dropped by correlation, importance, variance."""
    from riskframe.operators.report import feature_metadata
    plan, _ = _feature_plan(spark, sf, by_importance=True)
    imp = spark.createDataFrame(list(plan.importance.items()), "feature string, importance double")
    all_feats = spark.createDataFrame([(f,) for f in sorted(set(plan.kept) | set(plan.dropped_corr))],
                                      "feature string")
    dropped = spark.createDataFrame([(f,) for f in plan.dropped_corr], "feature string")
    kept = spark.createDataFrame([(f,) for f in plan.kept], "feature string")
    var = spark.createDataFrame(list(plan.variance.items()), "feature string, variance double")
    return feature_metadata(all_feats, dropped, imp, var, kept)


# ---- queries over saved state, stage records and small operators ------------------------

def q_saved_scaler(spark, sf):
    """A5: a scaler fitted on lineitem, saved, loaded back from the state store and applied."""
    from riskframe.sources.state import load_state, save_state
    li = derived(spark, sf, LINEITEM_MISSING)
    path = _scratch(spark, "state")
    save_state(spark, path, encode.StandardScaler.fit(li, WINSOR_COLS))
    return round_doubles(load_state(spark, path).transform(li).select("l_orderkey", "l_linenumber", *WINSOR_COLS))


def q_saved_clipper(spark, sf):
    """A5: clip bounds fitted on lineitem, saved, loaded back from the state store and applied."""
    from riskframe.sources.state import load_state, save_state
    li = derived(spark, sf, LINEITEM_MISSING)
    path = _scratch(spark, "state")
    save_state(spark, path, encode.Winsorizer.fit(li, WINSOR_COLS))
    return round_doubles(load_state(spark, path).transform(li).select("l_orderkey", "l_linenumber", *WINSOR_COLS))


def q_resumed_stages(spark, sf):
    """Two stages run twice over the same stage store; the second run reads both from their commit records.

    Rows are the second run's table with the log of both runs: one row per stage."""
    from riskframe.plans.inputs import _split_select
    from riskframe.sources.results import log_rows
    from riskframe.sources.stages import StageStore
    store = StageStore(spark, _scratch(spark, "stages"))
    for _ in range(2):
        clean_orders = store.run("clean", [table(spark, sf, "orders")], lambda o: clean.impute_constant(
            clean.normalize_placeholders(o.selectExpr(*_split_select(ORDERS_PLACEHOLDERS[1])), ["o_orderpriority"]), ["o_orderpriority"]))
        store.log("clean", log_rows(spark, "clean", "orders", {"rows": clean_orders.count()}))
        counts = store.run("counts", [clean_orders], lambda o: o.groupBy("o_orderpriority").agg(
            F.count(F.lit(1)).alias("n_orders")))
        store.log("counts", log_rows(spark, "counts", "orders", {"rows": counts.count()}))
    log = store.read_log().select(F.concat_ws(":", "stage", "metric").alias("name"), F.col("value").cast("long").alias("n"))
    return counts.select(F.col("o_orderpriority").alias("name"), F.col("n_orders").alias("n")).unionByName(log)


def q_join_sample_features(spark, sf):
    """Features of a 300-row sample joined onto every customer."""
    from riskframe.plans.modeling import join_sample_features
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    sample = sampling.sample_n(c, 300, "c_custkey", 42)
    extra = sample.select("c_custkey", "c_nationkey", (F.col("c_nationkey") % 3).alias("CLUSTER_ID"), F.abs("c_acctbal").alias("DIST_TO_CLUSTER_0"))
    return join_sample_features(c, extra, "c_custkey")


def q_duplicate_columns(spark, sf):
    """Of equally named columns the first stays."""
    from riskframe.functions.names import drop_duplicate_columns
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    twice = o.select("*", F.col("o_custkey").alias("O_ORDERKEY"), (F.col("o_totalprice") * 2).alias("o_totalprice"))
    return drop_duplicate_columns(twice)


def q_forced_numeric(spark, sf):
    """Forced numeric conversion; text that is no number becomes NULL."""
    from riskframe.functions.numeric import to_double_or_null
    t = derived(spark, sf, LINEITEM_TEXT_NUMBERS)
    return t.select("l_orderkey", "l_linenumber", to_double_or_null("t95", text=True).alias("t95"), to_double_or_null("t80", text=True).alias("t80"))


def _ranked_by_variance(spark, sf):
    """Columns of lineitem with their variance as importance, ranked (per-feature table)."""
    from riskframe.operators.report import top_importances
    li = derived(spark, sf, LINEITEM_MISSING)
    order = F.array_position(F.array(*[F.lit(c) for c in LI_FEATURES]), F.col("feature")).cast("int") - 1
    imp = profile.feature_variance(li, LI_FEATURES).select(
        F.lit("variance").alias("model"), "feature", F.col("variance").alias("importance"), order.alias("position"))
    return li, top_importances(imp, 2)


def q_top_features(spark, sf):
    """the two most important columns, ties by position."""
    return round_doubles(_ranked_by_variance(spark, sf)[1])


def q_selected_columns(spark, sf):
    """Ids, target and the kept features."""
    li, ranked = _ranked_by_variance(spark, sf)
    kept = {r["feature"] for r in ranked.collect()}     # two names
    return li.select("l_orderkey", "l_linenumber", "is_r", *[c for c in LI_FEATURES if c in kept])


def q_feature_report(spark, sf):
    """Selected, dropped by correlation, importance and variance per column, from data-derived per-feature tables."""
    from riskframe.operators.report import feature_metadata
    li, ranked = _ranked_by_variance(spark, sf)
    names = spark.createDataFrame([(c,) for c in LI_FEATURES], "feature string")
    variance = profile.feature_variance(li, LI_FEATURES)
    pairs = corr.correlation_matrix(li, LI_FEATURES)
    dropped = corr.correlation_prune(pairs, 0.9).select("feature")
    return round_doubles(feature_metadata(names, dropped, ranked.select("feature", "importance"), variance, ranked.select("feature")))


def q_safety_fill(spark, sf):
    """Features and target apart, what is still missing filled with the training rows' medians."""
    li = derived(spark, sf, LINEITEM_MISSING)
    train = li.where(F.col("l_orderkey") % 5 != 0)
    filled = clean.MedianImputer.fit(train, LI_FEATURES).transform(li)
    return (filled.withColumn("missing", F.col("l_orderkey") % 7 == 0)
            .withColumn("l_price_m", F.when(F.col("missing"), snap(F.col("l_price_m"))).otherwise(F.col("l_price_m")))
            .select("l_orderkey", "l_linenumber", *LI_FEATURES, F.col("is_r").alias("label")))


def q_rounded_report(spark, sf):
    """The comparison table with four decimals."""
    from riskframe.operators import report
    return report.comparison_table(score_results(spark, sf), digits=4)
