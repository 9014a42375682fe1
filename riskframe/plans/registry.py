"""Query registry: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from riskframe.plans import driver_queries as dq
from riskframe.plans.oracle import SQL

# name -> Spark callable; every name with an SQL entry in ``SQL`` is oracle-checked
QUERIES = {
    "standardize_columns": dq.q_standardize_columns,
    "clean_placeholders": dq.q_clean_placeholders,
    "impute_unknown": dq.q_impute_unknown,
    "clean_coerce_numeric": dq.q_clean_coerce_numeric,
    "impute_median": dq.q_impute_median,
    "dedupe_rows": dq.q_dedupe_rows,
    "missing_profile": dq.q_missing_profile,
    "clean_log": dq.q_clean_log,
    "safe_ratio": dq.q_safe_ratio,
    "sentinel_flag": dq.q_sentinel_flag,
    "engineer_features": dq.q_engineer_features,
    "drop_constant_columns": dq.q_drop_constant_columns,
    "class_filter": dq.q_class_filter,
    "rollup_numeric": dq.q_rollup_numeric,
    "rollup_category_share": dq.q_rollup_category_share,
    "rollup_join": dq.q_rollup_join,
    "target_correlations": dq.q_target_correlations,
    "top_correlations": dq.q_top_correlations,
    "class_balance": dq.q_class_balance,
    "describe_numeric": dq.q_describe_numeric,
    "quantiles": dq.q_quantiles,
    "distinct_counts": dq.q_distinct_counts,
    "feature_variance": dq.q_feature_variance,
    "binary_column_check": dq.q_binary_column_check,
    "class_histogram": dq.q_class_histogram,
    "correlation_matrix": dq.q_correlation_matrix,
    "correlation_prune": dq.q_correlation_prune,
    "spearman": dq.q_spearman,
    "mann_whitney": dq.q_mann_whitney,
    "mann_whitney_p": dq.q_mann_whitney_p,
    "chi_square": dq.q_chi_square,
    "chi_square_p": dq.q_chi_square_p,
    "cluster_profile": dq.q_cluster_profile,
    "kmeans_distance": dq.q_kmeans_distance,
    "class_weights": dq.q_class_weights,
    "avg_rank": dq.q_avg_rank,
    "roc_points": dq.q_roc_points,
    "pr_points": dq.q_pr_points,
    "ranking_metrics": dq.q_ranking_metrics,
    "confusion": dq.q_confusion,
    "sample_n": dq.q_sample_n,
    "stratified_split": dq.q_stratified_split,
    "encode_categoricals": dq.q_encode_categoricals,
    "winsorize": dq.q_winsorize,
    "standard_scale": dq.q_standard_scale,
    "results_table": dq.q_results_table,
    "comparison_table": dq.q_comparison_table,
    "model_selection": dq.q_model_selection,
    "score_contributions": dq.q_score_contributions,
    "runner_up_margin": dq.q_runner_up_margin,
    "metric_leaderboard": dq.q_metric_leaderboard,
    "screening_quadrant": dq.q_screening_quadrant,
    "pca_project": dq.q_pca_project,
    "kmeans_assign": dq.q_kmeans_assign,
    "unsupervised_summary": dq.q_unsupervised_summary,
    "kmeans_certificate": dq.q_kmeans_certificate,
    "silhouette": dq.q_silhouette,
    "kmeans_k_selection": dq.q_kmeans_k_selection,
    "model_results": dq.q_model_results,
    "model_comparison": dq.q_model_comparison,
    "second_booster": dq.q_second_booster,
    "top_importances": dq.q_top_importances,
    "selected_features": dq.q_selected_features,
    "feature_log": dq.q_feature_log,
    "pipeline_snapshot": dq.q_pipeline_snapshot,
    "saved_scaler": dq.q_saved_scaler,
    "saved_clipper": dq.q_saved_clipper,
    "resumed_stages": dq.q_resumed_stages,
    "join_sample_features": dq.q_join_sample_features,
    "duplicate_columns": dq.q_duplicate_columns,
    "forced_numeric": dq.q_forced_numeric,
    "top_features": dq.q_top_features,
    "selected_columns": dq.q_selected_columns,
    "feature_report": dq.q_feature_report,
    "safety_fill": dq.q_safety_fill,
    "rounded_report": dq.q_rounded_report,
    "csv_roundtrip": dq.q_csv_roundtrip,
    "prepared_customers": dq.q_prepared_customers,
    "prepare_log": dq.q_prepare_log,
    "non_finite_to_null": dq.q_non_finite_to_null,
    "fill_zero": dq.q_fill_zero,
    "distinct_ids": dq.q_distinct_ids,
    "sample_per_class": dq.q_sample_per_class,
    "feature_metadata": dq.q_feature_metadata,
}


def oracle() -> dict[str, str]:
    return {k: v for k, v in SQL.items() if k in QUERIES}
