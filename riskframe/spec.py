"""Table roles and fixed constants.

The fixed values below must equal the reference's for the same results; they
are stated once here and imported everywhere else.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values (must match the reference) ---------------------------------
PLACEHOLDER_TOKENS = ("", "NA", "N/A", "None", "null")
NUMERIC_SHARE = 0.90                  # text column becomes numeric at >= 90% parseable
TEXT_FILL = "UNKNOWN"                 # fill for missing text after cleaning
MISSING_LEVEL = "NAN"                 # name of the missing level in category shares
DAYS_EMPLOYED_SENTINEL = 365243
DAYS_PER_YEAR = 365.25
CLIP_QUANTILES = (0.01, 0.99)
LABEL_ENCODE_MAX_LEVELS = 2
ONE_HOT_MAX_LEVELS = 10
CORR_PRUNE_THRESHOLD = 0.95
TOP_K_FEATURES = 80
SAMPLE_ROWS = 20000
SEED = 42
TEST_SHARE = 0.2
CV_FOLDS = 5
MIN_ROWS_PER_CLASS = 20               # rank test is skipped below this
SELECTION_WEIGHTS = {"test_auc": 0.6, "cv_auc": 0.2, "test_pr_auc": 0.2}
SCREEN_RECALL = 0.65
SCREEN_PRECISION = 0.17
BOOSTING_POSITIVE_WEIGHT = 11.0
KMEANS_K = 3
KMEANS_K_RANGE = (2, 8)
KMEANS_RESTARTS = 10
SILHOUETTE_ROWS = 5000                # rows of the silhouette's sample
# -------------------------------------------------------------------------------


@dataclass(frozen=True)
class TableSpec:
    """Names of the entity key and the binary target; both pass through every
    encoder, clipper, scaler and selector untouched."""

    id_col: str = "SK_ID_CURR"
    target_col: str = "TARGET"

    @property
    def passthrough(self) -> tuple[str, str]:
        return (self.id_col, self.target_col)
