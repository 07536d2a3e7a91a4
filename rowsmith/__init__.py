"""Rowsmith: tabular classification work on Spark DataFrames.

Every operator takes DataFrames and column names and gives a DataFrame back, so plans
stay declarative until an action runs. The few that must look at a small aggregate before
they can build their plan (a row count, a covariance matrix, a hash cut) say so.
"""

from rowsmith.operators.align import (
    align,
    align_by_position,
    align_outer,
    lookup,
    mark_repeated,
    pending,
    semi_join,
    with_group_facts,
    with_position,
)
from rowsmith.operators.columns import (
    HEALTH_COMPOSITES,
    assemble,
    composite_features,
    drop_columns,
    filter_class,
    filter_not,
    rename_all,
    select_columns,
    split_xy,
    union_classes,
    with_row_id,
)
from rowsmith.operators.correlate import (
    correlation_array,
    correlation_long,
    label_correlation,
    pair_counts,
    pearson_matrix,
    rank_table,
    select_correlated,
    spearman_matrix,
    top_correlated,
)
from rowsmith.operators.describe import (
    class_counts,
    class_ratio,
    count_where,
    density,
    histogram,
    value_limits,
)
from rowsmith.operators.metrics import (
    all_metrics,
    auc_roc,
    audit_scores,
    binary_metrics,
    classification_metrics,
    confusion,
)
from rowsmith.operators.quality import (
    Rule,
    between,
    clean,
    drop_contradictions,
    drop_exact_duplicates,
    health_survey_rules,
    invalid_rows,
    one_of,
    validity_report,
)
from rowsmith.operators.reduce import (
    absolute_contributions,
    choose_by_elbow,
    choose_clusters,
    choose_components,
    explained_variance_table,
    factor_eigenvalues,
    factor_loadings,
    kmeans_clusters,
    kmeans_cost_curve,
    pca_filter,
    pca_fit,
    pca_project,
    silhouettes,
    top_contributors,
)
from rowsmith.operators.resample import (
    kfold,
    no_sampling,
    oversample,
    train_test_split,
    undersample,
)
from rowsmith.operators.scores import best_model, compare_models, compare_samplings, run_pending
from rowsmith.operators.wide import fit_wide, wide_components, wide_project, wide_scores
from rowsmith.operators.train import (
    MODEL_KEYS,
    ExactAuc,
    cross_validate,
    experiment,
    experiment_plan,
    fit_score,
    grid_search,
    halving_search,
    make_model,
    mlp_layers,
    param_grid,
)
from rowsmith.sources import (
    append_scores,
    load_table,
    read_score_table,
    read_scores,
    read_table_csv,
    write_scores_json,
    write_table_csv,
)

__version__ = "0.1.0"
__all__ = [name for name in dir() if not name.startswith("_") and name not in ("operators", "sources", "functions", "session")]
