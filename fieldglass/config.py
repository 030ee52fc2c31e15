"""Settings per stage. Overrides go through ``replaced``, which rejects unknown names."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field


class Replaceable:
    def replaced(self, **changes):
        known = {f.name for f in dataclasses.fields(self)}
        unknown = sorted(set(changes) - known)
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return dataclasses.replace(self, **changes)


# The defaults of the three stages.
@dataclass(frozen=True)
class EtlConfig(Replaceable):
    input_files: tuple[str, ...] = ()
    input_schema: str | None = None
    output_path: str | None = None
    report_path: str | None = None
    window_days: int | None = None
    keep_columns: tuple[str, ...] = ()
    drop_types: tuple[str, ...] = ()
    constant_columns: str = "drop"
    high_cardinality_threshold: int = 1000
    high_cardinality: str = "keep"
    missing_threshold: float = 0.95
    duplicate_rows: str = "keep"


@dataclass(frozen=True)
class FeatureConfig(Replaceable):
    input_path: str | None = None
    report_path: str | None = None
    output_path: str | None = None
    catalog_path: str | None = None
    targets: tuple[str, ...] = ()
    primary_target: str | None = None
    order_by: tuple[str, ...] = ()
    series_key: tuple[str, ...] = ()
    imputation: str = "ffill"
    categorical_columns: tuple[str, ...] = ()
    numerical_columns: tuple[str, ...] = ()
    categorical_threshold: int = 10
    # a label that one in so many rows has gets a column of its own
    rows_per_indicator: int = 100
    scaling: str = "standard"
    selection_methods: tuple[str, ...] = ("correlation", "lasso")
    correlation_method: str = "pearson"
    lasso_alpha: float = 0.01
    use_pca: bool = False
    pca_components: float = 0.95
    selection_ratio: dict[str, float] = field(
        default_factory=lambda: {"correlation": 1.0, "lasso": 0.0, "rfe": 0.0, "pca": 1.0}
    )
    chunk_rows: int | None = None


@dataclass(frozen=True)
class SeriesConfig(Replaceable):
    horizon: int = 24
    seasonal_periods: tuple[int, ...] = (7, 30, 365)
    folds: int = 3
    lookback: int = 30
    max_lag: int = 7
    rolling_windows: tuple[int, ...] = (7, 14, 30)
    time_column: str | None = None
    chunk_rows: int | None = None


@dataclass(frozen=True)
class ModelSetup(Replaceable):
    """What is done to the features before models see them; nothing unless asked for."""

    normalize: bool = False
    ignore_low_variance: bool = False
    low_variance: float = 0.0
    remove_multicollinearity: bool = False
    multicollinearity: float = 0.9
    polynomial_features: bool = False
    feature_interaction: bool = False
    feature_selection: bool = False
    selected_share: float = 0.2
    pca: bool = False
    pca_components: float = 0.95
    # for classification: rows of smaller classes are repeated for training
    fix_imbalance: bool = False


@dataclass(frozen=True)
class ModelConfig(Replaceable):
    use_case: str = "time_series"
    targets: tuple[str, ...] = ()
    primary_target: str | None = None
    features: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    series_key: tuple[str, ...] = ()
    k_folds: int = 5
    test_size: float = 0.2
    top_models: int = 5
    sample_share: float = 0.1
    seed: int = 42
    excluded_models: tuple[str, ...] = ()
    output_path: str | None = None
    series: SeriesConfig = field(default_factory=SeriesConfig)
    setup: ModelSetup = field(default_factory=ModelSetup)
