"""Typed run configuration (the reference's nested dict, validated).

``census(path)`` holds the settings of the census-income workflow. Column names are the
Spark-safe forms (dots become underscores at the source boundary).
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class RunConfig:
    path: str
    target: str
    target_mapping: dict
    expected_columns: list
    drop_features: list
    numeric_columns: tuple = ()                       # text that must be numbers: coerced after trimming
    grouping: dict = field(default_factory=dict)      # column -> min_freq
    other_label: str = "Other"
    outlier: str = "clip"
    pmin: float = 0.01
    pmax: float = 0.99
    num_impute: str = "median"
    cat_impute: str = "most_frequent"
    scaling: str = "standard"
    test_size: float = 0.2
    seed: int = 42
    folds: int = 5
    scoring: str = "accuracy"
    model: str = "RandomForestClassifier"
    model_params: dict = field(default_factory=dict)
    experiment: str = "experiment"
    null_tokens: tuple = ("?",)
    key: str | None = None

    def __post_init__(self):
        if self.outlier not in ("clip", "none"):
            raise ValueError(f"outlier strategy {self.outlier}")
        if self.scaling not in ("standard", "minmax", "robust", "none"):
            raise ValueError(f"scaling {self.scaling}")
        if not 0 < self.test_size < 1:
            raise ValueError("test_size must be in (0, 1)")


def census(path: str) -> RunConfig:
    """The census-income workflow over the CSV at ``path``."""
    # Target and its mapping, expected and dropped columns, the numeric list,
    # grouping thresholds, split and model defaults.
    return RunConfig(
        path=path,
        target="income",
        target_mapping={"<=50K": 0, ">50K": 1},
        expected_columns=["age", "workclass", "fnlwgt", "education", "education_num", "marital_status", "occupation",
                          "relationship", "race", "sex", "capital_gain", "capital_loss", "hours_per_week",
                          "native_country", "income"],
        drop_features=["education", "fnlwgt"],
        numeric_columns=("age", "fnlwgt", "education_num", "capital_gain", "capital_loss", "hours_per_week"),
        grouping={"workclass": 3000, "marital_status": 2000, "occupation": 2000, "relationship": 4000, "race": 500,
                  "native_country": 1000},
        outlier="clip", pmin=0.01, pmax=0.99,
        num_impute="median", cat_impute="most_frequent", scaling="standard",
        test_size=0.2, seed=42,
        model="RandomForestClassifier", model_params={"n_estimators": 100, "max_depth": None, "random_state": 42},
        experiment="census_income",
    )
