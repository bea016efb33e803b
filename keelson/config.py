"""Run settings, model defaults and search spaces.

The dictionaries below are fixed values that must equal the original
project's settings for the same tuning behaviour; they are stated here as
plain data, in their original order. Everything else in keelson reads them
through :func:`family_defaults` and :func:`search_space_rows`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES (kept equal to the original configuration; the registered
# model name is our own)
# ---------------------------------------------------------------------------

MODEL_CONFIG = {
    "TARGET_VARIABLE": "Weight",
    "COMPARISON_METRIC": "MAPE",
    "TEST_SIZE": 0.2,
    "MAX_EVALS": 10,
    "REGISTER_MODEL_NAME": "tabular_regressor",
    "PARALELISM": 1,
}

ETR_MODEL_CONFIG = {
    "CRITERION": "mse",
    "MAX_DEPTH": 60,
    "MIN_SAMPLES_LEAF": 2,
    "MIN_SAMPLES_SPLIT": 3,
    "N_ESTIMATORS": 400,
}

LGBM_MODEL_CONFIG = {
    "BOOSTING_TYPE": "goss",
    "MAX_DEPTH": 40,
    "N_ESTIMATORS": 200,
    "NUM_LEAVES": 250,
    "REG_LAMBDA": 1,
    "SCALE_POS_WEIGHT": 1,
    "COLSAMPLE_BYTREE": 1.0,
}

LGBM_FIXED_MODEL_CONFIG = {
    "LEARNING_RATE": 0.1,
    "MIN_DATA": 100,
    "SUBSAMPLE": 0.9,
    "NUM_ITERATIONS": 200,
}

XGBOOST_MODEL_CONFIG = {
    "LEARNING_RATE": 0.01,
    "MAX_DEPTH": 100,
    "N_ESTIMATORS": 1000,
    "REG_LAMBDA": 100,
    "SCALE_POS_WEIGHT": 10,
    "COLSAMPLE_BYTREE": 0.9,
    "GAMMA": 0.01,
}

RANDOM_FOREST_MODEL_CONFIG = {
    "bootstrap": False,
    "max_depth": 90,
    "max_features": "auto",
    "min_samples_leaf": 1,
    "min_samples_split": 10,
    "n_estimators": 1000,
}

XGBOOST_FIXED_MODEL_CONFIG = {"SUBSAMPLE": 0.95}

# Search spaces: ("choice", [values]) or ("uniform", low, high).
ETR_SPACE = {
    "n_estimators": ("choice", [80, 140, 150, 180, 200, 250, 300]),
    "max_depth": ("choice", [2, 10, 15, 30, 50, 100]),
    "min_samples_split": ("choice", [3, 7, 9, 12, 15]),
    "min_samples_leaf": ("choice", [2, 4, 5, 8, 12]),
    "criterion": ("choice", ["mse"]),
}

LIGHTGBM_SPACE = {
    "num_leaves": ("choice", [20, 40, 100, 240, 245, 250, 255]),
    "colsample_bytree": ("uniform", 0.3, 1.0),
    "n_estimators": ("choice", [280, 290, 300, 310, 320]),
    "boosting_type": ("choice", ["dart", "goss"]),
    "max_depth": ("choice", [10, 20, 38, 40, 42]),
    "reg_lambda": ("choice", [0, 1, 2, 3, 10, 15]),
    "scale_pos_weight": ("choice", [1, 2, 3, 4, 10, 15]),
}

XGBOOST_SPACE = {
    "max_depth": ("choice", [4, 9, 11, 30]),
    "learning_rate": ("choice", [0.01, 0.08, 0.1, 0.5, 1.0]),
    "gamma": ("choice", [0.01, 0.08, 0.1, 1.0]),
    "reg_lambda": ("choice", [1, 10, 30, 100]),
    "n_estimators": ("choice", [40, 200, 300, 500, 1000]),
    "scale_pos_weight": ("choice", [1, 2, 3, 4, 10, 15]),
    "colsample_bytree": ("uniform", 0.3, 1.0),
}

RANDOM_FOREST_SPACE = {
    "bootstrap": ("choice", [True, False]),
    "max_depth": ("choice", [10, 20, 30, 40, 50, 60, 70, 80, 90, 100, None]),
    "max_features": ("choice", ["auto", "sqrt"]),
    "min_samples_leaf": ("choice", [1, 2, 4, 7, 10]),
    "min_samples_split": ("choice", [2, 5, 10, 20]),
    "n_estimators": ("choice", [200, 400, 800, 1000, 1200, 1600, 2000]),
}

# The smaller random-forest space of the tuning walkthrough.
RANDOM_FOREST_TEMPLATE_SPACE = {
    "bootstrap": ("choice", [True, False]),
    "max_depth": ("choice", [10, 20, 30, 90, 100, None]),
    "max_features": ("choice", ["auto", "sqrt"]),
    "min_samples_leaf": ("choice", [1, 2, 5]),
    "min_samples_split": ("choice", [2, 5, 20]),
    "n_estimators": ("choice", [200, 400, 800, 1000]),
}

# Hand-set random forest of the tracking walkthrough.
RANDOM_FOREST_HAND_SET = {
    "max_depth": 5,
    "min_samples_leaf": 3,
    "min_samples_split": 3,
    "n_estimators": 200,
    "random_state": 42,
}

RUN_NAMES = {
    "extra_trees": "ExtraTrees_Hyperopt",
    "xgboost": "XGBoost_Hyperopt",
    "random_forest": "RandomForest_Hyperopt",
    "lightgbm": "LightGBM_Hyperopt",
}

STAGES = ["None", "Staging", "Production", "Archived"]

METRIC_KEYS = ["MSE", "RMSE", "R2", "R2_Adj", "MAPE", "Dataset_Size", "Number_of_variables"]

# ---------------------------------------------------------------------------
# end of fixed values
# ---------------------------------------------------------------------------

SPACES = {
    "extra_trees": ETR_SPACE,
    "xgboost": XGBOOST_SPACE,
    "random_forest": RANDOM_FOREST_SPACE,
    "lightgbm": LIGHTGBM_SPACE,
}

# Defaults used when a search gives nothing (keys in search-space names).
DEFAULTS = {
    "extra_trees": {
        "criterion": ETR_MODEL_CONFIG["CRITERION"],
        "max_depth": ETR_MODEL_CONFIG["MAX_DEPTH"],
        "min_samples_leaf": ETR_MODEL_CONFIG["MIN_SAMPLES_LEAF"],
        "min_samples_split": ETR_MODEL_CONFIG["MIN_SAMPLES_SPLIT"],
        "n_estimators": ETR_MODEL_CONFIG["N_ESTIMATORS"],
    },
    "xgboost": {
        "max_depth": XGBOOST_MODEL_CONFIG["MAX_DEPTH"],
        "learning_rate": XGBOOST_MODEL_CONFIG["LEARNING_RATE"],
        "gamma": XGBOOST_MODEL_CONFIG["GAMMA"],
        "reg_lambda": XGBOOST_MODEL_CONFIG["REG_LAMBDA"],
        "n_estimators": XGBOOST_MODEL_CONFIG["N_ESTIMATORS"],
        "scale_pos_weight": XGBOOST_MODEL_CONFIG["SCALE_POS_WEIGHT"],
        "colsample_bytree": XGBOOST_MODEL_CONFIG["COLSAMPLE_BYTREE"],
    },
    "random_forest": dict(RANDOM_FOREST_MODEL_CONFIG),
    "lightgbm": {
        "boosting_type": LGBM_MODEL_CONFIG["BOOSTING_TYPE"],
        "max_depth": LGBM_MODEL_CONFIG["MAX_DEPTH"],
        "colsample_bytree": LGBM_MODEL_CONFIG["COLSAMPLE_BYTREE"],
        "n_estimators": LGBM_MODEL_CONFIG["N_ESTIMATORS"],
        "num_leaves": LGBM_MODEL_CONFIG["NUM_LEAVES"],
        "reg_lambda": LGBM_MODEL_CONFIG["REG_LAMBDA"],
        "scale_pos_weight": LGBM_MODEL_CONFIG["SCALE_POS_WEIGHT"],
    },
}

@dataclass
class RunConfig:
    """Driver-side settings of one training / selection cycle."""

    target: str = "charge"
    features: list[str] = field(default_factory=lambda: ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    # row key of the regression table (without the ship date it repeats)
    keys: list[str] = field(default_factory=lambda: ["l_orderkey", "l_linenumber", "ship_epoch", "l_partkey",
                                                     "l_suppkey"])
    comparison_metric: str = MODEL_CONFIG["COMPARISON_METRIC"]
    test_size: float = MODEL_CONFIG["TEST_SIZE"]
    max_evals: int = MODEL_CONFIG["MAX_EVALS"]
    parallelism: int = MODEL_CONFIG["PARALELISM"]
    model_name: str = MODEL_CONFIG["REGISTER_MODEL_NAME"]
    seed: int = 42


def _vtype(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    return "string"


def encode_value(v) -> str | None:
    """String form of a parameter value as stored in tables."""
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v)


def decode_value(s: str | None, vtype: str):
    """Inverse of :func:`encode_value` given the stored type tag."""
    if s is None or vtype == "null":
        return None
    if vtype == "bool":
        return s == "true"
    if vtype == "int":
        return int(s)
    if vtype == "float":
        return float(s)
    return s


def search_space_rows(family: str, space: dict | None = None) -> list[tuple]:
    """Rows of the ``search_space`` table for one family:
    (family, param, kind, idx, value, vtype, low, high)."""
    space = SPACES[family] if space is None else space
    rows = []
    for param, spec in space.items():
        if spec[0] == "choice":
            for i, v in enumerate(spec[1]):
                rows.append((family, param, "choice", i, encode_value(v), _vtype(v), None, None))
        else:
            rows.append((family, param, "uniform", None, None, "float", float(spec[1]), float(spec[2])))
    return rows


def family_defaults(family: str) -> dict:
    return dict(DEFAULTS[family])
