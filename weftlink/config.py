"""Settings: typed defaults, overridden by environment variables or ``spark.weftlink.*``."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from typing import Any

TRUE_WORDS = frozenset({"true", "1", "t", "y", "yes"})


def env_str(env: Mapping[str, str], key: str, default: str) -> str:
    return env.get(key, default)


def env_int(env: Mapping[str, str], key: str, default: int) -> int:
    """The default if the variable is missing or no integer."""
    try:
        return int(env[key])
    except (KeyError, ValueError):
        return default


def env_float(env: Mapping[str, str], key: str, default: float) -> float:
    try:
        return float(env[key])
    except (KeyError, ValueError):
        return default


def env_bool(env: Mapping[str, str], key: str, default: bool) -> bool:
    return env[key].strip().lower() in TRUE_WORDS if key in env else default


def env_list(env: Mapping[str, str], key: str, default: tuple[str, ...]) -> tuple[str, ...]:
    """Comma-parted and stripped; an empty value gives the default."""
    found = tuple(x.strip() for x in env.get(key, "").split(",") if x.strip())
    return found or default


@dataclass(frozen=True)
class Settings:
    """One value for each key; the environment has them in capitals."""

    # Keys and defaults that decide results.
    random_seed: int = 42
    pipeline_mode: str = "infer"
    data_dir_train: str = "dataset/train"
    data_dir_test: str = "dataset/test"
    ground_truth_path: str = "dataset/train/train_ground_truth.tsv"
    processed_data_dir: str = "data/processed"
    model_output_path: str = "models/pair_model"
    output_dir: str = "output/"
    null_literals: tuple[str, ...] = ("n/a", "na", "null", "none", "-")
    nullname_prefix: str = "nullname"
    nulladdr_prefix: str = "nulladdr"
    enable_transliteration: bool = True
    transliteration_scheme: str = "itrans"
    symbol_at_replacement: str = " at "
    symbol_amp_replacement: str = " and "
    parquet_compression: str = "snappy"
    embed_batch_size: int = 256
    bm25_ngram_size: int = 3
    bm25_k1: float = 1.5
    bm25_b: float = 0.75
    bm25_epsilon: float = 0.25
    dag_k_base: int = 20
    dag_max_seen: int = 90
    dag_min_cycles: int = 3
    batch_size: int = 10000
    train_buffer_chunk_size: int = 10000
    rrf_k_bm25_name: int = 60
    rrf_k_bm25_addr: int = 60
    rrf_k_vector: int = 60
    bm25_self_score_floor: float = 1e-9
    jaro_winkler_prefix_weight: float = 0.1
    target_encoder_cv: int = 5
    search_trials: int = 100
    search_seed: int = 42
    cv_folds: int = 5
    threshold_search_start: float = 0.50
    threshold_search_end: float = 0.99
    threshold_search_step: float = 0.01
    fbeta_score_beta: float = 0.5

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None, spark: Any = None) -> Settings:
        """Defaults, then the environment, then ``spark.weftlink.<key>`` of a session."""
        env = dict(os.environ if env is None else env)
        if spark is not None:
            for f in fields(cls):
                if (value := spark.conf.get(f"spark.weftlink.{f.name}", None)) is not None:
                    env[f.name.upper()] = value
        read = {int: env_int, float: env_float, bool: env_bool, str: env_str, tuple: env_list}
        return cls(**{f.name: read[type(f.default)](env, f.name.upper(), f.default) for f in fields(cls)})
