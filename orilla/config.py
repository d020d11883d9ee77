"""Settings: one dataclass, read from the environment (ORILLA_*) and the session (spark.orilla.*)."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """All knobs with their defaults; a name in upper case behind ORILLA_ sets one."""

    freeze_n: int = 5
    recalibrate_k: int = 25
    pattern_tol: float = 0.15
    chunk: int = 25
    norm_high: float = 0.55
    max_pixels: int = 512_000_000
    disk_check_every: int = 20
    min_free_mb: float = 200.0
    quiet: bool = False
    bytes_per_worker: int = 750 * 1024 * 1024
    workers: int = 0
    sql_batch: int = 50
    sql_retries: int = 3
    db_url: str = ""
    api_timeout: float = 30.0
    api_retries: int = 3
    api_backoff: float = 0.5
    api_backoff_cap: float = 30.0
    api_token: str = ""

    @classmethod
    def read(cls, spark: SparkSession | None = None, env: Mapping[str, str] | None = None) -> Settings:
        """The session's values win over the environment's; a value that doesn't parse is an error that names its knob."""
        env = os.environ if env is None else env
        found = {}
        for f in fields(cls):
            value = env.get(f"ORILLA_{f.name.upper()}")
            if spark is not None:
                value = spark.conf.get(f"spark.orilla.{f.name}", value)
            if value is None or value == "":
                continue
            kind = type(f.default)
            try:
                found[f.name] = value.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(value)
            except ValueError as e:
                raise ValueError(f"setting {f.name}: {value!r} is no {kind.__name__}") from e
        return cls(**found)
