"""Layered configuration: defaults, then a job's mapping or JSON file, then LEDGERFLOW_* variables and key=value arguments."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable, Mapping

DEFAULTS: dict = {
    "app_name": "ledgerflow",
    "master": "local[*]",
    "spark": {"spark.sql.adaptive.enabled": "true", "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "spark.sql.session.timeZone": "UTC"},
    "servers": None,
    "feeds": {},
    "files_per_batch": None,
    "history_path": None,
    "current_path": None,
    "letters_path": None,
    "checkpoint": None,
    "buckets": None,
}


def _set(config: dict, key: str, value) -> None:
    *path, last = key.split(".") if not key.startswith("spark.") else ("spark", key)
    for p in path:
        config = config.setdefault(p, {})
    config[last] = value


def load(job: Mapping | str | None = None, environment: Mapping[str, str] | None = None, arguments: Iterable[str] = ()) -> dict:
    config = json.loads(json.dumps(DEFAULTS))
    if isinstance(job, str):
        with open(job, encoding="utf-8") as f:
            job = json.load(f)
    for key, value in (job or {}).items():
        config[key] = config[key] | value if isinstance(value, dict) and isinstance(config.get(key), dict) else value
    for key, value in (os.environ if environment is None else environment).items():
        if key.startswith("LEDGERFLOW_"):
            _set(config, key.removeprefix("LEDGERFLOW_").lower().replace("__", "."), value)
    for argument in arguments:
        key, _, value = argument.lstrip("-").partition("=")
        _set(config, key, value)
    return config
