"""Extraction settings: closed key set, types, ranges, precedence."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Config:
    min_contact_pairs: int = 5
    merge_gap_seconds: int = 600
    seed: int = 42
    limit_chats: int | None = None
    excluded_contact_labels: tuple[str, ...] = ()
    #: Host names that mark serialized metadata, besides the fixed patterns.
    metadata_hosts: tuple[str, ...] = ()


#: Settings that are read where none are named, if they are there; the example beside them.
DEFAULT_PATH, EXAMPLE = Path("config/extraction_config.json"), "extraction_config.example.json"
LISTS = ("excluded_contact_labels", "metadata_hosts")


def _checked(key: str, value):
    if key in LISTS:
        if not isinstance(value, (list, tuple)) or not all(isinstance(x, str) for x in value):
            raise ValueError(f"{key} must be a list of strings")
        return tuple(value)
    if value is None and key == "limit_chats":
        return None
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{key} must be an integer")
    return value


def load(path: str | None) -> dict:
    """Settings of a JSON file; unknown keys and wrong types are errors.

    Without a path, those at DEFAULT_PATH, or none if there are none. A named
    file that is missing is an error, with a hint if an example lies beside it.
    """
    if path is None:
        if not DEFAULT_PATH.exists():
            return {}
        path = str(DEFAULT_PATH)
    if not Path(path).exists():
        example = Path(path).with_name(EXAMPLE)
        raise FileNotFoundError(f"config file not found: {path}." + f" Copy {example} to {path} and edit it for local use." * example.exists())
    try:
        raw = json.loads(Path(path).read_text())
    except ValueError as e:
        raise ValueError(f"{path} is not JSON: {e}") from e
    if not isinstance(raw, dict):
        raise ValueError(f"{path} must hold an object")
    if unknown := sorted(set(raw) - {f.name for f in fields(Config)}):
        raise ValueError(f"unknown settings: {', '.join(unknown)}")
    return {k: _checked(k, v) for k, v in raw.items()}


def resolve(given: dict, loaded: dict) -> Config:
    """Given settings before loaded ones before defaults; ranges are checked."""
    merged = asdict(Config()) | loaded | {k: v for k, v in given.items() if v is not None}
    c = Config(**(merged | {k: tuple(merged[k]) for k in LISTS}))
    if c.min_contact_pairs < 1:
        raise ValueError("min_contact_pairs must be at least 1")
    if c.merge_gap_seconds < 0:
        raise ValueError("merge_gap_seconds must not be negative")
    if c.limit_chats is not None and c.limit_chats < 1:
        raise ValueError("limit_chats must be at least 1")
    return c
