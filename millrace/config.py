"""Validated settings."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

WRITE_MODES, COW_MODES, CLEANUPS = ("trajectory", "transaction"), ("none", "timer", "batch"), ("delete", "archive", "off")


@dataclass(frozen=True)
class Config:
    """write_mode: append the history, or mirror by key. cow_mode: how the mirror is written (row deltas,
    the same by timer, or copy-on-write by batch)."""

    write_mode: str = "trajectory"
    cow_mode: str = "none"
    max_files_per_trigger: int = 1000
    trigger_seconds: int = 5
    partition_col: str | None = None
    compact_dedup: bool = False
    compact_small_files: bool = False
    compact_interval_seconds: int = 3600
    compact_file_bytes: int = 128 << 20
    recreate: bool = False
    source_cleanup: str = "off"
    slice_rows: int = 100_000
    strict_fold: bool = False
    attempts_before_dead_letter: int = 3
    tables_at_once: int = 4

    def __post_init__(self) -> None:
        for name, allowed in (("write_mode", WRITE_MODES), ("cow_mode", COW_MODES), ("source_cleanup", CLEANUPS)):
            if getattr(self, name) not in allowed:
                raise ValueError(f"{name} must be one of {', '.join(allowed)}, not {getattr(self, name)!r}")
        for name in ("max_files_per_trigger", "trigger_seconds", "compact_interval_seconds", "compact_file_bytes", "slice_rows", "attempts_before_dead_letter", "tables_at_once"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")

    @property
    def transaction(self) -> bool:
        return self.write_mode == "transaction"

    @classmethod
    def of(cls, values: Mapping[str, str]) -> Config:
        """From strings, as in a properties file; unknown names are errors."""
        kinds = {f.name: f.default for f in fields(cls)}
        out = {}
        for k, v in values.items():
            if k not in kinds:
                raise ValueError(f"no such setting: {k}")
            d = kinds[k]
            out[k] = v.strip().lower() in ("true", "1") if isinstance(d, bool) else int(v) if isinstance(d, int) else (v.strip() or None)
        return cls(**out)
