"""Run settings: one frozen value object that the plans take as an argument."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

# Defaults and accepted ranges of the integer settings.
INT_RANGES = {
    "max_pages": (1, None),
    "max_datasets": (1, None),
    "dup_threshold": (0, 100),
    "dup_sample_size": (1, None),
    "year_min": (1900, None),
    "year_max": (2000, None),
}


@dataclass(frozen=True)
class Settings:
    max_pages: int | None = None
    max_datasets: int | None = None
    dup_threshold: int = 85
    dup_sample_size: int = 5
    verify_threshold: int = 98
    require_columns: tuple[str, ...] = ("tahun", "kode_wilayah")
    allowed_load_statuses: tuple[str, ...] = ("ready",)
    year_min: int = 2000
    year_max: int = 2025

    @classmethod
    def from_mapping(cls, values: dict[str, str | None]) -> "Settings":
        """Settings from text values keyed by field name; unusable values fall back to the default."""
        out = cls()
        for field in fields(cls):
            raw = values.get(field.name)
            if not raw:
                continue
            if field.name in ("require_columns", "allowed_load_statuses"):
                items = tuple(part.strip().lower() for part in raw.split(",") if part.strip())
                if items:
                    out = replace(out, **{field.name: items})
                continue
            try:
                number = int(raw)
            except ValueError:
                continue
            low, high = INT_RANGES.get(field.name, (None, None))
            if (low is None or number >= low) and (high is None or number <= high):
                out = replace(out, **{field.name: number})
        return out
