"""Settings of a run: defaults, environment, overrides, and their validation."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields
from pathlib import Path


@dataclass(frozen=True)
class Settings:
    """Values are checked on construction; ``load`` reads ``.env``, then the environment, then overrides."""

    data_dir: str = "./data"
    dataset_filter: str = "gjeldende"
    storage: str = "store"
    api_key: str = ""
    embedding_model: str = "local-hash"
    embedding_dimensions: int = 1024
    embedding_cache: str = ""
    chunk_max_tokens: int = 6800
    chunk_target_tokens: int = 2000
    chunk_min_tokens: int = 300
    chunk_overlap_ratio: float = 0.15
    batch_size: int = 100
    force: bool = False
    limit: int | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "dataset_filter", self.dataset_filter.strip())
        if self.storage not in {"flat", "jsonl", "store"}:
            raise ValueError(f"storage is flat, jsonl or store, not {self.storage!r}")
        if not self.dataset_filter:
            raise ValueError("dataset_filter is blank")
        if self.api_key and (not self.api_key.startswith("sk-") or len(self.api_key) < 20):
            raise ValueError("api_key starts with sk- and has 20 characters at least")
        for name, low, high in (("embedding_dimensions", 256, 3072), ("chunk_max_tokens", 100, 10_000), ("chunk_target_tokens", 100, 8191), ("chunk_min_tokens", 50, 1000), ("chunk_overlap_ratio", 0.0, 0.5)):
            if not low <= getattr(self, name) <= high:
                raise ValueError(f"{name} is from {low} to {high}, not {getattr(self, name)}")

    @classmethod
    def load(cls, overrides: Mapping[str, object] | None = None, env: Mapping[str, str] | None = None, env_file: str = ".env") -> Settings:
        """Names are taken without regard to case and unknown ones are ignored; None overrides nothing."""
        found: dict[str, object] = {}
        if Path(env_file).is_file():
            lines = (x.partition("=") for x in Path(env_file).read_text().splitlines() if "=" in x and not x.lstrip().startswith("#"))
            found |= {k.strip().lower(): v.strip().strip("\"'") for k, _, v in lines}
        found |= {k.lower(): v for k, v in (os.environ if env is None else env).items()}
        found |= {k.lower(): v for k, v in (overrides or {}).items() if v is not None}
        kinds = {f.name: str(f.type) for f in fields(cls)}
        cast = {"int": int, "float": float, "str": str, "int | None": lambda v: None if v in ("", None) else int(v), "bool": lambda v: v if isinstance(v, bool) else str(v).lower() in {"1", "true", "yes", "on"}}
        return cls(**{k: cast[kinds[k]](v) for k, v in found.items() if k in kinds})
