"""The two named settings of blocking."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Blocking:
    name_k: int = 10
    name_threshold: float = 0.3
    address_k: int = 5
    address_threshold: float = 0.4
    max_df: float = 0.1
    token_overlap: bool = True
    exact_longer: int = 0
    scope: str = "global"


TRAIN = Blocking()
PRODUCTION = Blocking(address_threshold=0.35, max_df=0.01, token_overlap=False, exact_longer=2)
