"""Scopes and manifests: frozen settings, excluded roots as a hash-linked chain, fingerprints of written tables."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical(value: object) -> str:
    """JSON with sorted keys and no blanks, the form that identities are hashed in."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def digest(value: object) -> str:
    return hashlib.sha256(canonical(value).encode()).hexdigest()


@dataclass(frozen=True)
class Amendment:
    """An authorisation to leave roots out, linked to the one before it by hash."""

    excluded_roots: tuple[str, ...]
    reason: str
    previous: str | None = None

    @property
    def sha256(self) -> str:
        return digest({"excluded_roots": list(self.excluded_roots), "reason": self.reason, "previous": self.previous})


def roots_of(chain: list[Amendment]) -> tuple[str, ...]:
    """All excluded roots of a valid chain, nested ones collapsed; a broken link raises."""
    before, roots = None, set()
    for a in chain:
        if a.previous != before:
            raise ValueError("the scope chain is broken")
        before = a.sha256
        roots |= set(a.excluded_roots)
    return tuple(sorted(r for r in roots if not any(r.startswith(o + "/") for o in roots)))


def frozen(settings: dict, expected: str | None = None) -> str:
    """The fingerprint of settings; raises if a run began with other ones."""
    now = digest(settings)
    if expected is not None and expected != now:
        raise ValueError("settings changed within a run")
    return now


def fingerprint(df: DataFrame) -> dict:
    """Rows and an order-free content hash of a table, for manifests and reuse."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)]) if df.columns else F.lit(0)
    rows, total = df.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(38,0)"))).first()
    return {"rows": rows, "content": digest([rows, str(total)]), "columns": sorted(df.dtypes)}
