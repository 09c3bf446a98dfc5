"""Patterns for personal data, secrets and artefacts, in two sets that stay apart.

The inventory set counts records; the task set rejects candidates.  Their
patterns differ on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns are part of the results.
INVENTORY = {
    "email": r"\b[A-Za-z0-9._%+\-]{1,64}@[A-Za-z0-9.\-]{1,200}\.[A-Za-z]{2,20}\b",
    "greek_phone": r"(?<!\d)(?:\+30[ .-]?)?(?:69|21|23|26|28)\d{8}(?!\d)",
    "iban": r"(?i)\bGR\s?\d{2}(?:\s?[A-Z0-9]){23}\b",
    "secret": r"sk-[A-Za-z0-9_-]{20,}|AKIA[A-Z0-9]{16}|-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----",
}
TASK = {
    "contact_or_financial_identifier": r"(?iu)[\p{L}\p{N}_.+-]+@[\p{L}\p{N}_.-]+\.[A-Za-z]{2,}|(?<!\p{Nd})(?:\+30[ -]?)?(?:69\p{Nd}{8}|2\p{Nd}{9})(?!\p{Nd})|\bGR\s?\p{Nd}{2}(?:\s?[A-Z0-9]){23}\b",
    "secret_pattern": r"(?iu)\b(?:sk-[A-Za-z0-9_-]{16,}|AKIA[A-Z0-9]{16})\b|-----BEGIN (?:RSA |EC |OPENSSH )?PRIVATE KEY-----|(?:api[_ -]?key|password|κωδικός\s+πρόσβασης)\s*[:=]\s*\S+",
    "personal_identifier_pattern": r"(?iu)(?:ΑΦΜ|ΑΜΚΑ|ΑΔΤ|Τ\.?Κ\.?|ταυτότητα|αριθμός\s+παραγγελίας)\s*[:#=-]?\s*\d{4,}|\b(?:om|order)[ -]?\d{5,}",
    "prompt_artifact_or_injection": r"(?iu)\{\{[^}]*\}\}|\[(?:INSERT|PLACEHOLDER|TODO)[^\]]*\]|<\|(?:assistant|user|system|endoftext|im_start|im_end).*?\|>|(?:ignore previous|αγνόησε τις προηγούμενες οδηγίες|as an ai language model)",
}
#: Codes that no review can waive.
UNWAIVABLE = ("secret_pattern", "prompt_artifact_or_injection")


def inventory_flags(text: Column) -> dict[str, Column]:
    """One flag a type; null gives null."""
    return {k: text.rlike(p) for k, p in INVENTORY.items()}


def task_codes(text: Column, waived: Column | None = None) -> Column:
    """The codes found, in fixed order; ``waived`` is an array of codes set aside by review, except those that cannot be."""
    found = [F.when(text.rlike(p) if waived is None or k in UNWAIVABLE else text.rlike(p) & ~F.array_contains(waived, k), F.lit(k)) for k, p in TASK.items()]
    return F.array_compact(F.array(*found))


def counters(rows: DataFrame, text: Column, by: str) -> DataFrame:
    """By group: records, records with each flag, records with any."""
    flags = inventory_flags(text)
    any_flag = None
    for f in flags.values():
        any_flag = f if any_flag is None else any_flag | f
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("records"), *[F.count_if(f).alias(f"risk_{k}_records") for k, f in flags.items()], F.count_if(any_flag).alias("flagged_records"))
