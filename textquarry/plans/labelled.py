"""The rule cascade, the issue list and the message form over generic annotated documents.

``documents`` with their ``labels``, where they have any, stand for an annotated
source: the quality label is the answer, the text the evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import risk
from textquarry.functions import text as T

ANSWERS = {0: "poor", 1: "good"}
INSTRUCTION = "Is the following text good or poor? Answer with one word.\n\nText:\n"
MAX_CHARS, LEAST_CHARS, LEAST_DISTINCT = 20_000, 50, 0.3


def _rules() -> list[tuple[str, Column]]:
    text, words = F.coalesce("text", F.lit("")), T.tokens(F.lower(F.coalesce("text", F.lit(""))))
    flags = risk.inventory_flags(text)
    return [
        ("missing_or_ambiguous_required_field", F.trim(text) == ""),
        ("whole_field_exceeds_limit_no_truncation", F.length(text) > MAX_CHARS),
        ("contact_or_financial_identifier", flags["email"] | flags["iban"]),
        ("secret_pattern", flags["secret"]),
        ("unsupported_language", ~F.col("lang").isin("en", "fr")),
        ("insufficient_context", F.length(text) < LEAST_CHARS),
        ("repetitive_text", F.size(F.array_distinct(words)) < F.size(words) * LEAST_DISTINCT),
        ("toxic_annotation", F.col("toxic") == 1),
        ("missing_annotation", F.col("quality").isNull()),
    ]


def decided(rows: DataFrame) -> DataFrame:
    """Every row with one outcome: accepted with prompt, answer and group, or rejected with the first reason."""
    reason = None
    for name, test in _rules():
        reason = F.when(test, name) if reason is None else reason.when(test, name)
    out = rows.withColumn("reason", reason)
    fine = F.col("reason").isNull()
    prompt = F.concat(F.lit(INSTRUCTION), F.col("text"))
    answer = F.create_map(*[F.lit(x) for p in ANSWERS.items() for x in p])[F.col("quality")]
    return out.withColumns({
        "status": F.when(fine, "accepted").otherwise("rejected"), "prompt": F.when(fine, prompt), "prompt_sha256": F.when(fine, F.sha2(prompt, 256)), "answer": F.when(fine, answer),
        "group_id": F.when(fine, F.sha2(F.concat_ws("|", "source", "text"), 256)),
    })


def issues(made: DataFrame) -> DataFrame:
    """Accepted rows with the sorted, distinct list of issues against them; the rebuilt answer is compared, not trusted."""
    text = F.col("text")
    letters, caps = T.count_of(text, r"\p{L}"), T.count_of(text, r"\p{Lu}")
    found = [
        F.when(F.size(T.numbers(text)) > 0, "numbers_require_review"),
        F.when(letters * 10 < F.length(text) * 6, "letter_share_check_failed"),
        F.when(caps * 2 > letters, "capitals_check_failed"),
        F.when(~F.col("prompt").startswith(INSTRUCTION) | ~F.col("prompt").endswith(text), "unsupported_or_changed_prompt"),
        F.when(F.col("answer") != F.when(F.col("quality") == 1, "good").otherwise("poor"), "answer_not_exactly_grounded"),
        F.when(F.col("n_chars") != F.length(text), "length_mismatch"),
        F.lit("license_unverified"),
    ]
    return made.where("status = 'accepted'").withColumn("issues", F.array_sort(F.array_distinct(F.array_compact(F.array(*found)))))


def canonical_messages(turns: DataFrame) -> DataFrame:
    """``conv_id, n_turns, roles, status``: conversations whose roles alternate user, assistant from turn 0 and whose texts are not blank are canonical."""
    ordered = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    roles = F.array_join(F.transform("t", lambda x: x["role"]), ",")
    blank = F.exists("t", lambda x: F.trim(F.coalesce(x["text"], F.lit(""))) == "")
    wrong = F.exists(F.transform("t", lambda x, i: (x["turn"] != i) | (x["role"] != F.when(i % 2 == 0, "user").otherwise("assistant"))), lambda x: F.coalesce(x, F.lit(True)))
    status = F.when(blank, "empty_or_malformed_message").when(wrong, "invalid_message_roles_or_order").otherwise("canonical")
    return ordered.select("conv_id", F.size("t").cast("long").alias("n_turns"), roles.alias("roles"), status.alias("status"))
