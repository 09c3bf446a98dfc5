"""Task adapters: annotated source records -> grounded examples, or the first reason against each.

An adapter names fields and rules; a record's rules are one CASE expression, so
the first that applies gives the reason, and rows without one become examples.
Records are raw JSON text; fields keep JSON's types, so a number where a text is
asked for counts as missing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textquarry.functions import risk
from textquarry.functions import text as T

# Labels, categories, templates and domains are part of the results.
SYSTEM = "Απάντησε στα ελληνικά, ακολουθώντας την οδηγία και χρησιμοποιώντας μόνο τα στοιχεία που δίνονται. Μην προσθέτεις πληροφορίες που δεν τεκμηριώνονται."
SENTIMENTS = {"Positive": "θετική", "Negative": "αρνητική"}
DISHES = ("Κυρίως Γεύμα", "Γλυκό", "Σαλάτα", "Ορεκτικό / Μεζές")
NEWS = ("Πολιτική", "Κόσμος", "Ελλάδα", "Οικονομία", "Πολιτισμός", "Επιστήμη")
LEVELS = ("προσχολική", "δημοτικό", "γυμνάσιο", "γενικό λύκειο", "επαγγελματικό λύκειο (ΕΠΑ.Λ)", "ειδική αγωγή")
TEMPLATES = {
    "shop_sentiment": "Χαρακτήρισε τη συνολική στάση της παρακάτω κριτικής για το κατάστημα ως θετική ή αρνητική. Απάντησε μόνο με μία από αυτές τις δύο λέξεις.\n\nΚριτική:\n{text}",
    "recipe_category": "Σε ποια κατηγορία ανήκει η παρακάτω συνταγή; Διάλεξε μία από τις κατηγορίες «Κυρίως Γεύμα», «Γλυκό», «Σαλάτα», «Ορεκτικό / Μεζές» και γράψε μόνο την κατηγορία.\n\nΤίτλος: {name}\n\nΥλικά:\n{Ingredients}\n\nΕκτέλεση:\n{Instructions}",
    "dictionary_pronunciation": "Στο παρακάτω λήμμα, ποια προφορά δίνεται για το «{lemma}»; Μετέφερε ακριβώς τη φωνητική γραφή μέσα σε αγκύλες, σε μία σύντομη πρόταση.\n\nΛήμμα:\n{text}",
    "news_category": "Σε ποια ειδησεογραφική κατηγορία ανήκει το παρακάτω άρθρο; Διάλεξε μία από τις κατηγορίες «Πολιτική», «Κόσμος», «Ελλάδα», «Οικονομία», «Πολιτισμός», «Επιστήμη» και γράψε μόνο την κατηγορία.\n\nΤίτλος: {title}\n\nΆρθρο:\n{text}",
    "learning_resource_classification": "Με βάση την παρακάτω περιγραφή εκπαιδευτικού υλικού, ταξινόμησέ το ως προς τις θεματικές περιοχές και τις εκπαιδευτικές βαθμίδες στις οποίες απευθύνεται. Γράψε μόνο ένα αντικείμενο JSON με τα κλειδιά «θεματικές_περιοχές» και «εκπαιδευτικές_βαθμίδες», καθένα με λίστα τιμών. Διατήρησε ολόκληρη τη θεματική ιεραρχία όπου υπάρχει.\n\nΤίτλος: {title}\n\nΠεριγραφή:\n{text}",
}
MAX_CHARS, LEAST_RATIO, LEAST_LETTERS = 20_000, 0.70, 15

Rules = list[tuple[str, Column]]


@dataclass(frozen=True)
class Adapter:
    """Fields in order of checking; ``rules``, ``answer`` and ``group`` make columns from the fields' columns."""

    family: str
    task: str
    domain: str
    inputs: tuple[str, ...]
    answers: tuple[str, ...]
    rules: Callable[[dict[str, Column], Column], Rules]
    answer: Callable[[dict[str, Column]], Column]
    group: Callable[[dict[str, Column]], Column]
    grouping: tuple[str, ...] = ()
    lists: tuple[str, ...] = field(default=())

    @property
    def fields(self) -> tuple[str, ...]:
        return self.inputs + self.answers + self.grouping


def _typed(path: str, spark_type: str) -> Column:
    at = "$." + path
    kind = F.schema_of_variant(F.try_variant_get("record", at, "variant"))
    if spark_type == "string":
        return F.when(kind == "STRING", F.try_variant_get("record", at, "string"))
    whole = F.try_variant_get("record", at, "array<variant>")
    strings = F.forall(whole, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
    return F.when(kind.startswith("ARRAY") & strings, F.try_variant_get("record", at, "array<string>"))


def _blank(x: Column) -> Column:
    return F.coalesce(x.rlike(r"^(?U:\s)*$"), F.lit(True))


def _shop(f: dict[str, Column], source: Column) -> Rules:
    return [
        ("unsupported_sentiment_label", ~f["label"].isin(*SENTIMENTS)),
        ("insufficient_nontrivial_review_context", F.length(f["text"]) < 50),
        ("source_annotation_label_leakage", f["text"].rlike(r"(?iU)\b(?:Positive|Negative)\b")),
    ]


def _news(f: dict[str, Column], source: Column) -> Rules:
    number = F.regexp_extract(f["url"], r"^https?://www\.amna\.gr/home/article/([0-9]+)/?$", 1)
    return [
        ("unsupported_news_category", ~f["category"].isin(*NEWS)),
        ("insufficient_nontrivial_article_context", F.length(f["text"]) < 160),
        ("article_id_url_mismatch_or_unknown_schema", ~f["id"].rlike(r"^[0-9]+\z") | (number != f["id"])),
        ("source_annotation_label_leakage", source.rlike(r"(?miu)^\s*(?:κατηγορία|category)\s*[:=]")),
    ]


def _learning(f: dict[str, Column], source: Column) -> Rules:
    levels, areas = f["audience.educational_levels"], f["classification.thematic_area"]
    poor = F.exists(areas, lambda a: (T.greek_counts(a)["greek_ratio"] < LEAST_RATIO) | F.exists(F.split(a, ">"), _blank))
    return [
        ("unsupported_educational_level", F.exists(levels, lambda x: ~x.isin(*LEVELS))),
        ("invalid_or_non_greek_thematic_annotation", poor),
        ("insufficient_nontrivial_resource_description", F.length(f["text"]) < 120),
        ("learning_object_identity_or_url_schema_unverified", ~f["url"].rlike(r"^https?://photodentro\.edu\.gr/aggregator/lo/photodentro-lor-8521-[0-9]+\z")),
        ("source_annotation_label_leakage", source.rlike(r"(?miu)^\s*(?:θεματικ(?:ή|ές)\s+περιοχ(?:ή|ές)|εκπαιδευτικ(?:ή|ές)\s+βαθμίδ(?:α|ες)|classification|audience)\s*[:=]")),
        ("annotation_output_exceeds_limit_no_truncation", F.length(_two_lists(f)) > 4096),
    ]


def _two_lists(f: dict[str, Column]) -> Column:
    """Canonical JSON: keys in order of code points, no blanks."""
    return F.to_json(F.struct(f["audience.educational_levels"].alias("εκπαιδευτικές_βαθμίδες"), f["classification.thematic_area"].alias("θεματικές_περιοχές")))


def _dictionary(f: dict[str, Column], source: Column) -> Rules:
    text, lemma, said = f["text"], f["lemma"], f["pronunciation"]
    after, last = F.substring(text, F.length(lemma) + 1, F.lit(1)), F.substring(lemma, -1, 1)
    runs_on = last.rlike(r"[\p{L}\p{N}]") & after.rlike(r"[\p{L}\p{N}]")
    first = F.regexp_extract(text, r"\[([^\[\]]+)\]", 1)
    return [
        ("lemma_does_not_match_entry_headword", ~text.startswith(lemma) | runs_on),
        ("pronunciation_not_unambiguous_first_bracket", (F.length(said) > 64) | said.contains("\n") | (first != said)),
        ("pronunciation_has_nonphonetic_content", ~said.rlike(r"^[\p{L}'’ˈˌː:. \-]+\z")),
    ]


def casefolded(x: Column) -> Column:
    return T._batched(str.casefold)(x)  # noqa: SLF001


ADAPTERS = (
    Adapter("skroutz_shop_reviews_sentiment_analysis", "shop_sentiment", "consumer_reviews", ("text",), ("label",), _shop, lambda f: F.create_map(*[F.lit(x) for p in SENTIMENTS.items() for x in p])[f["label"]], lambda f: casefolded(f["text"])),
    Adapter("recipes", "recipe_category", "cooking", ("name", "Ingredients", "Instructions"), ("Category",), lambda f, s: [("unsupported_recipe_category", ~f["Category"].isin(*DISHES))], lambda f: f["Category"], lambda f: casefolded(f["name"])),
    Adapter("modern-greek-dictionary", "dictionary_pronunciation", "language_reference", ("lemma", "text"), ("pronunciation",), _dictionary, lambda f: F.concat(F.lit("Η προφορά είναι ["), f["pronunciation"], F.lit("].")), lambda f: casefolded(f["lemma"])),
    Adapter("AMNA-press", "news_category", "news", ("title", "text"), ("category",), _news, lambda f: f["category"], lambda f: F.concat(F.lit("article:"), f["id"]), ("id", "url")),
    Adapter("Photodentro_all_documents", "learning_resource_classification", "education", ("title", "text"), ("classification.thematic_area", "audience.educational_levels"), _learning, _two_lists, lambda f: F.concat(F.lit("learning_object:"), F.regexp_extract(f["url"], r"([0-9]+)\z", 1)), ("url",), ("classification.thematic_area", "audience.educational_levels")),
)
BY_FAMILY = {a.family: a for a in ADAPTERS}


def prompt(adapter: Adapter, f: dict[str, Column]) -> Column:
    """The template with its fields filled in."""
    parts, rest = [], TEMPLATES[adapter.task]
    while "{" in rest:
        before, _, rest = rest.partition("{")
        name, _, rest = rest.partition("}")
        parts += [F.lit(before), f[name]]
    return F.concat(*parts, F.lit(rest))


def evidence_start(adapter: Adapter, f: dict[str, Column], made: Column) -> Column:
    """Where the evidence begins in the prompt (from 0): at the first field for tasks with a heading, else at the text."""
    if adapter.task in ("recipe_category", "news_category", "learning_resource_classification"):
        return F.lit(TEMPLATES[adapter.task].index("{" + adapter.inputs[0] + "}"))
    return F.length(made) - F.length(f["text"])


def decided(lines: DataFrame, adapter: Adapter, *, max_chars: int = MAX_CHARS, least_ratio: float = LEAST_RATIO, waived: Column | None = None) -> DataFrame:
    """``lines`` (with ``raw`` JSON) plus ``status`` accepted or rejected, ``reason``, ``prompt``, ``answer``, ``group_sha256``, span and counts.

    Every line gets exactly one outcome; what cannot be parsed is malformed.
    """
    out = lines.withColumn("record", F.try_parse_json("raw"))
    raw = {name: _typed(name, "array<string>" if name in adapter.lists else "string") for name in adapter.fields}
    out = out.withColumns({f"raw_{k}".replace(".", "_"): v for k, v in raw.items()})
    fields, tests = {}, []
    column = lambda name: F.col(f"raw_{name}".replace(".", "_"))
    for name in adapter.fields:
        x = column(name)
        if name in adapter.lists:
            clean = F.transform(x, lambda s: F.regexp_replace(F.regexp_replace(s, "\r\n?", "\n"), r"(?U)^\s+|\s+\z", ""))
            bad = x.isNull() | (F.size(x) < 1) | (F.size(x) > 16) | F.exists(x, lambda s: _blank(s) | (F.length(s) > 512))
            tests += [("missing_or_ambiguous_annotation_list", F.coalesce(bad, F.lit(True))), ("duplicate_annotation_label", F.size(F.array_distinct(clean)) < F.size(clean))]
            fields[name] = clean
        else:
            tests.append(("missing_or_ambiguous_required_field", _blank(x)))
            out = out.withColumn(f"f_{name}", T.trimmed(x))
            fields[name] = F.col(f"`f_{name}`")
    too_long = F.lit(False)
    for name in adapter.inputs:
        too_long = too_long | (F.length(fields[name]) > max_chars)
    tests.append(("whole_field_exceeds_limit_no_truncation", too_long))
    source = F.concat_ws("\n", *[fields[n] for n in adapter.inputs])
    screened = F.concat_ws("\n", source, F.to_json(F.struct(*[fields[n].alias(n.replace(".", "_")) for n in sorted(fields)])))
    out = out.withColumn("source_text", source).withColumn("codes", F.array_join(risk.task_codes(screened, waived), ";")).withColumn("greek", T.greek_counts(F.col("source_text")))
    tests.append((None, F.col("codes") != ""))
    tests.append(("insufficient_greek_text", (F.col("greek.greek_ratio") < least_ratio) | (F.col("greek.greek_characters") < LEAST_LETTERS)))
    tests.append(("missing_greek_accents_requires_review", F.col("greek.accented_characters") == 0))
    tests += adapter.rules(fields, F.col("source_text"))
    reason = F.when(F.col("record").isNull(), "malformed_json_or_encoding")
    for name, test in tests:
        reason = reason.when(F.coalesce(test, F.lit(True)), F.lit(name) if name else F.col("codes"))
    out = out.withColumn("reason", reason)
    fine = F.col("reason").isNull()
    made = prompt(adapter, fields)
    status = F.when(fine, "accepted").when(F.col("reason") == "malformed_json_or_encoding", "malformed").otherwise("rejected")
    out = out.withColumns({
        "status": status, "prompt": F.when(fine, made), "answer": F.when(fine, adapter.answer(fields)),
        "group_sha256": F.when(fine, F.sha2(F.concat(F.lit(adapter.family + "\0"), adapter.group(fields)), 256)),
        "span_start": F.when(fine, evidence_start(adapter, fields, made)), "span_end": F.when(fine, F.length(made)),
    })
    return out.select(*lines.columns, "status", "reason", "prompt", "answer", "group_sha256", "span_start", "span_end", F.col("greek.greek_ratio").alias("greek_ratio"))
