"""Sample records of the five annotated sources, written for this engine: one that is accepted and one for each of several rules.

The driver's tables hold no Greek; the registered adapter queries run over these.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

REVIEWS = "skroutz_shop_reviews_sentiment_analysis"
#: Registered query -> source family.
ADAPTERS = {"k1_shop_sentiment": REVIEWS, "k2_recipe_category": "recipes", "k3_news_category": "AMNA-press", "k4_learning_resource": "Photodentro_all_documents", "k5_dictionary": "modern-greek-dictionary"}

_REVIEW = "Αυτή είναι μια πολύ καλή κριτική για το κατάστημα που με εξυπηρέτησε άψογα και γρήγορα."
_RECIPE = {"name": "Σούπα", "Ingredients": "νερό, ρύζι, λεμόνι, αυγό", "Instructions": "Βράζουμε καλά το ρύζι και προσθέτουμε το αυγό.", "Category": "Κυρίως Γεύμα"}
_NEWS = {"id": "12", "url": "https://www.amna.gr/home/article/12", "title": "Τίτλος είδησης", "text": "Το άρθρο μιλά για την οικονομία της χώρας. " * 5, "category": "Οικονομία"}
_LESSON = {"title": "Μάθημα", "text": "Περιγραφή του μαθήματος για την άλγεβρα και τις ταυτότητες. " * 3, "url": "http://photodentro.edu.gr/aggregator/lo/photodentro-lor-8521-77", "classification": {"thematic_area": ["Μαθηματικά > Άλγεβρα"]}, "audience": {"educational_levels": ["γυμνάσιο"]}}
_WORD = {"lemma": "άλφα", "pronunciation": "álfa", "text": "άλφα [álfa] το πρώτο γράμμα του αλφαβήτου [alfa]"}

RECORDS: dict[str, list] = {
    REVIEWS: [
        {"text": _REVIEW, "label": "Positive"}, {"text": _REVIEW + " Όχι, τελικά όχι.", "label": "Negative"}, {"text": _REVIEW, "label": "Neutral"}, {"text": "", "label": "Positive"}, {"text": 5, "label": "Positive"}, "{",
        {"text": _REVIEW + " a@b.gr", "label": "Negative"}, {"text": "English only text that is long enough to pass every other rule here", "label": "Positive"}, {"text": "Καλό κατάστημα με ωραία", "label": "Positive"},
        {"text": _REVIEW + " positive", "label": "Positive"}, {"text": "Καλο μαγαζι " * 9, "label": "Positive"}, {"text": _REVIEW * 400, "label": "Positive"},
    ],
    "recipes": [_RECIPE, _RECIPE | {"Category": "Άλλο"}, _RECIPE | {"name": " "}, {k: v for k, v in _RECIPE.items() if k != "Instructions"}, "[1"],
    "AMNA-press": [_NEWS, _NEWS | {"id": "13"}, _NEWS | {"category": "Sports"}, _NEWS | {"text": "Το άρθρο μιλά για την οικονομία."}, _NEWS | {"text": _NEWS["text"] + "\nΚατηγορία: Οικονομία"}],
    "Photodentro_all_documents": [
        _LESSON, _LESSON | {"audience": {"educational_levels": ["γυμνάσιο", "γυμνάσιο"]}}, _LESSON | {"audience": {"educational_levels": ["πανεπιστήμιο"]}}, _LESSON | {"audience": {"educational_levels": []}},
        _LESSON | {"url": "http://example.org/77"}, _LESSON | {"classification": {"thematic_area": ["Mathematics"]}},
    ],
    "modern-greek-dictionary": [_WORD, _WORD | {"lemma": "άλφ"}, _WORD | {"pronunciation": "alfa"}, _WORD | {"pronunciation": "álf4", "text": "άλφα [álf4] το πρώτο γράμμα του αλφαβήτου"}],
}


def lines(spark: SparkSession, family: str) -> DataFrame:
    """The records of a family as lines of one file."""
    rows = [(f"{family}/sample.jsonl", k, f"{k:064x}", r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) for k, r in enumerate(RECORDS[family], 1)]
    return spark.createDataFrame(rows, "source_file string, source_line long, source_record_hash string, raw string")
