"""Text normalisers, tokens, shingles, sentences, numbers and script counts as columns.

Three normalisers exist side by side and are not interchangeable:
``folded`` keeps punctuation, ``word_folded`` keeps words only, ``trimmed`` keeps
case.  The first two need NFC and case folding, which Spark lacks; they are
Arrow-batched.  Everything else is built in.  Null gives null throughout.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Word characters: letters, digits and the underscore.
TOKEN = r"[\p{L}\p{N}_]+"
#: Sentences end after one of . ! ? ; U+00B7 U+037E and white space, or at line ends.
SENTENCE_END = r"(?<=[.!?;\u00b7\u037e])(?U:\s+)|\n+"
NUMBER = r"\p{Nd}+(?:[.,/]\p{Nd}+)*"
#: Accented Greek vowels that count as evidence of accents (monotonic).
GREEK_ACCENTS = "άέήίόύώΐΰΆΈΉΊΌΎΏ"
_WORDS = re.compile(r"[^\W_]+")


def fold_text(text: str) -> str:
    return " ".join(unicodedata.normalize("NFC", text).casefold().split())


def fold_words(text: str) -> str:
    return " ".join(_WORDS.findall(unicodedata.normalize("NFC", text).casefold()))


def trim_text(text: str) -> str:
    return unicodedata.normalize("NFC", text.replace("\r\n", "\n").replace("\r", "\n")).strip()


def _batched(each: Callable[[str], str]):
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(each, na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")


def folded(text: Column) -> Column:
    """NFC, case folded, white space collapsed."""
    return _batched(fold_text)(text)


def word_folded(text: Column) -> Column:
    """NFC, case folded, words only, joined by blanks."""
    return _batched(fold_words)(text)


def trimmed(text: Column) -> Column:
    """Line ends to LF, NFC, outer white space removed."""
    return _batched(trim_text)(text)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def shingles(words: Column, width: int) -> Column:
    """Distinct runs of ``width`` words; none where there are fewer words.

    The words are bound by an outer lambda: an expression named inside a lambda
    is otherwise computed again for each element.
    """

    def runs(w: Column) -> Column:
        n = F.size(w) - width + 1
        found = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(w, i, width), " "))
        return F.when(n >= 1, F.array_distinct(found)).otherwise(F.array().cast("array<string>"))

    return F.get(F.transform(F.array(words), runs), F.lit(0))


def sentences(text: Column) -> Column:
    """Distinct sentences of the raw text in order of code points, folded one by one, blanks dropped."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda some: sorted({y for x in some if (y := fold_text(x))}), na_action="ignore")

    run.__annotations__ = {"texts": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "array<string>")(F.split(text, SENTENCE_END))


def source_text(messages: Column, span: Column) -> Column:
    """What an example takes from its source: the span of the user's message, or all of it, and the answer; a span beyond the message raises."""
    user, answer = (F.element_at(messages, i)["content"] for i in (2, 3))
    fits = (span["message_index"] == 1) & (span["start"] >= 0) & (span["start"] < span["end"]) & (span["end"] <= F.length(user))
    cut = F.when(F.coalesce(fits, F.lit(False)), F.substring(user, span["start"] + 1, span["end"] - span["start"])).otherwise(F.raise_error(F.lit("invalid source-evidence span")))
    return F.concat(F.when(span.isNull(), user).otherwise(cut), F.lit("\n"), answer)


def numbers(text: Column) -> Column:
    """The numbers of a text in order."""
    return F.regexp_extract_all(text, F.lit(NUMBER), F.lit(0))


def count_of(text: Column, characters: str) -> Column:
    """How many characters of a class (in regular-expression notation) a text has."""
    return F.length(F.regexp_replace(text, f"[^{characters}]", ""))


def greek_counts(text: Column) -> Column:
    """A struct of letters, Greek letters, their ratio and accented characters."""
    letters = count_of(text, r"\p{L}")
    greek = F.length(F.regexp_replace(text, r"[^\p{L}&&[\u0370-\u03ff\u1f00-\u1fff]]", ""))
    return F.struct(
        letters.alias("alphabetic_characters"), greek.alias("greek_characters"),
        F.when(letters > 0, greek / letters).otherwise(0.0).alias("greek_ratio"),
        count_of(text, GREEK_ACCENTS).alias("accented_characters"),
    )


def contains_words(text: Column, phrase: Column) -> Column:
    """Whether a phrase stands in a text between word boundaries (both normalised to single blanks)."""
    return F.concat(F.lit(" "), text, F.lit(" ")).contains(F.concat(F.lit(" "), phrase, F.lit(" ")))


def unit_hash(seed: Column, key: Column) -> Column:
    """A number in [0, 1) from the first 8 bytes of SHA-256 of ``seed:key``."""
    head = F.substring(F.sha2(F.concat_ws(":", seed.cast("string"), key), 256), 1, 16)
    return F.conv(head, 16, 10).cast("decimal(20,0)").cast("double") / F.lit(2.0**64)


def slug(text: Column) -> Column:
    """A file-name-safe form of a text, made unique by a hash."""
    return F.concat(F.substring(F.regexp_replace(text, "[^A-Za-z0-9_-]", "_"), 1, 80), F.lit("_"), F.substring(F.sha2(text, 256), 1, 12))
