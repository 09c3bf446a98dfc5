"""Packing token pieces into fixed windows by minimum bin slack.

A document's ids, its end id included, are cut into full windows and one rest.
What is left to decide is which rests share a window.  That depends on their
lengths only, and there are fewer lengths than a window has places: the driver
holds one count a length, whatever the number of documents.  It opens a window
with the longest length left and fills it by subset-sum dynamic programming
over the multiset of lengths left: a bitset of reachable fills, from which the
fill closest to the capacity is traced back to how often each length is used.
The pattern is repeated as often as the counts allow, so each pattern uses up
some length and the number of patterns does not depend on the number of rows.

A pattern gives each of its lengths a range of ranks.  Ranks come from counts
by (length, cell) with cells cut by a hash of the row, so no length, however
frequent, is ranked in one task.

Ties: which of equally long pieces takes which place follows the rows' numbers;
of lengths that fill a window equally well the longer are used first.  Edge cases: a null or empty text has the end id alone; repeated rows are pieces
of their own; a null id stays null; an empty table gives an empty result;
further columns are ignored; long texts give many full windows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textquarry.llm.words import portions, release
from textquarry.storage import small_batches, written

CAPACITY = 2048
END_ID = 1
TOKENIZER = "word_bpe_49k.json"
#: Rows of a length that are ranked together, at least.
CELL_ROWS = 256
#: The letter that stands for a byte in byte-level models, where it is not the byte's own.
BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordIds:
    """A text's ids as little-endian 32-bit numbers, by way of its words.

    A tokenizer whose pieces never reach across white space, nor from letters to
    signs, gives a text the ids of its words in turn, and a word of Latin letters
    and signs behind them the ids of both.  Words are put together for a portion
    of text at a time; the letters' ids (small and capital letters are one) are
    kept from portion to portion up to ``LIMIT`` entries and dropped at a task's
    end, so memory does not grow with the vocabulary.  Letters are one piece, so
    the tokenizer's model alone gives their ids, without offsets; signs are
    encoded many at once, parted by a control character that has one id of its
    own; words of other forms, or that may hold a special token, are encoded
    alone.  Under any other tokenizer each text is encoded as a whole.
    """

    LIMIT, AT_ONCE, PART, PORTION = 200_000, 1024, "\x01", 2_000_000
    #: Pre-tokenizer and normalizer under which the above holds.
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    NORMAL = ["NFC", "Replace", "Lowercase"]
    #: Latin letters whose small form is one letter, then ASCII signs but the apostrophe.
    FORM = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ɏ]*)([!-&(-/:-@\\[-`{-~]*)")
    #: Both parts of each line; none of a line of another form.
    LINES = re.compile(f"^(?:{FORM.pattern}$|.+$)", re.MULTILINE)

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.model, normal = self.tokenizer.model, self.tokenizer.normalizer
        own = self._encoded(self.PART)
        self.part = int.from_bytes(own, "little")
        self.apart = len(own) == 4 and self._by_words()
        #: Letters as a byte-level model has them, in small form
        self.latin = {c: normal.normalize_str(chr(c)).encode().decode("latin-1").translate(BYTES) for c in range(65, 0x250) if chr(c).isalpha()} if self.apart else {}

    def _by_words(self) -> bool:
        config = json.loads(self.tokenizer.to_str())
        steps = (config["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        normal = [x["type"] for x in (config["normalizer"] or {}).get("normalizers", [])]
        first = steps[0]
        by_pieces = first.get("type") == "Split" and first["pattern"] == {"Regex": self.PIECES} and first["behavior"] == "Removed" and first["invert"]
        plain = len(steps) == 2 and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in steps[1:])
        return bool(by_pieces) and plain and normal == self.NORMAL and all("<|" in x["content"] for x in config["added_tokens"])

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _letters(self, word: str) -> bytes:
        """The ids of a run of letters, which is one piece."""
        if not word.isascii():
            word = word.translate(self.latin)
        ids = [x.id for x in self.model.tokenize(word)]
        return pack_ids(f"<{len(ids)}I", *ids)

    def _learn(self, new: list[str]) -> None:
        if len(self.known) + len(new) > self.LIMIT:
            self.known.clear()
        self.known |= {x: self._letters(x) for x in new if x[0].isalpha()}
        new = [x for x in new if not x[0].isalpha()]
        for i in range(0, len(new), self.AT_ONCE):
            some = new[i : i + self.AT_ONCE]
            raw = self._encoded(f" {self.PART} ".join(some))
            ends, begin = np.flatnonzero(np.frombuffer(raw, dtype="<u4") == self.part).tolist(), 0
            for w, end in zip(some, [*ends, len(raw) // 4], strict=True):
                self.known[w] = raw[4 * begin : 4 * end]
                begin = end + 1

    def table(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The ids of each word."""
        parts, out, known, words = [], {}, self.known, list(words)
        known[""] = b""
        for w, (letters, signs) in zip(words, self.LINES.findall(b"\n".join(words).decode()), strict=bool(words)):
            if not (letters or signs) or "<|" in signs:
                out[w] = self._encoded(w.decode())
                continue
            if letters.isascii():
                letters = letters.lower()
            if letters in known and signs in known:
                out[w] = known[letters] + known[signs] if signs else known[letters]
            else:
                parts.append((w, letters, signs))
        needed = {x for _, a, b in parts for x in (a, b) if x}
        new = [x for x in needed if x not in known]
        if len(known) + len(new) > self.LIMIT:
            new = list(needed)
        self._learn(new)
        known[""] = b""
        for w, a, b in parts:
            out[w] = known[a] + known[b]
        return out

    def ids(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text."""
        if not self.apart:
            yield from (self._encoded(x or "") for x in texts)
            return
        split = [(x or "").encode("utf-8", "replace").split() for x in texts]
        table = self.table(set().union(*split))
        for words in split:
            yield b"".join(map(table.__getitem__, words))


_loaded: dict[str, WordIds] = {}


def encoder(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def cut(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, text`` -> one row for each full window and each rest, with its ids' CRC-32."""
    path = tokenizer or default_tokenizer()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end, step = encoder(path), np.array([end_id], dtype="<u4").tobytes(), 4 * capacity
        for rows in portions(batches, lambda r: len(r[1] or ""), words.PORTION):
            out: list[tuple] = []
            for doc, ids in zip([r[0] for r in rows], words.ids([r[1] for r in rows]), strict=True):
                raw = ids + end
                n = len(raw) // 4
                out += [(doc, i // 4, min(capacity, n - i // 4), zlib.crc32(raw[i : i + step]), n) for i in range(0, len(raw), step)]
            columns = list(zip(*out, strict=True))
            del rows, out
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        words.known.clear()
        release()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pieces, PIECES)


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, out of ``counts``, whose sum is the largest up to ``room``.

    Bit s of a bitset says that sum s can be reached; each length enters in
    portions of 1, 2, 4 ... copies.  The portions are kept with the bitset that
    stood before them, to trace the sum back.
    """
    mask, reach, steps = (1 << (room + 1)) - 1, 1, []
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        copies, portion = min(counts[length], room // length), 1
        while copies:
            portion = min(portion, copies)
            steps.append((length, portion, reach))
            reach |= (reach << (length * portion)) & mask
            copies -= portion
            portion *= 2
        if reach >> room & 1:
            break
    best, used = reach.bit_length() - 1, {}
    for length, portion, before in reversed(steps):
        if not before >> best & 1:
            used[length] = used.get(length, 0) + portion
            best -= length * portion
    return used


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """``(times, {length: copies})`` that together use every piece exactly once."""
    left, out = {k: v for k, v in counts.items() if v}, []
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        used = fill(others, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        out.append((times, used))
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return out


def ranges(plan: list[tuple[int, dict[int, int]]]) -> np.ndarray:
    """Rows ``length, first rank, copies a window, first window, first offset`` in order of length and rank."""
    rows, ranks, window = [], {}, 0
    for times, used in plan:
        offset = 0
        for length, copies in sorted(used.items(), reverse=True):
            rows.append((length, ranks.get(length, 0), copies, window, offset))
            ranks[length] = ranks.get(length, 0) + times * copies
            offset += length * copies
        window += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document with its window (``sequence_id``) and ``offset`` there."""
    spark = docs.sparkSession
    small_batches(spark)
    made = written(cut(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}  # one row a length
    places = ranges(patterns(counts, capacity))
    # a length's rows are ranked in about as many cells as a cell has rows, so neither grows beyond the root of their number
    cells_of = [(k, max(1, int(min(n / CELL_ROWS, n**0.5)))) for k, n in counts.items()]
    cells_of = F.broadcast(spark.createDataFrame(cells_of, "length long, cells long"))  # at most one row a length
    made = made.join(cells_of, "length").withColumn("cell", F.pmod(F.xxhash64("piece"), F.col("cells")))
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = made.groupBy("length", "cell").agg(F.count(F.lit(1)).alias("n"))
    cells = cells.select("length", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    rank = F.row_number().over(Window.partitionBy("length", "cell").orderBy("piece")) - 1
    ranked = made.withColumn("at", rank.cast("long")).join(cells, ["length", "cell"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("at") + F.col("earlier")).alias("rank"))
    key = places[:, 0] << 44 | places[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, at = batch.column(2).to_numpy(zero_copy_only=False), batch.column(5).to_numpy(zero_copy_only=False)
            _, first, copies, window, offset = places[np.searchsorted(key, length << 44 | at, side="right") - 1].T
            k = at - first
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(window + k // copies), pa.array(offset + k % copies * length)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
