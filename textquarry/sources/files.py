"""Files as tables: scan, raw lines with exact bytes, whole JSON documents, Zstandard integrity.

Raw lines keep what Spark's text source drops: the terminator, invalid UTF-8 and
the line number.  A task opens a file by its path and reads it as a stream, block
by block: neither the file nor a line longer than the limit, which is hashed
completely but not kept, is ever held as a whole.
"""

from __future__ import annotations

import codecs
import hashlib
import io
import json
import re
import urllib.parse
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINES = "path string, line long, raw_sha256 string, raw binary, status string, reason string"
BLOCK = 1 << 20
MAX_LINE, MAX_DOCUMENT = 33_554_432, 67_108_864


def scan(spark: SparkSession, root: str) -> DataFrame:
    """``path, relative_path, size_bytes, modified`` of all files below a root but empty ones, which Spark's file sources leave out; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))
    return files.withColumn("relative_path", _relative(root))


def _relative(root: str) -> Column:
    return F.regexp_replace("path", "^.*?" + _quoted(root.rstrip("/").split("://")[-1]) + "/", "").alias("relative_path")


def _quoted(text: str) -> str:
    return r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"


def opened(path: str):
    """A file as a binary stream: ``file:``, ``hdfs://`` and S3 paths, by Hadoop's or other names."""
    from pyarrow import fs

    uri = re.sub(r"^s3[an]://", "s3://", re.sub(r"^file:/+", "file:///", path))
    store, at = fs.FileSystem.from_uri(urllib.parse.quote(uri, safe="/:%") if uri.startswith("file:") else uri)
    return store.open_input_stream(at, compression=None)


def _blocks_of(path: str) -> Iterator[bytes]:
    with opened(path) as f:
        while block := f.read(BLOCK):
            yield block


def _each(files: DataFrame, rows_of: Callable[[str, str], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows for every file: ``rows_of(path, relative_path)``, one file after another within a task, files dealt over tasks."""
    names, kinds = [x.split()[0] for x in schema.split(", ")], [KINDS[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, relative in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out, size = [], 0
                for row in rows_of(path, relative):
                    out.append(row)
                    size += sum(len(x) for x in row if isinstance(x, bytes))
                    if len(out) == 1000 or size > BLOCK:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    tasks = files.sparkSession.sparkContext.defaultParallelism
    return files.select("path", "relative_path").repartition(4 * tasks, "path").mapInArrow(run, schema)


KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
HASHED = "relative_path string, size_bytes long, sha256 string, head binary"


def hashed(spark: SparkSession, root: str) -> DataFrame:
    """Each file's size, SHA-256 and first four bytes, from one read."""

    def rows(path: str, relative: str) -> Iterator[tuple]:
        digest, size, head = hashlib.sha256(), 0, b""
        for block in _blocks_of(path):
            head = head or block[:4]
            digest.update(block)
            size += len(block)
        yield relative, size, digest.hexdigest(), head

    return _each(scan(spark, root), rows, HASHED)


def new_files(now: DataFrame, before: DataFrame) -> DataFrame:
    """The files of a scan (``relative_path, size_bytes, sha256``) that an earlier one lacks; raises if one of both is not what it was."""
    old = before.select("relative_path", F.col("size_bytes").alias("__size"), F.col("sha256").alias("__sha"))
    both = now.join(old, "relative_path", "left")
    other = both.where("__sha is not null and (__sha <> sha256 or __size <> size_bytes)").select("relative_path").limit(1).collect()
    if other:
        raise ValueError(f"source changed since it was read: {other[0]['relative_path']}")
    return both.where("__sha is null").select(*now.columns)


def encoding(head: Column) -> Column:
    """UTF-16 and UTF-32 marks make newline-delimited reading impossible."""
    h = F.hex(head)
    wide = h.startswith("FFFE") | h.startswith("FEFF") | h.startswith("0000FEFF")
    return F.when(wide, "unsupported_multibyte_record_delimiter").when(h.startswith("EFBBBF"), "utf-8-sig").otherwise("utf-8")


def form(path: Column) -> Column:
    """jsonl, json_document or opaque, by the end of the name."""
    lined = path.endswith(".jsonl") | path.endswith(".jsonl.zst") | path.endswith(".qjsonl.zst")
    return F.when(lined, "jsonl").when(path.endswith(".json") | path.endswith(".meta") | path.endswith(".idx"), "json_document").otherwise("opaque")


def is_zstandard(head: Column) -> Column:
    """Whether four bytes begin a Zstandard frame or a skippable one."""
    h = F.hex(F.substring(head, 1, 4))
    return (h == "28B52FFD") | h.rlike("^5[0-9A-F]2A4D18$")


def split_lines(blocks: Iterator[bytes], most: int = MAX_LINE) -> Iterator[tuple[int, str, bytes | None]]:
    """``number, SHA-256, bytes`` of each line with its terminator; lines end at LF only; bytes are None beyond ``most``."""
    number, digest, held, size = 1, hashlib.sha256(), [], 0
    for block in blocks:
        begin = 0
        while begin < len(block):
            end = block.find(b"\n", begin) + 1
            part = block[begin : end or len(block)]
            digest.update(part)
            size += len(part)
            if size <= most:
                held.append(part)
            else:
                held = []
            begin += len(part)
            if end:
                yield number, digest.hexdigest(), b"".join(held) if size <= most else None
                number, digest, held, size = number + 1, hashlib.sha256(), [], 0
    if size:
        yield number, digest.hexdigest(), b"".join(held) if size <= most else None


def judged(raw: bytes | None, number: int, strip_mark: bool = True) -> tuple[str, str]:
    """Status and reason of one physical line."""
    if raw is None:
        return "quarantined", "record_exceeds_safe_parse_limit"
    if number == 1 and strip_mark and raw.startswith(codecs.BOM_UTF8):
        raw = raw[3:]
    try:
        text = raw.decode("utf-8")
    except UnicodeDecodeError:
        return "malformed", "invalid_utf8"
    if not text.strip():
        return "malformed", "blank_physical_row"
    try:
        value = json.loads(text)
    except ValueError:
        return "malformed", "invalid_json"
    if not isinstance(value, dict):
        return "quarantined", "unsupported_non_object_schema"
    return "license_blocked", "license_not_verified_for_sft_redistribution"


def _lines_of(path: str, compressed: bool, most: int) -> Iterator[tuple[int, str, bytes | None]]:
    with opened(path) as f:
        if not compressed:
            yield from split_lines(iter(lambda: f.read(BLOCK), b""), most)
            return
        import zstandard

        with zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) as reader:
            yield from split_lines(iter(lambda: reader.read(BLOCK), b""), most)


def lines(spark: SparkSession, root: str, *, most: int = MAX_LINE) -> DataFrame:
    """Every line of every ``.jsonl`` and Zstandard ``.jsonl.zst`` file below a root: number, hash, bytes, status and reason.

    A damaged compressed file keeps the lines before the damage and ends with a
    ``processing_error`` row.
    """

    def rows(path: str, relative: str) -> Iterator[tuple]:
        number = 0
        try:
            for number, sha, raw in _lines_of(path, relative.endswith(".zst"), most):
                yield relative, number, sha, raw, *judged(raw, number)
        except Exception as error:  # noqa: BLE001  the decoder's own kinds of error
            yield relative, number + 1, None, None, "processing_error", type(error).__name__

    return _each(scan(spark, root).where(F.col("relative_path").rlike(r"\.q?jsonl(\.zst)?$")), rows, LINES)


def json_documents(spark: SparkSession, root: str, *, most: int = MAX_DOCUMENT) -> DataFrame:
    """Whole-file JSON documents: status, reason and the length of a top-level array."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    # larger files than are parsed are not read, only hashed
    files = files.select(_relative(root), F.col("length").alias("size_bytes"), F.when(F.col("length") <= most, F.col("content")).alias("content")).where(form(F.col("relative_path")) == "json_document")
    files = files.join(hashed(spark, root).select("relative_path", "sha256"), "relative_path")
    text = F.when(F.col("size_bytes") <= most, F.try_validate_utf8(F.col("content").cast("string")))
    value = F.try_parse_json(text)
    status = F.when(F.col("size_bytes") > most, "quarantined").when(value.isNull(), "malformed").otherwise("license_blocked")
    reason = F.when(F.col("size_bytes") > most, "json_document_exceeds_safe_parse_limit").when(value.isNull(), "invalid_json_document").otherwise("license_not_verified_for_sft_redistribution")
    return files.select("relative_path", "size_bytes", "sha256", status.alias("status"), reason.alias("reason"), F.json_array_length(text).alias("json_array_elements"))


#: Bytes of a Zstandard block at most (a fixed value of the format).
MAX_BLOCK = 131_072


def frame_fault(source) -> str | None:
    """Why a stream (or bytes) is no whole sequence of Zstandard frames; None if it is.

    Walks headers only: magic number, descriptor, window, dictionary and size
    fields, blocks by their lengths, checksum; skippable frames by theirs.
    """
    stream = io.BytesIO(source) if isinstance(source, bytes) else source

    def take(n: int) -> bytes | None:
        data = stream.read(n)
        while 0 < len(data) < n and (more := stream.read(n - len(data))):
            data += more
        return data if len(data) == n else None

    def skips(n: int) -> bool:
        while n:
            data = stream.read(min(n, BLOCK))
            if not data:
                return False
            n -= len(data)
        return True

    first = True
    while True:
        start = stream.read(1)
        if not start:
            return "zstandard_empty" if first else None
        first, rest = False, take(3)
        if rest is None:
            return "zstandard_truncated_magic"
        magic = int.from_bytes(start + rest, "little")
        if magic >> 4 == 0x184D2A5:
            size = take(4)
            if size is None:
                return "zstandard_truncated_skippable_size"
            if not skips(int.from_bytes(size, "little")):
                return "zstandard_truncated_skippable"
            continue
        if magic != 0xFD2FB528:
            return "zstandard_bad_magic"
        head = take(1)
        if head is None:
            return "zstandard_truncated_descriptor"
        descriptor = head[0]
        single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
        if descriptor >> 3 & 1:
            return "zstandard_reserved_bit"
        if not skips((not single) + (0, 1, 2, 4)[descriptor & 3] + (single, 2, 4, 8)[descriptor >> 6]):
            return "zstandard_truncated_header"
        last = False
        while not last:
            block = take(3)
            if block is None:
                return "zstandard_truncated_block_header"
            number = int.from_bytes(block, "little")
            last, kind, size = bool(number & 1), number >> 1 & 3, number >> 3
            if kind == 3:
                return "zstandard_reserved_block"
            if size > MAX_BLOCK:
                return "zstandard_block_exceeds_format_maximum"
            if not skips(1 if kind == 1 else size):
                return "zstandard_truncated_block"
        if not skips(4 * checksum):
            return "zstandard_truncated_checksum"


def compression(spark: SparkSession, root: str) -> DataFrame:
    """``relative_path, fault`` of the Zstandard files below a root: those that say so by name or by their first bytes."""

    def rows(path: str, relative: str) -> Iterator[tuple]:
        with opened(path) as f:
            yield relative, frame_fault(f)

    named = scan(spark, root)
    marked = hashed(spark, root).where(is_zstandard(F.col("head")) | F.col("relative_path").endswith(".zst")).select("relative_path")
    return _each(named.join(marked, "relative_path", "left_semi"), rows, "relative_path string, fault string")


def write_splits(rows: DataFrame, folder: str) -> None:
    """One folder of JSON lines a split, in order of id within each file; existing output is an error."""
    rows.repartition("split").sortWithinPartitions("split", "id").write.mode("errorifexists").partitionBy("split").json(folder)
