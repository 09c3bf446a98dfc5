"""WARC archives and their capture index.

Pages become WARC/1.1 records in gzip archives (one member a record) in the
shared folder.  Of records with equal payloads the one of the largest page id is
a response with its payload, the others are revisits that name it and carry the
HTTP headers only.  Each task writes its own archives under fresh names and
returns their paths; only paths in the committed manifest are read, so archives
of lost or repeated tasks count for nothing.

Reading an archive back checks every payload against its digest and gives a
capture run: its records sorted by URL key and time, written as a file of small
blocks in the shared folder, with the first and last key of each block in a
table.  The index is the k-way merge of all runs.  The key range is split by
bounds sampled from these keys (URL key, time and id together, so one hot URL
splits too).  For each range a task opens the runs at the first block that can
hold it, and a loser tree takes rows from the files as it needs them, block by
block: a task holds one block of each run, however long runs and ranges are, and
nothing is sorted after the runs are written.  More than ``FAN_IN`` runs are
merged in groups first, each into one longer run, until one pass can take all.

Edge cases: a null or empty html is an empty payload; a null url has an empty
target and key; a null page id is never the largest, and where no equal payload
has an id all are responses; rows that repeat the largest id are responses each;
captures of equal URL key and time follow by id (null first), archive and place;
payloads may be as long as a row; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import itertools
import pickle
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textquarry.llm.words import release
from textquarry.storage import new_path, small_batches, written

#: Bytes of records after which a task begins another archive, of index rows in one range, and the most ranges and sampled keys a range that the driver holds.
ARCHIVE_BYTES, RANGE_BYTES, RANGES, DRAWN = 32_000_000, 4_000_000, 10_000, 16
#: Rows in a block of a run's file, and runs that one task merges at most.
BLOCK_ROWS, FAN_IN = 256, 256
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RUN = "run string, url_key string, captured string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, position long"
COLUMNS = [c.split()[0] for c in RUN.split(", ")]


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()  # noqa: S324


def url_key(url: str) -> str:
    """A sortable key: host labels in reverse, then path and query, in lower case."""
    m = re.match(r"(?s)[^:/?#]*://([^/?#]*)([^#]*)", url or "")
    if not m:
        return (url or "").lower()
    host = m[1].rpartition("@")[2].lower()
    return ",".join(reversed(host.split("."))) + ")" + (m[2] or "/").lower()


def record(kind: str, page: int | None, url: str | None, captured: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page is None else page}>", f"WARC-Date: {captured}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def members(data: bytes, step: int = 1 << 16) -> Iterator[tuple[int, bytes]]:
    """Offset and content of each gzip member."""
    at, view = 0, memoryview(data)
    while at < len(data):
        one, end, parts = zlib.decompressobj(31), at, []
        while not one.eof:
            if end >= len(data):
                raise ValueError("the archive ends inside a record")
            parts.append(one.decompress(view[end : end + step]))
            end += step
        yield at, b"".join(parts)
        at = min(end, len(data)) - len(one.unused_data)


def parse(content: bytes) -> dict:
    """The index row of one record, without its run."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest_of(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    number = lambda x: int(x[10:-1]) if x and x != "<urn:page:>" else None
    return {
        "url_key": url_key(fields["WARC-Target-URI"]), "captured": fields["WARC-Date"], "page_id": number(fields["WARC-Record-ID"]), "payload_bytes": size,
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")),
    }


def _store(uri: str):
    """The file system and path of a URI of the shared folder; the names that Hadoop gives S3 are known."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def write_archives(pages: DataFrame, *, least_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``page_id, url, html`` as archives; returns the manifest ``path, records``."""
    folder = new_path(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    same = rows.where(F.octet_length("payload") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("largest"), F.count(F.lit(1)).alias("many"))
    same = written(same.where("many > 1 and largest is not null").select(F.col("sha").alias("of"), "largest"), "equal-payloads")
    rows = rows.join(same, F.col("sha") == F.col("of"), "left")
    seconds = F.lit(1577836800) + F.coalesce(F.pmod("page_id", F.lit(100_000_000)), F.lit(0))
    captured = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    revisit = F.coalesce(~F.col("page_id").eqNullSafe(F.col("largest")) & F.col("largest").isNotNull(), F.lit(False))
    rows = rows.select("page_id", "url", captured, "payload", F.when(revisit, F.col("largest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        out, size, records = [], 0, 0

        def close() -> pa.RecordBatch:
            path = f"{base}/{uuid.uuid4().hex}.warc.gz"
            store.create_dir(base, recursive=True)
            with store.open_output_stream(path, compression=None) as f:
                for part in out:
                    f.write(part)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records], pa.int64())], names=["path", "records"])

        for batch in batches:
            for page, url, when, payload, largest in zip(*batch.columns, strict=True):
                payload, largest = payload.as_py(), largest.as_py()
                raw = record("response" if largest is None else "revisit", page.as_py(), url.as_py(), when.as_py(), payload, digest_of(payload), largest)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                out.append(packer.compress(raw) + packer.flush())
                size, records = size + len(raw), records + 1
                if size >= archive_bytes:
                    yield close()
                    out, size, records = [], 0, 0
        if out:
            yield close()

    manifest = written(rows.mapInArrow(run, "path string, records long"), "manifest")
    manifest._folder = folder  # noqa: SLF001
    return manifest


SCHEMA = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RUN.split(", ")])
#: A block of a run's file: its first and last row's keys, packed.
INDEX = "file string, block int, first binary, last binary, bytes long"
INDEX_SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int32()), ("first", pa.binary()), ("last", pa.binary()), ("bytes", pa.int64())])


def order(row: dict) -> tuple:
    page = row["page_id"]
    return row["url_key"].encode(), row["captured"], page is not None, page or 0, row["run"], row["position"]


def write_run(store, path: str, rows: Iterable[dict]) -> pa.RecordBatch:
    """Write sorted rows as blocks of a file; returns the index of its blocks."""
    index, some = [], []
    with store.open_output_stream(path, compression=None) as out, pa.ipc.new_file(out, SCHEMA) as file:

        def close() -> None:
            block = pa.RecordBatch.from_pylist(some, schema=SCHEMA)
            file.write_batch(block)
            index.append((path, len(index), pickle.dumps(order(some[0])), pickle.dumps(order(some[-1])), block.nbytes))
            some.clear()

        for row in rows:
            some.append(row)
            if len(some) == BLOCK_ROWS:
                close()
        if some:
            close()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*index, strict=True)) or [()] * 5, INDEX_SCHEMA.types, strict=True)], schema=INDEX_SCHEMA)


def read_slice(store, path: str, blocks: list[int], low: tuple | None, high: tuple | None) -> Iterator[dict]:
    """Rows of a run from ``low`` on and before ``high``; a block is read when its first row is asked for."""
    with store.open_input_file(path) as data:
        file = pa.ipc.open_file(data)
        for k in sorted(blocks):
            for row in file.get_batch(k).to_pylist():
                key = order(row)
                if high is not None and key >= high:
                    return
                if low is None or key >= low:
                    yield row


def read_runs(manifest: DataFrame, folder: str) -> DataFrame:
    """Each archive as a file with its sorted capture run; returns the index of all blocks."""
    n = max(1, manifest.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_stream(path, compression=None) as f:
                    data = f.read()
                rows = [{"run": path, "position": at} | parse(content) for at, content in members(data)]
                del data
                rows.sort(key=order)
                yield write_run(store, f"{base}/run-{uuid.uuid4().hex}.arrow", rows)
        release()

    return written(manifest.select("path").repartition(min(n, 10_000)).mapInArrow(run, INDEX), "runs")


class LoserTree:
    """Merges sorted inputs: each inner node holds the loser of the match below it, the winner stands above the root."""

    def __init__(self, inputs: Iterable[Iterator[dict]]) -> None:
        self.inputs = list(inputs)
        self.heads = [next(i, None) for i in self.inputs]
        self.keys = [None if h is None else order(h) for h in self.heads]
        k = max(1, len(self.inputs))
        self.losers = [-1] * k
        winners = [-1] * k + [i if i < len(self.inputs) else -1 for i in range(k)]
        for node in range(k - 1, 0, -1):
            a, b = winners[2 * node], winners[2 * node + 1]
            winners[node], self.losers[node] = (a, b) if self.beats(a, b) else (b, a)
        self.winner = winners[1] if k > 1 else winners[k]

    def beats(self, a: int, b: int) -> bool:
        x, y = (None if i < 0 else self.keys[i] for i in (a, b))
        return y is None or (x is not None and x <= y)

    def __iter__(self) -> Iterator[dict]:
        k = len(self.losers)
        while self.inputs and self.heads[self.winner] is not None:
            w = self.winner
            yield self.heads[w]
            self.heads[w] = next(self.inputs[w], None)
            self.keys[w] = None if self.heads[w] is None else order(self.heads[w])
            node = (w + k) // 2
            while node:
                if not self.beats(w, self.losers[node]):
                    w, self.losers[node] = self.losers[node], w
                node //= 2
            self.winner = w


def bounds_of(index: DataFrame) -> list[tuple]:
    """Keys that cut all runs' rows into ranges of about ``RANGE_BYTES``, from a bounded sample of blocks' first keys."""
    size = index.agg(F.sum("bytes")).first()[0] or 0
    ranges = min(RANGES, max(1, -(-size // RANGE_BYTES)))
    drawn = index.select("first").orderBy(F.xxhash64("file", "block")).limit(DRAWN * ranges).collect() if ranges > 1 else []  # DRAWN * RANGES rows at most
    keys = sorted(pickle.loads(r["first"]) for r in drawn)  # noqa: S301
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def _ranged(index: DataFrame, bounds: list[tuple], groups: int) -> DataFrame:
    """``part, group, slices``: for each range and group of runs the blocks that can hold its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file, block, group, first, last in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "group", "first", "last")), strict=True):
                ends = [bisect.bisect_right(bounds, pickle.loads(k)) for k in (first, last)]  # noqa: S301
                out += [(part, group, file, block) for part in range(ends[0], ends[1] + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [()] * 4, (pa.int32(), pa.int32(), pa.string(), pa.int32()), strict=True)], names=["part", "group", "file", "block"])

    grouped = index.withColumn("group", F.pmod(F.xxhash64("file"), F.lit(groups)).cast("int"))
    each = grouped.mapInArrow(run, "part int, group int, file string, block int")
    slices = each.groupBy("part", "group", "file").agg(F.collect_list("block").alias("blocks"))
    return slices.groupBy("part", "group").agg(F.collect_list(F.struct("file", "blocks")).alias("slices"))


def _merging(folder: str, bounds: list[tuple], emit):
    """A function over rows ``part, slices``: ``emit(store, base, merged rows)`` for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for batch in batches:
            for part, slices in zip(*(batch.column(c).to_pylist() for c in ("part", "slices")), strict=True):
                low, high = bounds[part - 1] if part else None, bounds[part] if part < len(bounds) else None
                inputs = [read_slice(store, x["file"], x["blocks"], low, high) for x in sorted(slices, key=lambda x: x["file"])]
                yield from emit(store, base, iter(LoserTree(inputs)))
        release()

    return run


def _as_run(store, base: str, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    yield write_run(store, f"{base}/run-{uuid.uuid4().hex}.arrow", rows)


def _as_rows(store, base: str, rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    while some := list(itertools.islice(rows, 10_000)):
        yield pa.RecordBatch.from_pylist(some, schema=SCHEMA)


def merged_index(index: DataFrame, folder: str, *, fan_in: int = FAN_IN) -> DataFrame:
    """All capture runs as one table in order of URL key, time and id, partition after partition."""
    bounds = bounds_of(index)
    runs = index.select("file").distinct().count()
    while runs > fan_in:
        runs = max(1, -(-2 * runs // fan_in))  # groups of half the number on average, as a hash deals them
        plan = _ranged(index, bounds, runs).repartition("part", "group")
        index = written(plan.mapInArrow(_merging(folder, bounds, _as_run), INDEX), "runs")
    plan = _ranged(index, bounds, 1).repartitionByRange(len(bounds) + 1, "part").sortWithinPartitions("part")
    return plan.select("part", "slices").mapInArrow(_merging(folder, bounds, _as_rows), RUN)


def capture_index(pages: DataFrame, *, least_bytes: int = 0, fan_in: int = FAN_IN) -> DataFrame:
    """Write the archives, read them back, and merge their runs."""
    small_batches(pages.sparkSession)
    manifest = write_archives(pages, least_bytes=least_bytes)
    return merged_index(read_runs(manifest, manifest._folder), manifest._folder, fan_in=fan_in)  # noqa: SLF001
