"""WARC archives with a two-level capture index.

Captures are written in the order of their reversed-host URL keys, one gzip member
per record. The index has the same order: its entries are compressed in blocks,
and a directory keeps one line per block. A lookup searches the directory for the
block, the block for the entry, and reads the record's range of its archive.

Archives and index files are written by tasks through pyarrow's file systems. A
file's name is new for every attempt, and only the names that a finished task
returned enter the tables, so a lost executor or a second attempt leaves at most an
unnamed file behind.
"""

from __future__ import annotations

import base64
import bisect
import itertools
import uuid
import zlib
from collections import namedtuple
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paystrata.llm.common import written
from paystrata.session import scratch_path

#: Payloads shorter than this are stored every time.
REVISIT_BYTES = 1000
#: An archive is closed when it has this many bytes.
ARCHIVE_BYTES = 256 << 20
#: Entries per compressed block of the index.
BLOCK_ENTRIES = 1000
#: Ranges of an archive that lie this close together are read at once, up to READ_BYTES.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20

ENTRY = "surt string, page_id long, archive string, offset long, length long"
CAPTURE = (
    "surt string, page_id long, url string, record_type string, payload_digest string, "
    "payload_bytes long, refers_to long, payload binary"
)
DIRECTORY = "index string, offset long, length long, n_entries long, n_bytes long, first_key string, last_key string"


def surt(url: Column) -> Column:
    """Reversed-host key of a URL: ``org,example,www)/path?query`` in lower case.

    Scheme, user, port 80 or 443 and fragment are dropped; tabs and line ends are
    percent-encoded; a null URL gives ``-``.
    """
    lower = F.lower(F.regexp_replace(F.trim(url), "^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    bare = F.regexp_replace(lower, "#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, "^([^/?]*)", 1), "^.*@", "")
    port = F.regexp_replace(F.regexp_extract(host, "(:[0-9]*)$", 1), "^:(80|443|)$", "")
    host = F.regexp_replace(F.regexp_replace(host, ":[0-9]*$", ""), "[.]+$", "")
    path = F.regexp_extract(bare, "^[^/?]*(.*)$", 1)
    path = F.when(path == "", "/").otherwise(path)
    key = F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), port, F.lit(")"), path)
    for raw, code in (("\t", "%09"), ("\n", "%0a"), ("\r", "%0d")):
        key = F.replace(key, F.lit(raw), F.lit(code))
    return F.coalesce(key, F.lit("-"))


def _store(path: str):
    """(file system, path inside it) of a URI or a local path."""
    from pyarrow import fs

    if path.startswith("s3a://"):
        path = "s3://" + path[6:]
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


_TYPES = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows with exact values (nulls are None, integers stay integers)."""
    row = namedtuple("Row", batch.schema.names)
    return map(row._make, zip(*(column.to_pylist() for column in batch.columns)))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [field.split() for field in schema.split(", ")]
    columns = [pa.array(values, _TYPES[kind]) for values, (_, kind) in zip(zip(*rows), fields)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


class _Files:
    """Writes byte blocks one after the other into files of this attempt's own."""

    def __init__(self, folder: str, kind: str, suffix: str, limit: int) -> None:
        self.fs, self.folder = _store(folder)
        self.uri, self.kind, self.suffix, self.limit = folder.rstrip("/"), kind, suffix, limit
        self.out, self.at, self.name = None, 0, ""

    def add(self, block: bytes) -> tuple[str, int]:
        """(file, offset) of the block."""
        if self.out is not None and self.at + len(block) > self.limit:
            self.close()
        if self.out is None:
            name = f"{self.kind}-{uuid.uuid4().hex}{self.suffix}"
            self.fs.create_dir(self.folder, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.folder}/{name}", compression=None)
            self.at, self.name = 0, f"{self.uri}/{name}"
        place = self.name, self.at
        self.out.write(block)
        self.at += len(block)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(4, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _record(row) -> bytes:
    """One WARC record: a response with its payload, or a revisit without."""
    body = row.payload if row.refers_to is None else b""
    kind = "response" if row.refers_to is None else "revisit"
    page = "" if row.page_id is None else str(row.page_id)
    digest = base64.b32encode(bytes.fromhex(row.payload_digest)).decode()
    url = "" if row.url is None else "".join(c for c in row.url if c not in "\r\n")
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {row.payload_bytes}",
    ]
    if row.refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{row.refers_to}>",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n"


def _parsed(record: bytes) -> dict:
    """The fields and the payload of a record, checked against its digest."""
    import hashlib

    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])

    def page(name: str) -> int | None:
        digits = fields[name][len("<urn:page:") : -1]
        return int(digits) if digits else None

    payload = rest[: int(fields["Content-Length"])]
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    revisit = fields["WARC-Type"] == "revisit"
    return {
        "page_id": page("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"] or None,
        "record_type": fields["WARC-Type"],
        "payload_digest": digest,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "refers_to": page("WARC-Refers-To") if revisit else None,
        "payload": None if revisit else payload,
    }


def _revisits(captures: DataFrame, least: int) -> DataFrame:
    """``surt``, ``page_id``, ``refers_to`` of captures whose payload another one keeps.

    Only keys and digests are shuffled. The groups are reduced on the map side, and
    only payloads that occur more than once meet the captures again.
    """
    long_enough = captures.where(F.col("payload_bytes") >= least).select("surt", "page_id", "same")
    kept = (
        long_enough.groupBy("same")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND refers_to IS NOT NULL")
    )
    return (
        long_enough.join(kept, "same")
        .where(F.col("page_id").isNull() | (F.col("page_id") < F.col("refers_to")))
        .select("surt", "page_id", "same", "refers_to")
        .distinct()
    )


def write_archives(
    pages: DataFrame, folder: str, *, least: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); the entries, as a table.

    The payload is the html in UTF-8, a null html an empty payload. Of captures with
    equal payloads of at least ``least`` bytes, that with the largest page_id is the
    response and the others are revisits of it (rows that repeat the largest id are
    all responses; a null id is smaller than any, and if all ids are null all rows are
    responses). Null URLs are allowed. Columns other than the three are ignored; an
    empty table gives no archive.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    captures = pages.select("page_id", "url", payload.alias("payload")).select(
        surt(F.col("url")).alias("surt"),
        "page_id",
        "url",
        F.sha1("payload").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        # SHA-1 alone would let a forged collision pass for an equal payload.
        F.when(F.octet_length("payload") >= least, F.unhex(F.sha2("payload", 256))).alias("same"),
        "payload",
    )
    # A note about each revisit travels to its capture by the same range shuffle
    # that sorts the captures, so payloads are shuffled only once.
    notes = _revisits(captures, least).select(
        "surt", "page_id", F.lit(0).alias("is_page"), "same", "refers_to"
    )
    rows = notes.unionByName(captures.withColumn("is_page", F.lit(1)), allowMissingColumns=True)
    placed = rows.repartitionByRange("surt", "page_id").sortWithinPartitions("surt", "page_id", "is_page")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, capture, noted = _Files(folder, "archive", ".warc.gz", archive_bytes), None, {}
        for batch in batches:
            entries = []
            for row in _rows(batch):
                if (row.surt, row.page_id) != capture:
                    capture, noted = (row.surt, row.page_id), {}
                if not row.is_page:
                    noted[row.same] = int(row.refers_to)
                    continue
                refers_to = noted.get(row.same) if row.same is not None else None
                block = _gzip(_record(row._replace(refers_to=refers_to)))
                entries.append((row.surt, row.page_id, *files.add(block), len(block)))
            if entries:
                yield _batch(entries, ENTRY)
        files.close()

    return written(placed.mapInArrow(write, ENTRY), "warc-entries")


def _entry_line(row) -> str:
    page = "" if row.page_id is None else row.page_id
    return f"{row.surt}\t{page}\t{row.archive}\t{row.offset}\t{row.length}"


def _entries(block: bytes) -> list[list[str]]:
    return [line.split("\t") for line in zlib.decompress(block).decode().split("\n")]


def write_index(entries: DataFrame, folder: str, *, block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Sort the entries by key into compressed blocks; the directory, as a table.

    One directory line per block: where it is, its first and last key, how many
    entries and archive bytes it stands for. Equal keys may cross a block's edge.
    """
    placed = entries.repartitionByRange("surt", "page_id", "archive", "offset")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, "index", ".cdx.z", ARCHIVE_BYTES)
        waiting: list = []

        def block(rows: list) -> tuple:
            data = zlib.compress("\n".join(map(_entry_line, rows)).encode(), 6)
            name, at = files.add(data)
            return name, at, len(data), len(rows), int(sum(r.length for r in rows)), rows[0].surt, rows[-1].surt

        lines = []
        for batch in batches:
            waiting.extend(_rows(batch))
            while len(waiting) >= block_entries:
                lines.append(block(waiting[:block_entries]))
                del waiting[:block_entries]
        if waiting:
            lines.append(block(waiting))
        files.close()
        if lines:
            yield _batch(lines, DIRECTORY)

    ordered = placed.sortWithinPartitions("surt", "page_id", "archive", "offset")
    return written(ordered.mapInArrow(write, DIRECTORY), "warc-directory")


class _Reader:
    """Range reads with one open file at a time."""

    def __init__(self) -> None:
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            store, path = _store(name)
            self.name, self.file = name, store.open_input_file(path)
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
            self.name = self.file = None

    def records(self, entries: list[list[str]]) -> Iterator[tuple[str, dict]]:
        """(key, record) of entries; neighbours in an archive are read together."""
        places = sorted((e[2], int(e[3]), int(e[4]), e[0]) for e in entries)
        at = 0
        while at < len(places):
            name, begin, length, _ = places[at]
            end, upto = begin + length, at + 1
            while (
                upto < len(places)
                and places[upto][0] == name
                and places[upto][1] - end <= GAP_BYTES
                and places[upto][1] + places[upto][2] - begin <= READ_BYTES
            ):
                end, upto = places[upto][1] + places[upto][2], upto + 1
            data = self.read(name, begin, end - begin)
            for _, offset, size, key in places[at:upto]:
                yield key, _parsed(zlib.decompress(data[offset - begin : offset - begin + size], 31))
            at = upto


def _captures(found: Iterator[tuple[str, dict]]) -> Iterator[pa.RecordBatch]:
    """Records as batches of bounded size, columns as in ``CAPTURE``."""
    rows, size = [], 0
    for key, record in found:
        rows.append((key, *record.values()))
        size += len(record["payload"] or b"")
        if len(rows) >= 1000 or size >= READ_BYTES:
            yield _batch(rows, CAPTURE)
            rows, size = [], 0
    if rows:
        yield _batch(rows, CAPTURE)


def read_archives(directory: DataFrame, *, task_bytes: int = 64 << 20) -> DataFrame:
    """All captures of an index, block by block, with their payloads (revisits: null)."""
    total = directory.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    blocks = directory.select("index", "offset", "length")
    tasks = max(int(total // task_bytes) + 1, int(directory.sparkSession.sparkContext.defaultParallelism))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, archive = _Reader(), _Reader()

        def records() -> Iterator[tuple[str, dict]]:
            for batch in batches:
                for name, offset, length in _rows(batch):
                    yield from archive.records(_entries(index.read(name, offset, length)))

        yield from _captures(records())
        index.close()
        archive.close()

    return blocks.repartition(tasks, "index", "offset").mapInArrow(read, CAPTURE)


FOUND = "kind long, part long, surt string, index string, offset long, length long, last_key string"


def _found(kind: int, key: str | None, line) -> tuple:
    return kind, line.part, key, line.index, line.offset, line.length, line.last_key


def _found_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Directory lines and keys of one range, in order: the blocks that may hold each key.

    ``kind`` is 0 for a block to read, 1 for a key below which the range has no line
    (its block, if any, began in an earlier range) and 2 for the range's last line.
    """
    lines, firsts = [], []
    for batch in batches:
        found = []
        for row in _rows(batch):
            if row.rank == 0:
                lines.append(row)
                firsts.append(row.surt)
                continue
            # Lines sort before keys, so all that begin up to this key are there.
            at = bisect.bisect_left(firsts, row.surt)
            if not at:
                found.append((1, row.part, row.surt, None, None, None, None))
            elif lines[at - 1].last_key >= row.surt:
                found.append(_found(0, row.surt, lines[at - 1]))
            found.extend(_found(0, row.surt, line) for line in lines[at:])
        if found:
            yield _batch(found, FOUND)
    if lines:
        yield _batch([_found(2, None, lines[-1])], FOUND)


def lookup(directory: DataFrame, keys: DataFrame, *, task_bytes: int = 64 << 20) -> DataFrame:
    """The captures whose URL key is among ``keys`` (column ``surt``), each once.

    Repeated keys count once; null keys and keys without captures find nothing, as does
    an empty directory. Directory lines and distinct keys meet in one range shuffle. A
    task has the lines of its range and finds each key's block among them by a binary
    search; a block that reaches over a range's end is known by the last line of the
    range before (one record per partition). Each block that may hold a key is then read
    once: a binary search in it finds every key's entries, and only their ranges of the
    archives are read.
    """
    lines = directory.select("index", "offset", "length", "last_key", F.col("first_key").alias("surt"), F.lit(0).cast("long").alias("rank"))
    wanted = keys.select("surt").where(F.col("surt").isNotNull()).distinct().withColumn("rank", F.lit(1).cast("long"))
    # Of the blocks that begin with one key, that with the greatest last key ends last.
    placed = (
        lines.unionByName(wanted, allowMissingColumns=True)
        .repartitionByRange("surt")
        .sortWithinPartitions("surt", "rank", "last_key")
        .withColumn("part", F.spark_partition_id().cast("long"))
    )
    found = written(placed.mapInArrow(_found_blocks, FOUND), "warc-lookup")
    # The last line before a range is that of the greatest partition below it that has
    # lines: one record per partition.
    tail = F.max(F.when(F.col("kind") == 2, F.struct("index", "offset", "length", "last_key")))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = found.groupBy("part").agg(tail.alias("tail")).select(
        "part", F.last("tail", ignorenulls=True).over(earlier).alias("line")
    )
    reaching = (
        found.where("kind = 1").select("part", "surt")
        .join(F.broadcast(ranges), "part")
        .where(F.col("line.last_key") >= F.col("surt"))
        .select("surt", "line.index", "line.offset", "line.length")
    )
    jobs = found.where("kind = 0").select("surt", "index", "offset", "length").unionByName(reaching)
    total = directory.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    tasks = max(int(total // task_bytes) + 1, int(directory.sparkSession.sparkContext.defaultParallelism))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, archive = _Reader(), _Reader()
        rows = (row for batch in batches for row in _rows(batch))

        def records() -> Iterator[tuple[str, dict]]:
            for (name, offset, length), group in itertools.groupby(rows, key=lambda row: (row.index, row.offset, row.length)):
                entries = _entries(index.read(name, offset, length))
                names = [entry[0] for entry in entries]
                hits = []
                for row in group:
                    hits.extend(entries[bisect.bisect_left(names, row.surt) : bisect.bisect_right(names, row.surt)])
                yield from archive.records(hits)

        yield from _captures(records())
        index.close()
        archive.close()

    by_block = jobs.repartition(tasks, "index", "offset").sortWithinPartitions("index", "offset", "surt")
    return by_block.mapInArrow(read, CAPTURE)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write archives and index below ``folder`` (default: the shared folder); the directory."""
    folder = folder or scratch_path(pages.sparkSession, "warc")
    return write_index(write_archives(pages, f"{folder}/archive"), f"{folder}/index")
