"""WARC archives: writing, and reading by boundary-chain verification."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import is_small, looked_up, scratch, small, stored

#: What every record begins with, before the minor version; what the tasks look for.
MAGIC = "WARC/1."
#: What follows it: versions 1.0 and 1.1.
VERSIONS = (b"0\r\n", b"1\r\n")
#: Least bytes of a payload of which later copies become revisits.
REVISIT = 1000
DATE = "2024-01-01T00:00:00Z"
#: Most splits of which the places where chains enter them are broadcast; beyond it the bytes are shuffled by split.
SPLITS = 500_000
#: Records and bytes of an output batch, about.
ROWS_AT_ONCE, BYTES_AT_ONCE = 256, 4 << 20

_OFFSETS = "path string, block long, start long, leaves long, last long, ends long, missing long"
_RECORDS = "path string, offset long, size long, header string, http string, payload binary"
_KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
_LENGTH = re.compile(rb"(?im)^content-length[ \t]*:[ \t]*(\d+)[ \t]*\r?$")


def records(pages: DataFrame, least: int = REVISIT) -> DataFrame:
    """page_id, url, payload, size, sha1, refers_to: the records to write.

    Of rows with equal payloads of at least `least` bytes, those of the largest page_id are responses; the others revisit it.
    A null html is an empty payload; a null page_id comes below all ids. Copied payloads are looked up by digest: by a
    broadcast of the copied digests while they are few, else by a shuffle of the rows in which each digest is salted.
    """
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload")).withColumn("sha1", F.sha1("payload"))
    groups = rows.where(F.col("size") >= least).groupBy("sha1").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    copied = stored(groups.where("n > 1").select("sha1", "last"), "copied")
    met = looked_up(rows, copied, ["sha1"], "left")
    again = (F.col("size") >= least) & F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return met.select("page_id", "url", "payload", "size", "sha1", F.when(again, F.col("last")).alias("refers_to"))


def write(found: DataFrame, path: str) -> None:
    """Write records() as WARC 1.1 files, one for each task, through Spark's text writer: the end of a record is its line separator."""
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), line("Content-Length", F.col("size")), F.lit("\r\n"))
    body = F.when(revisit, http).otherwise(F.concat(http, F.decode("payload", "utf-8")))
    header = F.concat(
        F.lit(f"{MAGIC}1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\\r\\n]", " ")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Refers-To", urn(F.col("refers_to"))), line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(body)),
    )
    found.select(F.concat(header, F.lit("\r\n"), body).alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magics, in the order of the file within each split."""
    raw = spark.read.option("lineSep", MAGIC).text(path)
    where = F.col("_metadata")
    return raw.select(F.col("value").cast("binary").alias("seg"), where["file_path"].alias("path"), where["file_block_start"].alias("block"), where["file_size"].alias("length"))


def _each(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows' values of these columns, one row at a time."""
    for batch in batches:
        columns = [batch.column(n) for n in names]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def _batches(rows: Iterator[tuple], schema: str, weight: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded rows and, by the length of the column at `weight`, bytes."""
    names = [c.split() for c in schema.split(", ")]
    limit = ROWS_AT_ONCE if weight is not None else 16 * ROWS_AT_ONCE
    made = lambda held: pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], _KINDS[t]) for i, (_, t) in enumerate(names)], names=[n for n, _ in names])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[weight]) if weight is not None else 0
        if len(held) >= limit or size >= BYTES_AT_ONCE:
            yield made(held)
            held, size = [], 0
    if held:
        yield made(held)


def _offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: its length (a row without start) and its candidate records, offsets only, relative to the split.

    Of a segment no more is kept than its place, its end, where its header ends and the length that it states. `leaves` is
    where the chain that begins at a candidate leaves the split (null: it breaks), `last` the last record of that chain in it.
    """

    def rows() -> Iterator[tuple]:
        key, held, at = None, [], 0
        for seg, path, block in _each(batches, "seg", "path", "block"):
            if (path, block) != key:
                if key:
                    yield from _chains(*key, held, at)
                key, held, at = (path, block), [], 0
                if block == 0 and seg:
                    raise ValueError(f"{path} doesn't begin with a record of WARC 1.0 or 1.1")
            if block == 0 and len(held) == 1 and not seg.startswith(VERSIONS):
                raise ValueError(f"{path} doesn't begin with a record of WARC 1.0 or 1.1")
            end = seg.find(b"\r\n\r\n")
            told = _LENGTH.findall(seg[seg.find(b"\r\n") + 1 : (end if end >= 0 else seg.rfind(b"\r\n")) + 2])
            # a magic in the middle of a line of the header is part of it
            held.append((at, at + end + 4 if end >= 0 else None, int(told[-1]) if told else None, bool(seg) and not seg.endswith(b"\r\n"), seg.startswith(VERSIONS)))
            at += len(seg) + len(MAGIC)
        if key:
            yield from _chains(*key, held, at)

    return _batches(rows(), _OFFSETS)


def _chains(path: str, block: int, held: list[tuple], at: int) -> Iterator[tuple]:
    edge = at - len(MAGIC)
    ahead: tuple[int | None, int | None] = (None, None)  # where the header that the next segment goes on with ends, and its length
    found: dict[int, tuple] = {}
    for k in range(len(held) - 1, -1, -1):
        place, body, length, open_, version = held[k]
        if body is None and open_ and ahead[0] is not None:
            body, length = ahead[0], ahead[1] if ahead[1] is not None else length
        ahead = (body, length)
        if body is None or length is None or not version or (block == 0 and k == 0):
            continue
        start, ends = place - len(MAGIC), body + length
        onward = ends + 4
        leaves, last = (onward, start) if onward >= edge else found[onward][3:5] if onward in found else (None, None)
        found[start] = (path, block, start, leaves, last, ends, max(0, ends - edge))
    yield (path, block, None, at, None, None, None)
    yield from found.values()


def _fields(head: bytes) -> Iterator[tuple[bytes, bytes]]:
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            yield name.strip().lower(), value.strip()


def _parted(header: bytes, body: bytes) -> tuple[str, bytes]:
    """The HTTP header and the payload of a record's block; without an HTTP header the block is the payload."""
    if dict(_fields(header)).get(b"content-type", b"").startswith(b"application/http"):
        http, parted, payload = body.partition(b"\r\n\r\n")
        if parted:
            return http.decode("utf-8", "replace"), payload
    return "", body


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records on the chain from each split's `entry`. One record is held at a time; those that go on in another split are left out."""

    def rows() -> Iterator[tuple]:
        key = None
        for seg, path, block, base, entry in _each(batches, "seg", "path", "block", "base", "entry"):
            if (path, block) != key:
                key, at, due, got, need = (path, block), 0, entry, None, None
            start, at = at - len(MAGIC), at + len(seg) + len(MAGIC)
            if got is not None:
                got += [MAGIC.encode(), seg]
                size += len(MAGIC) + len(seg)
            elif start == due:
                got, size, need = [seg], len(seg), None
            else:
                continue
            if need is None:
                whole = b"".join(got)
                body = whole.find(b"\r\n\r\n") + 4
                if body < 4 and seg and not seg.endswith(b"\r\n"):
                    continue  # the magic is in the middle of a line of the header
                head = whole[: max(body - 4, 0)]
                told = _LENGTH.findall(head + b"\r\n")
                if not told or not whole.startswith(VERSIONS):
                    due = got = None  # the chain breaks
                    continue
                need = body + int(told[-1])
            if size >= need:
                block_ = b"".join(got)[body:need]
                yield path, base + due, len(block_), head.decode("utf-8", "replace"), *_parted(head, block_)
                due, got = due + len(MAGIC) + need + 4, None

    return _batches(rows(), _RECORDS, weight=5)


def _reached(bases: DataFrame, found: DataFrame) -> DataFrame:
    """path, block, base, entry (relative): where the chain from the file's start enters each split; by pointer jumping.

    Only places where some chain leaves a split, and the start, are nodes: about one for each split. In each round the reached
    places grow by a jump, and jumps double.
    """
    absolute = found.join(bases, ["path", "block"]).select("path", "block", "base", (F.col("start") + F.col("base")).alias("at"), (F.col("leaves") + F.col("base")).alias("to"))
    landings = absolute.select("path", F.col("to").alias("at")).where("at IS NOT NULL").distinct()
    starts = bases.select("path").distinct().withColumn("at", F.lit(0).cast("long"))
    jumps = stored(absolute.join(landings.unionByName(starts).distinct(), ["path", "at"]).select("path", "at", "to", "block", "base"), "jumps")
    links, reached, n = jumps.select("path", "at", "to"), starts, -1
    while n != (n := reached.count()):
        onward = reached.join(links, ["path", "at"]).where("to IS NOT NULL").select("path", F.col("to").alias("at"))
        reached = stored(reached.unionByName(onward).distinct(), "reached")
        then = links.select("path", F.col("at").alias("to"), F.col("to").alias("then"))
        links = stored(links.join(then, ["path", "to"]).select("path", "at", F.col("then").alias("to")).where("to IS NOT NULL"), "jumps")
    return jumps.join(reached, ["path", "at"]).select("path", "block", "base", (F.col("at") - F.col("base")).alias("entry"))


def read(spark: SparkSession, path: str, derived: dict[str, Column] | None = None, splits: int = SPLITS) -> DataFrame:
    """path, offset, size, header, http, payload of the records under `path`, of WARC 1.0 or 1.1, plain or in gzip files.

    Tasks first emit every candidate record with the place after it, offsets only, from splits of the files; the chain from each
    file's start keeps the true ones, so that a magic inside a payload is no record. A second pass over the splits then cuts the
    true records, holding one at a time. A chain that breaks or a record that the file's end cuts off ends the file; a
    header that holds a magic in a line and is parted by the end of a split breaks it. A file that
    begins with anything else is an error; empty files give nothing. With `derived`, those columns (of header, http,
    payload) replace the payload before anything is shuffled.
    """
    segments = _segments(spark, path)
    found = stored(segments.mapInArrow(_offsets, _OFFSETS), "offsets")
    lengths = found.where("start IS NULL").select("path", "block", F.col("leaves").alias("length"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = stored(lengths.withColumn("base", F.coalesce(F.sum("length").over(before), F.lit(0))), "bases")
    # before the first magic there is an empty segment: records of the first split start at 0
    places = found.where("start IS NOT NULL")
    entries = stored(_reached(bases.drop("length"), places.select("path", "block", "start", "leaves")), "entries")
    if is_small(entries, splits):
        met = segments.join(F.broadcast(entries), ["path", "block"])
    else:
        ordered = segments.withColumn("place", F.monotonically_increasing_id()).join(entries, ["path", "block"])
        met = ordered.sortWithinPartitions("path", "block", "place")
    own = [c.alias(n) for n, c in (derived or {"payload": F.col("payload")}).items()]
    whole = met.select("seg", "path", "block", "base", "entry").mapInArrow(_cut, _RECORDS).select("path", "offset", "size", "header", "http", *own)
    ending = entries.join(places.select("path", "block", F.col("start").alias("entry"), F.col("last").alias("start")), ["path", "block", "entry"])
    cut = ending.join(places.where("missing > 0").select("path", "block", "start", "ends"), ["path", "block", "start"])
    cut = stored(cut.select("path", (F.col("start") + F.col("base")).alias("offset"), (F.col("ends") + F.col("base")).alias("hi")), "cut")
    return whole if cut.isEmpty() else whole.unionByName(_stitched(spark, path, bases, cut).select("path", "offset", "size", "header", "http", *own))


def _stitched(spark: SparkSession, path: str, bases: DataFrame, cut: DataFrame) -> DataFrame:
    """Records that go on in later splits, from pieces of those: only magics inside payloads bring this about."""

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            key, at = None, 0
            for seg, p, block in _each(batches, "seg", "path", "block"):
                if (p, block) != key:
                    key, at = (p, block), 0
                yield p, block, at, seg + MAGIC.encode()  # the file's last segment has no magic after it: pieces end with the file
                at += len(seg) + len(MAGIC)

        return _batches(rows(), "path string, block long, at long, tile binary", weight=3)

    over = bases.join(cut, "path").where((F.col("base") < F.col("hi")) & (F.col("base") + F.col("length") > F.col("offset") - len(MAGIC)))
    needed = stored(over.select("path", "block", "base").distinct(), "needed")
    pieces = _segments(spark, path).join(small(needed), ["path", "block"])
    if not is_small(needed):
        pieces = pieces.withColumn("place", F.monotonically_increasing_id()).sortWithinPartitions("path", "block", "place")
    placed = pieces.select("seg", "path", "block").mapInArrow(tiles, "path string, block long, at long, tile binary").join(small(needed), ["path", "block"]).withColumn("from", F.col("at") + F.col("base"))
    files = _segments(spark, path).join(small(needed), ["path", "block"]).select("path", "length").distinct()
    due = stored(cut.join(files, "path").select("path", "offset", "hi", F.least("hi", "length").alias("end"), (F.col("offset") + len(MAGIC)).alias("lo")), "due")
    met = placed.join(small(due), "path").where((F.col("from") < F.col("hi")) & (F.col("from") + F.octet_length("tile") > F.col("lo")))
    skip = F.greatest(F.col("lo") - F.col("from"), F.lit(0))
    piece = F.substring(F.col("tile"), (skip + 1).cast("int"), (F.least(F.col("end") - F.col("from"), F.octet_length("tile")) - skip).cast("int"))
    parts = met.groupBy("path", "offset", "lo", "hi").agg(F.array_sort(F.collect_list(F.struct("from", piece.alias("piece")))).alias("parts"))
    body = parts.withColumn("body", F.aggregate("parts", F.lit("").cast("binary"), lambda a, x: F.concat(a, x.piece))).where(F.octet_length("body") == F.col("hi") - F.col("lo"))

    def halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for p, offset, text in _each(batches, "path", "offset", "body"):
                head, _, block = text.partition(b"\r\n\r\n")
                yield p, offset, len(block), head.decode("utf-8", "replace"), *_parted(head, block)

        return _batches(rows(), _RECORDS, weight=5)

    return body.select("path", "offset", "body").mapInArrow(halves, _RECORDS)


def _field(name: str, of: str = "header") -> Column:
    return F.nullif(F.regexp_extract(F.col(of), f"(?im)^{name}:[ \\t]*([^\\r\\n]*)", 1), F.lit(""))


def digest(pages: DataFrame) -> DataFrame:
    """Write the pages' records, read the archives back; one row per record with what the archive says of it.

    A response's size and digest are those of the payload read; a revisit, which has none, states them in its headers.
    """
    spark = pages.sparkSession
    path = scratch(spark, "archive")
    write(records(pages), path)
    back = read(spark, path, {"payload_bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")})
    page = lambda name: F.regexp_extract(_field(name), "<urn:page:(-?\\d+)>", 1)
    kind = _field("WARC-Type")
    return back.select(
        F.nullif(page("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"),
        F.when(kind == "revisit", _field("Content-Length", "http").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(kind == "revisit", F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "")).otherwise(F.col("sha1")).alias("payload_digest"),
        kind.alias("record_type"),
        F.nullif(page("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"),
    )
