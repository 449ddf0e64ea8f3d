"""WARC archives (operator 11), read back by boundary-chain verification.

Writing. A row becomes one WARC/1.1 record whose block is an HTTP response with
the payload in UTF-8. Of the rows with equal payloads (equal SHA-1) of at least
``min_revisit_bytes`` bytes, the one with the largest id is written in full and
the others as ``revisit`` records that refer to it. Spark's text writer ends
every record with the two line ends that the format asks for, so an archive is
a folder of uncompressed WARC files in any store that Spark writes to.

Reading. A record's length stands in its header, so where a record starts
follows from the one before it; a task that starts in the middle of a file
cannot know, and a payload may hold anything, whole records included.

1. The files are read in splits. Every place with the format's magic after an
   empty line (or first in a split) is a candidate; the task emits its offset
   and, from the length in its header, the offset of its successor (``pieces``).
2. The candidates of one split are followed to where their chains leave it,
   and the first offset in each file to all that it reaches by pointer jumping:
   each round doubles the length of the jumps (``entered``). The tables of
   these steps hold offsets only, a few rows for each split of a file.
3. Only records on the chain from the start of their file are kept. What else
   looked like a record lies within a payload and is part of it: the pieces of a
   record that was read in several come together again by its offset.

A chain has to end where its file does. ``records`` raises otherwise, or with
``strict=False`` returns the records before the damage, and ``damage`` tells the
files and offsets.

Memory: a task holds one record, or the offsets of one split; a header of more
than 64 KB counts as damage.

Defined cases: a NULL payload is empty, a NULL url leaves its field out, a NULL
id is smaller than others and is read as NULL; all rows of the largest id among
equal payloads (repeated rows) are responses, and if all ids are NULL all are;
line ends and other control characters in a url are left out; an empty table
writes no records; other columns never matter.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewater.llm.common import col, cut, python_tasks, shared_dir, staged

MAGIC = "WARC/1."
END = "\r\n\r\n"  # after a header, and after a record
HEAD_BYTES = 1 << 16

# Fixed values of the format.
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 SHA-1: five bytes are eight digits."""
    digest = F.sha1(payload)
    eight = [F.lpad(F.conv(F.substring(digest, 10 * i + 1, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*eight), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def record_id(page_id: Column, digest: Column) -> Column:
    """A name for a record that a retried task gives again."""
    h = F.md5(F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("-")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
                    F.lit(">"))


def write(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
          min_revisit_bytes: int = 0, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write one record per row of ``pages`` to a new folder of WARC files."""
    rows = pages.select(col(pages, id_col).cast("long").alias("page_id"), col(pages, url_col).cast("string").alias("url"),
                        F.coalesce(col(pages, payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("n", F.octet_length("payload"))
    # written first: with its size known, a small table of groups does not make Spark shuffle the payloads
    groups = staged(rows.where(F.col("n") >= min_revisit_bytes).groupBy("digest")
                    .agg(F.max("page_id").alias("first_id"), F.count("*").alias("members"))
                    .where("members > 1").select("digest", "first_id", F.lit(True).alias("grouped")), "groups")
    known = rows.join(groups, "digest", "left").withColumn(
        "kind", F.when(F.col("grouped") & ~F.col("page_id").eqNullSafe(F.col("first_id")), REVISIT).otherwise(RESPONSE))
    revisit = F.col("kind") == REVISIT
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END))
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))  # noqa: E731 -- NULL: no line
    clean = F.nullif(F.regexp_replace("url", r"[\x00-\x20\x7F]", ""), F.lit(""))
    known = known.withColumn("http", http)
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("kind")), line("WARC-Record-ID", record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", clean), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        line("WARC-Refers-To", F.when(revisit, record_id(F.col("first_id"), F.col("digest")))),
        line("WARC-Profile", F.when(revisit, F.lit(PROFILE))), line("Page-Id", F.col("page_id").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", (F.octet_length("http") + F.when(revisit, 0).otherwise(F.col("n"))).cast("string")))
    known.select(F.concat(head, F.lit("\r\n"), "http", F.when(revisit, "").otherwise(F.col("payload"))).alias("value")) \
        .write.option("lineSep", END).text(folder)


def length_in(head: str) -> int | None:
    """The length of the block by a whole header; None if this is no record's header."""
    if not re.match(r"WARC/1\.\d\r\n", head):
        return None
    found = re.search(r"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", head, re.I)
    return int(found[1]) if found else None


def payload_of(head: str, block: bytes) -> tuple[str, bytes]:
    """(HTTP header, payload) of a record's block."""
    http = re.search(r"\r\ncontent-type:[ \t]*application/http", head, re.I)
    at = block.find(END.encode(), 0, HEAD_BYTES) if http else -1
    return (block[:at].decode("utf-8", "replace"), block[at + 4:]) if at >= 0 else ("", block)


def measured(head: str, block: bytes) -> tuple[str, int, str, bytes]:
    http, payload = payload_of(head, block)
    return http, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), payload


class Split:
    """Cuts one split of a file, chunk by chunk, into pieces that begin at candidates.

    A split at the start of a file knows the chain: ``due`` is where the next
    record starts. Others learn it from ``entered``."""

    def __init__(self, file: str, start: int, file_bytes: int):
        self.file, self.start, self.file_bytes = file, start, file_bytes
        self.at, self.tail, self.begun, self.first = 0, b"", None, True
        self.parts, self.head, self.due = [], None, None if start else 0

    def begin(self, data: bytes) -> None:
        self.begun, self.parts, self.head = self.at, [], data if data.startswith(MAGIC.encode()) else None

    def chunk(self, data: bytes):
        if self.begun is None:
            self.begin(data)
        elif self.tail == END.encode():
            yield self.piece(last=False)
            self.begin(data)
        elif self.head is not None and len(self.head) < HEAD_BYTES and END.encode() not in self.head:
            self.head += data  # the magic stands in a header
        self.parts.append(data)
        self.at += len(data)
        self.tail = (self.tail + data)[-4:]

    def piece(self, last: bool) -> dict:
        body = b"".join(self.parts)
        row = {"file": self.file, "block": self.start, "file_bytes": self.file_bytes, "at": self.begun, "size": len(body), "body": body}
        if self.first and self.start:  # what a header that the split before left open goes on with
            end = body.find(END.encode(), 0, HEAD_BYTES)
            row["lead"] = body[:end + 4] if end >= 0 else body[:HEAD_BYTES]
        self.first = False
        if self.head is not None:
            end = self.head.find(END.encode(), 0, HEAD_BYTES)
            if end >= 0:
                head = self.head[:end + 4].decode("utf-8", "replace")
                n = length_in(head)
                if n is not None:
                    row |= {"head": head, "head_bytes": end + 4, "length": end + 4 + n + 4}
                    if self.begun == self.due:
                        self.due += row["length"]
                        row["known"] = row["length"] <= row["size"]
            elif last and len(self.head) < HEAD_BYTES:
                row["open"] = self.head
        return row


PIECES = pa.schema([
    ("file", pa.string()), ("block", pa.int64()), ("file_bytes", pa.int64()), ("at", pa.int64()), ("size", pa.int64()),
    ("lead", pa.binary()), ("open", pa.binary()), ("head", pa.string()), ("head_bytes", pa.int64()), ("length", pa.int64()),
    ("http", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("body", pa.binary())])
PIECES_DDL = ("file string, block long, file_bytes long, at long, size long, lead binary, open binary, head string, head_bytes long, "
              "length long, http string, payload_bytes long, payload_digest string, body binary")
BATCH_BYTES = 8 << 20


def settled(row: dict, payload: bool) -> dict:
    """A record that is known to be on the chain, and whose payload nobody wants, is measured at once and leaves no bytes."""
    if row.get("known") and not payload:
        http, n, digest, _ = measured(row["head"], row["body"][row["head_bytes"]:row["length"] - 4])
        return row | {"http": http, "payload_bytes": n, "payload_digest": digest, "body": None}
    return row


def pieces(spark: SparkSession, folder: str, payload: bool) -> DataFrame:
    """The pieces of all files in the splits that Spark reads: each begins at a
    candidate or at the start of a split, ``at`` bytes after the first piece of its split."""
    python_tasks(spark)
    text = spark.read.option("lineSep", MAGIC).text(folder)
    chunks = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.col("_metadata.file_size").alias("file_bytes"), F.col("value").cast("binary").alias("chunk"))
    magic = MAGIC.encode()

    def tasks(batches):
        split, rows, held = None, [], 0
        for batch in batches:
            files, blocks, sizes, data = (batch.column(i) for i in range(4))
            for i in range(batch.num_rows):
                file, block, chunk, done = files[i].as_py(), blocks[i].as_py(), data[i].as_py(), []
                first = split is None or (file, block) != (split.file, split.start)
                if first:
                    if split is not None and split.begun is not None:
                        done.append(split.piece(last=True))
                    split = Split(file, block, sizes[i].as_py())
                # the reader takes the magic for the end of a line: it stands before all chunks but the first of a file
                chunk = chunk if first and block == 0 else magic + chunk
                if chunk:
                    done += split.chunk(chunk)
                rows += [settled(x, payload) for x in done]
                held += sum(x["size"] for x in done)
                if held >= BATCH_BYTES or len(rows) >= 2048:
                    yield pa.RecordBatch.from_pylist(rows, schema=PIECES)
                    rows, held = [], 0
        if split is not None and split.begun is not None:
            rows.append(settled(split.piece(last=True), payload))
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=PIECES)

    return chunks.mapInArrow(tasks, PIECES_DDL)


def placed(found: DataFrame) -> DataFrame:
    """Every piece without its bytes, at its offset in the file; headers that a
    split left open are completed by what the next split begins with."""
    rows = found.drop("body")
    blocks = rows.groupBy("file", "block").agg(F.sum("size").alias("n"), F.max("lead").alias("first_bytes"))
    in_file = W.partitionBy("file").orderBy("block")  # one row for each split of a file
    blocks = blocks.select("file", "block", F.coalesce(F.sum("n").over(in_file.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"),
                           F.lead("first_bytes").over(in_file).alias("next_bytes"))
    whole = F.decode(F.concat("open", F.coalesce("next_bytes", F.encode(F.lit(""), "UTF-8"))), "ISO-8859-1")  # a letter per byte
    end = F.when(F.col("open").isNotNull(), F.instr(whole, END))
    length = F.regexp_extract(whole, r"(?i)\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", 1)
    late = (end > 0) & whole.rlike(r"^WARC/1\.\d\r\n") & (length != "")
    rows = rows.join(blocks, ["file", "block"]).withColumn("off", F.col("base") + F.col("at"))
    return rows.select(
        "file", "block", "file_bytes", "at", "off", "size",
        F.when(late, F.decode(F.substring(F.concat("open", "next_bytes"), F.lit(1), end + 3), "UTF-8")).otherwise(F.col("head")).alias("head"),
        F.when(late, end + 3).otherwise(F.col("head_bytes")).cast("long").alias("head_bytes"),
        (F.col("off") + F.when(late, end + 3 + length.try_cast("long") + 4).otherwise(F.col("length"))).alias("next"),
        "http", "payload_bytes", "payload_digest")


def leave_split(rows: pd.DataFrame) -> pd.DataFrame:
    """Per candidate of one split: the first offset of its chain that is not a candidate of the split."""
    rows = rows.sort_values("off", ascending=False)
    leaves: dict[int, int] = {}
    for off, after in zip(rows["off"].tolist(), rows["next"].tolist()):
        leaves[off] = leaves.get(after, after)
    return pd.DataFrame({"file": rows["file"], "off": rows["off"], "to": [leaves[x] for x in rows["off"].tolist()]})


def owners(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one split with the offset of the record that each belongs
    to: the last one on the chain that starts at or before the piece."""
    rows = rows.sort_values("off")
    due, current, found = set(), None, []
    for off, after, entry in zip(rows["off"].tolist(), rows["next"].tolist(), rows["entry"].tolist()):
        if after == after and (entry or off in due):  # NaN: no candidate
            due.add(int(after))
            current = off
        found.append(current)
    return rows.assign(owner=pd.array(found, dtype="Int64")).drop(columns="entry")


def entered(candidates: DataFrame) -> DataFrame:
    """(file, off): where the chain from offset 0 of a file enters each of its
    splits, from the candidates (file, block, off, next) of all splits."""
    steps = cut(candidates.groupBy("file", "block").applyInPandas(leave_split, "file string, off long, to long"))
    # nodes: where a file begins, or where a chain that left a split goes on
    targets = steps.select("file", F.col("to").alias("off")).distinct()
    nodes = cut(steps.join(targets, ["file", "off"], "left_semi").union(steps.where("off = 0")).distinct())
    keys = nodes.select("file", F.col("off").alias("to"))
    jumps = cut(nodes.join(keys, ["file", "to"], "left_semi").select("file", "off", "to"))
    on, n = nodes.where("off = 0").select("file", "off"), 0
    while jumps.limit(1).count():
        on = cut(on.union(on.join(jumps, ["file", "off"]).select("file", F.col("to").alias("off"))).distinct())
        before, n = n, on.count()
        if n == before:
            break
        jumps = cut(jumps.join(jumps.select("file", F.col("off").alias("to"), F.col("to").alias("further")), ["file", "to"])
                    .select("file", "off", F.col("further").alias("to")))
    return on


RECORDS = pa.schema([("file", pa.string()), ("off", pa.int64()), ("length", pa.int64()), ("head", pa.string()), ("http", pa.string()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])
RECORDS_DDL = "file string, off long, length long, head string, http string, payload_bytes long, payload_digest string, payload binary"


class Archive:
    """An archive as it was read: ``records`` and ``damage`` are DataFrames."""

    def __init__(self, spark: SparkSession, folder: str, payload: bool):
        found = staged(pieces(spark, folder, payload), "pieces")
        places = staged(placed(found), "places")
        entries = entered(places.where("next is not null").select("file", "block", "off", "next"))
        flagged = places.join(entries.withColumn("entry", F.lit(True)), ["file", "off"], "left").select(
            *places.columns, F.coalesce("entry", F.lit(False)).alias("entry"))
        kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in places.schema)
        owned = staged(flagged.groupBy("file", "block").applyInPandas(owners, f"{kinds}, owner long"), "owners")
        # a split begins with the rest of a record of the splits before it
        carried = owned.groupBy("file", "block").agg(F.max("owner").alias("latest")).select("file", "block", F.max("latest").over(
            W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)).alias("carried"))
        self.places = owned
        starts = owned.where("off = owner and next <= file_bytes").withColumn("length", F.col("next") - F.col("off"))
        bodies = found.select("file", "block", "at", "body")
        known = starts.where("payload_digest is not null").select(
            "file", "off", "length", "head", "http", "payload_bytes", "payload_digest", F.lit(None).cast("binary").alias("payload"))
        whole = starts.where("payload_digest is null and length <= size").join(bodies, ["file", "block", "at"]).select(
            "file", "off", "length", "head", "head_bytes", "body")
        long = starts.where("length > size").select("file", F.col("off").alias("owner"), "length", "head", "head_bytes")
        parts = owned.select("file", "block", "at", "off", F.col("owner").alias("own")).join(carried, ["file", "block"]) \
            .withColumn("owner", F.coalesce("own", "carried")).join(long, ["file", "owner"]).join(bodies, ["file", "block", "at"])

        def taken(row: dict) -> dict:
            http, n, digest, data = measured(row["head"], row["body"][row["head_bytes"]:row["length"] - 4])
            return {"file": row["file"], "off": row["off"], "length": row["length"], "head": row["head"], "http": http,
                    "payload_bytes": n, "payload_digest": digest, "payload": data if payload else None}

        def measure(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pylist([taken(row) for row in batch.to_pylist()], schema=RECORDS)

        def together(key, rows: pd.DataFrame) -> pd.DataFrame:
            row = dict(zip(("file", "off", "length", "head", "head_bytes"), key))
            return pd.DataFrame([taken(row | {"body": b"".join(rows.sort_values("off")["body"])})])

        several = parts.groupBy("file", "owner", "length", "head", "head_bytes").applyInPandas(together, RECORDS_DDL)
        self.records = known.union(whole.mapInArrow(measure, RECORDS_DDL)).union(several)

    @property
    def damage(self) -> DataFrame:
        """(file, off, file_bytes): files whose chain does not end where they do, and where it breaks."""
        files = self.places.groupBy("file").agg(F.max("file_bytes").alias("file_bytes"), F.sum("size").alias("seen"))
        ends = self.places.where("off = owner and next <= file_bytes").groupBy("file").agg(F.max("next").alias("off"))
        return files.join(ends, "file", "left").select("file", F.coalesce("off", F.lit(0)).alias("off"), "file_bytes", "seen") \
            .where("off != file_bytes or seen != file_bytes").select("file", "off", "file_bytes")


class Damaged(ValueError):
    """Files of an archive whose records do not follow each other to the end."""


def records(spark: SparkSession, folder: str, *, payload: bool = True, strict: bool = True) -> DataFrame:
    """One row per record: file, off, length, head, http, payload_bytes, payload_digest, payload (NULL unless asked for)."""
    archive = Archive(spark, folder, payload)
    if strict and (broken := archive.damage.orderBy("file").limit(5).collect()):
        raise Damaged("; ".join(f"{r['file']} at {r['off']} of {r['file_bytes']} bytes" for r in broken))
    return archive.records


def field(name: str) -> Column:
    """A header field's value; NULL if there is none."""
    return F.nullif(F.regexp_extract("head", rf"(?i)\r\n{re.escape(name)}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def pages(found: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each
    record. A digest that differs from the one in the header, or a revisit of a
    record that is not there, is an error."""
    rows = found.select(field("Page-Id").cast("long").alias("page_id"), field("WARC-Type").alias("record_type"),
                        field("WARC-Record-ID").alias("id"), field("WARC-Refers-To").alias("to"),
                        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("said"), "payload_bytes", "payload_digest")
    rows = staged(rows, "records")
    checked = F.when(F.col("said").eqNullSafe(F.col("payload_digest")), F.col("payload_digest")).otherwise(
        F.raise_error(F.concat(F.lit("digest does not match: record "), F.coalesce("id", F.lit("-")))))
    full = rows.where(F.col("record_type") == RESPONSE).select("page_id", "payload_bytes", checked.alias("payload_digest"), "record_type",
                                                               F.lit(None).cast("long").alias("refers_to"))
    targets = rows.where(F.col("record_type") == RESPONSE).groupBy(F.col("id").alias("to")).agg(
        F.max("page_id").alias("refers_to"), F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("digest"))
    seen = rows.where(F.col("record_type") == REVISIT).drop("payload_bytes", "payload_digest").join(targets, "to", "left")
    known = F.when(F.col("said").eqNullSafe(F.col("digest")), F.col("digest")).otherwise(
        F.raise_error(F.concat(F.lit("revisit of a record that is not there: "), F.coalesce("id", F.lit("-")))))
    return full.union(seen.select("page_id", "payload_bytes", known.alias("payload_digest"), "record_type", "refers_to"))


def archive_folder(docs: DataFrame, **options) -> str:
    """``docs`` written to a new folder of WARC files in the shared folder."""
    folder = f"{shared_dir(docs.sparkSession)}/warc-{uuid.uuid4().hex}"
    write(docs, folder, **options)
    return folder
