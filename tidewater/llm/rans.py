"""Token-ID / binary output (operator 9): range asymmetric numeral system (rANS).

Format. A folder with three Parquet tables, so that it can lie in any store
that Spark writes to:

- ``symbols`` (id, freq): the shared frequency table, frequencies that sum to
  2^bits, from counts over all ids of the corpus;
- ``blocks`` (part, block, first, n_ids, doc_ids, sizes, coded, crc): whole
  consecutive documents of at least ``BLOCK_IDS`` ids together; ``first`` counts
  ids from the start of the part;
- ``parts`` (part, n_ids): the size of each part; parts follow each other in
  order of doc_id, so their running sum is the place of a part in the stream.

A block is coded by itself: ``LANES`` coders interleaved, id i by coder
i mod LANES, each with a 64-bit state that moves 32-bit words to one common
stream. Every ``STEPS`` steps a checkpoint holds all states, the place in the
stream and the CRC of the ids up to the next one: a reader may start at any
checkpoint, in parallel with others, and verifies what it has read.

Writing: the ids are staged once with a row number, sorted by (doc_id, row
number) over range partitions, and coded partition by partition in bounded
memory. Nothing but the frequency table and the part sizes comes to the driver.

Ids come from the tokenizers library: its model encodes the pieces that the
vocabulary file's normaliser and pattern give (see ``bpe.TextEncoder``),
remembered in caches of bounded size that a Python worker keeps from task to
task, which is what makes whole corpora affordable.

Defined cases: a NULL text counts as empty, and a document without tokens has
just the end id; NULL doc_ids come first; repeated doc_ids follow each other;
an empty table writes tables without rows and reads back without rows; other
columns never matter.
"""

from __future__ import annotations

import functools
import struct
import uuid
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.bpe import TextEncoder, byte_symbols, parse
from tidewater.llm.common import id_text, python_tasks, shared_dir, staged

LANES, STEPS, BLOCK_IDS = 1024, 64, 1 << 17
LOW = np.uint64(1 << 31)  # a coder's state is in [2^31, 2^63)
HEAD = struct.Struct("<4sBIIII")  # mark, bits, ids, lanes, words, checkpoints
MARK = b"rANS"


def frequencies(counts: dict[int, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """(bits, ids, freqs): every id that occurs gets at least 1 of 2^bits."""
    ids = np.array(sorted(counts), dtype=np.int64)
    n = np.array([counts[int(i)] for i in ids], dtype=np.float64)
    bits = max(16, int(len(ids)).bit_length() + 4)
    freqs = 1 + np.floor(n * ((1 << bits) - len(ids)) / max(1.0, n.sum())).astype(np.int64)
    if len(ids):
        freqs[np.argmax(n)] += (1 << bits) - freqs.sum()
    return bits, ids, freqs


class Coder:
    """The shared tables: symbols are places in ``ids``."""

    def __init__(self, bits: int, ids: np.ndarray, freqs: np.ndarray):
        self.bits, self.ids = bits, ids
        self.freq = freqs.astype(np.uint64)
        self.start = (np.cumsum(freqs) - freqs).astype(np.uint64)
        self.symbol_at = np.repeat(np.arange(len(ids), dtype=np.int32), freqs)  # slot -> symbol
        self.place = None  # id -> symbol, or -1; ids beyond any vocabulary's are searched for
        if len(ids) and ids[-1] < 1 << 20:
            self.place = np.full(int(ids[-1]) + 1, -1, dtype=np.int32)
            self.place[ids] = np.arange(len(ids), dtype=np.int32)

    def symbols(self, ids: np.ndarray) -> np.ndarray:
        if self.place is not None:
            found = self.place[np.minimum(ids, len(self.place) - 1)]
        else:
            found = np.minimum(np.searchsorted(self.ids, ids), len(self.ids) - 1)
        if len(ids) and (not len(self.ids) or (self.ids[found] != ids).any()):
            raise ValueError("an id without a frequency")
        return found

    def encode(self, ids: np.ndarray) -> bytes:
        n, bits, symbols = len(ids), np.uint64(self.bits), self.symbols(ids)
        state = np.full(LANES, LOW, dtype=np.uint64)
        steps, words, marks, emitted = -(-n // LANES), [], [], 0
        for t in range(steps - 1, -1, -1):
            s = symbols[t * LANES:(t + 1) * LANES]
            f, x = self.freq[s], state[:len(s)]
            full = x >= f << np.uint64(63 - self.bits)
            out = (x[full] & np.uint64(0xFFFFFFFF)).astype("<u4")
            words.append(out)
            emitted += len(out)
            x[full] >>= np.uint64(32)
            q = x // f
            state[:len(s)] = (q << bits) + (x - q * f) + self.start[s]
            if t % STEPS == 0:
                part = ids[t * LANES:(t + STEPS) * LANES].astype("<u4")
                marks.append((emitted, zlib.crc32(part.tobytes()), state.astype("<u8").tobytes()))
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        head = HEAD.pack(MARK, self.bits, n, LANES, len(stream), len(marks))
        points = b"".join(struct.pack("<II", emitted - e, crc) + x for e, crc, x in marks[::-1])
        return head + points + stream.tobytes()

    def decode(self, coded: bytes, checkpoints: range | None = None) -> np.ndarray:
        """The ids of a block, or only those from the given checkpoints; their checksums are verified."""
        mark, bits, n, lanes, n_words, n_points = HEAD.unpack_from(coded)
        if mark != MARK or bits != self.bits:
            raise ValueError("not a block of these tables")
        size = 8 + 8 * lanes
        stream = np.frombuffer(coded, "<u4", n_words, HEAD.size + n_points * size).astype(np.uint64)
        slots, shift, out = np.uint64((1 << bits) - 1), np.uint64(bits), []
        for k in checkpoints if checkpoints is not None else range(n_points):
            at, crc = struct.unpack_from("<II", coded, HEAD.size + k * size)
            state = np.frombuffer(coded, "<u8", lanes, HEAD.size + k * size + 8).astype(np.uint64)
            got = []
            for t in range(k * STEPS, min((k + 1) * STEPS, -(-n // lanes))):
                x = state[:min(lanes, n - t * lanes)]
                slot = x & slots
                s = self.symbol_at[slot]
                got.append(s)
                x = self.freq[s] * (x >> shift) + slot - self.start[s]
                less = x < LOW
                more = int(less.sum())
                x[less] = (x[less] << np.uint64(32)) | stream[at:at + more]
                at += more
                state[:len(x)] = x
            ids = self.ids[np.concatenate(got)].astype("<u4")
            if zlib.crc32(ids.tobytes()) != crc:
                raise ValueError("checksum of a checkpoint does not match")
            out.append(ids)
        return np.concatenate(out) if out else np.zeros(0, "<u4")


@functools.lru_cache(maxsize=1)
def library_encoder(file: str) -> TextEncoder:
    """text -> ids by the tokenizers library's model. One per Python worker: later tasks find its caches filled."""
    from tokenizers import Tokenizer
    tokenize, symbols = Tokenizer.from_str(file).model.tokenize, dict(enumerate(byte_symbols()))

    def piece(text: str) -> bytes:
        if not (text.isascii() and text.isprintable()):  # other bytes have characters that stand for them
            text = text.encode("utf-8", "surrogatepass").decode("latin-1").translate(symbols)
        return array("I", [t.id for t in tokenize(text)]).tobytes()

    _, _, special, rest = parse(file)
    return TextEncoder(special, rest, piece, cached=600_000)


def narrow(ids: bytes) -> bytes:
    """Ids as they are staged and sorted: 16 bits each if all fit, else 32; the first byte tells."""
    x = np.frombuffer(ids, "<u4")
    return b"\x02" + x.astype("<u2").tobytes() if not len(x) or x.max() < 1 << 16 else b"\x04" + ids


def wide(ids: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u2" if x[:1] == b"\x02" else "<u4", offset=1) for x in ids]


def tokens(docs: DataFrame, path: str, end_id: int | None = None, *, id_col: str = "doc_id", text_col: str = "text",
           pack=bytes) -> DataFrame:
    """One row per document: doc_id and its ids (little-endian unsigned 32-bit
    integers, or what ``pack`` makes of them), with ``end_id`` last."""
    python_tasks(docs.sparkSession)
    with open(path, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file, of fixed size
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")

    def tasks(batches):
        encode = library_encoder(file.value)
        for batch in batches:
            ids = pa.array([pack(encode(x.as_py()) + tail) for x in batch.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["doc_id", "ids"])

    df = id_text(docs, id_col, text_col)
    return df.mapInArrow(tasks, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, ids binary")


def id_counts(ids: DataFrame) -> dict[int, int]:
    """How often each of the packed ids occurs in the whole corpus (bounded by the vocabulary)."""
    def count(batches):
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            got = np.bincount(np.concatenate(wide(batch.column(0).to_pylist())))
            if len(got) > len(total):
                got, total = total, got.astype(np.int64)
            total[:len(got)] += got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


def write(ids: DataFrame, folder: str) -> None:
    """Write (doc_id, ids binary) in ascending doc_id order as a folder of the format."""
    python_tasks(ids.sparkSession)

    def pack(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([narrow(x) for x in batch.column(1).to_pylist()], pa.binary())],
                                             names=["doc_id", "ids"])

    write_packed(ids.select("doc_id", "ids").mapInArrow(pack, ids.select("doc_id", "ids").schema), folder)


def write_packed(ids: DataFrame, folder: str) -> None:
    spark = ids.sparkSession
    python_tasks(spark)
    rows = staged(ids.withColumn("uid", F.monotonically_increasing_id()), "ids")
    bits, symbols, freqs = frequencies(id_counts(rows))
    spark.createDataFrame(list(zip(symbols.tolist(), freqs.tolist())), "id long, freq long").coalesce(1).write.parquet(f"{folder}/symbols")
    coder = spark.sparkContext.broadcast(Coder(bits, symbols, freqs))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def code(batches):
        part, block, first = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, sizes, n = [], [], [], 0

        def made():
            coded = coder.value.encode(np.concatenate(ids).astype(np.uint32))
            return pa.RecordBatch.from_pylist([{"part": part, "block": block, "first": first, "n_ids": n, "doc_ids": doc_ids,
                                                "sizes": sizes, "coded": coded, "crc": zlib.crc32(coded)}], schema=shape)
        for batch in batches:
            shape = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                               ("doc_ids", pa.list_(batch.schema.field(0).type)), ("sizes", pa.list_(pa.int64())),
                               ("coded", pa.binary()), ("crc", pa.int64())])
            for doc_id, x in zip(batch.column(0).to_pylist(), wide(batch.column(1).to_pylist())):
                ids.append(x)
                doc_ids.append(doc_id)
                sizes.append(len(x))
                n += len(x)
                if n >= BLOCK_IDS:
                    yield made()
                    block, first, n = block + 1, first + n, 0
                    ids, doc_ids, sizes = [], [], []
        if doc_ids:
            yield made()

    ordered = rows.repartitionByRange("doc_id", "uid").sortWithinPartitions("doc_id", "uid").select("doc_id", "ids")
    ordered.mapInArrow(code, f"part int, block int, first long, n_ids long, doc_ids array<{kind}>, sizes array<bigint>, "
                             "coded binary, crc long").write.parquet(f"{folder}/blocks")
    spark.read.parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids")).coalesce(1).write.parquet(f"{folder}/parts")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document: doc_id, start (ids before it), n_tokens, ids (binary)."""
    python_tasks(spark, rows=8)
    table = spark.read.parquet(f"{folder}/symbols").orderBy("id").collect()
    freqs = np.array([r["freq"] for r in table], dtype=np.int64)
    coder = spark.sparkContext.broadcast(Coder(int(freqs.sum()).bit_length() - 1, np.array([r["id"] for r in table], dtype=np.int64), freqs))
    before, starts = 0, {}
    for r in spark.read.parquet(f"{folder}/parts").orderBy("part").collect():  # one row per written partition
        starts[r["part"]] = before
        before += r["n_ids"]
    blocks = spark.read.parquet(f"{folder}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if zlib.crc32(row["coded"]) != row["crc"]:
                    raise ValueError(f"checksum of block {row['part']}/{row['block']} does not match")
                data, sizes = coder.value.decode(row["coded"]).tobytes(), np.array(row["sizes"], dtype=np.int64)
                ends = np.cumsum(sizes)
                ids = [data[4 * (e - s):4 * e] for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], batch.schema.field("doc_ids").type.value_type),
                     pa.array(starts[row["part"]] + row["first"] + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                     pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

    return blocks.mapInArrow(decode, f"doc_id {kind}, start long, n_tokens long, ids binary")


def token_folder(docs: DataFrame, path: str, end_id: int, folder: str | None = None) -> str:
    """Encode ``docs`` and write them; the folder (a new one in the shared folder unless given)."""
    folder = folder or f"{shared_dir(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_packed(tokens(docs, path, end_id, pack=narrow), folder)
    return folder
