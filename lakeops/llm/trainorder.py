"""Token ids in training order: fixed-stride binary shards.

1. Documents are range-partitioned and sorted by id and hash of the text, so that one
   stream of all token ids has the same order however the input is dealt out. They are
   tokenised in that order, each followed by the end token, and written as blocks of
   ``BLOCK`` sequences' worth of ids. The token counts of partitions place each block in the
   stream, and the stream is cut into sequences of ``SEQUENCE`` ids.
2. A keyed Feistel network permutes the numbers of the sequences: it is a bijection of the
   smallest square power of two that holds all N of them, and numbers that land at N or
   above go through it again until they don't (cycle walking), so slots are exactly
   0 .. N - 1. Any key gives a full shuffle without a sort by random numbers, and the same
   one on every retry.
3. Sequences, and the two parts of those that lie over the edge of a block, go to the
   partition of their shard (slot // ``SHARD_ROWS``), sorted by slot, and are
   written: shard k holds slots k * rows .. of ``SEQUENCE`` little-endian ids each, 16 bit
   where the vocabulary allows. Slot s lies in shard s // rows at byte
   (s % rows) * stride, so reads are sequential and resume anywhere.

Only the token count of each partition comes to the driver. A task holds one block, and
one document that is longer than it. Shards are moved into place when whole; a retry
writes the same bytes.

Defined results: a null or empty text is its end token alone. A null id comes first, rows
of one id in order of the text's hash, and repeated rows are written each. Only the
last sequence is padded. A sequence lists the ids of the documents in it, null ids
included. An empty table gives no shard. Other columns are not stored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeops.llm import common, tokens, words as W

SEQUENCE = 2048
SHARD_ROWS = 8192
BLOCK = 32  # sequences
LEVEL = 1  # of compression between stages
ROUNDS = 6
PAD = 0
KEY = "training-order"


class Permutation:
    """A keyed bijection of 0 .. n - 1."""

    def __init__(self, n: int, key: str, rounds: int = ROUNDS):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        digest = [hashlib.sha256(f"{key}/{r}".encode()).digest() for r in range(rounds)]
        self.keys = [np.uint64(int.from_bytes(d[:8], "little")) for d in digest]

    def _once(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for k in keys:
            left, right = right, left ^ (W.mix(right + k) & self.mask)
        return (left << self.half) | right

    def __call__(self, numbers: np.ndarray) -> np.ndarray:
        x = self._once(numbers.astype(np.uint64), self.keys)
        while True:
            out = np.flatnonzero(x >= np.uint64(self.n))
            if not len(out):
                return x.astype(np.int64)
            x[out] = self._once(x[out], self.keys)


def id_bytes(path: str) -> int:
    """2 where all ids of the vocabulary fit, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def blocks(docs: DataFrame, *, key: str, text: str, path: str, size: int, width: int) -> DataFrame:
    """The stream of token ids: ``part``, ``begin`` (place in the partition's stream), ``n`` ids,
    ``docs`` (their documents), ``ends`` (where each of these ends), ``goes_on`` (the first one
    began in the block before) and ``z``, compressed ids. A block has ``size`` ids but for the
    last of a partition."""
    kind = docs.schema[key].dataType
    schema = T.StructType([
        T.StructField("part", T.LongType()), T.StructField("begin", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("docs", T.ArrayType(kind)), T.StructField("ends", T.ArrayType(T.LongType())),
        T.StructField("goes_on", T.BooleanType()), T.StructField("z", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, dtype = TaskContext.get().partitionId(), f"<u{width}"
        pack = zstandard.ZstdCompressor(level=LEVEL)
        begin, held, names, ends, key_type, goes_on = 0, [], [], [], None, False

        def block() -> pa.RecordBatch:
            nonlocal begin, held, names, ends
            ids = np.concatenate(held)
            row = [part, begin, len(ids), names, ends, goes_on, pack.compress(ids.astype(dtype).tobytes())]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(key_type), pa.list_(pa.int64()), pa.bool_(), pa.binary()]
            begin, held, names, ends = begin + len(ids), [], [], []
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], schema.names)

        for b in batches:
            keys, key_type = b.column(0), b.schema.field(0).type
            for row, ids, _ in tokens.token_rows(b.column(1), path):
                name, at = keys[row].as_py(), 0
                while at < len(ids):
                    full = ends[-1] if ends else 0
                    if not ends:
                        goes_on = at > 0
                    some = ids[at: at + size - full]
                    held.append(some)
                    names.append(name)
                    ends.append(full + len(some))
                    at += len(some)
                    if ends[-1] == size:
                        yield block()
        if held:
            yield block()

    order = [F.col(key), F.xxhash64(text), F.monotonically_increasing_id()]  # equal rows may part
    names = [common.fresh(docs.columns, n) for n in ("hash", "tie")]
    own = docs.select(F.col(key), F.col(text), *(c.alias(n) for c, n in zip(order[1:], names)))
    own = own.repartitionByRange(key, *names).sortWithinPartitions(key, *names)
    return own.select(F.col(key), F.col(text)).mapInArrow(run, schema)


def _parts(stream: DataFrame, base: dict[int, int], order: Permutation, *, length: int, shard_rows: int, width: int) -> DataFrame:
    """Blocks cut into sequences, or the part of one that they hold: ``slot``, ``shard``,
    ``sequence_id``, ``at`` (the part's place in the sequence), ``n``, ``docs``, ``goes_on``, ``z``."""
    schema = T.StructType([
        *(T.StructField(c, T.LongType()) for c in ("slot", "shard", "sequence_id", "at", "n")), stream.schema["docs"],
        T.StructField("goes_on", T.BooleanType()), T.StructField("z", T.BinaryType())])
    shared = stream.sparkSession.sparkContext.broadcast((base, order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases, permute = shared.value
        pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
        for b in batches:
            for r in range(b.num_rows):
                part, begin, n = (b.column(i)[r].as_py() for i in range(3))
                names, ends, goes_on = b.column(3)[r].values, b.column(4)[r].values.to_numpy(), b.column(5)[r].as_py()
                ids = unpack.decompress(b.column(6)[r].as_py(), max_output_size=n * width)
                first = bases[part] + begin
                cuts = np.unique(np.append(np.arange(-first % length, n, length), [0, n]))
                a, z = cuts[:-1], cuts[1:]
                sequence, at = np.divmod(first + a, length)
                slot = permute(sequence)
                since, upto = np.searchsorted(ends, a, side="right"), np.searchsorted(ends, z, side="left") + 1
                offsets = np.concatenate([[0], np.cumsum(upto - since)])
                own = names.take(pa.array(np.arange(offsets[-1]) - np.repeat(offsets[:-1] - since, upto - since)))
                before = np.append(0, ends)[since] < a
                before[0] |= goes_on
                raw = [pack.compress(ids[width * x: width * y]) for x, y in zip(a.tolist(), z.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in (slot, slot // shard_rows, sequence, at, z - a)),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), own), pa.array(before), pa.array(raw, pa.binary())], schema.names)

    return stream.mapInArrow(run, schema)


def write_shards(
    docs: DataFrame, path: str, *, key: str = "doc_id", text: str = "text", vocabulary: str | None = None,
    length: int = SEQUENCE, shard_rows: int = SHARD_ROWS, seed: str = KEY,
) -> DataFrame:
    """Write shards below ``path``. A written table with one row per sequence: ``slot``, ``shard``,
    ``byte_offset``, ``sequence_id``, ``n_tokens``, ``doc_ids``, ``ids_crc32`` (padding
    included) and ``id_bytes``."""
    vocabulary = vocabulary or tokens.vocabulary_path()
    width = id_bytes(vocabulary)
    stream = common.written(blocks(docs, key=key, text=text, path=vocabulary, size=BLOCK * length, width=width), "blocks")
    base, total = {}, 0
    for part, n in sorted(tuple(r) for r in stream.groupBy("part").agg(F.sum("n")).collect()):  # one row per partition
        base[part], total = total, total + n
    total = -(-total // length)
    parts = _parts(stream, base, Permutation(max(total, 1), seed), length=length, shard_rows=shard_rows, width=width)
    shards = max(1, -(-total // shard_rows))
    placed = parts.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot", "at")
    stride = length * width
    out = T.StructType([
        *(T.StructField(c, T.LongType()) for c in ("slot", "shard", "byte_offset", "sequence_id", "n_tokens")),
        T.StructField("doc_ids", stream.schema["docs"].dataType), T.StructField("ids_crc32", T.LongType()), T.StructField("id_bytes", T.LongType())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        list_type = None

        def whole() -> Iterator[tuple]:
            """(slot, shard, sequence, ids in it, documents, bytes) from the parts of each."""
            nonlocal list_type
            now = None
            for b in batches:
                list_type = b.column(5).type
                for slot, shard, sequence, at, n, names, goes_on, z in zip(*(b.column(i).to_pylist() for i in range(8))):
                    if now is None or now[0] != slot:
                        if now is not None:
                            yield now
                        now = [slot, shard, sequence, 0, [], b""]
                    now[3] += n
                    now[4] += names[1:] if goes_on and now[4] else names
                    now[5] += unpack.decompress(z, max_output_size=stride)
            if now is not None:
                yield now

        rows, padding = whole(), np.full(length, PAD, dtype=f"<u{width}").tobytes()
        row = next(rows, None)
        while row is not None:
            shard, written = row[1], []

            def payloads() -> Iterator[bytes]:
                nonlocal row
                while row is not None and row[1] == shard:
                    raw = row[5] + padding[len(row[5]):]
                    written.append((row[0], shard, len(written) * stride, *row[2:5], zlib.crc32(raw), width))
                    yield raw
                    row = next(rows, None)

            common.write_once(shard_file(path, shard), payloads())
            for a in range(0, len(written), 4096):
                some = written[a: a + 4096]
                yield pa.RecordBatch.from_arrays([pa.array([w[i] for w in some], list_type if i == 5 else pa.int64()) for i in range(8)], out.names)

    return common.written(placed.mapInArrow(write, out), "slots")


def shard_file(path: str, shard: int) -> str:
    return f"{path}/shard-{shard:08d}.bin"


def read_from(path: str, slot: int, total: int, *, length: int = SEQUENCE, shard_rows: int = SHARD_ROWS, width: int = 2) -> Iterator[np.ndarray]:
    """Sequences from ``slot`` on, in training order: how a trainer starts or resumes."""
    while slot < total:
        shard, row = divmod(slot, shard_rows)
        files, inside = common.file_system(shard_file(path, shard))
        with files.open_input_file(inside) as f:
            f.seek(row * length * width)
            while raw := f.read(length * width):
                yield np.frombuffer(raw, dtype=f"<u{width}")
                slot += 1


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return write_shards(docs, common.shared_path(spark, "shards"))


SQL = None
