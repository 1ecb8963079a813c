"""Token ids in binary files, coded by a static range asymmetric numeral system (rANS).

One frequency table, counted over all documents, is shared by all blocks. A block holds whole documents, about
``BLOCK_TOKENS`` ids, and is coded on its own: its ids are dealt over interleaved lanes, each with its own 64-bit state,
so that a step codes one id of every lane with array operations. Every ``CHECKPOINT_STEPS`` steps a block notes the
lanes' states and the place in its words; decoding can start at any of these. Checksums guard the block and its ids.

Layout of a block, little-endian: magic, sizes and checksums (``HEAD``), the documents' identifiers (and which are null)
and numbers of ids, the checkpoints' places and states, the words.

The files of a table follow each other in ascending order of doc_id: rows are range-partitioned and sorted by doc_id,
each task writes one file, and a manifest names the files of the tasks that finished. Which block begins at which id
follows from running sums: inside a file by the task, over files from one row per file.

A folder can be read alone: ``table`` in it has the frequency table with its checksum, ``manifest`` the blocks. The
manifest is written last, so a folder without one is that of a job that did not finish.

Nulls and edges: null text is the end id alone. Null identifiers come first. Rows that share an identifier are ordered by
their ids. An empty table gives no file and an empty result. Identifiers are integers.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattloom.llm.common import saved, written
from wattloom.llm.files import create, open_file
from wattloom.llm.tokens import END_ID, default_path, tokenized, unpacked
from wattloom.session import scratch_dir, shuffle_partitions

BLOCK_TOKENS = 1 << 19
LANES = 1024
CHECKPOINT_STEPS = 128
PRECISION = 20
MAGIC = b"RANSBLK1"
HEAD = struct.Struct("<8sQQQIIIII")  # magic, documents, ids, words, lanes, steps per checkpoint, checkpoints, crc of ids, crc of rest
MANIFEST = "file string, part bigint, offset bigint, bytes bigint, start_in_file bigint, n_tokens bigint"
FLOOR = np.uint64(1 << 31)
U = np.uint64


class Model:
    """Integer frequencies that sum to 2 ** PRECISION; every id that occurs has at least 1."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._symbols: np.ndarray | None = None

    @staticmethod
    def fit(counts: np.ndarray) -> Model:
        total, room = int(counts.sum()), 1 << PRECISION
        used = np.flatnonzero(counts)
        if len(used) > room:
            raise ValueError("more different ids than the precision can tell apart")
        freq = np.zeros(len(counts), np.int64)
        if len(used):
            freq[used] = 1 + (counts[used].astype(object) * (room - len(used)) // total).astype(np.int64)
            freq[used[np.argmax(counts[used])]] += room - freq.sum()
        return Model(freq)

    @property
    def symbols(self) -> np.ndarray:
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbols


def encode_ids(ids: np.ndarray, model: Model, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, and per checkpoint the place in the words and the lanes' states. The first checkpoint is the start."""
    steps = -(-len(ids) // lanes)
    x = np.full(lanes, FLOOR, np.uint64)
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    states: dict[int, np.ndarray] = {}
    shift, most = U(PRECISION), U(31 - PRECISION + 32)
    for step in range(steps - 1, -1, -1):
        now = ids[step * lanes : (step + 1) * lanes]
        y, f, c = x[: len(now)], model.freq[now], model.start[now]
        full = y >= (f << most)
        words[step] = y[full].astype(np.uint32)
        y = np.where(full, y >> U(32), y)
        q = y // f
        x[: len(now)] = (q << shift) + (y - q * f) + c
        if step % every == 0:
            states[step] = x.copy()
    ends = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.uint64)
    places = np.array([ends[s] for s in sorted(states)], np.uint64)
    kept = np.array([states[s] for s in sorted(states)], np.uint64).reshape(-1, lanes)
    return np.concatenate(words) if words else np.empty(0, np.uint32), places, kept


def decode_steps(n: int, lanes: int, first: int, last: int, words: np.ndarray, place: int, state: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The ids of steps ``first`` to ``last`` of a block of ``n`` ids, from a checkpoint; and the states after them."""
    x, out, mask = state.copy(), [], U((1 << PRECISION) - 1)
    for step in range(first, last):
        y = x[: min(lanes, n - step * lanes)]
        slot = y & mask
        symbol = model.symbols[slot]
        y = model.freq[symbol] * (y >> U(PRECISION)) + slot - model.start[symbol]
        low = y < FLOOR
        need = int(np.count_nonzero(low))
        y[low] = (y[low] << U(32)) | words[place : place + need]
        place += need
        x[: len(y)] = y
        out.append(symbol)
    return np.concatenate(out) if out else np.empty(0, np.uint32), x


def pack_block(docs: list[tuple[int | None, np.ndarray]], model: Model) -> bytes:
    ids = np.concatenate([d[1] for d in docs]).astype("<u4")
    words, places, states = encode_ids(ids, model)
    rest = b"".join(
        [
            np.array([0 if d[0] is None else d[0] for d in docs], "<i8").tobytes(),
            np.array([d[0] is None for d in docs], np.uint8).tobytes(),
            np.array([len(d[1]) for d in docs], "<u8").tobytes(),
            places.astype("<u8").tobytes(),
            states.astype("<u8").tobytes(),
            words.astype("<u4").tobytes(),
        ]
    )
    head = HEAD.pack(MAGIC, len(docs), len(ids), len(words), LANES, CHECKPOINT_STEPS, len(places), zlib.crc32(ids.tobytes()), zlib.crc32(rest))
    return head + rest


class Block:
    """A block read back; its parts between checkpoints can be decoded one by one."""

    def __init__(self, data: bytes):
        magic, docs, self.n, words, self.lanes, self.every, points, self.crc, rest = HEAD.unpack_from(data)
        if magic != MAGIC or zlib.crc32(data[HEAD.size :]) != rest:
            raise ValueError("damaged block")
        at = HEAD.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        self.doc_ids, self.nulls, self.lengths = take("<i8", docs), take("u1", docs), take("<u8", docs).astype(np.int64)
        self.places, self.states = take("<u8", points), take("<u8", points * self.lanes).reshape(points, self.lanes)
        self.words = take("<u4", words).astype(np.uint64)

    def part(self, k: int, model: Model) -> np.ndarray:
        """The ids from checkpoint ``k`` to the next."""
        steps = -(-self.n // self.lanes)
        last = min(steps, (k + 1) * self.every)
        ids, after = decode_steps(self.n, self.lanes, k * self.every, last, self.words, int(self.places[k]), self.states[k], model)
        expected = self.states[k + 1] if k + 1 < len(self.places) else np.full(self.lanes, FLOOR)
        if not np.array_equal(after, expected):
            raise ValueError("damaged part of a block")
        return ids

    def ids(self, model: Model) -> np.ndarray:
        parts = [self.part(k, model) for k in range(len(self.places))]
        ids = np.concatenate(parts).astype("<u4") if parts else np.empty(0, "<u4")
        if zlib.crc32(ids.tobytes()) != self.crc:
            raise ValueError("the ids of a block do not match their checksum")
        return ids


def count_ids(tokens: DataFrame) -> Model:
    """The shared table, from the counts of all ids. What reaches the driver is one number per id of the vocabulary."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1, np.int64)
        for batch in batches:
            for data, kind in zip(batch.column("ids").to_pylist(), batch.column("dtype").to_pylist()):
                own = np.bincount(unpacked(data, kind))
                if len(own) > len(counts):
                    counts = np.concatenate([counts, np.zeros(len(own) - len(counts), np.int64)])
                counts[: len(own)] += own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], names=["id", "n"])

    found = tokens.select("ids", "dtype").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    counts[found["id"]] = found["n"]
    return Model.fit(counts)


def save_model(spark: SparkSession, model: Model, folder: str) -> None:
    """The shared table, one number per id of the vocabulary, as one row."""
    data = model.freq.astype("<u4").tobytes()
    spark.createDataFrame([(data, zlib.crc32(data))], "freq binary, crc bigint").coalesce(1).write.parquet(f"{folder}/table")


def load_model(spark: SparkSession, folder: str) -> Model:
    row = spark.read.schema("freq binary, crc bigint").parquet(f"{folder}/table").first()
    if row is None or zlib.crc32(row["freq"]) != row["crc"]:
        raise ValueError("the frequency table does not match its checksum")
    return Model(np.frombuffer(row["freq"], "<u4"))


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Write all ids under ``folder``, with the shared table and the manifest (one row per block)."""
    tokens = written(tokenized(docs, path, end_id), "tokens")
    model = count_ids(tokens)
    save_model(docs.sparkSession, model, folder)
    freq = model.freq.astype(np.uint32)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, file, name = Model(freq), None, ""
        part, rows, held, size, offset, start = TaskContext.get().partitionId(), [], [], 0, 0, 0
        for batch in batches:
            for doc_id, kind, data in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "dtype", "ids")]):
                held.append((doc_id, unpacked(data, kind)))
                size += len(held[-1][1])
                if size >= BLOCK_TOKENS:
                    if file is None:
                        name, file = create(folder, ".rans")
                    block = pack_block(held, own)
                    file.write(block)
                    rows.append((name, part, offset, len(block), start, size))
                    offset, start, held, size = offset + len(block), start + size, [], 0
        if held:
            if file is None:
                name, file = create(folder, ".rans")
            block = pack_block(held, own)
            file.write(block)
            rows.append((name, part, offset, len(block), start, size))
        if file is not None:
            file.close()
            columns = [pa.array(c, pa.string() if k == 0 else pa.int64()) for k, c in enumerate(zip(*rows))]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "part", "offset", "bytes", "start_in_file", "n_tokens"])

    spark = docs.sparkSession
    ordered = tokens.repartitionByRange(shuffle_partitions(spark), F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "n_tokens", "ids")
    saved(ordered.select("doc_id", "dtype", "ids").mapInArrow(write, MANIFEST), f"{folder}/manifest")


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document, from the folder alone: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    manifest, model = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"), load_model(spark, folder)
    # One row per file, so the ordered sum fits one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.groupBy("file", "part").agg(F.sum("n_tokens").alias("n"))
    files = files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    blocks = manifest.join(files, "file").select("file", "offset", "bytes", (F.col("base") + F.col("start_in_file")).alias("start"))
    freq = model.freq.astype(np.uint32)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(freq)
        for batch in batches:
            for name, offset, size, start in zip(*[c.to_pylist() for c in batch.columns]):
                with open_file(folder, name) as file:
                    file.seek(offset)
                    block = Block(file.read(size))
                ids, ends = block.ids(own), np.cumsum(block.lengths)
                starts = ends - block.lengths
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None if null else int(d) for d, null in zip(block.doc_ids, block.nulls)], pa.int64()),
                        pa.array(starts + start, pa.int64()),
                        pa.array(block.lengths, pa.int64()),
                        pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = blocks.repartition(shuffle_partitions(spark))
    return spread.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def token_file_report(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the token files of the documents, read them back, and digest what was read."""
    folder = scratch_dir(docs.sparkSession, "token-files")
    write_token_files(docs, folder, path or default_path())
    return read_token_files(docs.sparkSession, folder)
