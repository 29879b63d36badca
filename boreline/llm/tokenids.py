"""Token ids of a corpus in binary files, coded by Simple-8b.

A file holds ids in blocks. A block is a run of Simple-8b words and, behind
them, its escaped values; documents follow one another without regard to block
edges. The footer has where each block starts and how many ids it holds, and a
key and a length for each document, so a reader decodes any range of ids from
the blocks that it touches.

    file    = MAGIC, blocks, footer, trailer
    footer  = block starts, ids, words (int64 each); keys (int64), null marks (a byte each, to a multiple of 8), lengths (Simple-8b words, escapes)
    trailer = place of the footer, blocks, documents, words and escapes of the lengths, CRC-32 of the footer (int64 each), MAGIC

Files are written by tasks into a shared folder, each of a range of the order,
under names that no other attempt uses. What counts is the manifest that Spark
commits when the tasks are done. Ids come from the tokenizers library; what it
says of a piece of text between two single spaces is kept and used again.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreline.llm import simple8b
from boreline.llm.bpe import default_vocabulary
from boreline.llm.rows import STEP, table, text_of
from boreline.session import stored, work_path

MAGIC = b"S8BTOK01"
BLOCK_IDS = 1 << 16
#: A file is closed when it has so many ids or documents; its footer is held in memory until then.
FILE_IDS, FILE_DOCS = 1 << 25, 200_000
END_ID = 2
#: Units, or characters of units, that make a generation full, and units that are encoded by one call.
CACHED_UNITS, CACHED_CHARS, JOINED = 600_000, 16 << 20, 2_000
TRAILER = struct.Struct("<6q8s")

SPACES = re.compile(r" \s|\s ").search
#: Between two characters that are no white space, a single space always begins a pre-token.
CUTS = re.compile(r"(?<=\S) (?=\S)").split


class Units:
    """Ids of texts by the library, which is asked once for what stands between two single spaces.

    What it says is kept in a young and an old generation; when the young one
    is full, the old one is forgotten.
    """

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        spec = json.loads(content)
        pre = spec.get("pre_tokenizer") or {}
        added = {a["id"]: a["content"] for a in spec.get("added_tokens", ())}
        loose = any(a.get(k) for a in spec.get("added_tokens", ()) for k in ("single_word", "lstrip", "rstrip"))
        #: Whether a text may be cut at spaces: only for files whose pre-tokens are known to begin there.
        self.cuts = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not loose and not any(re.search(r"\s", a) for a in added.values())
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of each token: one for each character of its name in a byte-level vocabulary.
        self.sizes = np.zeros(max(names.values()) + 1, np.int64)
        for name, i in names.items():
            self.sizes[i] = len(added[i].encode()) if i in added else len(name)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.chars = 0

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as unsigned 32-bit integers."""
        if not self.cuts:
            return self._library(texts)
        firsts, others = [], []
        for text in texts:
            first, *rest = CUTS(text) if SPACES(text) else text.split(" ")
            if not first and rest:  # the text begins with a space
                first, rest = " " + rest[0], rest[1:]
            firsts.append(first)
            others.append(rest)
        self._learn(set().union(*others))
        get = self.young.__getitem__
        return [first + b"".join(map(get, rest)) for first, rest in zip(self._library(firsts), others, strict=True)]

    def _learn(self, units: set[str]) -> None:
        """Afterwards the young generation has all these units."""
        if len(self.young) >= CACHED_UNITS or self.chars >= CACHED_CHARS:
            self.old, self.young, self.chars = self.young, {}, 0
        young, old = self.young, self.old
        new = [u for u in units if u not in young]
        if old:
            young.update((u, old[u]) for u in new if u in old)
            new = [u for u in new if u not in old]
        self.chars += sum(map(len, new))
        # A unit with white space at its ends, or spaces within, would be cut elsewhere if it were joined with others.
        alone = [u for u in new if not u or " " in u or u[0].isspace() or u[-1].isspace()]
        young.update(zip(alone, self._library([" " + u for u in alone]), strict=True))
        joined = list(set(new).difference(alone)) if alone else new
        for k in range(0, len(joined), JOINED):
            self._joined(joined[k : k + JOINED])

    def _joined(self, units: list[str]) -> None:
        """Many units by one call: each begins with a space, where a pre-token begins; the bytes of the tokens tell them apart."""
        text = " " + " ".join(units)
        ids = np.frombuffer(self._library([text])[0], "<u4")
        data = np.frombuffer(text.encode(), np.uint8)
        ends = np.append(np.flatnonzero(data == 32)[1:], len(data))
        reached = np.cumsum(self.sizes[ids])
        cuts = np.searchsorted(reached, ends) + 1
        if len(ends) != len(units) or cuts[-1] != len(ids) or (reached[cuts - 1] != ends).any():
            raise ValueError("the vocabulary's tokens do not cover their texts byte by byte")
        packed, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
        self.young.update(zip(units, [packed[a:b] for a, b in zip(cuts, cuts[1:])], strict=True))


@lru_cache(maxsize=1)
def units_of(content: str) -> Units:
    """One per Python worker, which serves many tasks."""
    return Units(content)


def _system(path: str) -> tuple:
    return pyarrow.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


class Writer:
    """One file of ids, written to a stream that cannot go back."""

    def __init__(self, path: str):
        self.path = path
        system, place = _system(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.stream = system.open_output_stream(place)
        self.stream.write(MAGIC)
        self.at, self.total, self.held, self.parts = len(MAGIC), 0, 0, []
        self.blocks: list[tuple[int, int, int]] = []
        self.keys: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, key: int | None, ids: bytes) -> None:
        """A document's ids as unsigned 32-bit integers."""
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.parts.append(ids)
        self.held += len(ids) // 4
        self.total += len(ids) // 4
        if self.held >= BLOCK_IDS:
            self._flush(BLOCK_IDS)

    def _flush(self, least: int) -> None:
        waiting = np.frombuffer(b"".join(self.parts), "<u4")
        start = 0
        while len(waiting) - start >= max(1, least):
            self._block(waiting[start : start + BLOCK_IDS])
            start += BLOCK_IDS
        rest = waiting[start:]
        self.parts, self.held = [rest.tobytes()], len(rest)

    def _block(self, ids: np.ndarray) -> None:
        words, escapes = simple8b.encode(ids)
        self.blocks.append((self.at, len(ids), len(words)))
        self._put(words, escapes)

    def _put(self, *columns: np.ndarray) -> None:
        for column in columns:
            data = column.astype(column.dtype.newbyteorder("<")).tobytes()
            self.stream.write(data)
            self.at += len(data)

    def full(self) -> bool:
        return self.total >= FILE_IDS or len(self.keys) >= FILE_DOCS

    def close(self) -> tuple[str, int, int]:
        """Path, documents and ids."""
        self._flush(0)
        marks = np.array([k is None for k in self.keys] + [False] * (-len(self.keys) % 8), np.uint8)
        words, escapes = simple8b.encode(np.array(self.lengths, np.uint64))
        table = np.array(self.blocks, np.int64).reshape(-1, 3).T
        keys = np.array([k or 0 for k in self.keys], np.int64)
        footer = b"".join(np.ascontiguousarray(c).tobytes() for c in (*table, keys, marks, words, escapes))
        self.stream.write(footer)
        self.stream.write(TRAILER.pack(self.at, len(self.blocks), len(self.keys), len(words), len(escapes), zlib.crc32(footer), MAGIC))
        self.stream.close()
        return self.path, len(self.keys), self.total


class Reader:
    """Ids of a file by range, each block decoded at once."""

    def __init__(self, path: str):
        system, place = _system(path)
        self.file = system.open_input_file(place)
        size = self.file.size()
        if size < len(MAGIC) + TRAILER.size or self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        self.end, blocks, docs, words, escapes, check, mark = TRAILER.unpack(self._at(size - TRAILER.size, TRAILER.size))
        footer = self._at(self.end, size - TRAILER.size - self.end)
        if mark != MAGIC or zlib.crc32(footer) != check:
            raise ValueError(f"the footer of {path} is damaged")
        at = 0

        def take(count: int, kind: str) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(footer, kind, count, at)
            at += out.nbytes
            return out

        self.starts, self.counts, self.words = (take(blocks, "<i8") for _ in range(3))
        self.keys, marks = take(docs, "<i8"), take(docs + -docs % 8, "u1")[:docs]
        self.nulls = marks.astype(bool)
        self.lengths = simple8b.decode(take(words, "<u8"), take(escapes, "<u8"), docs).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(self.counts)))

    def _at(self, offset: int, size: int) -> bytes:
        data = self.file.read_at(size, offset)
        if len(data) != size:
            raise ValueError(f"file ends before {offset + size}")
        return data

    def block(self, k: int) -> np.ndarray:
        after = int(self.starts[k + 1]) if k + 1 < len(self.starts) else self.end
        data = np.frombuffer(self._at(int(self.starts[k]), after - int(self.starts[k])), "<u8")
        return simple8b.decode(data[: self.words[k]], data[self.words[k] :], int(self.counts[k]))

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop``, counted from the file's first."""
        if not 0 <= start <= stop <= self.before[-1]:
            raise IndexError(f"{start} to {stop} of {self.before[-1]}")
        first, last = np.searchsorted(self.before, [start, stop], "right") - 1
        parts = [self.block(k) for k in range(first, min(last + 1, len(self.counts)))] if stop > start else []
        whole = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        skip = start - int(self.before[first])
        return whole[skip : skip + stop - start]

    def documents(self) -> Iterator[tuple[int | None, int, int, Iterator[np.ndarray]]]:
        """Key, start, length and the parts of the ids (one for each block touched) of the documents in order."""
        k, held, at, start = -1, np.empty(0, np.uint32), 0, 0
        for key, null, n in zip(self.keys.tolist(), self.nulls.tolist(), self.lengths.tolist(), strict=True):

            def parts(n=n):
                nonlocal k, held, at
                while n:
                    if at == len(held):
                        k, at = k + 1, 0
                        held = self.block(k).astype("<u4")
                    part = held[at : at + n]
                    at += len(part)
                    n -= len(part)
                    yield part

            yield None if null else key, start, n, parts()
            start += n

    def close(self) -> None:
        self.file.close()


def write_ids(df: DataFrame, vocabulary_path: str, folder: str, key: str = "doc_id", text: str = "text", end_id: int | None = END_ID) -> DataFrame:
    """Encode every text and write the ids in ascending order of the keys; returns the manifest.

    The manifest has a row per file: ``path``, ``part`` and ``seq`` (their
    order), ``docs``, ``ids``. ``end_id`` is added to each document. Null and
    empty texts have that id only, rows without a key come first, and rows of
    one key come in an order of their own, each of them whole. Other columns
    are ignored; an empty table gives no file. The key is an integer. Rows are
    dealt by ranges of (key, digest of the text, row), so no key, however many
    rows it has, has to fit one task.
    """
    spark = df.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        content = spark.sparkContext.broadcast(file.read())
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("bigint").alias("key"), text_of(text).alias("text"))
    order = ["key", "digest", "row"]
    rows = rows.select("*", F.xxhash64("text").alias("digest"), F.monotonically_increasing_id().alias("row"))
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("key", "text")
    end = b"" if end_id is None else struct.pack("<I", end_id)

    def run(batches):
        from pyspark import TaskContext

        task, units, writer, done = TaskContext.get(), units_of(content.value), None, []
        name = f"{folder}/part-{task.partitionId():05d}-{task.taskAttemptId()}"
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                for doc, ids in zip(part.column(0).to_pylist(), units.of(part.column(1).to_pylist()), strict=True):
                    if writer is None:
                        writer = Writer(f"{name}-{len(done):03d}-{uuid.uuid4().hex[:8]}.s8b")
                    writer.add(doc, ids + end)
                    if writer.full():
                        done.append(writer.close())
                        writer = None
        if writer is not None:
            done.append(writer.close())
        if done:
            columns = [*zip(*done, strict=True)]
            at = [pa.array([task.partitionId()] * len(done), pa.int32()), pa.array(range(len(done)), pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0]), *at, *(pa.array(c, pa.int64()) for c in columns[1:])], names=["path", "part", "seq", "docs", "ids"])

    return stored(rows.mapInArrow(run, "path string, part int, seq int, docs bigint, ids bigint"), "token-files")


def read_ids(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """``key``, ``start``, ``n_tokens``, ``ids_crc32``, and ``ids`` if asked for, of every document in the files.

    ``start`` counts the ids of all documents before it. A file is read by one
    task, block by block.
    """
    parts = manifest.groupBy("part").agg(F.sum("ids").alias("n"))
    # One row for each task that wrote files.
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("ids").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = manifest.withColumn("inside", inside).join(parts, "part").select("path", (F.col("base") + F.col("inside")).alias("base"))
    schema = "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64())] * with_ids
    names = ["key", "start", "n_tokens", "ids_crc32", "ids"][: len(kinds)]

    def run(batches):
        def packed(out):
            made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
            out.clear()
            return made

        for batch in batches:
            out: list[tuple] = []
            for path, base in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader = Reader(path)
                for doc, start, n, pieces in reader.documents():
                    crc, kept = 0, []
                    for piece in pieces:
                        crc = zlib.crc32(piece.tobytes(), crc)
                        if with_ids:
                            kept.extend(piece.tolist())
                    out.append((doc, base + start, n, crc) + (kept,) * with_ids)
                    if len(out) >= (100 if with_ids else 4000):
                        yield packed(out)
                reader.close()
            if out:
                yield packed(out)

    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(run, schema)


def op11_tokenids(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_ids(table(spark, sf_dir, "documents"), default_vocabulary(), work_path(spark, "token-ids"))
    return read_ids(manifest).withColumnRenamed("key", "doc_id")
