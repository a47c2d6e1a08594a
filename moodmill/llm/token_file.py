"""Token ids of a table in binary files: written in key order, read back and checked.

A file is a row of records, each followed by one line end. A record holds whole documents:

    "TIDS", version u32, bytes after this field u32, crc32 of the rest u32,
    documents u32, blocks u32,
    per document: key i64, key is null u8, ids u32,
    per block: ids u32, bytes u32, crc32 of the ids (as 32-bit) u32,
    the blocks' range-coded bytes (see ``range_coder``)

All numbers are little-endian. A block has at most ``BLOCK`` ids and starts from empty tables. Spark
writes the records as lines of raw bytes, so the files reach any store that Spark reaches, and the
part numbers of the files follow the key ranges.

Defined results: a null text is an empty one and holds the end id only; repeated keys keep all their
rows, ordered by a hash of the text; null keys come first; a very long text is one document of one record; an
empty table gives no records; other columns, whatever their names, are not read. Ids must be below 65,536. A damaged record or block raises an error that names the file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from moodmill.llm import range_coder
from moodmill.llm.token_ids import encoder
from moodmill.storage import materialise, new_path

END_ID = 0
#: Ids of a block.
BLOCK = 2048
#: Ids from which on a record is closed, and records of a file at most; they bound a file's size.
RECORD_IDS = 1 << 18
FILE_RECORDS = 32
#: Ids that a task gathers before it codes them side by side.
GATHER_IDS = 1 << 23
VERSION = 2

_HEAD = struct.Struct("<4sIII")
_COUNTS = struct.Struct("<II")
_DOC = np.dtype([("key", "<i8"), ("null", "u1"), ("ids", "<u4")])
_BLOCK = np.dtype([("ids", "<u4"), ("bytes", "<u4"), ("crc", "<u4")])


def _records(keys: list[int | None], docs: list[bytes]) -> Iterator[bytes]:
    """Records of documents given as little-endian 32-bit ids; all their blocks are coded together."""
    groups: list[tuple[int, int]] = []
    begin = held = 0
    for i, ids in enumerate(docs):
        held += len(ids) // 4
        if held >= RECORD_IDS or i + 1 == len(docs):
            groups.append((begin, i + 1))
            begin, held = i + 1, 0
    blocks: list[np.ndarray] = []
    owners: list[range] = []
    for first, last in groups:
        ids = np.frombuffer(b"".join(docs[first:last]), dtype="<u4")
        if len(ids) and int(ids.max()) > 0xFFFF:
            raise ValueError("token ids of 65,536 and more do not fit this format")
        cut = [ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]
        owners.append(range(len(blocks), len(blocks) + len(cut)))
        blocks.extend(cut)
    coded = range_coder.encode([b.astype(np.uint16) for b in blocks])
    for (first, last), own in zip(groups, owners, strict=True):
        table = np.zeros(last - first, dtype=_DOC)
        table["key"] = [0 if k is None else k for k in keys[first:last]]
        table["null"] = [k is None for k in keys[first:last]]
        table["ids"] = [len(d) // 4 for d in docs[first:last]]
        index = np.zeros(len(own), dtype=_BLOCK)
        index["ids"] = [len(blocks[b]) for b in own]
        index["bytes"] = [len(coded[b]) for b in own]
        index["crc"] = [zlib.crc32(blocks[b].tobytes()) for b in own]
        body = _COUNTS.pack(last - first, len(own)) + table.tobytes() + index.tobytes()
        body += b"".join(coded[b] for b in own)
        yield _HEAD.pack(b"TIDS", VERSION, len(body) + 4, zlib.crc32(body)) + body


def write(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    keeps_space: bool = True,
) -> None:
    """Encode every text and write the files in ascending key order."""
    narrow = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    # Texts are spread and sorted before they are encoded, so that the range sample stays cheap.
    placed = (
        narrow.withColumn("h", F.xxhash64("t")).repartitionByRange("k", "h").sortWithinPartitions("k", "h")
    )
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, keeps_space)
        keys: list[int | None] = []
        ids: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for record in _records(keys, ids):
                yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

        for batch in batches:
            encoded = encode(batch.column(1))
            for k, own in zip(batch.column(0).to_pylist(), encoded, strict=True):
                keys.append(k)
                ids.append(own + end)
                held += len(ids[-1]) // 4
                if held >= GATHER_IDS:
                    yield from flush()
                    keys, ids, held = [], [], 0
        if keys:
            yield from flush()

    records = placed.select("k", "t").mapInArrow(run, "record binary")
    lines = records.select(F.col("record").cast("string").alias("value"))
    lines.write.option("maxRecordsPerFile", FILE_RECORDS).option("compression", "none").text(path)


def _parse(content: bytes, name: str) -> list[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """``(documents, blocks, payloads)`` of every record of a file."""
    out, at = [], 0
    while at < len(content):
        magic, version, size, check = _HEAD.unpack_from(content, at)
        at += _HEAD.size
        body = content[at : at + size - 4]
        if magic != b"TIDS" or version != VERSION or zlib.crc32(body) != check:
            raise ValueError(f"damaged record in {name}")
        n_docs, n_blocks = _COUNTS.unpack_from(body)
        docs = np.frombuffer(body, _DOC, n_docs, _COUNTS.size)
        place = _COUNTS.size + docs.nbytes
        index = np.frombuffer(body, _BLOCK, n_blocks, place)
        place += index.nbytes
        ends = place + np.cumsum(index["bytes"].astype(np.int64))
        payloads = [
            body[int(e) - int(b) : int(e)] for e, b in zip(ends, index["bytes"].tolist(), strict=True)
        ]
        out.append((docs, index, payloads))
        at += size - 4 + 1
    return out


def _decoded(content: bytes, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The document table of a file and all its ids."""
    records = _parse(content, name)
    payloads = [p for _, _, own in records for p in own]
    index = np.concatenate([i for _, i, _ in records]) if records else np.zeros(0, _BLOCK)
    blocks = range_coder.decode(payloads, index["ids"].tolist())
    ids = [b.astype("<u4") for b in blocks]
    for block, crc in zip(ids, index["crc"].tolist(), strict=True):
        if zlib.crc32(block.tobytes()) != crc:
            raise ValueError(f"damaged block in {name}")
    docs = np.concatenate([d for d, _, _ in records]) if records else np.zeros(0, _DOC)
    return docs, np.concatenate(ids) if ids else np.zeros(0, "<u4")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, in file order: ``part``, ``chunk``, ``key``, ``at`` (ids before it in the file),
    ``n_tokens``, ``crc``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    numbered = files.select(
        F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("part"),
        F.coalesce(F.try_to_number(F.regexp_extract(name, r"-c(\d+)", 1), F.lit("999999999999")), F.lit(0))
        .cast("long")
        .alias("chunk"),
        "path",
        "content",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk, where, content in zip(*(batch.column(i) for i in range(4)), strict=True):
                docs, ids = _decoded(content.as_py(), where.as_py())
                size = docs["ids"].astype(np.int64)
                stop = np.cumsum(size)
                raw = memoryview(ids.tobytes())
                crc = [
                    zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(stop.tolist(), size.tolist(), strict=True)
                ]
                n = len(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part.as_py()] * n, pa.int64()),
                        pa.array([chunk.as_py()] * n, pa.int64()),
                        pa.array(docs["key"].astype(np.int64), pa.int64(), mask=docs["null"].astype(bool)),
                        pa.array(stop - size, pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["part", "chunk", "key", "at", "n_tokens", "crc"],
                )

    return numbered.mapInArrow(
        run, "part bigint, chunk bigint, key bigint, at bigint, n_tokens bigint, crc bigint"
    )


def digest(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", path: str | None = None
) -> DataFrame:
    """Write the files, read them back, and give each document's place, count and checksum."""
    spark = docs.sparkSession
    path = path or new_path(spark, "token-ids")
    write(docs, path, tokenizer, key, text)
    found = materialise(read(spark, path), "token-docs")
    files = found.groupBy("part", "chunk").agg(F.sum("n_tokens").alias("ids"))
    parts = files.groupBy("part").agg(F.sum("ids").alias("ids"))

    def before(*keys: str) -> WindowSpec:
        window = Window.partitionBy("part") if keys == ("chunk",) else Window.partitionBy()
        return window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)

    def running(*keys: str) -> Column:
        return F.coalesce(F.sum("ids").over(before(*keys)), F.lit(0))

    bases = files.select("part", "chunk", running("chunk").alias("in_part")).join(
        parts.select("part", running("part").alias("of_part")), "part"
    )
    return found.join(bases, ["part", "chunk"]).select(
        F.col("key").alias(key),
        (F.col("of_part") + F.col("in_part") + F.col("at")).alias("start"),
        "n_tokens",
        F.col("crc").alias("ids_crc32"),
    )
