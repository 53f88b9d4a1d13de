"""Token ids in files of patched frame-of-reference blocks.

A file is a table of documents in ascending id order; a document's ids are cut into blocks of BLOCK. A block holds
the smallest id, a width chosen by a percentile of the differences to it, the differences packed at that width, and
a list of exceptions: places and values of the differences that need more bits. The starts of the blocks stand in an
index beside the payload, so any block can be read alone.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import PieceIds, cutter
from .textops import process_cache, sized, stored

BLOCK = 4096
PERCENTILE = 95
ROWS = 128
#: Ids in a block, its minimum, the width, and the number of exceptions.
_HEAD = "<IIBH"


def pack_block(values: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """One block: count, minimum, width and number of exceptions, then packed low bits, places and high values."""
    low = int(values.min())
    above = values.astype(np.int64) - low
    rank = (len(above) - 1) * percentile // 100
    width = int(np.partition(above, rank)[rank]).bit_length()
    places = np.flatnonzero(above >> width)
    bits = ((above[:, None] >> np.arange(width)) & 1).astype(np.uint8)
    packed = np.packbits(bits.ravel(), bitorder="little").tobytes()
    head = struct.pack(_HEAD, len(values), low, width, len(places))
    return head + packed + places.astype("<u2").tobytes() + (above[places] >> width).astype("<u4").tobytes()


def unpack_block(data: bytes) -> np.ndarray:
    n, low, width, patches = struct.unpack_from(_HEAD, data)
    size = (n * width + 7) // 8
    at = struct.calcsize(_HEAD)
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    above = np.zeros(n, np.int64)
    for k in range(width):
        above |= bits[:, k].astype(np.int64) << k
    places = np.frombuffer(data, "<u2", patches, at + size).astype(np.int64)
    above[places] |= np.frombuffer(data, "<u4", patches, at + size + 2 * patches).astype(np.int64) << width
    return (above + low).astype(np.uint32)


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[list[int], bytes]:
    """Starts of the blocks in the payload, and the payload."""
    blocks = [pack_block(ids[k : k + block]) for k in range(0, len(ids), block)]
    starts = np.cumsum([0] + [len(b) for b in blocks])[:-1]
    return starts.tolist(), b"".join(blocks)


def unpack(starts: list[int], payload: bytes) -> np.ndarray:
    ends = [*starts[1:], len(payload)]
    return np.concatenate([np.empty(0, np.uint32), *[unpack_block(payload[a:b]) for a, b in zip(starts, ends, strict=True)]])


class FileTokenizer:
    """The tokenizers library over a tokenizer file; each distinct piece of a task is encoded once where the file cuts
    texts by the byte-level pattern alone, other files encode whole texts.

    With match_added the ids are those of the library's defaults: texts that hold an added token's content go to the
    library whole. Without, special tokens in a text are text.
    """

    def __init__(self, file: str, match_added: bool = False):
        self.whole = Tokenizer.from_str(file)
        self.whole.encode_special_tokens = not match_added
        made = json.loads(file)
        added = [t["content"] for t in made.get("added_tokens") or [] if match_added]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        cut = made.get("pre_tokenizer") or {}
        self.by_piece = (
            made.get("normalizer") is None
            and cut.get("type") == "ByteLevel"
            and cut.get("use_regex", True)
            and not cut.get("add_prefix_space", True)
        )
        self.ids_of, self.pieces = PieceIds(self.whole.model), cutter(public_tokenizers.PATTERN)

    def encode(self, text: str) -> np.ndarray:
        if not self.by_piece or (self.added and self.added.search(text)):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.frombuffer(b"".join(map(self.ids_of.__getitem__, self.pieces(text))), np.uint32)


def _tokenizer(file: str, match_added: bool) -> FileTokenizer:
    kept = process_cache("tokenizer-files")
    if (file, match_added) not in kept:
        kept[file, match_added] = FileTokenizer(file, match_added)
    return kept[file, match_added]


def _packed(file: str, end: int, match_added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, context, before = _tokenizer(file, match_added), TaskContext.get(), 0
        part = context.partitionId() if context else 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                ids = [np.append(tokenizer.encode(t or ""), np.uint32(end)) for t in rows.column("text").to_pylist()]
                counts = np.array([len(i) for i in ids], np.int64)
                starts = before + np.cumsum(counts) - counts
                before += int(counts.sum())
                packed = [pack(i) for i in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part] * len(ids), pa.int64()),
                        rows.column("id"),
                        pa.array(starts),
                        pa.array(counts),
                        pa.array([s for s, _ in packed], pa.list_(pa.int64())),
                        pa.array([p for _, p in packed], pa.binary()),
                    ],
                    ["part", "id", "start", "n", "blocks", "payload"],
                )

    return run


def _unpacked(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                pairs = zip(rows.column("blocks").to_pylist(), rows.column("payload").to_pylist(), strict=True)
                ids = [unpack(b, p) for b, p in pairs]
                if digests:
                    value = pa.array([zlib.crc32(i.astype("<u4").tobytes()) for i in ids], pa.int64())
                else:
                    value = pa.array([i.tolist() for i in ids], pa.list_(pa.int64()))
                n = pa.array([len(i) for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(c) for c in ("part", "id", "start")], n, value], ["part", "id", "start", "n", "value"]
                )

    return run


def write_token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end: int = 0, match_added: bool = False) -> DataFrame:
    """Files of every row's ids and the end id, in ascending order of id (nulls first, ties by text), read back.

    Texts are dealt by ranges of ids, so that each task writes one file of documents in order. Null and empty texts
    hold the end id alone; an empty table gives no rows. Without a path the files go to the shared folder. match_added
    gives the added tokens' own ids to their contents in a text, as the library does by default.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        made = file.read()
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    dealt = rows.repartitionByRange("id").sortWithinPartitions("id", "text")
    schema = f"part long, id {kind}, start long, n long, blocks array<long>, payload binary"
    packed = dealt.mapInArrow(_packed(made, end, match_added), schema)
    if path is None:
        return stored(packed, "token-files")
    packed.write.parquet(path)
    return docs.sparkSession.read.schema(packed.schema).parquet(path)


def read_token_files(files: DataFrame, id_col: str = "doc_id", digests: bool = False) -> DataFrame:
    """(id, start, n_tokens, ids or ids_crc32) of every document; start counts the ids of all documents before it."""
    kind = files.schema["id"].dataType.simpleString()
    value = "long" if digests else "array<long>"
    read = files.mapInArrow(_unpacked(digests), f"part long, id {kind}, start long, n long, value {value}")
    totals = files.groupBy("part").agg(F.sum("n").alias("total"))
    # One row for each file: a running sum over so few rows needs no more than one task.
    base = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("base"))
    placed = read.join(sized(stored(base, "parts"), 100_000), "part")
    return placed.select(
        F.col("id").alias(id_col),
        (F.col("base") + F.col("start")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("value").alias("ids_crc32" if digests else "ids"),
    )
