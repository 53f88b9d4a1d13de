"""Byte-level BPE from a file of ranks: encoding with the tokenizers library over Arrow batches, and decoding.

The model of the library works on characters, so every byte stands for one printable character. A token's ways to be
split into two tokens are all merges, ordered by the token's rank; whole pieces that are tokens need no merges. A
text is cut by the pattern, and each distinct piece of a task is encoded once.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import models

from .textops import process_cache

#: Rows encoded together, and distinct pieces that a worker process keeps; neither changes a result.
ROWS = 128
KEPT_PIECES = 600_000


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is printable, else one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b if b in printable else next(others)) for b in range(256)}


def _members(of: str) -> str:
    """The characters of a class below U+10000, as ranges for the standard library's regular expressions."""
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000)
    runs = (m.group() for m in regex.finditer(f"{of}+", every))
    return "".join(f"\\u{ord(r[0]):04x}-\\u{ord(r[-1]):04x}" for r in runs)


def cutter(pattern: str) -> Callable[[str], list[str]]:
    """Cuts a text into its matches of the pattern. The public pattern has a twin with its classes spelt out, which
    is faster and serves every text without characters from U+10000 on."""
    plain = regex.compile(pattern).findall
    if pattern != public_tokenizers.PATTERN:
        return plain
    letters, numbers, space = _members(r"\p{L}"), _members(r"\p{N}"), _members(r"\s")
    twin = re.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"
    ).findall
    beyond = re.compile("[\U00010000-\U0010ffff]").search
    return lambda text: plain(text) if beyond(text) else twin(text)


class PieceIds(dict):
    """From a piece to its ids, as the bytes of 32-bit numbers; a piece is encoded when it is first asked for."""

    def __init__(self, model: models.Model):
        super().__init__()
        self.model, self.translation = model, byte_characters()

    def __missing__(self, piece: str) -> bytes:
        if piece.isascii() and piece.isprintable():
            named = piece.replace(" ", self.translation[0x20])
        else:
            named = piece.encode().decode("latin-1").translate(self.translation)
        ids = array("I", [t.id for t in self.model.tokenize(named)]).tobytes()
        if len(self) < KEPT_PIECES:
            self[piece] = ids
        return ids


class ByteBpe:
    """Encoder and decoder for one rank file, given as its bytes."""

    def __init__(self, rank_file: bytes, pattern: str = public_tokenizers.PATTERN):
        pairs = (line.split() for line in rank_file.splitlines() if line.strip())
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        to_char = byte_characters()
        named = {token: token.decode("latin-1").translate(to_char) for token in ranks}
        merges = [
            (named[token[:cut]], named[token[cut:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        vocab = {named[token]: rank for token, rank in ranks.items()}
        self.ids_of = PieceIds(models.BPE(vocab=vocab, merges=merges, ignore_merges=True))
        self.pieces = cutter(pattern)
        # Decoding: the byte table turned round, from characters back to bytes.
        to_byte = {c: b for b, c in to_char.items()}
        self.bytes_of = {rank: bytes(to_byte[c] for c in name) for name, rank in vocab.items()}
        self.lengths = np.zeros(max(self.bytes_of) + 1, np.int64)
        for rank, data in self.bytes_of.items():
            self.lengths[rank] = len(data)

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(b"".join(map(self.ids_of.__getitem__, self.pieces(text))), np.uint32)

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids; a character of which only some bytes are there becomes U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, ids: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """For each token the number of the character it starts in, and whether it starts inside that character."""
        lengths = self.lengths[ids]
        inside = (np.frombuffer(data, np.uint8) & 0xC0) == 0x80
        starts = np.cumsum(lengths) - lengths
        characters = np.cumsum(~inside) - 1
        return characters[starts], inside[starts]


def _coder(rank_file: bytes, pattern: str) -> ByteBpe:
    kept, key = process_cache("byte-bpe"), (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in kept:
        kept[key] = ByteBpe(rank_file, pattern)
    return kept[key]


def _encoded(rank_file: bytes, pattern: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _coder(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = [bpe.encode(t) for t in texts]
                data = [t.encode() for t in texts]
                placed = [bpe.offsets(i, d) for i, d in zip(ids, data, strict=True)]
                split = pa.array([int(s.sum()) for _, s in placed], pa.int64())
                if digests:
                    columns = {
                        "n_tokens": pa.array([len(i) for i in ids], pa.int64()),
                        "n_split": split,
                        "ids_sha256": pa.array([hashlib.sha256(i.astype("<u4").tobytes()).hexdigest() for i in ids]),
                        "decoded_sha256": pa.array([hashlib.sha256(bpe.decode_bytes(i.tolist())).hexdigest() for i in ids]),
                    }
                else:
                    columns = {
                        "ids": pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                        "starts": pa.array([c.tolist() for c, _ in placed], pa.list_(pa.int32())),
                        "n_split": split,
                    }
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns.values()], ["id", *columns])

    return run


def _decoded(rank_file: bytes, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _coder(rank_file, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = [bpe.decode(i or []) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    return run


def _ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, ids, starts, n_split) of every row: the token ids, the character each starts in, and how many start inside
    a character. Null and empty texts have no tokens; ids may be null or repeat, each row stands for itself."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"id {kind}, ids array<int>, starts array<int>, n_split long"
    return rows.mapInArrow(_encoded(_ranks(path), pattern, False), schema).withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, text) of rows of token ids; null stands for no tokens, bytes that are no whole character for U+FFFD."""
    kind = tokens.schema[id_col].dataType.simpleString()
    rows = tokens.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decoded(_ranks(path), pattern), f"id {kind}, text string").withColumnRenamed("id", id_col)


def token_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """(id, n_tokens, n_split, ids_sha256, decoded_sha256) of every row: encoded, decoded again, and both digested."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = f"id {kind}, n_tokens long, n_split long, ids_sha256 string, decoded_sha256 string"
    return rows.mapInArrow(_encoded(_ranks(path), pattern, True), schema).withColumnRenamed("id", id_col)
