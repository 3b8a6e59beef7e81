"""Token ids packed into fixed-length rows by best-fit decreasing.

Texts are encoded with the vocabulary file of a public byte-level BPE
tokenizer.  A document longer than a row is split into row-length chunks and a
rest: no token is dropped.  Chunks are sorted by decreasing length, and each
goes into the open row with the least room that still holds it; a segment tree
over the possible capacities finds that row in O(log length).

Packing is done in blocks of at most ``block_tokens`` tokens (16 MB of ids or
so) of one input partition: no shuffle, bounded memory, and a lost task is
simply run again with the same result.  Each packed row carries its id row
(little-endian, padded), the cumulative segment lengths and where positions
start again from 0.

Defined cases: a NULL or empty text has no tokens and no segment; equal rows are
packed each for itself (``doc_row`` tells them apart); an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import process_wide

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: the pre-tokenizer pattern that belongs to the byte-level BPE vocabularies (a fixed value)
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ROW_TOKENS = 2048
BLOCK_TOKENS = 4_000_000
#: entries of a worker's word cache; it is emptied beyond that
CACHE = 500_000


class Encoder:
    """Text to little-endian 16-bit ids (32-bit for a vocabulary that needs them)."""

    def __init__(self, vocabulary: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.size = max(ranks.values()) + 1
        self.dtype = np.dtype("<u2" if self.size < 1 << 16 else "<u4")
        self.bpe = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.words: dict[str, bytes] = {}

    def _plain(self, text: str) -> bytes:
        return np.array(self.bpe.encode_ordinary(text), self.dtype).tobytes()

    def _word(self, word: str) -> bytes:
        ids = self._plain(" " + word)
        if "\n" not in word:
            if len(self.words) >= CACHE:
                self.words.clear()
            self.words[word] = ids
        return ids

    def encode(self, text: str | None) -> np.ndarray:
        """The same ids as ``encode_ordinary``.

        In the pattern a single blank always opens the token of the word after
        it, so a text without two blanks in a row can be encoded (and
        remembered) word by word.
        """
        if not text:
            return np.empty(0, self.dtype)
        if "  " in text or text[-1] == " " or " " in text:
            return np.frombuffer(self._plain(text), self.dtype)
        first, *rest = text.split(" ")
        known, parts = self.words.get, [self._plain(first)]
        parts += [known(w) or self._word(w) for w in rest]
        return np.frombuffer(b"".join(parts), self.dtype)


class RoomTree:
    """Open rows by room left; finds the least room that is enough."""

    def __init__(self, length: int):
        self.leaves = 1 << max(1, length).bit_length()
        self.open = [0] * (2 * self.leaves)  # rows below each node
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, row: int, room: int) -> None:
        self.rows[room].append(row)
        node = self.leaves + room
        while node:
            self.open[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(row, room)`` with the least room of at least ``need``."""
        node = self.leaves + need
        if not self.open[node]:
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.open[node] -= 1
            node >>= 1
        return self.rows[room].pop(), room


def best_fit_decreasing(lengths: list[int], row_tokens: int) -> list[list[int]]:
    """Indices of ``lengths`` (each from 1 to ``row_tokens``) by row."""
    tree, rows = RoomTree(row_tokens), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = tree.take(lengths[i])
        if found is None:
            found = len(rows), row_tokens
            rows.append([])
        row, room = found
        rows[row].append(i)
        if room > lengths[i]:
            tree.add(row, room - lengths[i])
    return rows


SCHEMA = ("part int, block int, pack int, n_tokens int, ids binary, cu_seqlens array<int>, resets array<int>, "
          "doc_ids array<bigint>, doc_rows array<bigint>, chunk_starts array<bigint>")


def _packed(chunks: list[tuple], row_tokens: int, dtype: np.dtype, pad: int, place: tuple[int, int]) -> pa.RecordBatch:
    out = {name: [] for name in ("part", "block", "pack", "n_tokens", "ids", "cu_seqlens", "resets", "doc_ids",
                                 "doc_rows", "chunk_starts")}
    for pack, row in enumerate(best_fit_decreasing([len(c[0]) for c in chunks], row_tokens)):
        ids = np.full(row_tokens, pad, dtype)
        ends = np.cumsum([0] + [len(chunks[i][0]) for i in row])
        for a, i in zip(ends, row):
            ids[a:a + len(chunks[i][0])] = chunks[i][0]
        for name, value in zip(out, (*place, pack, int(ends[-1]), ids.tobytes(), ends.tolist(), ends[:-1].tolist(),
                                     [chunks[i][1] for i in row], [chunks[i][2] for i in row],
                                     [chunks[i][3] for i in row])):
            out[name].append(value)
    kinds = [pa.int32()] * 4 + [pa.binary()] + [pa.list_(pa.int32())] * 2 + [pa.list_(pa.int64())] * 3
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                   row_tokens: int = ROW_TOKENS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Packed rows of all documents.

    ``ids``: ``row_tokens`` ids, padded with the first id after the vocabulary;
    ``cu_seqlens``: cumulative segment lengths from 0 to ``n_tokens``; positions
    start again at ``resets``; segment i is document ``doc_ids[i]`` (row
    ``doc_rows[i]`` of the partition) from its token ``chunk_starts[i]`` on.
    """
    with open(vocabulary, "rb") as f:  # under a megabyte; executors get its bytes
        content = f.read()
    shared, name = docs.sparkSession.sparkContext.broadcast(content), hashlib.md5(content).hexdigest()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_wide(f"encoder {name}", lambda: Encoder(shared.value))
        part = TaskContext.get().partitionId()
        chunks, tokens, block, row = [], 0, 0, 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encoder.encode(text.as_py())
                for start in range(0, len(ids), row_tokens):
                    piece = ids[start:start + row_tokens]
                    if tokens + len(piece) > block_tokens and chunks:
                        yield _packed(chunks, row_tokens, encoder.dtype, encoder.size, (part, block))
                        chunks, tokens, block = [], 0, block + 1
                    chunks.append((piece, doc, row, start))
                    tokens += len(piece)
                row += 1
        if chunks:
            yield _packed(chunks, row_tokens, encoder.dtype, encoder.size, (part, block))

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(pack, SCHEMA)


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet files, in their order within each input partition."""
    packed.write.parquet(path)
