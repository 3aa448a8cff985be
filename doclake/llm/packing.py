"""Token ids packed into fixed rows, as binary matrices.

Whole texts are tokenised with a public vocabulary (a file path is a
parameter). A document longer than a row is split without loss into full
rows and a rest. Each task takes its documents in groups of bounded tokens
and packs a group best-fit-decreasing: segments by falling length, each into
the fullest row that still has room, found in a segment tree over the
capacities. A group's rows go to one little-endian matrix file; the returned
rows say where each row lies, which documents it holds, the cumulative
segment lengths and the places where positions start again. No shuffle: a
lost task writes its own files again, under the same names.

Defined cases: null and empty texts have no tokens and are in no row; a null
``doc_id`` is written as null; repeated rows are packed as often as they
occur; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from doclake.llm.common import AtomicFile, shared_folder, write_table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the vocabulary's splitting pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PAD = 50256  # an id that no text yields
ROW_SCHEMA = ("matrix string, row int, n_tokens int, n_segments int, doc_ids array<long>, "
              "doc_starts array<int>, cu_seqlens array<int>, position_resets array<int>, ids_crc32 long")


class _Pieces(dict):
    """Bounded cache: a piece -> its ids as bytes, with a blank in front."""

    def __init__(self, encode: Callable[[str], list[int]], size: int):
        super().__init__()
        self.encode, self.size = encode, size

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.size:
            self.clear()
        got = self[piece] = np.array(self.encode(" " + piece), dtype="<u2").tobytes()
        return got


class Tokenizer:
    """Byte-level BPE with a bounded cache of blank-separated pieces.

    A single blank between two non-blank characters always starts a new
    token group in the pattern, so pieces cut there can be encoded alone.
    """

    #: a blank with white space before or behind it
    _irregular = re.compile(r" (?:(?=\s)|(?<=\s ))")

    def __init__(self, path: str, cache: int = 1 << 19):
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = _Pieces(self.enc.encode_ordinary, cache)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, "<u2")
        if text[0].isspace() or text[-1].isspace() or self._irregular.search(text):
            return np.array(self.enc.encode_ordinary(text), dtype="<u2")
        first, *rest = text.split(" ")
        head = np.array(self.enc.encode_ordinary(first), dtype="<u2").tobytes()
        return np.frombuffer(head + b"".join(map(self.pieces.__getitem__, rest)), "<u2")


class CapacityTree:
    """Counts of open rows by room left; finds the least room that is enough."""

    def __init__(self, length: int):
        self.size = 1 << (length + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        i = room + self.size
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room >= need."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.rows[room].pop()


def best_fit_decreasing(lengths: list[int], row_len: int) -> list[list[int]]:
    """Indices of the segments of each row, in the order they were put there."""
    tree, rows = CapacityTree(row_len), []
    for i in sorted(range(len(lengths)), key=lambda j: (-lengths[j], j)):
        got = tree.take(lengths[i])
        room, row = got if got else (row_len, len(rows))
        if got is None:
            rows.append([])
        rows[row].append(i)
        if room > lengths[i]:
            tree.add(room - lengths[i], row)
    return rows


def pack_group(docs: list[tuple[int | None, np.ndarray]], row_len: int) -> tuple[np.ndarray, list[dict]]:
    """(matrix, rows): the packed ids and what each row holds."""
    segs = [(d, ids, s, min(s + row_len, len(ids))) for d, ids in docs for s in range(0, len(ids), row_len)]
    rows = best_fit_decreasing([e - s for _, _, s, e in segs], row_len)
    matrix = np.full((len(rows), row_len), PAD, "<u2")
    out = []
    for r, members in enumerate(rows):
        cu = [0]
        for m in members:
            _, ids, s, e = segs[m]
            matrix[r, cu[-1]: cu[-1] + e - s] = ids[s:e]
            cu.append(cu[-1] + e - s)
        out.append({"row": r, "n_tokens": cu[-1], "n_segments": len(members), "doc_ids": [segs[m][0] for m in members],
                    "doc_starts": [segs[m][2] for m in members], "cu_seqlens": cu, "position_resets": cu[:-1],
                    "ids_crc32": zlib.crc32(matrix[r].tobytes())})
    return matrix, out


def pack(docs: DataFrame, folder: str, row_len: int = 2048, group_tokens: int = 4_000_000,
         vocabulary: str = VOCABULARY) -> DataFrame:
    """Write the matrices below ``folder``; one returned row per matrix row (ROW_SCHEMA), stored."""

    def task(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        part, group, held, tokens, tok = TaskContext.get().partitionId(), 0, [], 0, Tokenizer(vocabulary)
        types = pa.schema([("matrix", pa.string()), ("row", pa.int32()), ("n_tokens", pa.int32()),
                           ("n_segments", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                           ("doc_starts", pa.list_(pa.int32())), ("cu_seqlens", pa.list_(pa.int32())),
                           ("position_resets", pa.list_(pa.int32())), ("ids_crc32", pa.int64())])

        def flush():
            nonlocal group, held, tokens
            name = f"ids-{part:06d}-{group:05d}.u16"
            matrix, rows = pack_group(held, row_len)
            f = AtomicFile(folder, name)
            f.write(matrix.tobytes())
            f.close()
            group, held, tokens = group + 1, [], 0
            return pa.RecordBatch.from_pylist([{"matrix": name, **r} for r in rows], schema=types)
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                ids = tok.encode(text.as_py() or "")
                if len(ids):
                    held.append((doc_id, ids))
                    tokens += len(ids)
                if tokens >= group_tokens:
                    yield flush()
        if held:
            yield flush()
    return write_table(docs.select("doc_id", "text").mapInArrow(task, ROW_SCHEMA), "packed-rows")


def op9_packing(spark, sf_dir: str) -> DataFrame:
    """Query: all documents as packed rows of 2,048 ids."""
    folder = shared_folder(spark, "packed")
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), folder)
