"""Byte-level BPE encoding and decoding by merges in padded numpy matrices.

A text is cut by the vocabulary's pattern; each match is encoded on its own. Matches that are tokens as they are keep their
id. The others become rows of byte ids, put into buckets by length and padded. In every round each row of a matrix merges
its leftmost pair of least rank, found through a hashed table of pairs, and every row is compacted by one column; rows
without a pair that merges leave the matrix. A row too long for a bucket merges in one round all occurrences of its least
pair, from the left, as long as no pair that this makes ranks lower: the same merges as one at a time, in fewer rounds.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from tradewake.llm.frames import column, gathered, lists

NONE = np.int64(1) << 40
#: The white space of Unicode, which is what \\s stands for in the published pattern.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Longest row of each bucket; cells of one matrix; bytes or ids handled at a time; matches and ids that a task remembers.
BUCKETS = (4, 6, 8, 12, 16, 24, 32, 64, 128, 256)
CELLS, CHUNK, KNOWN, HELD = 1 << 19, 1 << 20, 1 << 18, 1 << 22


class PairTable:
    """(left id, right id) -> rank of the joined token, by open addressing in two arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        keys = self._key(left, right)
        self.shift = np.uint64(64 - max(4, int(len(keys) * 4).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask = np.uint64(size - 1)
        self.keys, self.ranks = np.full(size, np.iinfo(np.uint64).max, np.uint64), np.full(size, NONE)
        empty, place, todo = self.keys[0], self._home(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[place[todo]] == empty]
            _, first = np.unique(place[free], return_index=True)
            put = free[first]
            self.keys[place[put]], self.ranks[place[put]] = keys[put], rank[put]
            todo = todo[self.keys[place[todo]] != keys[todo]]
            place[todo] = (place[todo] + np.uint64(1)) & self.mask

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, NONE for a pair that does not merge."""
        keys = self._key(left, right).ravel()
        place, out = self._home(keys), np.full(len(keys), NONE)
        todo = None
        while True:
            got = self.keys[place if todo is None else place[todo]]
            want = keys if todo is None else keys[todo]
            hit = got == want
            at = np.flatnonzero(hit) if todo is None else todo[hit]
            out[at] = self.ranks[place[at]]
            on = ~hit & (got != np.iinfo(np.uint64).max)
            todo = np.flatnonzero(on) if todo is None else todo[on]
            if not len(todo):
                return out.reshape(np.shape(left))
            place[todo] = (place[todo] + np.uint64(1)) & self.mask


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Vocabulary:
    """Tokens by id, ids of bytes, and the table of pairs that merge."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.known = np.zeros(len(tokens), bool)
        self.known[list(self.ranks.values())] = True
        self.sizes = np.array(list(map(len, tokens)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        get = self.ranks.get
        pairs = [
            (a, b, rank) for token, rank in self.ranks.items() for k in range(1, len(token))
            if (a := get(token[:k])) is not None and (b := get(token[k:])) is not None
        ]
        self.pairs = PairTable(*np.array(pairs, np.int64).reshape(-1, 3).T)

    def decoded(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, byte offsets) of the lists ``ids[offsets[k]:offsets[k + 1]]``."""
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        return gathered(self.flat, self.starts[ids], self.sizes[ids]), ends[offsets]


@lru_cache(maxsize=2)
def vocabulary(name: str) -> Vocabulary:
    import public_tokenizers

    return Vocabulary(public_tokenizers.path(name))


@lru_cache(maxsize=1)
def splitter() -> regex.Pattern:
    import public_tokenizers

    pattern = public_tokenizers.PATTERN.replace(r"[^\s", f"[^{SPACE}").replace(r"(?!\S)", f"(?![^{SPACE}])").replace(r"\s", f"[{SPACE}]")
    return regex.compile(pattern)


def merged_matrix(ids: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """(rows in their final form, padded by -1, their lengths); ``ids`` holds byte ids padded by -1 at the end."""
    n, width = ids.shape
    out, sizes = np.full((n, width), -1, np.int64), np.zeros(n, np.int64)
    rank = np.full((n, width - 1), NONE)
    real = ids[:, 1:] >= 0
    rank[real] = pairs.find(ids[:, :-1][real], ids[:, 1:][real])
    row = np.arange(n)
    while len(row):
        at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
        least = rank[np.arange(len(row)), at] if rank.shape[1] else np.full(len(row), NONE)
        done = least == NONE
        if done.any():
            out[row[done], : ids.shape[1]] = ids[done]
            sizes[row[done]] = (ids[done] >= 0).sum(axis=1)
            row, ids, rank, at, least = row[~done], ids[~done], rank[~done], at[~done], least[~done]
            if not len(row):
                break
        line, width = np.arange(len(row)), ids.shape[1]
        ids[line, at] = least
        ids = ids[np.arange(width) != at[:, None] + 1].reshape(len(row), width - 1)
        rank = rank[np.arange(width - 1) != at[:, None]].reshape(len(row), width - 2)
        before = np.flatnonzero(at > 0)
        rank[before, at[before] - 1] = pairs.find(ids[before, at[before] - 1], ids[before, at[before]])
        after = np.flatnonzero(at < width - 2)
        right = ids[after, at[after] + 1]
        rank[after, at[after]] = np.where(right >= 0, pairs.find(ids[after, at[after]], np.maximum(right, 0)), NONE)
    return out, sizes


def merged_long(ids: np.ndarray, pairs: PairTable) -> np.ndarray:
    """The final form of one long row of byte ids."""
    rank = pairs.find(ids[:-1], ids[1:])
    while len(rank):
        least = rank.min()
        if least == NONE:
            break
        at = np.flatnonzero(rank == least)
        run = np.cumsum(np.diff(at, prepend=-2) > 1)  # occurrences that overlap form runs; every other one merges
        at = at[(at - at[np.searchsorted(run, run)]) % 2 == 0]
        many = len(at) > 1 and pairs.find(np.array([least]), ids[at[:1]])[0] > least
        for take in ([at, at[:1]] if many else [at[:1]]):
            new = ids.copy()
            new[take] = least
            new = np.delete(new, take + 1)
            put = take - np.arange(len(take))
            ranks = np.delete(rank, take)
            left, right = put[put > 0], put[put < len(new) - 1]
            ranks[left - 1] = pairs.find(new[left - 1], new[left])
            ranks[right] = pairs.find(new[right], new[right + 1])
            if len(take) == 1 or np.concatenate((ranks[left - 1], ranks[right], [NONE])).min() > least:
                break
        ids, rank = new, ranks
    return ids


def merged(pieces: list[bytes], vocab: Vocabulary) -> list[np.ndarray]:
    """The ids of each non-empty piece."""
    out: list[np.ndarray | None] = [None] * len(pieces)
    size = np.array(list(map(len, pieces)), np.int64)
    whole = np.array([vocab.ranks.get(p, -1) for p in pieces], np.int64)
    for k in np.flatnonzero(whole >= 0).tolist():
        out[k] = whole[k : k + 1]
    low = 0
    for high in BUCKETS:
        rows = np.flatnonzero((whole < 0) & (size > low) & (size <= high))
        for k in range(0, len(rows), CELLS // high):
            part = rows[k : k + CELLS // high]
            matrix = np.full((len(part), high), -1, np.int64)
            cells = np.arange(high) < size[part, None]
            matrix[cells] = vocab.byte_ids[np.frombuffer(b"".join([pieces[i] for i in part.tolist()]), np.uint8)]
            ids, sizes = merged_matrix(matrix, vocab.pairs)
            for i, row, n in zip(part.tolist(), ids, sizes.tolist()):
                out[i] = row[:n]
        low = high
    for k in np.flatnonzero((whole < 0) & (size > low)).tolist():
        out[k] = merged_long(vocab.byte_ids[np.frombuffer(pieces[k], np.uint8)], vocab.pairs)
    return out


class Encoder(dict):
    """Match -> its number; the ids of all numbered matches lie in one array. Emptied when it holds too much, so memory is bounded."""

    def __init__(self, name: str):
        super().__init__()
        self.vocab, self.find = vocabulary(name), splitter().findall
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.flat, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.new.append(piece)
        return number

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; none for a null or empty text."""
        if len(self) > KNOWN or len(self.flat) > HELD:
            self.reset()
        numbers = [np.fromiter(map(self.__getitem__, self.find(text or "")), np.int64) for text in texts]
        if self.new:
            ids = merged([p.encode() for p in self.new], self.vocab)
            self.flat = np.concatenate([self.flat, *ids])
            self.sizes = np.concatenate([self.sizes, np.array(list(map(len, ids)), np.int64)])
            self.new = []
        starts = np.cumsum(self.sizes) - self.sizes
        return [gathered(self.flat, starts[n], self.sizes[n]) for n in numbers]


def pieces_of(batch: pa.RecordBatch, sizes: np.ndarray, most: int):
    """``batch`` cut so that the ``sizes`` of a cut's rows add up to at most about ``most``."""
    cut = np.cumsum(sizes) // most
    edges = np.flatnonzero(np.diff(cut, prepend=-1)).tolist() + [batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)


def _with(batch: pa.RecordBatch, name: str, values: pa.Array, schema: StructType) -> pa.RecordBatch:
    cols = [values if f.name == name else batch.column(f.name) for f in schema.fields]
    return pa.RecordBatch.from_arrays(cols, names=schema.names)


def _extended(docs: DataFrame, name: str, kind) -> StructType:
    return StructType([f for f in docs.schema.fields if f.name.lower() != name.lower()] + [StructField(name, kind)])


def encode(docs: DataFrame, text_col: str = "text", ranks: str = "byte_bpe_multi_50k.tiktoken", to: str = "ids") -> DataFrame:
    """``docs`` with the array of ids of each whole text in the column ``to``, which replaces one of that name.

    A null or empty text has no ids. Special tokens are not known: their strings are plain text. Rows are encoded where
    they are read, without a shuffle; memory follows the longest text of a batch and the bounds above, not the table. Repeated rows
    get the same ids; an empty table gives an empty result. ``ranks`` names a file of ranks among the public ones.
    """
    schema = _extended(docs, to, ArrayType(IntegerType()))

    def run(batches):
        encoder = Encoder(ranks)
        for batch in batches:
            sizes = pc.binary_length(batch.column(text_col)).fill_null(0).to_numpy(zero_copy_only=False)
            for part in pieces_of(batch, sizes, CHUNK):
                yield _with(part, to, lists(encoder.encode(part.column(text_col).to_pylist()), pa.int32()), schema)

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, ids_col: str = "ids", ranks: str = "byte_bpe_multi_50k.tiktoken", to: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of the ids in the column ``to``, which replaces one of that name.

    No ids give no bytes; null ids, or a list with an id that the vocabulary does not have, give null.
    """
    schema = _extended(docs, to, BinaryType())

    def run(batches):
        vocab = vocabulary(ranks)
        for batch in batches:
            ids = batch.column(ids_col)
            counts = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for part in pieces_of(batch, counts, CHUNK):
                ids = part.column(ids_col)
                values, valid = ids.flatten(), ids.is_valid().to_numpy(zero_copy_only=False)
                offsets = np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
                flat = values.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                bad = (flat < 0) | (flat >= len(vocab.sizes))
                bad[~bad] = ~vocab.known[flat[~bad]]
                valid &= np.diff(np.concatenate(([0], np.cumsum(bad)))[offsets]) == 0
                data, ends = vocab.decoded(np.where(bad, 0, flat), offsets)
                out = pa.Array.from_buffers(pa.binary(), len(valid), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
                if not valid.all():
                    out = pa.array([v if ok else None for v, ok in zip(out.to_pylist(), valid.tolist())], pa.binary())
                yield _with(part, to, out, schema)

    return docs.mapInArrow(run, schema)
