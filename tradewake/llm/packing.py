"""Packing token sequences into windows by Karmarkar-Karp multiway differencing.

A document's ids, with the end id, are cut into full windows and a rest; the rest is cut into pieces of at most ``grain``
ids. Rests are dealt into groups of about ``windows`` windows, and every group is split by differencing: partial
partitions, each a vector of window sums, are merged two by two, the two with the largest spread first, the largest sums
of one joining the smallest of the other. That leaves near-equal windows. If the fullest exceeds the capacity, the group
is split again into one window more.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from bisect import insort
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import column, lists, store

END_ID, SPECIAL = 1, "<|endoftext|>"
PIECE = "uid long, id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def encoder(name: str):
    """text -> ids of the public vocabulary ``name``.

    The ids are those of ``tokenizers`` with add_special_tokens=False. They come from tiktoken over the same vocabulary,
    which is several times faster; the special token's string, which the two treat differently, goes to ``tokenizers``.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @lru_cache(maxsize=1)
    def exact() -> Tokenizer:
        return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            return np.array(exact().encode(text, add_special_tokens=False).ids, "<u4")
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    return encode


def cuts(n: int, capacity: int, grain: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows first, then the rest in near-equal pieces of at most ``grain``."""
    full, rest = divmod(n, capacity)
    out = [(k * capacity, capacity) for k in range(full)]
    if rest:
        parts = -(-rest // grain)
        edges = [full * capacity + rest * k // parts for k in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:])]
    return out


def _tokenised(vocabulary: str, capacity: int, grain: int, keep_ids: bool):
    def run(batches):
        encode, uid = encoder(vocabulary), TaskContext.get().partitionId() << 36
        names = [f.split()[0] for f in PIECE.split(", ")] + ["ids"] * keep_ids
        rows, ids, held = [], [], 0

        def flush():
            cols = [pa.array(c, pa.int64()) for c in zip(*rows)]
            return pa.RecordBatch.from_arrays(cols + [lists(ids, pa.int32())] * keep_ids, names=names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens = np.append(encode(text or ""), np.array(END_ID, "<u4"))
                for start, length in cuts(len(tokens), capacity, grain):
                    part = tokens[start : start + length]
                    rows.append((uid, doc, start, length, zlib.crc32(part.tobytes()), len(tokens)))
                    uid += 1
                    if keep_ids:
                        ids.append(part.astype(np.int32))
                        held += length
                if len(rows) >= 10_000 or held > 1 << 21:
                    yield flush()
                    rows, ids, held = [], [], 0
        if rows:
            yield flush()

    return run


class _Partial:
    """A partial partition: (sum, node) of the windows that hold something, ascending; the others hold ``base``.

    Only the differences between windows matter, so sums are read less ``base``, the least of all windows.
    """

    __slots__ = ("base", "held")

    def __init__(self, held: list[tuple[int, int]], base: int = 0):
        self.held, self.base = held, base

    def spread(self) -> int:
        return self.held[-1][0] - self.base


def _merged(a: _Partial, b: _Partial, windows: int, join) -> _Partial:
    """The largest sums of one joined to the least of the other; only windows that hold something are touched."""
    if len(a.held) < len(b.held):
        a, b = b, a
    shift = a.base - b.base
    both = len(a.held) + len(b.held) - windows  # so many windows of each meet one of the other that holds something
    if both > 0:
        met = [(x + y - b.base, join(p, q)) for (x, p), (y, q) in zip(a.held[:both], b.held[both - 1 :: -1])]
    else:
        met, both = [], 0
    held = a.held
    del held[:both]
    new = met + [(y + shift, q) for y, q in b.held[both:]]
    if len(new) == 1:
        insort(held, new[0])
    else:
        held += new
        held.sort()
    return _Partial(held, held[0][0] if len(held) == windows else a.base)


def differencing(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window (0 .. windows - 1) of each item, by Karmarkar-Karp differencing. Ties go by the order of the items."""
    n = len(sizes)
    if windows == 1 or n == 0:
        return np.zeros(n, np.int64)
    left, right = [-1] * n, [-1] * n  # items joined in a window form a binary tree

    def join(p: int, q: int) -> int:
        left.append(p)
        right.append(q)
        return len(left) - 1

    heap = [(-size, i, _Partial([(size, i)])) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    number = n
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        both = _merged(a, b, windows, join)
        heapq.heappush(heap, (-both.spread(), number, both))
        number += 1
    out = np.zeros(n, np.int64)
    for w, (_, root) in enumerate(heap[0][2].held):
        todo = [root]
        while todo:
            node = todo.pop()
            if left[node] < 0:
                out[node] = w
            else:
                todo += (left[node], right[node])
    return out


def windows_of(lengths: np.ndarray, capacity: int, grain: int) -> np.ndarray:
    """The window of each piece (lengths at most ``grain``, itself at most half the capacity); no window exceeds the capacity.

    Pieces under an eighth of the grain are first joined, in order, into bundles of about a quarter of it, so that the number of
    items follows the windows and not the pieces.
    """
    tiny = lengths < grain // 8
    item = np.empty(len(lengths), np.int64)
    item[~tiny] = np.arange((~tiny).sum())
    before = np.cumsum(lengths[tiny]) - lengths[tiny]
    _, bundle = np.unique(before // (grain // 4), return_inverse=True)
    item[tiny] = (~tiny).sum() + bundle
    sizes = np.bincount(item, weights=lengths).astype(np.int64)
    count = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, count)
        if np.bincount(window, weights=sizes[: len(window)]).max() <= capacity:
            return window[item]
        count += 1


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, grain: int = 256, windows: int = 128,
         vocabulary: str = "byte_bpe_50k", keep_ids: bool = False) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row for each piece.

    Every id of every document, its end id included, lies in one piece; pieces of a sequence follow one another from
    offset 0 without gaps. A null or empty text is its end id alone; a null id stays null; repeated rows are packed like
    others. An empty table gives an empty result. ``keep_ids`` adds the ids themselves.

    Texts are tokenised once and pieces stored. Groups hold about windows * capacity ids whatever the documents are, and
    number the more the larger the input is.
    """
    texts = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    schema = PIECE + ", ids array<int>" * keep_ids
    pieces = store(texts.mapInArrow(_tokenised(vocabulary, capacity, grain, keep_ids), schema), "pack-pieces")
    rest = pieces.where(F.col("length") < capacity)
    total = rest.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // (windows * capacity)))

    def share(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("uid", ignore_index=True)
        window = windows_of(frame["length"].to_numpy(), capacity, grain)
        frame["sequence_id"] = 2 * ((frame["part"].to_numpy() << 24) + window)
        frame["offset"] = frame.groupby("sequence_id")["length"].cumsum() - frame["length"]
        return frame.drop(columns="part")

    slim = rest.select("uid", "id", "start", "length", "ids_crc32", "doc_tokens", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("part"))
    shared = slim.groupBy("part").applyInPandas(share, PIECE + ", sequence_id long, offset long")
    alone = pieces.where(F.col("length") == capacity).withColumns({"sequence_id": 2 * F.col("uid") + 1, "offset": F.lit(0).cast("long")})
    out = shared.unionByName(alone.select(*shared.columns))
    if keep_ids:
        out = out.join(pieces.select("uid", "ids"), "uid")
    return out.drop("uid")
