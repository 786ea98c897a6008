"""Exact counts of all words and bigrams of a corpus, handed to blocks of texts as large as a task can hold.

Texts are cut into blocks where they are read. Each block asks for its words and, under each word, for the words that follow
it; questions are dealt out by the word asked for, so that whoever answers sees all of a word's occurrences and followers
at once. Words that lead a large share of all bigrams are dealt out by word and follower. Nothing is left out, however
rare, and nothing but tables of fixed size is broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm import bloom
from tradewake.llm.words import WordHashes, mixed, words

#: Stands for the start of a text, before its first word.
START = np.uint64(0x243F6A8885A308D3)
_PAIR = np.uint64(0x9E3779B97F4A7C15)
#: Tokens and rows of a block.
BLOCK, BLOCK_ROWS = 1 << 21, 1 << 16
#: Bytes of text for each of the parts that answer questions.
PART_BYTES = 1 << 23
#: Words with a short code, tokens of a partition that they are chosen from, and words that a partition names.
COMMON, HEAD, NAMED = (1 << 18) - 1, 1 << 18, 1 << 14
_CODE_BITS = np.int64(30)
_CODEC = pa.Codec("zstd", compression_level=1)
#: Roles of a row: its text is counted, its text wants answers.
COUNTED, WANTED = 1, 2


def hashed(text: str | None, known: WordHashes) -> np.ndarray:
    tokens = words(text)
    return np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))


def pair_keys(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mixed(mixed(before) * _PAIR + after)


def narrow(values: np.ndarray) -> bytes:
    """Counts in as few bytes as the largest takes, first all lowest bytes, then all second ones, compressed."""
    values = np.ascontiguousarray(values, np.uint64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + len(planes).to_bytes(8, "little") + _CODEC.compress(planes, asbytes=True)


def widened(data: bytes) -> np.ndarray:
    width, size = data[0], int.from_bytes(data[1:9], "little")
    planes = np.frombuffer(_CODEC.decompress(data[9:], size) if size else b"", np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view(np.int64).ravel()


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts the values, the sorted values, and where each different one begins there."""
    order = np.argsort(values)
    found = values[order]
    return order, found, np.flatnonzero(np.append(True, found[1:] != found[:-1])[: len(found)])


def numbered(order: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """For each value of ``runs``, the number of its run."""
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
    return out


class Deal:
    """How questions are dealt out: the number of parts, words with short codes, words whose followers go to several parts.

    Estimated from the beginning of every partition; it decides what counting costs, never a count.
    """

    def __init__(self, parts: int, estimate: dict[str, np.ndarray]):
        word, n = estimate["word"], estimate["n"].astype(float)
        order = np.argsort(word)
        self.parts, word, n = parts, word[order], n[order]
        real = word != START
        self.common = word[real]
        self.rank = np.empty(real.sum(), np.int64)  # short codes are ranks by frequency
        self.rank[np.argsort(-n[real], kind="stable")] = np.arange(len(self.rank))
        self.by_rank = self.common[np.argsort(self.rank)]
        share = np.ceil(n / max(1.0, n[word != START].sum()) * parts).astype(np.int64)
        self.wide, self.spread = word[share > 1], np.minimum(share[share > 1], parts)

    def parts_of(self, word: np.ndarray) -> np.ndarray:
        """For each word, among how many parts its followers are dealt out."""
        out = np.ones(len(word), np.int64)
        if len(self.wide) and len(word):
            at = np.minimum(np.searchsorted(self.wide, word), len(self.wide) - 1)
            out = np.where(self.wide[at] == word, self.spread[at], 1)
        return out

    def short(self, word: np.ndarray) -> np.ndarray:
        """Short codes of words, COMMON for those that have none."""
        if not len(self.common):
            return np.full(len(word), COMMON)
        at = np.minimum(np.searchsorted(self.common, word), len(self.common) - 1)
        return np.where(self.common[at] == word, self.rank[at], COMMON)


def _beginning(batches):
    """texts -> (word, n) of the most frequent words among a partition's first tokens, with its texts under START."""
    known, parts, held, texts = WordHashes(), [], 0, 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            parts.append(hashed((text or "")[: 8 * HEAD], known))
            held, texts = held + len(parts[-1]), texts + bool(len(parts[-1]))
            if held >= HEAD:
                break
        if held >= HEAD:
            break
    if held:
        word, n = np.unique(np.concatenate(parts), return_counts=True)
        top = np.argsort(-n, kind="stable")[:NAMED]
        word, n = np.append(word[top], START), np.append(n[top], texts)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


def dealt(texts: DataFrame, parts: int | None = None) -> Deal:
    """``texts`` has one column."""
    if parts is None:
        size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
        parts = 1 + size // PART_BYTES
    named = texts.mapInArrow(_beginning, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = named.orderBy(F.desc("n"), "word").limit(COMMON).toPandas()
    return Deal(parts, {"word": top["word"].to_numpy(np.int64).view(np.uint64), "n": top["n"].to_numpy(np.int64)})


def flagged(docs: DataFrame, ids: DataFrame, bits) -> DataFrame:
    """``docs`` (id, text, role) and, again, with ``target`` those whose id may be in ``ids`` by the Bloom filter ``bits``.

    Rows without ``target`` count only where the filter excludes their id; so whole texts are moved for the others only, and
    by the same plan at every size.
    """

    def may_be(batches):
        for batch in batches:
            yield batch.filter(pa.array(maybe(batch.column(0), bits.value)))

    asked = docs.mapInArrow(may_be, docs.schema)
    target = ids.withColumnRenamed(ids.columns[0], "_target").hint("merge")
    decided = asked.join(target, F.col("id") == F.col("_target"), "left").select("id", "text", "role", F.col("_target").isNotNull().alias("target"))
    return docs.select("id", "text", "role", F.lit(None).cast("boolean").alias("target")).unionAll(decided)


def maybe(ids: pa.Array, bits: np.ndarray) -> np.ndarray:
    return bloom.held(bits, ids.fill_null(0).to_numpy(zero_copy_only=False)) & ids.is_valid().to_numpy(zero_copy_only=False)


BLOCKS = "block long, ids array<long>, lengths array<int>, roles binary, targets binary, codes binary, words binary"


def blocks_of(bits, most: int = BLOCK):
    """(id, text, role, target) -> blocks. A block's words are in order of falling frequency, its codes are places there."""

    def run(batches):
        known, block = WordHashes(), TaskContext.get().partitionId() << 32
        ids, texts, roles, targets, held = [], [], [], [], 0

        def flush():
            tokens = np.concatenate(texts)
            word, at, n = np.unique(tokens, return_inverse=True, return_counts=True)
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            if len(word) >= 1 << 30:
                raise ValueError("a text has too many different words")
            return pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int32())),
                pa.array([bytes(roles)]), pa.array([bytes(targets)]), pa.array([narrow(rank[at])]), pa.array([word[order].tobytes()]),
            ], names=["block", "ids", "lengths", "roles", "targets", "codes", "words"])

        for batch in batches:
            own, target = batch.column(0), batch.column(3).to_pylist()
            skipped = maybe(own, bits.value)
            for k, (one, text, role) in enumerate(zip(own.to_pylist(), batch.column(1), batch.column(2).to_pylist())):
                if target[k] is None and role & COUNTED and skipped[k]:
                    continue  # comes again with its target
                ids.append(one)
                texts.append(hashed(text.as_py(), known))
                roles.append(role)
                targets.append(bool(target[k]))
                held += len(texts[-1])
                if held >= most or len(ids) >= BLOCK_ROWS:
                    yield flush()
                    block, ids, texts, roles, targets, held = block + 1, [], [], [], [], 0
        if ids:
            yield flush()

    return run


class Block:
    """A block's words and different bigrams, and the questions about them in the order in which they are dealt out."""

    def __init__(self, lengths: np.ndarray, codes: bytes, words_: bytes, deal: Deal):
        self.lengths = lengths
        word = widened(codes)
        self.word = np.append(np.frombuffer(words_, np.uint64), START)
        size = len(self.word)
        self.some = lengths > 0
        self.first = (np.cumsum(lengths) - lengths)[self.some]
        before = np.empty_like(word)
        before[1:] = word[:-1]
        before[self.first] = size - 1
        self.codes = word
        order, pair, begin = runs(before << _CODE_BITS | word)
        self.each = numbered(order, begin)  # the bigram at each token
        pair = pair[begin]
        self.before, self.after = pair >> _CODE_BITS, pair & ((1 << _CODE_BITS) - 1)
        # one question for each word and part, with the followers that belong there
        spread = deal.parts_of(self.word)
        base = (mixed(self.word) % np.uint64(deal.parts)).astype(np.int64)
        begin = np.cumsum(spread) - spread
        of = np.repeat(np.arange(size), spread)
        step = np.arange(len(of)) - begin[of]
        part = (base[of] + step) % deal.parts
        lead = spread[self.before]
        which = begin[self.before]
        wide = lead > 1
        scattered = mixed(self.word + _PAIR)
        which[wide] += (scattered[self.after[wide]] % lead[wide].astype(np.uint64)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        asked = rank[which]
        self.of, self.leading = of[order], step[order] == 0  # word of each question; whether it is the word's first
        self.order = np.argsort(asked, kind="stable")  # of the bigrams
        self.many = np.bincount(asked, minlength=len(order))
        self.cuts = np.searchsorted(part[order], np.arange(deal.parts + 1))
        self.pair_cuts = np.concatenate([[0], np.cumsum(self.many)])[self.cuts]


def asking(deal_):
    """Blocks -> their questions, a row for each block and part."""

    def run(batches):
        deal = deal_.value
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k] for name in ("block", "lengths", "roles", "targets", "codes", "words")}
                b = Block(row["lengths"].values.to_numpy(zero_copy_only=False).astype(np.int64), row["codes"].as_py(), row["words"].as_py(), deal)
                roles, target = (np.frombuffer(row[x].as_py(), np.uint8) for x in ("roles", "targets"))
                weights = [(roles & COUNTED).astype(float), (target & roles & COUNTED).astype(float)]
                size = len(b.word)
                n, c = [], []
                for weight in weights:
                    each = np.repeat(weight, b.lengths)
                    n.append(np.bincount(b.each, each, len(b.before)).astype(np.int64)[b.order])
                    own = np.bincount(b.codes, each, size)
                    own[-1] = weight[b.some].sum()
                    c.append(own.astype(np.int64)[b.of])
                word, after = b.word[b.of], b.word[b.after[b.order]]
                short = deal.short(b.word)[b.after[b.order]]
                wanted = bool((roles & WANTED).any())
                out = [[] for _ in range(10)]
                for p in range(deal.parts):
                    q, v = slice(b.cuts[p], b.cuts[p + 1]), slice(b.pair_cuts[p], b.pair_cuts[p + 1])
                    codes = short[v]
                    flags = narrow(b.leading[q])
                    new = (narrow(b.many[q]), narrow(c[0][q]), narrow(c[1][q]), narrow(codes), after[v][codes == COMMON].tobytes(), narrow(n[0][v]), narrow(n[1][v]))
                    for col, x in zip(out, (p, row["block"].as_py(), word[q].tobytes() + flags, *new)):
                        col.append(x)
                kinds = [pa.int32(), pa.int64()] + [pa.binary()] * 8
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)] + [pa.array([wanted] * deal.parts)], names=ASKED)

    return run


ASKED = ["part", "block", "words", "many", "c_all", "c_target", "short", "long", "n_all", "n_target", "wanted"]
ASKED_TYPES = "part int, block long, words binary, many binary, c_all binary, c_target binary, short binary, long binary, n_all binary, n_target binary, wanted boolean"
ANSWERS = ["block", "part", "size", "tokens_all", "tokens_target", "words", "pairs"]
ANSWER_TYPES = "block long, part int, size long, tokens_all long, tokens_target long, words array<binary>, pairs array<binary>"


def answering(deal_):
    """All questions of a part -> an answer for each block that wants one: the corpus-wide counts in the order of its questions."""

    def run(asked: pa.Table) -> pa.Table:
        deal = deal_.value
        cols = {name: asked.column(name).to_pylist() for name in asked.column_names}
        many = [widened(x) for x in cols["many"]]
        sizes = [len(x) for x in many]
        word = np.concatenate([np.frombuffer(x, np.uint64, n) for x, n in zip(cols["words"], sizes)])
        leading = np.concatenate([widened(x[8 * n :]) for x, n in zip(cols["words"], sizes)]).astype(bool)
        many_all = np.concatenate(many)
        order, different, begin = runs(word)
        different, at = different[begin], numbered(order, begin)
        total = lambda where, values, size: np.bincount(where, values, size).astype(np.int64)
        whole = lambda name: np.concatenate([widened(x) for x in cols[name]])
        c = [total(at, whole(name), len(different)) for name in ("c_all", "c_target")]
        # a word's first part counts it for the size of the vocabulary and the number of tokens
        first = np.zeros(len(different), bool)
        first[at[leading]] = True
        first &= different != START
        short = whole("short")
        after = np.empty(len(short), np.uint64)
        rare = short == COMMON
        after[rare] = np.concatenate([np.frombuffer(x, np.uint64) for x in cols["long"]])
        after[~rare] = deal.by_rank[short[~rare]]
        lead = np.repeat(at, many_all)
        order, _, begin = runs(pair_keys(different[lead], after))
        where, pair = order[begin], numbered(order, begin)
        n = [total(pair, whole(name), len(where)) for name in ("n_all", "n_target")]
        of = lead[where]
        followed = [total(of, x, len(different)) for x in n]
        followers = [total(of, x > 0, len(different)) for x in n]
        ends, pair_ends = np.cumsum(sizes), np.cumsum([x.sum() for x in many])
        out = []
        for k in np.flatnonzero(cols["wanted"]):
            q, v = at[ends[k] - sizes[k] : ends[k]], pair[pair_ends[k] - many[k].sum() : pair_ends[k]]
            out.append((cols["block"][k], cols["part"][k], [narrow(x[q]) for x in (*c, *followed, *followers)], [narrow(x[v]) for x in n]))
        same = [int((first & (c[0] > 0)).sum()), int(c[0][first].sum()), int(c[1][first].sum())]
        return pa.table([
            pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), *(pa.array([s] * len(out), pa.int64()) for s in same),
            pa.array([x[2] for x in out], pa.list_(pa.binary())), pa.array([x[3] for x in out], pa.list_(pa.binary())),
        ], names=ANSWERS)

    return run


class Counts:
    """What a block was answered, each with a column for all texts and for the target's: of its words, how often they occur, how
    often a word follows them and how many different ones do (``c``, ``followed``, ``followers``); of its bigrams ``n``; of the
    whole corpus its ``tokens`` and, for both, the number ``size`` of its words."""

    def __init__(self, block: Block, answers: pa.Table):
        answers = answers.sort_by("part")
        words_, pairs = (answers.column(x).to_pylist() for x in ("words", "pairs"))
        total = lambda name: answers.column(name).to_numpy().sum()
        self.size, self.tokens = int(total("size")), np.array([total("tokens_all"), total("tokens_target")])
        size = len(block.word)
        got = [np.concatenate([widened(x[k]) for x in words_]) for k in range(6)]
        self.c = np.zeros((size, 2), np.int64)
        for m in (0, 1):
            self.c[block.of, m] = got[m]  # the same from every part
        self.followed, self.followers = (np.stack([np.bincount(block.of, x, size) for x in got[k : k + 2]], 1) for k in (2, 4))
        self.n = np.zeros((len(block.before), 2), np.int64)
        for m in (0, 1):
            self.n[block.order, m] = np.concatenate([widened(x[m]) for x in pairs])
