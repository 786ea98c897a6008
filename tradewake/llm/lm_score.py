"""Cross-entropy difference (Moore and Lewis, 2010) of documents under two matched bigram models.

Target and background model share one vocabulary and one set of bigrams, both fixed by the background, which is all
documents; each has its own counts. All words and bigrams are in the models, however rare; their counts are a table that
blocks of texts ask (``ngram_counts``). Bigrams are discounted absolutely and interpolated with unigrams, so that
probabilities sum to one; unigrams, with one unknown word, get one added to each count.

With ``least_share`` the models are small instead: a word or bigram is in them if it occurs twice and makes up at least that
share of the background's tokens; all other words are the unknown word. Nothing uses that unless it is asked for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm import bloom, ngram_counts
from tradewake.llm.frames import column, store
from tradewake.llm.ngram_counts import _PAIR, START, hashed
from tradewake.llm.words import WordHashes, mixed

#: Counts that a task holds before it hands them over.
HELD = 1 << 21
#: A word's place in a small model's vocabulary takes so many bits.
PLACE_BITS = 20


def pairs_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word before each word, and the key of the two."""
    before = np.concatenate([[START], tokens[:-1]]).astype(np.uint64) if len(tokens) else tokens
    return before, mixed(mixed(before) * _PAIR + tokens)


def _words(batches):
    """texts -> partial counts (word, n)."""
    known, parts, held = WordHashes(), [], 0

    def flush():
        unique, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    for batch in batches:
        for text in batch.column(0).to_pylist():
            tokens = hashed(text, known)
            parts.append(tokens)
            held += len(tokens)
            if held >= HELD:
                yield flush()
                parts, held = [], 0
    if held:
        yield flush()


def places(vocabulary: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The place of each word in the sorted vocabulary, its length for words that are not in it."""
    if not len(vocabulary):
        return np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(vocabulary, tokens), len(vocabulary) - 1)
    return np.where(vocabulary[at] == tokens, at, len(vocabulary))


def _counts(shared):
    """(text, target) -> partial counts (key, background, target). The key of a word is its place; that of a bigram of two
    known words, or of the start and a known word, has the place of the first plus one (the start's is the last) above it."""

    def run(batches):
        vocabulary, known, parts, held = shared.value, WordHashes(), [], 0
        unknown, start = len(vocabulary), len(vocabulary) + 1

        def flush():
            key, target = (np.concatenate(c) for c in zip(*parts))
            unique, at = np.unique(key, return_inverse=True)
            return pa.RecordBatch.from_arrays([
                pa.array(unique), pa.array(np.bincount(at, minlength=len(unique)).astype(np.int64)),
                pa.array(np.bincount(at, weights=target, minlength=len(unique)).astype(np.int64)),
            ], names=["key", "background", "target"])

        for batch in batches:
            for text, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                word = places(vocabulary, hashed(text, known))
                if len(word):
                    before = np.concatenate([[start], word[:-1]])
                    both = (before != unknown) & (word != unknown)
                    key = np.concatenate([word, (before[both] + 1) << PLACE_BITS | word[both]])
                    parts.append((key, np.full(len(key), float(target))))
                    held += len(key)
                if held >= 2 * HELD:
                    yield flush()
                    parts, held = [], 0
        if parts:
            yield flush()

    return run


class Model:
    """Both small models as sorted arrays: at most 1 / least_share words and as many bigrams, for any corpus."""

    def __init__(self, words_: dict[str, np.ndarray], bigrams: dict[str, np.ndarray], total: np.ndarray, starts: np.ndarray, discount: float):
        """words_: key, n; bigrams: key, before, word, n; each n, total and starts with a column for background and target."""
        order = np.argsort(words_["key"])
        self.word = words_["key"][order]
        counts = np.vstack([words_["n"][order].reshape(-1, 2), total.reshape(1, 2) - words_["n"].reshape(-1, 2).sum(0)]) + 1.0
        uni = counts / counts.sum(0)  # the last row is the unknown word; one is added to each count
        self.uni = np.log(uni)
        order = np.argsort(bigrams["key"])
        self.key, n = bigrams["key"][order], bigrams["n"][order].reshape(-1, 2)
        before, word = bigrams["before"][order], bigrams["word"][order]
        at_before, at_word = self.place(before), self.place(word)
        raw = np.vstack([words_["n"][np.argsort(words_["key"])].reshape(-1, 2), np.zeros((1, 2)), starts.reshape(1, 2)])
        at_before = np.where(before == START, len(raw) - 1, at_before)
        context = np.maximum(raw[at_before], 1e-300)
        p = np.where(n > 0, np.maximum(n - discount, 0) / context, 0.0)
        mass = np.stack([np.bincount(at_before, weights=p[:, m], minlength=len(raw)) for m in (0, 1)], 1)
        back = np.where(raw > 0, np.maximum(1 - mass, 1e-300), 1.0)
        self.back = np.log(back)
        self.bi = np.log(p + back[at_before] * uni[at_word])

    def place(self, tokens: np.ndarray) -> np.ndarray:
        """The row of each word, the unknown word's for all others."""
        return places(self.word, tokens)

    def log_probabilities(self, tokens: np.ndarray) -> np.ndarray:
        """Per token the natural logs of its probability under background and target."""
        before, key = pairs_of(tokens)
        at = self.place(tokens)
        context = np.where(before == START, len(self.back) - 1, self.place(before))
        out = self.back[context] + self.uni[at]
        if len(self.key) and len(tokens):
            k = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            # both words in the vocabulary: kept bigrams are of kept words
            hit = self.key[k] == key
            out[hit] = self.bi[k[hit]]
        return out


def log_probabilities(block: ngram_counts.Block, counts: ngram_counts.Counts, discount: float) -> np.ndarray:
    """Of each different bigram of a block the natural logs of its second word's probability under background and target."""
    uni = (counts.c + 1) / (counts.tokens + counts.size + 1)
    context = np.maximum(counts.c, 1)
    rest = np.where(counts.c > 0, 1 - (counts.followed - discount * counts.followers) / context, 1.0)
    return np.log(np.maximum(counts.n - discount, 0) / context[block.before] + rest[block.before] * uni[block.after])


class Counted:
    """Both models of all words and bigrams: ``docs`` and the ids of the target, counted when texts are scored."""

    def __init__(self, docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str, discount: float, block: int, parts: int | None):
        if not 0 < discount <= 1:
            raise ValueError("discount must be over 0 and at most 1")
        self.docs, self.cols, self.discount, self.block, self.parts = docs, (id_col, text_col), discount, block, parts
        target = target_ids.toDF("_target").select(F.col("_target").cast("long").alias("_target"))
        self.target = target.where("_target IS NOT NULL").distinct()

    def losses(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        spark = docs.sparkSession
        rows = lambda df, cols, role: df.select(column(cols[0]).cast("long").alias("id"), column(cols[1]).alias("text"), F.lit(role).alias("role"))
        same = docs is self.docs and (id_col, text_col) == self.cols
        bits = spark.sparkContext.broadcast(bloom.build(self.target))
        texts = ngram_counts.flagged(rows(self.docs, self.cols, ngram_counts.COUNTED | ngram_counts.WANTED * same), self.target, bits)
        if not same:
            texts = texts.unionAll(rows(docs, (id_col, text_col), ngram_counts.WANTED).withColumn("target", F.lit(None).cast("boolean")))
        deal = spark.sparkContext.broadcast(ngram_counts.dealt(self.docs.select(column(self.cols[1]).alias("text")), self.parts))
        blocks = store(texts.mapInArrow(ngram_counts.blocks_of(bits, self.block), ngram_counts.BLOCKS), "lm-blocks")
        asked = blocks.drop("ids").mapInArrow(ngram_counts.asking(deal), ngram_counts.ASKED_TYPES)
        answers = asked.groupBy("part").applyInArrow(ngram_counts.answering(deal), ngram_counts.ANSWER_TYPES)

        discount = self.discount

        def run(block: pa.Table, answered: pa.Table) -> pa.Table:
            out = [pa.array([], t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
            if answered.num_rows:
                row = block.slice(0, 1).to_pylist()[0]
                b = ngram_counts.Block(np.array(row["lengths"], np.int64), row["codes"], row["words"], deal.value)
                of_pair = log_probabilities(b, ngram_counts.Counts(b, answered), discount)
                loss = np.zeros((len(b.lengths), 2))
                if len(b.first):
                    loss[b.some] = -np.add.reduceat(of_pair[b.each], b.first) / b.lengths[b.some, None]
                wanted = (np.frombuffer(row["roles"], np.uint8) & ngram_counts.WANTED) > 0
                ids = pa.array(row["ids"], pa.int64()).filter(pa.array(wanted))
                none = ~b.some[wanted]
                out = [ids, pa.array(b.lengths[wanted]), pa.array(loss[wanted, 1], mask=none), pa.array(loss[wanted, 0], mask=none)]
            return pa.table(out, names=["id", "n_tokens", "target_loss", "background_loss"])

        return blocks.drop("targets").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SCORES)


SCORES = "id long, n_tokens long, target_loss double, background_loss double"


def train(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_share: float = 0.0, discount: float = 0.75,
          block: int = ngram_counts.BLOCK, parts: int | None = None) -> Model | Counted:
    """The models over all documents (background) and over those whose id is in ``target_ids`` (its only column).

    Null ids are no target; null and empty texts count nothing; rows that are repeated count each time. Without any
    token both models give the unknown word probability one. All counts are exact over the whole corpus. Ids are integers.

    Tasks hold ``block`` tokens at a time, or one text if it is longer; counts are added up in ``parts`` parts (by default
    as many as the texts' size asks for). Small models (``least_share`` over 0) come to the driver, with at most
    1 / least_share rows by construction.
    """
    if least_share <= 0:
        return Counted(docs, target_ids, id_col, text_col, discount, block, parts)
    spark = docs.sparkSession
    texts = docs.select(column(text_col).alias("text"))
    counted = store(texts.mapInArrow(_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    tokens = float(counted.agg(F.sum("n")).first()[0] or 0)
    least = max(2.0, least_share * tokens)
    kept = counted.where(F.col("n") >= least).select("word").toPandas()["word"].to_numpy(np.int64).view(np.uint64)
    vocabulary = np.sort(kept)
    size = len(vocabulary)
    if size + 2 >= 1 << PLACE_BITS:
        raise ValueError("least_share must leave fewer words")

    # counts of both models in one pass; what is too rare is left out by the reducers
    target = target_ids.toDF("_target").where("_target IS NOT NULL").distinct()
    flagged = docs.select(column(id_col).alias("id"), column(text_col).alias("text")).join(target, F.col("id") == F.col("_target"), "left")
    flagged = flagged.select("text", F.col("_target").isNotNull().cast("int").alias("target"))
    partial = flagged.mapInArrow(_counts(spark.sparkContext.broadcast(vocabulary)), "key long, background long, target long")
    rows = partial.groupBy("key").agg(F.sum("background").alias("background"), F.sum("target").alias("target"))
    rows = rows.where((F.col("key") < 1 << PLACE_BITS) | (F.col("background") >= least)).toPandas().sort_values("key")
    key, n = rows["key"].to_numpy(np.int64), rows[["background", "target"]].to_numpy(float)
    of_word = np.zeros((size + 1, 2))
    single = key < 1 << PLACE_BITS
    of_word[key[single]] = n[single]
    words_ = {"key": vocabulary, "n": of_word[:size]}
    named = np.append(vocabulary, [np.uint64(0), START])
    before, word = named[(key[~single] >> PLACE_BITS) - 1], named[key[~single] & ((1 << PLACE_BITS) - 1)]
    bigrams = {"key": mixed(mixed(before) * _PAIR + word), "before": before, "word": word, "n": n[~single]}
    return Model(words_, bigrams, of_word.sum(0), _texts(docs, target, id_col, text_col), discount)


def _texts(docs: DataFrame, target: DataFrame, id_col: str, text_col: str) -> np.ndarray:
    """How many texts have words, in all and in the target."""
    some = docs.where(F.coalesce(column(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")).select(column(id_col).alias("id"))
    row = some.join(target, F.col("id") == F.col("_target"), "left").agg(F.count("*"), F.count("_target")).first()
    return np.array([row[0], row[1]], float)


def score(docs: DataFrame, model: Model | Counted, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, target_loss, background_loss, difference): mean negative log probabilities per token of whole texts.

    A low difference (target less background) means closer to the target. Texts without words have 0 tokens and null
    losses. A row for each row of ``docs``, null ids and repeated rows included.
    """
    if isinstance(model, Counted):
        return model.losses(docs, id_col, text_col).withColumn("difference", F.col("target_loss") - F.col("background_loss"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        known = WordHashes()
        for batch in batches:
            n, losses = [], []
            for text in batch.column(1).to_pylist():
                tokens = hashed(text, known)
                n.append(len(tokens))
                losses.append(-shared.value.log_probabilities(tokens).mean(0) if len(tokens) else (None, None))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, pa.int64()), pa.array([x[1] for x in losses], pa.float64()), pa.array([x[0] for x in losses], pa.float64()),
            ], names=["id", "n_tokens", "target_loss", "background_loss"])

    rows = docs.select(column(id_col).cast("long").alias("id"), column(text_col).alias("text"))
    out = rows.mapInArrow(run, SCORES)
    return out.withColumn("difference", F.col("target_loss") - F.col("background_loss"))
