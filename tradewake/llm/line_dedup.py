"""Line deduplication: lines that many documents share stay in one of them.

Built from explode, hash, distinct count and reassembly by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.llm.frames import column, store

#: The characters stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: F.Column) -> F.Column:
    """The line without blanks at its ends, A-Z lower-cased (other letters keep their case)."""
    bare = F.btrim(line, F.lit(BLANKS))
    plain = F.octet_length(bare) == F.char_length(bare)
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the text that is left, and n_lines and n_dropped; all other columns are kept.

    A text is split at line feeds; a null or empty text is one empty line and comes back as it was. A line's key
    (``line_key``) counts if it has at least ``min_chars`` code points. A key found in at least ``min_docs`` documents
    loses its lines everywhere except in the document with the largest id among those that hold it, where all of them
    stay. Rows with the same id are one document. Rows with a null id hold no key and keep every line. Columns named
    n_lines or n_dropped are replaced. An empty table gives an empty result.

    Keys travel as 128-bit hashes with row identity (id, hash of the text) and line positions, not as text. A key held by
    a large part of all documents is combined before it is counted, and the join back is one that adaptive execution can
    split. Memory in a task is bounded by one document.
    """
    text = F.coalesce(column(text_col), F.lit(""))
    rows = docs.withColumns({"_ld_lines": F.split(text, "\n"), "_ld_text": F.xxhash64(text)})
    keys = (
        rows.where(column(id_col).isNotNull() & (F.char_length(text) >= min_chars))
        .select(column(id_col).alias("id"), F.col("_ld_text").alias("text"), F.posexplode("_ld_lines").alias("pos", "line"))
        .where(F.char_length("line") >= min_chars)
        .select("id", "text", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", "text", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )
    keys = store(keys, "line-keys")
    common = (
        keys.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("holders"), F.max("id").alias("keeper"))
        .where(F.col("holders") >= min_docs)
    )
    common = store(common, "line-common")
    drops = (
        keys.join(common, ["h1", "h2"]).where("id != keeper")
        .groupBy(F.col("id").alias("_ld_id"), F.col("text").alias("_ld_text")).agg(F.collect_set("pos").alias("_ld_drop"))
    )
    n = F.size("_ld_lines")
    every = F.sequence(F.lit(0), n - 1)
    left = F.transform(F.array_except(every, F.col("_ld_drop")), lambda p: F.get(F.col("_ld_lines"), p))
    hit = F.col("_ld_drop").isNotNull()
    return (
        rows.withColumn("_ld_id", column(id_col)).join(drops, ["_ld_id", "_ld_text"], "left")
        .withColumns({
            text_col: F.when(hit, F.array_join(left, "\n")).otherwise(column(text_col)),
            "n_lines": n.cast("long"),
            "n_dropped": F.coalesce(F.size("_ld_drop"), F.lit(0)).cast("long"),
        })
        .select(*[column(c) for c in docs.columns if c not in ("n_lines", "n_dropped")], "n_lines", "n_dropped")
    )
