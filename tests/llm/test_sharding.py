import hashlib

from pyspark.sql import functions as F

from tradewake.llm.sharding import assign, write_shards


def shards(df):
    out = {}
    for r in df.collect():
        out.setdefault((r["shard"], r["depth"], r["shard_bytes"], r["shard_rows"]), []).append(r)
    return out


def test_limits_prefixes_and_least_splits(frame):
    rows = [(k, "x" * (k * 37 % 211)) for k in range(500)]
    got = shards(assign(frame(rows, "doc_id long, text string"), limit_bytes=1000))
    names = sorted(name for name, *_ in got)
    assert not any(b.startswith(a) for a in names for b in names if a != b)
    bits = {k: f"{int(hashlib.md5(str(k).encode()).hexdigest()[:10], 16):040b}" for k, _ in rows}
    for (name, depth, size, n), held in got.items():
        assert size == sum(len(r["text"]) for r in held) <= 1000 and n == len(held) and depth == len(name)
        assert all(bits[r["doc_id"]].startswith(name) for r in held)
        assert sum(len(t) for k, t in rows if bits[k].startswith(name[:-1])) > 1000  # what it was split from did not fit


def test_one_key_large_rows_nulls_and_empty(frame):
    rows = [(7, "y" * 100, "a")] * 60 + [(8, "z" * 5000, "b"), (None, None, None), (None, "", "c")]
    got = shards(assign(frame(rows, "doc_id long, text string, shard string"), limit_bytes=1000))
    assert sum(map(len, got.values())) == 63
    assert all(size <= 1000 or n == 1 for _, _, size, n in got)
    assert assign(frame([], "doc_id long, text string")).collect() == []
    assert {k[:2] for k in shards(assign(frame(rows[:3], "doc_id long, text string, depth string")))} == {("", 0)}


def test_other_size_and_files(frame, spark, tmp_path):
    docs = frame([(k, "t", k % 7) for k in range(100)], "key long, text string, w int")
    assert all(size <= 20 for _, _, size, _ in shards(assign(docs, "key", F.col("w"), 20)))
    write_shards(docs, str(tmp_path / "out"), key_col="key", size=F.col("w"), limit_bytes=20)
    back = spark.read.option("basePath", str(tmp_path / "out")).schema("key long, shard string").parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() > 10
