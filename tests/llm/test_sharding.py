from zlib import crc32

from pyspark.sql import functions as F

from weftlink.llm.sharding import place_heavy, shard

from .conftest import prose


def test_shards(spark):
    rows = [(k, prose(k % 150, 1 + k % 40) if k % 9 else None, ["en", "de", None][k % 3], f"s{k % 4}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = shard(df).collect()
    texts = {k: t or "" for k, t, _, _ in rows}
    assert sorted(r.doc_id for r in got) == sorted(texts)
    shards, sizes, homes = {}, [0] * 8, {}
    for r in got:
        t = texts[r.doc_id]
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(t.encode()) + 1, crc32(t.encode()), "bytes", None)
        shards.setdefault(r.shard, []).append(r.slot)
        homes.setdefault(t, set()).add(r.shard)
        sizes[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert all(len(s) == 1 for s in homes.values())
    assert max(sizes) < 1.15 * min(sizes)  # a group is up to 3 % of a shard here


def test_hot_group_is_dealt(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "x" * 50).otherwise(F.concat(F.lit("y" * 40), "id")).alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"))
    sizes = [r["n"] for r in shard(df).groupBy("shard").agg(F.sum("size").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) < 1.1 * min(sizes)


def test_oddities(odd, none):
    assert shard(odd).count() == odd.count()
    assert shard(none).count() == 0


def test_place_heavy():
    parts, room = place_heavy([(1, 250), (2, 30), (3, 90)], 4, 100.0)
    assert [s for _, s in parts[2]] != [s for _, s in parts[3]] and len(parts[2]) == 1
    assert len(parts[1]) == 3 and parts[1][-1][0] == 1.0 and min(room) >= 0
