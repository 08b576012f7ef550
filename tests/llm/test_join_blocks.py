"""No task of a large region gets more than a region may hold, however wide the ring around a text is."""

from helpers import frame, rows
from pyspark.sql import functions as F

from brewlens.llm import ngram_join


def test_blocks_are_bounded_and_whole(spark):
    members = spark.range(2000).select(F.lit(1).cast("long").alias("region"), F.col("id").alias("set_id"),
                                       F.lit(10).cast("long").alias("n"), F.lit(1).cast("long").alias("weight"),
                                       F.array(*[F.lit(k).cast("long") for k in range(10)]).alias("shingles"))
    dealt = ngram_join.blocks(members, ngram_join.Settings(region_shingles=4000)).collect()
    tasks = {}
    for r in dealt:
        tasks.setdefault((r["home_block"], r["other_block"]), []).append(r)
    assert len(tasks) == 100 and max(len(t) for t in tasks.values()) * 10 <= 1.2 * 4000
    assert sum(r["home"] for r in dealt) == 2000 * 10                 # every set meets every block
    for (i, j), t in tasks.items():
        assert any(r["home"] for r in t) and any(r["other"] for r in t)


def test_template_with_a_wide_ring(spark):
    base = [f"x{i}" for i in range(120)]
    texts = [" ".join(base[:k % 90] + [f"y{k}z{j}" for j in range(12)] + base[k % 90 + 12:]) for k in range(80)]
    docs = frame(spark, rows(texts))
    want = sorted(tuple(r) for r in ngram_join.join(docs).collect())
    assert sorted(tuple(r) for r in ngram_join.join(docs, ngram_join.Settings(region_shingles=1500)).collect()) == want
