"""The stored name index: filing in parts equals one pass, and later parts tokenise their own names only."""

import os
import random

from brewlens.operators import link as L
from brewlens.operators import nameindex as NI


def noisy_entities(n, seed):
    r, out = random.Random(seed), []
    words = ["harbor", "coffee", "mill", "north", "roast", "river", "stone", "blue", "lantern", "copper"]
    for i in range(n):
        name = " ".join(r.sample(words, 3))
        if r.random() < 0.5:
            k = r.randrange(len(name))
            name = name[:k] + r.choice("aeiou") + name[k + 1:]
        out.append((i, name.title(), name.replace(" ", "-"), r.choice(["roaster", "cafe"])))
    return out


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_parts_equal_one_pass_and_only_new_names_are_tokenised(spark, tmp_path):
    entities = spark.createDataFrame(noisy_entities(60, 1), "id long, name string, slug string, entity_type string")
    cache = L.entity_cache(entities)
    total = cache.count()
    later = cache.where("pos_id >= 40")
    index = NI.NameIndex.create(cache.where("pos_id < 40"), str(tmp_path / "i"), buckets=8)
    before = files(tmp_path / "i" / "prefixes")
    first = index.keys.read().count()
    added = index.add(later)
    after = files(tmp_path / "i" / "prefixes")
    assert added == total - first and before.items() <= after.items()
    fresh = spark.read.schema("tok string, key string").parquet(*sorted(set(after) - set(before)))
    assert {r["key"] for r in fresh.select("key").distinct().collect()} <= {r["key"] for r in later.select("key").collect()}
    assert index.add(later) == 0 and files(tmp_path / "i" / "prefixes") == after

    r = random.Random(5)
    probes = [(i, n[1] if i % 4 == 0 else n[1][:i % 7] + n[1][i % 7 + 1:], r.choice(["roaster", "cafe"]))
              for i, n in enumerate(noisy_entities(60, 1) + noisy_entities(30, 9))]
    probes = spark.createDataFrame(probes + [(900, "", "cafe"), (901, None, "cafe")], "probe_id long, name string, entity_type string")
    want = sorted(map(tuple, L.match_entities(probes, cache).collect()))
    got = sorted(map(tuple, NI.NameIndex(spark, str(tmp_path / "i")).match(probes).collect()))
    assert got == want and len(want) >= 40
    names = probes.selectExpr("lower(name) AS key").dropna()
    assert index.candidates(names).count() < names.count() * total


def test_an_index_of_nothing_takes_names_later(spark, tmp_path):
    cache = L.entity_cache(spark.createDataFrame(noisy_entities(5, 2), "id long, name string, slug string, entity_type string"))
    index = NI.NameIndex.create(cache.limit(0), str(tmp_path / "i"), buckets=4)
    probe = spark.createDataFrame([(1, noisy_entities(5, 2)[0][1], "cafe")], "probe_id long, name string, entity_type string")
    assert index.match(probe).count() == 0
    index.add(cache)
    assert [r["method"] for r in index.match(probe).collect()] == ["exact"]


def test_unlike_names_are_not_compared(spark, tmp_path):
    """Of names no two of which are alike, each meets hardly any key but its own."""
    r = random.Random(3)
    names = ["".join(r.choice("abcdefghijklmnop") for _ in range(19)) for _ in range(200)]
    cache = spark.createDataFrame([(n, i, "cafe", i, 0) for i, n in enumerate(names)],
                                  "key string, entity_id long, entity_type string, pos_id long, pos_p int")
    index = NI.NameIndex.create(cache, str(tmp_path / "i"), buckets=4)
    asked = spark.createDataFrame([(n[:5] + n[6:],) for n in names], "key string")
    got = {(row["lid"], row["rid"]) for row in index.candidates(asked).collect()}
    assert {(n[:5] + n[6:], n) for n in names} <= got and len(got) < 2 * len(names)
