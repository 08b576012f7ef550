"""Dedup, similarity join, mixing and packing against plain Python."""

import itertools
import random
from collections import Counter

import pytest
from helpers import doc_words, frame, hostile_texts, rows

from brewlens.llm import digest_index, mixing, ngram_join, packing
from brewlens.llm.components import components


# ------------------------------------------------------------------ components
def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(5)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(300, 300), (400, 401), (401, 400)] + [(r.randrange(500, 600), r.randrange(500, 600)) for _ in range(60)]
    r.shuffle(edges)
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {n: c for n, c in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ similarity join
def brute_join(data, percent=80, size=5):
    sets = []
    for _, text, *_ in data:
        w = doc_words("".join(c.lower() if c.isascii() else c for c in text or ""))
        sets.append({tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    parent = list(range(len(data)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, j in itertools.combinations(range(len(data)), 2):
        both = len(sets[i] & sets[j])
        if sets[i] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and None not in (data[i][0], data[j][0]):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(data):
        if d[0] is not None:
            least[find(i)] = min(least.get(find(i), d[0]), d[0])
    return sorted((str(d[0]), len(s), str(least[find(i)] if d[0] is not None else None))
                  for i, (d, s) in enumerate(zip(data, sets)))


def near_copies(seed, groups=12, most=14):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = " ".join(r.choice(vocabulary) for _ in range(30))       # shared by many texts
    texts = []
    for g in range(groups):
        base = [r.choice(vocabulary) for _ in range(r.choice([4, 6, 9, 15, 30, 60, 150]))]
        for _ in range(r.randrange(1, most)):
            w = list(base)
            for _ in range(r.randrange(0, 1 + len(w) // 20)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w) + (" " + passage if r.random() < 0.4 else ""))
    return texts


@pytest.mark.parametrize("settings", [
    ngram_join.Settings(),
    ngram_join.Settings(region_shingles=150),                # regions are settled by jobs
    ngram_join.Settings(cell_members=3, pivots=2),           # regions are cut into cells
])
def test_join_finds_every_link(spark, settings):
    data = rows(near_copies(1) + hostile_texts()[:-1])
    data += [data[20], (None, data[20][1], "en", "s", 0)]    # a repeated row, and one without id
    out = ngram_join.join(frame(spark, data, True), settings).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute_join(data)


def test_join_with_common_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "COMMON_LEAST", 2)
    monkeypatch.setattr(ngram_join, "COMMON_MOST", 300)
    data = rows(near_copies(2, groups=16))
    out = ngram_join.join(frame(spark, data)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in out) == brute_join(data)


def test_join_of_one_large_group(spark):
    base = [f"x{i}" for i in range(120)]
    texts = [" ".join(base[:k % 117] + [f"y{k}"] + base[k % 117 + 1:]) for k in range(300)]
    out = ngram_join.join(frame(spark, rows(texts)), ngram_join.Settings(region_shingles=4000)).collect()
    assert {r["component_id"] for r in out} == {0} and len(out) == 300


def test_join_of_nothing_and_dedup_columns(spark):
    assert ngram_join.join(frame(spark, [])).count() == 0
    docs = frame(spark, rows(["a b c d e f"] * 3 + ["z"] + [None]), True)
    left = ngram_join.deduplicate(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [0, 3, 4]


# ------------------------------------------------------------------ exact dedup
def test_exact_dedup_decisions(spark):
    data = rows(hostile_texts()) + [(None, "w", "en", "s", 0), (None, "w", "en", "s", 0), (900, "tie", "en", "s", 0), (900, "tie", "en", "s", 0)]
    got = digest_index.decisions(frame(spark, data, True)).collect()
    groups = {}
    for i, t, *_ in data:
        groups.setdefault(t or "", []).append(i)
    assert len(got) == len(data)
    for r, text in ((r, t) for t, ids in groups.items() for r in got if r["doc_id"] in ids and r["doc_id"] is not None):
        keep = max(i for i in groups[text] if i is not None)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, len(groups[text]), r["doc_id"] == keep)
    left = digest_index.deduplicate(frame(spark, data, True))
    assert Counter(r["text"] or "" for r in left.collect()) == Counter({t: 2 if t == "w" else 1 for t in groups})
    assert digest_index.decisions(frame(spark, [])).count() == 0


def test_index_persists_and_repeats_add_nothing(spark, tmp_path):
    path = str(tmp_path / "index")
    first, second = rows(["a", "b", "b", "c"]), rows(["c", "d", "d", None], 10)
    a = {r["doc_id"]: r["kept"] for r in digest_index.decisions(frame(spark, first), path).collect()}
    index = digest_index.DigestIndex(spark, path)
    size = index.table().count()
    index.close()                                              # as a later session would, open it by its path
    b = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in digest_index.decisions(frame(spark, second), path).collect()}
    again = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in digest_index.decisions(frame(spark, second), path).collect()}
    assert a == {0: True, 1: False, 2: True, 3: True}
    assert b == again == {10: (3, False), 11: (12, False), 12: (12, True), 13: (13, True)}
    assert size == 3
    index = digest_index.DigestIndex(spark, path)
    assert index.table().count() == 5
    index.close()


def test_a_reopened_index_keeps_its_layout(spark, tmp_path):
    path, data = str(tmp_path / "index"), rows([f"text {i}" for i in range(200)])
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    tables = {t.name for t in spark.catalog.listTables()}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        for partitions in (8, 16, 3):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            out = digest_index.decisions(frame(spark, data), path).collect()
            assert len(out) == 200 and all(r["kept"] and r["group_size"] == 1 for r in out)
            index = digest_index.DigestIndex(spark, path)
            assert index.buckets == 8 and index.table().count() == 200
            plan = index.table().hint("merge")._jdf.queryExecution().executedPlan().toString()
            assert "Bucketed: true" in plan or "bucket" in plan.lower()
            index.close()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {t.name for t in spark.catalog.listTables()} == tables       # no name is left behind
    with pytest.raises(ValueError, match="bigint"):
        digest_index.decisions(spark.createDataFrame([("x", "t")], "doc_id string, text string"), path)


def test_appending_merges_without_broadcast(spark, tmp_path):
    index = digest_index.DigestIndex(spark, str(tmp_path / "index"))
    groups = digest_index.digests(frame(spark, rows(["a", "b"]))).groupBy("digest").count()
    plan = groups.join(index.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    index.close()


# ------------------------------------------------------------------ mixing
def shares_wanted(have, exponent, budget):
    """Tokens to draw of each value: tempered shares, values that run short give all they have."""
    total, short = budget * sum(have.values()), set()
    while True:
        rest = {v: n ** exponent for v, n in have.items() if v not in short}
        scale = (total - sum(have[v] for v in short)) / sum(rest.values())
        more = {v for v in rest if rest[v] * scale > have[v]}
        if not more:
            return {v: have[v] if v in short else rest[v] * scale for v in have}
        short |= more


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_raking_meets_every_target_with_production_parameters(spark, seed):
    r = random.Random(seed)
    cells = [(s, l, t, int(10 ** r.uniform(0, 5))) for s in ("a", "b", None, "rare") for l in ("en", "de") for t in ("x", "y", "z")]
    df = spark.createDataFrame(cells, "source string, lang string, topic string, n_tokens long")
    fitted = mixing.cell_probabilities(df, mixing.DIMENSIONS, mixing.BUDGET).collect()
    tokens = {c[:3]: c[3] for c in cells}
    drawn = {(c["cell_source"], c["cell_lang"], c["cell_topic"]): c["probability"] * tokens[c[0], c[1], c[2]] for c in fitted}
    assert all(0 < c["probability"] <= 1 for c in fitted) and (seed != 4 or any(c["probability"] == 1 for c in fitted))
    for k, e in enumerate(mixing.DIMENSIONS.values()):
        have, got = Counter(), Counter()
        for c, n in tokens.items():
            have[c[k]] += n
            got[c[k]] += drawn[c]
        for v, target in shares_wanted(have, e, mixing.BUDGET).items():
            assert got[v] == pytest.approx(target, rel=1e-3)


def test_targets_that_cannot_be_met_together_end(spark):
    # all of source a is in topic x, which is to be drawn less often than a
    cells = [("a", "x", 1000), ("b", "x", 10), ("b", "y", 100_000)]
    df = spark.createDataFrame(cells, "source string, topic string, n_tokens long")
    got = mixing.cell_probabilities(df, {"source": 0.1, "topic": 1.0}, 0.5).collect()
    assert len(got) == 3 and all(0 <= c["probability"] <= 1 for c in got)


def test_shares_of_the_given_documents(spark):
    out = mixing.mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).toPandas()
    out["drawn"] = out["n_tokens"] * out["probability"]
    for d, e in mixing.DIMENSIONS.items():
        sums = out.groupby(d)[["n_tokens", "drawn"]].sum()
        wanted = shares_wanted(sums["n_tokens"].to_dict(), e, mixing.BUDGET)
        for v in wanted:
            assert sums["drawn"][v] == pytest.approx(wanted[v], rel=1e-3)


def test_mix_draws_by_probability(spark):
    texts = ["word " * (5 + i % 400) for i in range(600)] + [None, ""]
    data = [(i, t, ["en", "de", None][i % 3], "hot" if i % 3 else f"s{i % 5}", 0) for i, t in enumerate(texts)]
    docs = frame(spark, data, True)
    out = mixing.mix(docs).collect()
    assert len(out) == len(data) and {r["doc_id"] for r in out} == set(range(len(data)))
    tokens = sum(r["n_tokens"] for r in out)
    expected = sum(r["n_tokens"] * r["probability"] for r in out)
    assert expected == pytest.approx(0.6 * tokens, rel=1e-3)
    drawn = sum(r["n_tokens"] for r in out if r["kept"])
    assert drawn == pytest.approx(expected, rel=0.1)
    sampled = mixing.sample(docs)
    assert sampled.columns == docs.columns
    assert {r["doc_id"] for r in sampled.collect()} == {r["doc_id"] for r in out if r["kept"]}
    assert mixing.mix(frame(spark, [])).count() == 0 and mixing.sample(frame(spark, [])).count() == 0


# ------------------------------------------------------------------ packing
def brute_best_fit(sized, capacity, per_source):
    bins, where = [], []
    for size, source, cluster in sized:
        fits = [(room, b) for b, (room, inside) in enumerate(bins) if room >= size
                and sum(s == source for s, _ in inside) < per_source and not any(c == cluster >= 0 for _, c in inside)]
        if fits:
            b = min(fits)[1]
        else:
            b = len(bins)
            bins.append([capacity, []])
        bins[b][0] -= size
        bins[b][1].append((source, cluster))
        where.append(b)
    return where


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_finds_the_tightest_compatible_bin(seed):
    r = random.Random(seed)
    sized = [(r.randrange(1, 100), min(r.randrange(9), 4), r.choice([-1, -1, 0, 1, 2])) for _ in range(400)]
    if seed % 2:
        sized.sort(reverse=True)
    assert packing.best_fit(sized, 100, 3) == brute_best_fit(sized, 100, 3)


def test_packing_places_every_token_once(spark):
    texts = [*hostile_texts(), *["copy of a text " * 9] * 120]
    data = [(i, t, "en", "hot" if i % 3 else None, 0) for i, t in enumerate(texts)] + [(5, "same id", "en", "s", 0), (None, "x", "en", "s", 0)]
    out = packing.pack_documents(frame(spark, data, True), capacity=300, per_source=4, shard_docs=64).collect()
    need = Counter()
    for d in data:
        need[d[0]] += len(doc_words(d[1])) + 1
    got, bins = Counter(), {}
    for r in out:
        got[r["doc_id"]] += r["n_tokens"]
        bins.setdefault(r["bin_id"], []).append(r)
    assert got == need
    for inside in bins.values():
        assert sum(r["n_tokens"] for r in inside) <= 300
        assert max(Counter(r["source"] for r in inside).values()) <= 4
        assert max(Counter(r["cluster"] for r in inside).values()) == 1
    assert packing.pack_documents(frame(spark, [])).count() == 0


