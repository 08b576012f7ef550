"""Similarity join and entity creation against plain sequential loops."""

import difflib
import random

from pyspark.sql import functions as F

from brewlens.operators import link as L
from brewlens.plans import standins as S
from conftest import SMALL


def _norm(n):
    return n.lower().strip().replace("'", "").replace("-", " ")


def sequential(entities, probes, entity_type="roaster", create=True):
    """What each name resolves to, from the rule: an equal key of any type, else the
    earliest of the most similar keys of the type (above 0.85), else a new entity.

    The known keys are a list of (key, id, type) in the order they came; a key
    that comes again keeps its place and takes the later id and type."""
    known = []

    def learn(key, ident, kind):
        places = [i for i, k in enumerate(known) if k[0] == key]
        if places:
            known[places[0]] = (key, ident, kind)
        else:
            known.append((key, ident, kind))

    for e in sorted(entities, key=lambda e: e["id"]):
        for text in (e["name"], e["slug"]):
            learn(text.lower(), e["id"], e["entity_type"])
    by_slug = {e["slug"]: e["id"] for e in entities}
    answers = {}
    for probe, name in probes:
        wanted = _norm(name)
        equal = [ident for key, ident, _ in known if key == wanted]
        ranked = sorted(((-difflib.SequenceMatcher(None, wanted, key).ratio(), place, ident)
                         for place, (key, ident, kind) in enumerate(known) if kind == entity_type)) if not equal else []
        if equal:
            answers[probe] = equal[0]
        elif ranked and -ranked[0][0] > 0.85:
            answers[probe] = ranked[0][2]
        elif create:
            slug = name.lower().replace(" ", "-").replace("'", "")
            answers[probe] = by_slug.setdefault(slug, ("new", slug))
            learn(wanted, answers[probe], entity_type)
        else:
            answers[probe] = None
    return answers


def _groups(mapping):
    g = {}
    for pid, eid in mapping.items():
        g.setdefault(eid, set()).add(pid)
    return {frozenset(v) for v in g.values()}


def _inputs(spark):
    ents = [r.asDict() for r in S.entities_from_supplier(spark, SMALL).collect()]
    probes = [(r.probe_id, r.name) for r in S.name_probes_from_customer(spark, SMALL).orderBy("seq").collect()]
    return ents, probes


def test_fuzzy_match_equals_brute_force(spark):
    ents, probes = _inputs(spark)
    cache = L.entity_cache(S.entities_from_supplier(spark, SMALL))
    pr = S.name_probes_from_customer(spark, SMALL).withColumn("entity_type", F.lit("roaster"))
    got = {r.probe_id: r.entity_id for r in L.match_entities(pr, cache).collect()}
    want = {k: v for k, v in sequential(ents, probes, create=False).items() if v is not None}
    assert got == want


def test_create_entities_equals_sequential(spark):
    ents, probes = _inputs(spark)
    res = L.create_entities(S.name_probes_from_customer(spark, SMALL), S.entities_from_supplier(spark, SMALL))
    got = {r.probe_id: r.entity_id for r in res.collect()}
    want = sequential(ents, probes)
    existing = {e["id"] for e in ents}
    assert {p for p, e in got.items() if e in existing} == {p for p, e in want.items() if e in existing}
    assert all(got[p] == want[p] for p, e in want.items() if e in existing)
    assert _groups(got) == _groups(want)


def test_similarity_join_loses_no_pair_on_random_names(spark):
    rnd = random.Random(7)
    base = ["".join(rnd.choice("abc ") for _ in range(rnd.randint(3, 12))) for _ in range(60)]
    names = base + ["".join(ch for ch in b if rnd.random() > 0.1) for b in base]
    left = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "lid long, lstr string")
    right = spark.createDataFrame([(i, s) for i, s in enumerate(names)], "rid long, rstr string")
    got = {(r.lid, r.rid) for r in L.similarity_candidates(left, right).collect()}
    need = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names)
            if difflib.SequenceMatcher(None, a, b).ratio() > 0.85}
    assert need <= got


def test_creation_rounds_on_random_names(spark):
    rnd = random.Random(11)
    stems = ["blue bottle", "onyx", "stumptown", "heart", "verve", "sight glass"]
    names = []
    for _ in range(120):
        s = list(rnd.choice(stems))
        for _ in range(rnd.randint(0, 2)):
            i = rnd.randrange(len(s))
            s[i] = rnd.choice("aeiou '-")
        names.append("".join(s).strip() or "x")
    probes = [(i, n) for i, n in enumerate(names)]
    ents = [{"id": 1, "name": "Blue Bottle", "slug": "blue-bottle", "entity_type": "roaster"},
            {"id": 2, "name": "Onyx", "slug": "onyx", "entity_type": "cafe"}]
    edf = spark.createDataFrame(ents)
    pdf = spark.createDataFrame([(i, i, n) for i, n in probes], "probe_id long, seq long, name string")
    got = {r.probe_id: r.entity_id for r in L.create_entities(pdf, edf).collect()}
    want = sequential(ents, probes)
    assert all(got[p] == want[p] for p, e in want.items() if e in (1, 2))
    assert _groups(got) == _groups(want)


def test_long_chain_of_near_duplicates(spark):
    """Each name is near the one before it only: rounds go on to the end, no id is null."""
    text = "abcdefghijklmnopqrstuvwxyz0123456789"
    names = ["".join(text[(j + 3 * k) % 36] for j in range(20)) for k in range(14)]
    pdf = spark.createDataFrame([(i, i, n) for i, n in enumerate(names)], "probe_id long, seq long, name string")
    none = spark.createDataFrame([], "id long, name string, slug string, entity_type string")
    got = {r.probe_id: r.entity_id for r in L.create_entities(pdf, none).collect()}
    assert None not in got.values()
    assert _groups(got) == _groups(sequential([], list(enumerate(names))))


def test_each_distinct_name_is_scored_once(spark):
    names = [(i, ["blue botle", "onix coffee", "zzz"][i % 3], "roaster") for i in range(300)]
    probes = spark.createDataFrame(names, "probe_id long, name string, entity_type string")
    ents = spark.createDataFrame([(1, "Blue Bottle", "blue-bottle", "roaster"), (2, "Onyx Coffee", "onyx", "roaster")],
                                 "id long, name string, slug string, entity_type string")
    cache = L.entity_cache(ents)
    got = {r.probe_id: r.entity_id for r in L.match_entities(probes, cache).collect()}
    assert got == {i: 1 + i % 3 for i in range(300) if i % 3 < 2}
    p = probes.select(F.lower("name").alias("lid"), F.lower("name").alias("lstr")).distinct()
    k = cache.select(F.col("key").alias("rid"), F.col("key").alias("rstr"))
    assert L.similarity_candidates(p, k).count() <= 4        # of 3 names and 4 keys


def test_names_that_differ_in_letters_are_pruned(spark):
    p = spark.read.parquet(f"{SMALL}/part.parquet").select("p_partkey", "p_name")
    left = p.select(F.col("p_partkey").alias("lid"), F.expr("concat(substring(p_name, 1, 3), substring(p_name, 5))").alias("lstr"))
    right = p.select(F.col("p_partkey").alias("rid"), F.col("p_name").alias("rstr"))
    n = p.count()
    scored = L.scored_pairs(L.similarity_candidates(left, right), left, right)
    assert {r.lid for r in scored.where("lid = rid").collect()} == {r.p_partkey for r in p.collect()}
    assert L.similarity_candidates(left, right).count() < n * n / 2


def _invented(n, seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(9))
    return [f"{word()} {word()}" for _ in range(n)]


def test_candidates_of_unlike_names_do_not_grow_with_all_pairs(spark):
    """Names of which no two are alike: two bigrams meet in a third of all pairs, a long subsequence in hardly any."""
    names = _invented(400, 3)
    left = spark.createDataFrame([(i, s[:4] + s[5:]) for i, s in enumerate(names)], "lid long, lstr string")
    right = spark.createDataFrame(list(enumerate(names)), "rid long, rstr string")
    got = {(r.lid, r.rid) for r in L.similarity_candidates(left, right).collect()}
    assert {(i, i) for i in range(400)} <= got and len(got) < 2 * 400


def test_long_names_meet_by_bigrams(spark):
    """Lengths with too many signatures lose no pair either, beside lengths that have few."""
    rnd = random.Random(5)
    names = []
    for s in _invented(12, 9):
        for text in (s, s * 2 + s[:rnd.randint(0, 9)]):
            names += [text, *("".join(c for c in text if rnd.random() > p) for p in (0.03, 0.1, 0.15))]
    left = spark.createDataFrame(list(enumerate(names)), "lid long, lstr string")
    got = {(r.lid, r.rid) for r in L.similarity_candidates(left, left.toDF("rid", "rstr")).collect()}
    need = {(i, j) for i, a in enumerate(names) for j, b in enumerate(names) if difflib.SequenceMatcher(None, a, b).ratio() > 0.85}
    assert need <= got and len(need) > len(names)


def test_creation_where_a_near_name_is_a_follower(spark):
    """b follows a; c is very near b and not near a, so it leads though its nearest earlier name does not."""
    a = "abcdefghijklmnopqrstuvwxyzabcdef"
    chain = [a]
    for k in range(12):
        chain.append(chain[-1][:2 * k] + "0" + chain[-1][2 * k + 1:])
    pdf = spark.createDataFrame([(i, i, n) for i, n in enumerate(chain)], "probe_id long, seq long, name string")
    none = spark.createDataFrame([], "id long, name string, slug string, entity_type string")
    got = {r.probe_id: r.entity_id for r in L.create_entities(pdf, none).collect()}
    want = sequential([], list(enumerate(chain)))
    assert _groups(got) == _groups(want) and len(set(want.values())) > 1
