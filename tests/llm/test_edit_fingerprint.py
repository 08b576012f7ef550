"""Edit fingerprints against the walk written out step by step."""

import hashlib
import random
import statistics

import numpy as np
import pytest
from helpers import frame, hostile_texts, rows

from brewlens.llm import edit_fingerprint as E

BITS = np.random.default_rng(E.SEED).integers(0, 2, (256, E.PERIOD), np.uint8)
BITS[:, -1] = 1


def plain_walk(text):
    """Character and the two before at each step."""
    read = list(E.classes(text))
    out, at, step = [], 0, 0
    while at < len(read):
        out.append((read[at], read[at - 1] if at else 0, read[at - 2] if at > 1 else 0))
        at += int(BITS[read[at], step % E.PERIOD])
        step += 1
    return out


def plain_fingerprint(text):
    steps, digits = plain_walk(text), ""
    for k in E.sampled_steps(len(steps)):
        a, b, c = steps[k]
        m = (a * 0x9E3779B1 + b * 0x85EBCA77 + c * 0xC2B2AE3D) % 2 ** 32
        digits += "%x" % ((m ^ m >> 15) * 0x2C1B3C6D % 2 ** 32 >> 28)
    return f"{len(steps):x}:{digits}"


def prose(r, n):
    return " ".join("".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(1, 9))) for _ in range(n))


def edited(text, edits, r):
    y = list(text)
    for _ in range(edits):
        p = r.randrange(len(y))
        y[p:p + r.randrange(2)] = r.choice(["", "q", "zz"])
    return "".join(y)


def test_walk_in_parts_equals_the_walk_step_by_step(monkeypatch):
    r = random.Random(3)
    texts = ["", "a", "ab", "日本 ß é\U0001F600", *[prose(r, n) for n in (3, 20, 90, 700)], "a" * 5000]
    for text in texts:
        assert E.fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(E, "CHUNK", 7)
    for text in texts:
        assert E.fingerprint(text) == plain_fingerprint(text)


def test_likeness_follows_the_edit_distance():
    r = random.Random(9)
    texts = [prose(r, 400) for _ in range(60)]
    means = [statistics.mean(E.likeness(E.fingerprint(t), E.fingerprint(edited(t, k, r))) for t in texts) for k in (0, 1, 8, 40)]
    assert means[0] == 1 and means[1] > 0.9 and means[2] > 0.6 and means == sorted(means, reverse=True)
    others = [E.likeness(E.fingerprint(a), E.fingerprint(b)) for a, b in zip(texts, texts[1:])]
    assert max(others) < 0.15 and min(others) >= 0
    assert E.likeness(E.fingerprint(""), E.fingerprint("")) == 1 and E.likeness(E.fingerprint(""), E.fingerprint("x")) == 0
    estimate = []
    for t in texts[:20]:                # the sampled share is near the share over all steps
        u = edited(t, 12, r)
        a, b = plain_walk(t), plain_walk(u)
        whole = sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))
        estimate.append(E.likeness(E.fingerprint(t), E.fingerprint(u)) - whole)
    assert abs(statistics.mean(estimate)) < 0.08 and max(map(abs, estimate)) < 0.25


def brute_compare(data):
    ordered = sorted(data, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or ""))
    out = []
    for k, (doc_id, text, *_) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(text)
        changed = text[:n - n // 2] + after[:n // 2]
        f, e, x = plain_fingerprint(text), plain_fingerprint(changed), plain_fingerprint(after)
        out.append((str(doc_id), n, hashlib.sha256(changed.encode()).hexdigest(), f, e, E.likeness(f, e), E.likeness(f, x)))
    return sorted(out)


@pytest.mark.parametrize("partitions", [1, 8, 40])
def test_compare_with_next_over_any_ranges(spark, partitions):
    r = random.Random(partitions)
    data = rows(hostile_texts()[:-1] + [prose(r, 150)] * 2)
    data += [(7, "same id, other text", "en", "s", 0), (None, "no id", "en", "s", 0), (None, None, "en", "s", 0), data[4]]
    r.shuffle(data)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = E.compare_with_next(frame(spark, data, clash=True)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted((str(g[0]), *g[1:7]) for g in got) == brute_compare(data)


def test_half_kept_is_nearer_than_another_text(spark):
    r = random.Random(4)
    data = rows([prose(r, 200) for _ in range(60)] + ["y" * 300_000])
    got = E.compare_with_next(frame(spark, data)).collect()
    assert all(0 <= g.near_next <= 1 and 0 <= g.near_edited <= 1 for g in got)
    usual = [g for g in got if g.doc_id < 59]
    assert all(g.near_edited > 0.3 > g.near_next for g in usual)
    assert sum(g.edited_banded for g in usual) > 50 and not any(g.next_banded for g in usual)


def test_search_finds_near_copies_and_verifies_them(spark):
    r = random.Random(6)
    base = [prose(r, 300) for _ in range(40)]
    near = [edited(t, 4, r) for t in base]
    data = rows(base + near + [base[0]] * 50)
    prints = E.fingerprints(frame(spark, data)).cache()
    queries = prints.filter("doc_id < 40")
    got = {(g.query_id, g.fingerprint): g for g in E.search(queries, prints).collect()}
    f = [E.fingerprint(d[1]) for d in data]
    wanted = {(i, f[j]) for i in range(40) for j in range(len(data)) if E.likeness(f[i], f[j]) >= 0.7}
    assert set(got) <= wanted and len(got) >= 0.9 * len(wanted)
    assert got[0, f[0]].n_docs == 51 and got[0, f[0]].likeness == 1


def test_single_row_and_empty_table(spark):
    one = E.compare_with_next(frame(spark, rows(["abcdef"]))).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
    assert E.compare_with_next(frame(spark, [])).count() == 0
    df = spark.createDataFrame([("b", "one"), ("a", "two")], "doc_id string, text string")
    assert {x.doc_id for x in E.compare_with_next(df).collect()} == {"a", "b"}
