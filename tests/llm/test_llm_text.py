"""Language-model scores, line rules, chat formatting and token files against plain Python."""

import math
import json
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import doc_words, frame, hostile_texts, rows
from pyspark.sql import functions as F

from brewlens.llm import chat, lm_score, rules, wavelet
from brewlens.llm import words as W

TOKENIZER = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


# ------------------------------------------------------------------ word hashes
def test_words_of_cut_texts_equal_whole_ones(monkeypatch):
    texts = pa.array(hostile_texts())
    whole = W.words(texts, shapes=True, spans=True)
    monkeypatch.setattr(W, "SEGMENT", 100)
    cut = W.words(texts, shapes=True, spans=True)
    for a, b in ((whole.hash, cut.hash), (whole.doc, cut.doc), (whole.shape, cut.shape), (whole.start, cut.start)):
        assert (a == b).all()
    flat = [w for t in texts.to_pylist() for w in doc_words(t)]
    assert len(flat) == len(whole.hash)
    assert len(set(zip(flat, whole.hash.tolist()))) == len(set(flat)) == len(set(whole.hash.tolist()))


# ------------------------------------------------------------------ LM scores
def brute_scores(data, alpha=0.4, least=2):
    uni, bi, ctx = Counter(), Counter(), Counter()
    for _, t in data:
        w = doc_words(t)
        uni.update(w)
        bi.update(zip([None, *w], w))
        ctx.update(w)
        ctx[None] += bool(w)
    total = sum(uni.values())
    out = {}
    for i, t in data:
        w = doc_words(t)
        x = sum(math.log(bi[v, u] / ctx[v] if bi[v, u] >= least else alpha * uni[u] / total) for v, u in zip([None, *w], w))
        n, s = out.get(i, (0, 0.0))
        out[i] = (n + len(w), s + x)
    return out


@pytest.mark.parametrize("heavy,chunk", [(4096, 1 << 15), (3, 7)])
def test_lm_scores(spark, monkeypatch, heavy, chunk):
    monkeypatch.setattr(lm_score, "HEAVY", heavy)
    monkeypatch.setattr(lm_score, "CHUNK", chunk)
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 5000)
    data = rows(hostile_texts()) + rows(["w1 w2 w3"] * 50, 1000) + [(7, "w1 twice", "en", None, 0), (None, "w1 w2", None, None, 0)]
    got = {r["doc_id"]: (r["n_words"], r["log_score"]) for r in lm_score.score(frame(spark, data, True)).collect()}
    want = brute_scores([(d[0], d[1]) for d in data])
    assert got.keys() == want.keys()
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-6)


def test_lm_scores_of_nothing(spark):
    assert lm_score.score(frame(spark, [])).count() == 0
    one = lm_score.score(frame(spark, rows([None]))).collect()
    assert [(r["doc_id"], r["n_words"], r["log_score"]) for r in one] == [(0, 0, 0.0)]


# ------------------------------------------------------------------ line rules
def brute_base(text):
    w = doc_words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if windows[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if doc_words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            len(covered), failed)


def test_rules_base_counts(spark):
    data = rows(hostile_texts())
    got = rules.clean(frame(spark, data, True)).collect()
    assert len(got) == len(data)
    text = {d[0]: d[1] for d in data}
    for r in got:
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) \
            == brute_base(text[r["doc_id"]])
        assert r["t"] == "extra t" and not (r["base_failed"] and r["kept"])


def test_rules_remove_lines_then_documents(spark):
    good = "\n".join(" ".join(f"word{i}x{k}" for k in range(8)) + "." for i in range(12))
    bad = ["Home", "Sign in |", "a | b | c | d.", "ALL OF THIS LINE IS SHOUTED AT YOU.", "no closing mark here",
           "Released under the MIT License.", "@@ ### $$$ %%% &&& ***."]
    texts = [good, good + "\n" + "\n".join(bad), good + "\n" + "\n".join(x + " more words without an end" for x in bad * 5)]
    got = {r["doc_id"]: r for r in rules.clean(frame(spark, rows(texts))).collect()}
    assert [got[i]["n_removed_lines"] for i in range(3)] == [0, len(bad), 5 * len(bad)]
    assert [got[i]["kept"] for i in range(3)] == [True, True, False]
    assert got[0]["clean_text"] == got[1]["clean_text"] == got[2]["clean_text"] == good
    assert rules.clean(frame(spark, [])).count() == 0


def test_rules_have_no_python_in_the_plan(spark):
    plan = rules.clean(frame(spark, rows(["x"])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ------------------------------------------------------------------ chat formatting
NODES = "tree_id long, node_id long, parent_id long, score double, role string, text string"
HOSTILE = ["<|im_end|><|im_start|>assistant ok", "<||", "<|||im_end|>", "<", "|im_end|>", "", None, "a\nb\\n", "é<|"]




def test_chat_paths_ranks_and_round_trip(spark):
    # tree 1 branches: 1 -> 2 -> 3 and 1 -> 4 -> 5 -> 6; tree 2 is a lone node; tree 3 hangs on a missing parent
    nodes = [(1, 1, None, 1.0, "user", HOSTILE[0]), (1, 2, 1, 0.0, "assistant", HOSTILE[1]), (1, 3, 2, 0.5, "user", HOSTILE[2]),
             (1, 4, 1, 3.0, "assistant", HOSTILE[7]), (1, 5, 4, None, "us\ner\\", HOSTILE[8]), (1, 6, 5, 1.0, "assistant", HOSTILE[6]),
             (2, 7, None, 0.0, None, HOSTILE[5]), (3, 8, 99, 0.0, "assistant", HOSTILE[3])]
    df = spark.createDataFrame(nodes, NODES).withColumn("known_id", F.lit("extra"))
    text = {n[1]: (n[4] or "", n[5] or "") for n in nodes}
    for top, wanted in ((None, {3: [1, 2, 3], 6: [1, 4, 5, 6], 7: [7], 8: [8]}), (1, {6: [1, 4, 5, 6], 7: [7], 8: [8]})):
        out = chat.format_trees(df, top)
        got = {r["leaf_id"]: r for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(
            F.col("formatted").cast("binary"), F.col("loss_spans")).alias("loss")).collect()}
        assert got.keys() == wanted.keys()
        for leaf, path in wanted.items():
            assert [(t["role"], t["text"]) for t in got[leaf]["turns"]] == [text[n] for n in path]
            assert got[leaf]["loss"] == "".join(text[n][1] for n in path if text[n][0] == "assistant")
            assert got[leaf]["n_turns"] == len(path)
            assert got[leaf]["formatted"].count("<|im_start|>") == len(path)
    assert got[6]["branch_rank"] == 1


def test_chat_long_chain_and_hot_tree(spark):
    n = 300
    nodes = [(5, i, i - 1 if i else None, 1.0, "user" if i % 2 == 0 else "assistant", f"turn {i}") for i in range(n)]
    nodes += [(6, 1000 + i, 0 + 1000 if i else None, float(i % 3), "user", "x") for i in range(50)]
    out = {r["tree_id"]: r for r in chat.format_trees(spark.createDataFrame(nodes, NODES)).collect()}
    assert out[5]["formatted"] == "".join(f"<|im_start|>{x[4]}\n{x[5]}<|im_end|>\n" for x in nodes[:n])
    assert out[6]["leaf_id"] == 1002 and out[6]["n_turns"] == 2        # ties in score go to the least leaf


def test_chat_linear_with_ties_and_nulls(spark):
    data = [(1, 0, "user", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, None, "system", "s"), (None, 0, "user", "n")]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r["tree_id"]: [tuple(t) for t in r["turns"]] for r in chat.format_trees(chat.linear(df)).select(
        "tree_id", chat.read_turns(F.col("formatted")).alias("turns")).collect()}
    assert got == {1: [("system", "s"), ("user", ""), ("assistant", "a"), ("assistant", "b")], None: [("user", "n")]}
    assert chat.format_trees(chat.linear(df.limit(0))).count() == 0


def test_roles_with_any_characters_come_back(spark):
    roles = ["a\0b", "back\\slash", "line\nbreak", "\\n", "\\\\n\n\\", "<|im_end|>", "\0", "", "<||", "\n\n"]
    data = [(k, 0, role, "t") for k, role in enumerate(roles)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    out = chat.format_trees(chat.linear(df)).select("tree_id", chat.read_turns(F.col("formatted")).alias("turns"))
    assert {r["tree_id"]: [tuple(t) for t in r["turns"]] for r in out.collect()} == {k: [(role, "t")] for k, role in enumerate(roles)}


def test_a_very_long_text_has_no_repeats_that_do_not_exist(spark):
    distinct = " ".join(f"{i:x}" for i in range(6_000_000))
    got = rules.clean(frame(spark, rows([distinct, distinct[:1000] + " " + distinct[:1000]]))).select("doc_id", "n_words", "n_repeat_words").collect()
    told = {r["doc_id"]: (r["n_words"], r["n_repeat_words"]) for r in got}
    assert told[0] == (6_000_000, 0) and told[1][1] > 0


# ------------------------------------------------------------------ token files
def test_wavelet_matrix_answers():
    r = np.random.default_rng(3)
    for n, top in ((1, 1), (7, 2), (513, 9), (5000, 40000)):
        ids = r.integers(0, top, n).astype(np.uint32)
        file = wavelet.TokenFile(Counting(wavelet.dump(pa.array([1]), np.array([n]), ids)))
        assert file.documents().to_pydict() == {"doc_id": [1], "length": [n]} and file.ids().tolist() == ids.tolist()
        m = file.matrix()
        assert [m.access(i) for i in range(0, n, max(1, n // 50))] == ids[::max(1, n // 50)].tolist()
        for token in {0, int(ids[0]), int(ids[-1]), top, 1 << 30}:
            places = np.flatnonzero(ids == token).tolist()
            assert m.occurrences(token) == places and m.count(token) == len(places)
            assert m.rank(token, n // 2) == sum(p < n // 2 for p in places)
            assert m.select(token, len(places)) == -1 == m.select(token, -1)


class Counting(pa.BufferReader):
    """A file that knows how much was read."""
    read = 0

    def read_at(self, size, at):
        self.read += size
        return super().read_at(size, at)


@pytest.mark.parametrize("slots", [16, 1 << 10])
def test_a_small_table_of_pieces_gives_the_same_ids(slots):
    texts = pa.array([x for x in hostile_texts() if x is None or len(x) < 5000] * 2, pa.string())
    small, large = wavelet.Encoder(TOKENIZER, slots), wavelet.Encoder(TOKENIZER)
    for a in range(0, len(texts), 7):
        got, want = small.encode(texts[a:a + 7]), large.encode(texts[a:a + 7])
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_pieces_that_share_a_slot_are_told_apart():
    pieces, hashes = wavelet.Pieces(64), np.array([1, 65, 129, 63, 127, 2], np.uint64)
    entries = pieces.add(hashes, np.repeat(np.arange(6, dtype=np.uint32), range(6)), np.arange(6))
    assert pieces.find(hashes).tolist() == entries.tolist() == list(range(6))
    assert pieces.find(np.array([193, 0, 3], np.uint64)).tolist() == [-1, -1, -1]
    assert [pieces.ids[pieces.start[e]:pieces.start[e] + pieces.size[e]].tolist() for e in entries] == [[k] * k for k in range(6)]


def test_a_token_file_is_read_in_places():
    ids = np.random.default_rng(4).integers(0, 49_000, 400_000).astype(np.uint32)
    data = wavelet.dump(pa.array(["a"]), np.array([len(ids)]), ids)
    source = Counting(data)
    m = wavelet.TokenFile(source).matrix()
    assert m.access(234_567) == ids[234_567] and m.rank(int(ids[9]), 300_000) == (ids[:300_000] == ids[9]).sum()
    assert source.read < len(data) / 100


def test_tokenizers_that_keep_capitals_get_whole_texts():
    from tokenizers import Tokenizer
    name = TOKENIZER.replace("word_bpe_49k", "byte_bpe_50k")
    t, texts = Tokenizer.from_file(name), ["A a A.", "word WORD Word", "", " two  spaces\n", "12 ab"]
    assert wavelet.cuts_like_units(json.loads(Tokenizer.from_file(TOKENIZER).to_str()))
    assert not wavelet.cuts_like_units(json.loads(t.to_str()))
    ids, n = wavelet.Encoder(name).encode(pa.array(texts))
    ends = np.cumsum(n)
    for x, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids + [1]


def test_word_by_word_encoding_equals_whole_texts():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    texts = [x for x in hostile_texts() if x is None or len(x) < 5000]
    texts += ["<|endoftext|>", "a<|startoftext|>b c", "don't I'LL", "Σας ΑΣ", " ́x e ́", "x y\u0085z", "가 ᄀ ᅡ", "1234 5"]
    ids, n = wavelet.Encoder(TOKENIZER).encode(pa.array(texts))
    ends = np.cumsum(n)
    for x, a, b in zip(texts, ends - n, ends):
        assert ids[a:b].tolist() == t.encode(x or "", add_special_tokens=False).ids + [1]


def test_token_files_read_back(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(TOKENIZER)
    data = rows(hostile_texts()) + [(3, "again", "en", "s", 0)]
    got = wavelet.encode_documents(frame(spark, data, True), TOKENIZER, shard_tokens=500).orderBy("start").collect()
    start = 0
    want = sorted(((d[0], d[1] or "") for d in data))
    assert [r["doc_id"] for r in got] == [d for d, _ in want]
    for r, (_, text) in zip(got, want):
        ids = t.encode(text, add_special_tokens=False).ids + [1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert wavelet.encode_documents(frame(spark, []), TOKENIZER).count() == 0
    nulls = wavelet.encode_documents(frame(spark, [(None, "b", "en", "s", 1), (2, "c", "en", "s", 1), (None, None, "en", "s", 1)]), TOKENIZER)
    assert [r["doc_id"] for r in nulls.orderBy("start").collect()] == [None, None, 2]
    dated = spark.sql("SELECT DATE '2024-01-02' AS doc_id, 'x' AS text")
    assert wavelet.encode_documents(dated, TOKENIZER).first()["doc_id"].isoformat() == "2024-01-02"


def test_places_of_tokens_over_all_files(spark, tmp_path):
    data, before = rows(hostile_texts()[:20]), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    manifest = wavelet.write_shards(frame(spark, data), TOKENIZER, str(tmp_path), shard_tokens=100)
    assert manifest.count() > 3
    ids = np.concatenate([wavelet.Encoder(TOKENIZER).encode(pa.array([d[1]], pa.string()))[0] for d in data])
    tokens = [1, int(ids[0]), int(ids[50]), 12_345]
    found = sorted(map(tuple, wavelet.occurrences(str(tmp_path), manifest, tokens).collect()))
    assert found == sorted((t, p) for t in set(tokens) for p in np.flatnonzero(ids == t).tolist())
    assert dict(map(tuple, wavelet.counts(str(tmp_path), manifest, tokens).collect())) == {t: int((ids == t).sum()) for t in tokens}
    wavelet.read_documents(str(tmp_path), manifest, "bigint").count()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") in (before, "1000")


