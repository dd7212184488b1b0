import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.operators import bpe, pieces


def brute(words, merges, least=1):
    """Plain learner that counts everything anew for each merge."""
    words = [(list(s), f) for s, f in words]
    out = []
    while len(out) < merges:
        count = Counter()
        for s, f in words:
            for p in zip(s, s[1:]):
                count[p] += f
        if not count:
            break
        pair = min(count, key=lambda p: (-count[p], p))
        if count[pair] < least:
            break
        new = 256 + len(out)
        done = []
        for s, f in words:
            t, i = [], 0
            while i < len(s):
                if i + 1 < len(s) and (s[i], s[i + 1]) == pair:
                    t.append(new)
                    i += 2
                else:
                    t.append(s[i])
                    i += 1
            done.append((t, f))
        words = done
        out.append((*pair, new, count[pair]))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(97, 99), min_size=1, max_size=9), st.integers(1, 5)), min_size=1, max_size=8))
def test_learner_is_brute_force(words):
    state, out = bpe.Learner(words), []
    while len(out) < 12 and (top := state.best()):
        out.append((*top[0], 256 + len(out), top[1]))
        state.merge(top[0], 256 + len(out) - 1)
    assert out == brute(words, 12)


def inventory(spark, words):
    return spark.createDataFrame([(i, s, f) for i, (s, f) in enumerate(words)], "word_idx bigint, symbols array<int>, freq bigint")


def test_frame_and_production_agree(spark):
    rng = random.Random(3)
    words = [(list(rng.choice(["banana", "bandana", "cabana", "aaaa", "abab"]).encode()), rng.randint(1, 4)) for _ in range(12)]
    df = inventory(spark, words)
    expect = brute(words, 5)
    assert bpe.learn(df, 5) == expect
    assert [tuple(r)[1:] for r in bpe.learn_frame(df, 5, cut_every=2).orderBy("rank").collect()] == expect
    assert bpe.learn(df, 5, replay=[x[:3] for x in expect[:2]]) == expect


def test_replay_checks(spark):
    df = inventory(spark, [([1, 2], 3)])
    with pytest.raises(ValueError, match="expected 256"):
        bpe.learn(df, 1, replay=[(1, 2, 300)])
    with pytest.raises(ValueError, match="no effect"):
        bpe.learn(df, 1, replay=[(5, 6, 256)])
    with pytest.raises(ValueError, match="word types"):
        bpe.learn(inventory(spark, [([1], 1), ([2], 1)]), 1, max_words=1)
    assert bpe.learn(df, 3, least=4) == [] and bpe.learn(df, 0) == []


def test_ties_go_to_the_smaller_ids(spark):
    df = inventory(spark, [([1, 3], 2), ([1, 2], 2)])
    assert tuple(bpe.best_pair(bpe.pair_counts(df)).first()) == (1, 2, 2)


def test_inventory(spark):
    df = spark.createDataFrame([("ba", 3), ("aa", 3), ("z", 1)], "piece string, freq bigint")
    for cap in (None, 10):
        got = pieces.word_inventory(df, least=2, most_words=cap).orderBy("word_idx").collect()
        assert [(r["word_idx"], r["symbols"], r["freq"]) for r in got] == [(0, [97, 97], 3), (1, [98, 97], 3)]
    assert [r["freq"] for r in pieces.word_inventory(spark.createDataFrame([("aa", 5), ("ab", 4), ("ac", 3)], "piece string, freq bigint"), most_words=2).orderBy("word_idx").collect()] == [5, 4]
    assert pieces.top_pieces(spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "piece string, freq bigint"), 1, 2).collect()[0]["piece"] == "a"


def test_codec(spark):
    codec = bpe.Codec([(97, 98)])
    assert codec.piece(b"ab") == [256] and codec.piece(b"a") == [97] and codec.piece(b"abab") == [256, 256]
    with pytest.raises(KeyError):
        bpe.Codec([], ids=[None] * 256).piece(b"a")
    assert bpe.Codec([], ids=[None] * 256, unk=7).piece(b"ab") == [7, 7]


def test_round_trip(spark):
    from corpusloom.functions.text import resolve_pattern

    texts = ["banana bandana!\nbanana cabana\n", "", None, "日本 naïve", "x" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for merges in ([], [(97, 110), (256, 97)], [(a, b) for a, b, _, _ in brute([(list(t.encode()), 1) for t in texts if t], 300)]):
        vocab = bpe.vocabulary(spark, merges, ["<|endoftext|>"])
        got = bpe.decode(bpe.encode(df, merges, resolve_pattern()).drop("text"), vocab)
        assert [r["text"] for r in got.orderBy("i").collect()] == texts


def test_vocabulary(spark):
    for placement, first in (("start", 0), ("end", 257)):
        v = {r["token"]: r["token_id"] for r in bpe.vocabulary(spark, [(97, 98)], ["<s>"], placement).collect()}
        assert v["<s>"] == first and sorted(v.values()) == list(range(258))
    with pytest.raises(ValueError):
        bpe.vocabulary(spark, [], ["A"])
    with pytest.raises(ValueError):
        bpe.token_bytes([(97, 98), (256, 99), (98, 99), (97, 258)])
    chars = bpe.byte_chars()
    assert len(set(chars)) == 256 and chars[65] == "A" and chars[32] == "Ġ"
    assert bpe.target_merges(262, 2) == 4 and bpe.target_merges(256, 2) == 0 and bpe.target_merges(9, 0, 5) == 5


def test_roles(spark):
    def roles(names):
        return {r["role"]: r["token"] for r in bpe.role_map(spark.createDataFrame(list(enumerate(names)), "ord int, token string")).collect()}

    assert roles(["<|endoftext|>", "<|pad|>"]) == {"bos_token": "<|endoftext|>", "eos_token": "<|endoftext|>", "unk_token": "<|endoftext|>", "pad_token": "<|pad|>"}
    assert roles(["x", "<eos>", "<bos>", "<unk>", "<pad>"])["bos_token"] == "<bos>"
    assert roles(["x", "y"]) == {"bos_token": "x", "eos_token": "x", "unk_token": "x", "pad_token": "y"}


def test_log(spark):
    rows = [(1, "BEGIN", 1, 2, 3, 10), (2, "COMMIT", 1, 256, None, None), (3, "BEGIN", 2, 1, 1, 4)]
    log = spark.createDataFrame(rows, "line int, kind string, merge_idx int, f1 int, f2 int, f3 bigint")
    assert [tuple(r) for r in bpe.committed(log).collect()] == [(1, 2, 3, 256)]
    assert bpe.gaps(spark.createDataFrame([(0,), (1,), (3,)], "merge_idx int")).count() == 1
