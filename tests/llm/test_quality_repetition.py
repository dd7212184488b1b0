import random

import numpy as np
from pyspark.sql import functions as F

from corpusloom.llm import codepoints as cp
from corpusloom.llm import quality, repetition

NOUNS = "goose mill river bridge barn kettle lamp wagon fence ladder button pond".split()
VERBS = "found painted moved watched carried opened".split()


def sentence(rng):
    return f"The {rng.choice(NOUNS)} of the {rng.choice(NOUNS)} {rng.choice(VERBS)} a {rng.choice(NOUNS)} in the {rng.choice(NOUNS)} by the {rng.choice(NOUNS)}."


def corpus(rng):
    prose = [" ".join(sentence(rng) for _ in range(rng.randint(3, 8))) for _ in range(160)]
    prose[:6] = [prose[0].lower().replace(".", ""), prose[1].replace(". ", ".\n"), prose[2].upper(), "Ann: " + prose[3].split(".")[0] + ".\nTom: " + prose[3].split(".")[1] + ".", prose[4] + " Let $x < 3$ be a ring with $f(x) = 12x - 4$ for the goose.", " ".join([prose[5]] * 4)]
    junk = ["\n".join(f"- {rng.choice(NOUNS)}" for _ in range(12)), "\n".join(f"{rng.choice(NOUNS)},{rng.randint(1, 9999)},{rng.randint(1, 99)}" for _ in range(12)), "name: goose; grade: 12; shelf: A3; place: mill", '{"name": "goose", "grade": "12", "shelf": "A3"}', "\n".join(rng.choice(NOUNS) for _ in range(14)), "Home  Login (3)  Cart (5)  Contact  Share (8)  Menu", "x1=f2(a3,44);y5=g6(b7,55);if(c8){d9.e1=3}", "QW2mcWnQbTfSABxT469jP26WNdgI4PGXvIb7c1NK9XWAnE", "#-#>^#&^:/_>%^+$*<=<|/#;"]
    return prose, junk


def test_prose_and_junk(spark):
    prose, junk = corpus(random.Random(2))
    rows = [(f"p{i}", t) for i, t in enumerate(prose)] + [(f"j{i}", t) for i, t in enumerate(junk)] + [("n", None), ("e", ""), (None, prose[9]), ("p0", prose[0])]
    df = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id string, text string, distance double, lang string")
    stats = quality.statistics(df)
    assert stats.count() == len(prose) + len(junk)
    assert {r["doc_id"] for r in quality.not_prose(stats).collect()} == {f"j{i}" for i in range(len(junk))}
    for r in quality.outlierness(stats).collect():
        assert abs(r["distance"] - sum(r[f"by_{s}"] for s in quality.STATS)) < 1e-6
    assert quality.not_prose(quality.statistics(df.where("false"))).count() == 0


def test_statistics_of_batches_are_those_of_single_texts():
    prose, junk = corpus(random.Random(4))
    texts = prose[:20] + junk + ["x", " ", "\n\n", "。", "今天好。", "a" * 100_000]
    whole, langs = quality.batch_statistics(*cp.from_strings(texts))
    for i, t in enumerate(texts):
        one, lang = quality.batch_statistics(*cp.from_strings([t]))
        assert np.allclose(one[0], whole[i]) and lang[0] == langs[i]
    assert np.isfinite(whole).all()


def brute(words, width):
    seen, covered = set(), set()
    for i in range(len(words) - width + 1):
        w = tuple(words[i : i + width])
        if w in seen:
            covered |= set(range(i, i + width))
        seen.add(w)
    return len(covered)


def test_repetition_is_brute_force():
    rng = random.Random(1)
    texts = []
    for _ in range(120):
        ws = [rng.choice(NOUNS) for _ in range(rng.randint(0, 40))]
        if len(ws) > 10 and rng.random() < 0.7:
            ws += ws[2 : 2 + rng.randint(3, 9)] * rng.randint(1, 3)
        texts.append(" ".join(ws).title() + "! 7")
    total, again, _ = repetition.repeated_words(*cp.from_strings(texts), 6, 12)
    for t, n, k in zip(texts, total, again):
        ws = t.lower().replace("!", "").replace("7", "").split()
        assert (n, k) == (len(ws), brute(ws, 6))
    text = "小狐狸在渡口卖掉了生锈的钥匙，又收集了白鹅" * 3
    total, again, _ = repetition.repeated_words(*cp.from_strings([text]), 6, 12)
    letters = [c for c in text if c != "，"]
    assert (total[0], again[0]) == (len(letters), brute(letters, 12))


def test_adaptive_filter(spark):
    rng = random.Random(3)
    rows = [(f"d{i}", " ".join(sentence(rng) for _ in range(6)), rng.choice(["a", None])) for i in range(60)]
    phrase = "the goose went home by the old mill again "
    rows += [("r1", phrase * 5, "a"), ("r2", sentence(rng) + " " + phrase * 6, None), ("n", None, "a"), ("e", "", "a"), ("r1", phrase * 5, "a"), ("w", "!!!", "a")]
    df = spark.createDataFrame([(*r, 1.0, "z") for r in rows], "doc_id string, text string, source string, share double, lang string")
    shares = repetition.repeated_shares(df)
    assert shares.count() == 63
    found = repetition.repetitive(shares).where(F.col("repeated") * 5 >= F.col("words") * 2)
    assert {r["doc_id"] for r in found.collect()} == {"r1", "r2"}
    assert repetition.with_thresholds(shares).count() == 63
    assert repetition.repetitive(repetition.repeated_shares(df.where("false"))).count() == 0


def test_thresholds_change_what_is_found(spark):
    # The English of source a never repeats, b's is a third repetition, c has too few documents for quartiles of its own.
    rows = [(f"a{i}", "en", "a", 100, 0) for i in range(200)] + [(f"b{i}", "en", "b", 100, 60 if i % 3 == 0 else i % 5) for i in range(150)] + [("c0", "en", "c", 100, 30), ("z0", "fr", None, 0, 0), ("z1", "fr", None, 100, 90)]
    shares = spark.createDataFrame([(i, g, s, n, k, k / max(1, n)) for i, g, s, n, k in rows], "doc_id string, lang string, source string, words long, repeated long, share double")
    limits = {(r["lang"], r["source"]): round(r["threshold"], 4) for r in repetition.adaptive_thresholds(shares).collect()}
    top = limits["en", "c"]
    assert limits["en", "a"] == 0 and limits["en", "b"] == top == limits["fr", None] and 0 < top < 0.3
    found = {r["doc_id"] for r in repetition.repetitive(shares).collect()}
    assert found >= {f"b{i}" for i in range(0, 150, 3)} | {"c0", "z1"} and "z0" not in found and "b1" not in found
    assert {r["doc_id"] for r in repetition.repetitive(shares, fence=40.0).collect()} == set()
    renamed = repetition.named_sources(shares, spark.createDataFrame([("a", "x", "c1"), ("b", "x", "c1"), ("b", "x", "c1"), (None, "x", "c2")], "path string, split string, corpus string"))
    assert renamed.count() == shares.count() and {r["source"] for r in renamed.select("source").distinct().collect()} == {"c1", None}
