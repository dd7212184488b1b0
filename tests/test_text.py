import hashlib
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as T


def rows(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def column(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def test_white_space_is_pythons(spark):
    texts = ["a\x1cb\x85c\xa0d e　f", "   ", "", "x\r\n\ty", "a​b", " a b c", None]
    assert column(rows(spark, texts), T.collapse_white(F.col("v"))) == [None if t is None else " ".join(t.split()) for t in texts]


@pytest.mark.parametrize("form", ["NFC", "NFD", "NFKC", "NFKD"])
def test_forms_come_after_collapsing(spark, form):
    texts = ["é ﬁ", "x ¨", None, "Ａ"]
    assert column(rows(spark, texts), T.corpus_text(F.col("v"), form)) == [None if t is None else unicodedata.normalize(form, " ".join(t.split())) for t in texts]


def test_unknown_form_and_policy():
    with pytest.raises(ValueError):
        T.normalise(None, "NFX")
    with pytest.raises(ValueError):
        T.decode_bytes(None, "guess")


def test_bad_bytes(spark):
    data = [b"ab\xff", b"\xe3\x81", b"\xf0\x9f\x98", b"ok"]
    df = rows(spark, [bytearray(d) for d in data], "binary")
    assert column(df, T.decode_bytes(F.col("v"))) == [d.decode("utf-8", "replace") for d in data]
    assert column(df, T.decode_bytes(F.col("v"), "ignore")) == [d.decode("utf-8", "ignore") for d in data]


def test_document_id(spark):
    texts = ['q"uote', "tab\tbell\x07", "café\x1f", "a/b\\"]
    df = rows(spark, texts)
    expect = [hashlib.sha256(json.dumps({"line_no": i, "source": "s", "text": t}, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest() for i, t in enumerate(texts)]
    assert column(df, T.document_id(F.lit("s"), F.col("i"), F.col("v"))) == expect


def test_hash_bucket(spark):
    ids = ["a", "b", "xyz"]
    assert column(rows(spark, ids), T.hash_bucket(F.col("v"), 1000)) == [int(hashlib.sha256(x.encode()).hexdigest()[:8], 16) % 1000 for x in ids]


def test_pieces(spark):
    df = rows(spark, ["don't stop  now\n", "it's they'll 123abc !!!  x", ""])
    regex = pytest.importorskip("regex")
    for name in T.PATTERNS:
        got = column(df, T.pieces(F.col("v"), T.resolve_pattern(name)))
        assert got == [regex.findall(T.PATTERNS[name], t) for t in column(df, F.col("v"))]
        assert ["".join(g) for g in got] == column(df, F.col("v"))
    assert got[0] == ["don", "'t", " stop", " ", " now", "\n"]


def test_pattern_errors():
    for args in (("custom", None), ("custom", ""), ("other", None)):
        with pytest.raises(ValueError):
            T.resolve_pattern(*args)
    with pytest.raises(ValueError):
        T.resolve_pattern("gpt2_fast", flags=("DOTALL",))


def test_special_segments(spark):
    df = rows(spark, ["hello<|endoftext|>world", "<|endoftext|>", "a<|endoftext|>b<|end|>c", None, ""])
    assert column(df, T.plain_segments(F.col("v"), ["<|end|>", "<|endoftext|>"])) == [["hello", "world"], [], ["a", "b", "c"], None, []]


def test_bytes_and_back(spark):
    texts = ["héllo", "", "日本", None]
    df = rows(spark, texts)
    assert column(df, T.text_bytes(F.col("v"))) == [None if t is None else list(t.encode()) for t in texts]
    assert column(df, T.bytes_text(T.text_bytes(F.col("v")))) == texts


def test_pairs(spark):
    df = rows(spark, [[1, 2, 1, 2, 3], [7], [], [1, 1, 1]], "array<int>")
    assert [[tuple(p) for p in x] for x in column(df, T.adjacent(F.col("v")))] == [[(1, 2), (2, 1), (1, 2), (2, 3)], [], [], [(1, 1), (1, 1)]]
    assert column(df, T.merge_pair(F.col("v"), 1, 1, 9)) == [[1, 2, 1, 2, 3], [7], [], [9, 1]]
    assert column(df, T.merge_pair(F.col("v"), 1, 2, 9)) == [[9, 9, 3], [7], [], [1, 1, 1]]
    a, b = T.split_pair(T.pair_id(F.lit(70000), F.lit(5)))
    assert tuple(df.select(a, b).first()) == (70000, 5)


def test_widths(spark):
    df = rows(spark, [[65535], [65536]], "array<int>")
    assert df.where("i = 0").select(T.checked_ids(F.col("v"), "uint16")).first()[0] == [65535]
    with pytest.raises(Exception, match="uint16"):
        df.where("i = 1").select(T.checked_ids(F.col("v"), "uint16")).collect()
    assert T.storage_width(65280) == "uint16" and T.storage_width(65281) == "uint32"


def test_prompt(spark):
    assert rows(spark, ["x"]).select(T.prompt(F.lit("do"), F.lit("done"))).first()[0] == "### Instruction:\ndo\n\n### Response:\ndone\n"
