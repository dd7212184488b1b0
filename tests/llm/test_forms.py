import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import codepoints as cp
from corpusloom.llm import forms, lookalikes
from corpusloom.llm.lookalikes import consistent_forms, lookalike_pairs


def test_same_look():
    same = ["Ｔｈｅ cаfé", "The café", "T​he cafe\u0301", "The\u202fcafé", "\ufeffThe café"]
    assert len(set(forms.visual_strings(same))) == 1
    assert forms.visual_strings(["ﬁne", "ⅳ", "⼈", "ｶﾞ", "a\r\nb\rc\u2028d"]) == ["fine", "iv", "人", "ガ", "a\nb\nc\nd"]


def test_other_look():
    for a, b in (("x²", "x2"), ("café", "cafe"), ("a b", "a  b"), ("a\nb", "a b"), ("Rose", "rose"), ("wait…", "wait..."), ("½", "1⁄2")):
        assert len(set(forms.visual_strings([a, b]))) == 2, (a, b)


def test_letters():
    assert forms.letters(["Straße 3.14, a.b!", "STRASSE 3.14 AB"]) == ["strasse3.14ab", "strasse3.14ab"]
    assert len(set(forms.letters(["МОСТ", "мост", "MOCT"]))) == 1
    assert forms.letters(["3. 14", ".5", "5.", ""]) == ["314", "5", "5", ""]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=12), max_size=6))
def test_batches_are_single_texts(texts):
    whole = forms.visual_strings(texts)
    assert whole == [forms.visual_strings([t])[0] for t in texts]
    assert forms.visual_strings(whole) == whole
    assert all(unicodedata.is_normalized("NFC", t) for t in whole)
    assert forms.letters(texts) == [forms.letters([t])[0] for t in texts]
    assert cp.to_strings(*cp.from_strings(texts)) == texts


def test_pairs(spark):
    rows = [("b", "Ｈi café"), ("a", "Hi cafe\u0301"), ("a", "Hi cafe\u0301"), ("c", "Hi café"), ("d", "Hi café"), ("e", "hi café"), ("f", None), ("g", ""), (None, "Hi café"), ("h", "x" * 300_000), ("i", "x" * 299_999 + "х")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id string, text string, id int, form_key string")
    got = {tuple(r) for r in lookalike_pairs(df).collect()}
    assert got == {("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("h", "i")}
    assert lookalike_pairs(df.where("false")).count() == 0
    formed = {r["doc_id"]: r["form"] for r in consistent_forms(df).where("doc_id < 'h'").collect()}
    assert formed == {"a": "Hi café", "b": "Hi café", "c": "Hi café", "d": "Hi café", "e": "hi café", "f": None, "g": None}
    assert consistent_forms(df, fold=True).where("doc_id = 'b'").first()["form"] == "hi café"


def test_hot_form_is_salted(spark, monkeypatch):
    from corpusloom.llm import lookalikes

    rows = [(f"a{i:02d}", "Hi there") for i in range(20)] + [(f"b{i:02d}", "Ｈi there") for i in range(13)] + [("c", "Hi thеre")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    expect = {(a, b) for a, t in rows for b, u in rows if a < b and t != u}
    for size in (3, 10_000):
        monkeypatch.setattr(lookalikes, "SALT_ROWS", size)
        assert {tuple(r) for r in lookalike_pairs(df).collect()} == expect


def test_links(spark):
    rows = [("a", "\uff21 b"), ("b", "A b"), ("c", "A b"), ("c", "A b"), ("d", "A\u00a0b"), ("e", "other"), ("f", "other"), (None, "A b"), ("g", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id string, text string, links int")
    found = {r["doc_id"]: (r["class_id"], r["links"]) for r in lookalikes.lookalike_links(df).collect()}
    assert {k: n for k, (_, n) in found.items()} == {"a": 3, "b": 2, "c": 2, "d": 3} and len({c for c, _ in found.values()}) == 1
    assert lookalikes.lookalike_links(df.where("false")).count() == 0
