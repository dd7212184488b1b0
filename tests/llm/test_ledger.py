import random
from collections import defaultdict

from corpusloom.llm import ledger

ROWS = [
    ("a", "title: Big Book; shelf: A 1; grade: 3"), ("b", '{"shelf": "A1", "grade": "3", "title": "big BOOK"}'), ("c", "GRADE: 3\nTITLE: BIG BOOK\nSHELF: A1"), ("d", "title: 3; shelf: A 1; grade: Big Book"),
    ("e", "Hello, World!"), ("f", "hello\n world"), ("g", "Ｈｅllo wоrld"), ("h", "Hello worlds"), ("i", "pi 3.14"), ("j", "PI: 3.14"), ("k", "pi 314"), ("l", "!!!"), ("m", "..."), ("n", None), ("o", ""), ("e", "Hello, World!"), (None, "Hello, World!"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, b"x", 7) for r in rows], "doc_id string, text string, key binary, copies int")


def test_groups(spark):
    found = {tuple(r) for r in ledger.hidden_copies(table(spark, ROWS)).collect()}
    assert found == {("a", "b"), ("a", "c"), ("e", "f"), ("e", "g"), ("i", "j")}
    counts = {r["keep_doc_id"]: r["copies"] for r in ledger.copy_counts(table(spark, ROWS)).collect()}
    assert counts == {"a": 3, "d": 1, "e": 3, "h": 1, "i": 2, "k": 1}
    assert ledger.hidden_copies(table(spark, [])).count() == 0


def test_batches_add_up(spark):
    rng = random.Random(0)
    rows = [(f"{i:05d}", rng.choice(["One two", "one TWO.", f"text {rng.randint(0, 30)}"])) for i in range(600)]
    keys = ledger.canonical_keys(table(spark, rows))
    expect = defaultdict(list)
    for i, t in rows:
        expect["".join(c for c in t.lower() if c.isalnum())].append(i)
    for batches in (1, 3):
        book = ledger.copy_ledger(keys, batches=batches, buckets=3)
        got = sorted((r["keep_id"], r["copies"]) for r in book.read().collect())
        assert got == sorted((min(v), len(v)) for v in expect.values())


def test_a_ledger_outlives_runs(spark, tmp_path):
    path = str(tmp_path / "book")
    assert ledger.Ledger(spark, path).read().count() == 0

    def keys(*rows):
        return spark.createDataFrame([(bytearray(k.encode()), i) for k, i in rows], "key binary, doc_id string")

    ledger.Ledger(spark, path, buckets=16).add(keys(("k1", "b"), ("k1", "c"), ("k2", "d"), ("k1", "b")), "monday")
    before = dict(ledger.Ledger(spark, path).state["folders"])
    book = ledger.Ledger(spark, path).add(keys(("k1", "a"), ("k3", "e")), "tuesday").add(keys(("k1", "b"), ("k1", "c")), "monday")
    assert {bytes(r["key"]).decode(): (r["copies"], r["keep_id"]) for r in ledger.Ledger(spark, path).read().collect()} == {"k1": (3, "a"), "k2": (1, "d"), "k3": (1, "e")}
    # Buckets that the second batch doesn't touch stay where they were.
    after = ledger.Ledger(spark, path).state
    assert after["batches"] == ["monday", "tuesday"] and after["buckets"] == 16 and book.state == after
    assert any(after["folders"][b] == f for b, f in before.items())
    # A write that broke off before its manifest leaves no trace.
    (tmp_path / "book" / "batch-00000002").mkdir()
    assert ledger.Ledger(spark, path).read().count() == 3


def test_fields():
    assert ledger.fields_of("a: 1; b: 2; c: 3") == [("a", "1"), ("b", "2"), ("c", "3")]
    assert ledger.fields_of('[ {"a": 1, "b": [2]} ]') == [("a", "1"), ("b", "[2]")]
    for text in ("Vevel: One.\nYsfan: Two.\nVevel: Three.", "no fields here", "a: 1", "a: 1; b: 2", "{broken", ""):
        assert ledger.fields_of(text) is None


def test_hot_group(spark):
    rows = [(f"{i:04d}", "The SAME text!" if i % 3 == 0 else f"text {i}") for i in range(900)]
    found = ledger.hidden_copies(table(spark, rows)).collect()
    assert {r["keep_doc_id"] for r in found} == {"0000"} and len({r["copy_doc_id"] for r in found}) == len(found) == 299


def test_two_fields(spark):
    rows = [
        ("a", '{"prompt": "Big book", "completion": "A 1"}'), ("b", '{"completion": "a1", "prompt": "BIG BOOK"}'), ("c", "completion: A1\nprompt: big book"), ("d", '{"prompt": "A 1", "completion": "Big book"}'),
        ("e", "shelf: A 1; title: Mill"), ("f", "TITLE = mill | SHELF = a1"), ("g", '{"only": "one field"}'), ("h", "Only one field"),
    ]
    found = {tuple(r) for r in ledger.hidden_copies(table(spark, rows)).collect()}
    assert found == {("a", "b"), ("a", "c"), ("e", "f"), ("g", "h")}
