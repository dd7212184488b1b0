import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.pairs import SuffixAutomaton, _Windows, batch_defects, open_delimiters, pair_defects

CASES = [
    ("Tell a story.", None, "empty"), ("Tell a story.", " ​\n", "empty"), ("Tell a story.", "<|endoftext|>", "empty"), ("Tell a story.", "### Response:\n", "empty"), ("Tell a story.", "...", "empty"), (None, None, "empty"),
    ("Tell a story about a goose and a mill.", "I'm sorry, but I can't help with that request.", "refusal"), ("Was weißt du über das Haus?", "Entschuldigung, dabei kann ich nicht helfen.", "refusal"), ("请解释为什么灰猫睡觉。", "很遗憾，我无法回答这个问题。", "refusal"),
    ("Write a polite reply in which Tom turns down an offer.", "Dear Ann, sadly I must decline to take your kind offer. Yours, Tom.", None), ("Tell a story.", "A pump cannot help a workshop that is quiet. The bell rang and nobody came to the door.", None),
    ("Why did the goose cross the bridge?", "Question: why did the goose cross  the bridge", "copy"), ("Why did the goose cross the bridge?", "Why did the goose cross the bridge?\nWhy did the goose cross the bridge?", "copy"),
    ("Copy this line for the record: The goose slept in the barn.", "The goose slept in the barn.", None), ("Why did the goose cross the bridge?", "You ask about this: Why did the goose cross the bridge? Because the old miller had left his bread upon the other bank of the river that day.", None),
    ("Why did the goose cross the bridge?", "Die Gans ging über die Brücke, weil der Müller auf dem Markt war.", "other_language"), ("Translate into German: The goose slept.", "Die Gans ging in das Haus und schlief.", None), ("Why did it rain?", "Потому что в этот день было холодно и на небе были тучи.", "other_language"),
    ("Describe the goose of the mill.", "The goose was grey. It lived in the", "truncated"), ("Describe the goose.", "It was grey.\n```python\nfor x in y:\n    print(x", "truncated"), ("Describe the goose.", "Here is the plan.\n1. It was grey.\n2.", "truncated"), ("Describe the goose.", "It was grey, and the miller said:", "truncated"), ("请描述灰猫。", "灰猫在屋顶上睡觉。后来，它打开了", "truncated"),
    ("Suggest a title for a tale.", "The Grey Goose Of The Mill", None), ("List 2 things.", "- goose\n- old mill by the river", None), ("What is 2 plus 3?", "5", None), ("Write a line of Python.", "```python\nx = 1\n```", None), ("Describe the goose.", "It was grey.", None), ("", "It was grey.", None),
]


@pytest.mark.parametrize(("prompt", "response", "defect"), CASES)
def test_case(prompt, response, defect):
    assert batch_defects([prompt], [response]) == [defect]


def test_long_prompts():
    prompt = "Describe " + " ".join(f"goose number {i}" for i in range(9000))
    assert batch_defects([prompt, prompt], [prompt.upper(), "It was grey."]) == ["copy", None]


def test_batches_are_single_pairs():
    assert batch_defects([c[0] for c in CASES], [c[1] for c in CASES]) == [c[2] for c in CASES]


@settings(max_examples=100, deadline=None)
@given(st.text("ab", max_size=12), st.text("abc", max_size=15), st.integers(1, 4))
def test_coverage_is_brute_force(prompt, response, least):
    covered, best = set(), 0
    for i in range(len(response)):
        for j in range(i + least, len(response) + 1):
            if response[i:j] in prompt:
                covered |= set(range(i, j))
                best = max(best, j - i)
    assert SuffixAutomaton(prompt).covered(response, least) == (len(covered), best)
    total, longest = _Windows(prompt, least).covered(response, least)
    assert total == len(covered)
    exact = max((j - i for i in range(len(response)) for j in range(i + 1, len(response) + 1) if response[i:j] in prompt), default=0)
    assert longest == (exact if exact >= 0.8 * len(prompt) else 0)


def test_stack():
    assert open_delimiters("a (b [c] “d”") == ["("] and open_delimiters("„a“ «b»") == [] and open_delimiters("``` x") == ["```"]


def test_table(spark):
    rows = [(1, "Tell.", None), (1, "Tell.", None), (2, None, "It was grey."), (None, "x", None), (3, "Describe the goose.", "It was " + "grey and " * 20_000)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "example_id bigint, instruction string, output string, defect string, id int")
    assert sorted(map(tuple, pair_defects(df).collect())) == [(1, "empty"), (3, "truncated")]
    assert pair_defects(df.where("false")).count() == 0


def test_long_refusals_and_thai_ends():
    why = " ".join(f"The subject of point {k} is one that my rules leave to trained people, who know the place and the law." for k in range(8))
    refusal = "I'm sorry, but I can't help with that request."
    story = "The goose came to the mill. " + why
    thai = "แมวสีเทานอนอยู่บนหลังคาบ้าน มันเห็นนกตัวหนึ่ง"
    prompts = ["Tell a story about a goose and a mill."] * 4 + ["อธิบายเรื่องแมว"] * 4
    responses = [f"{refusal} {why}", f"{refusal} However, here is a story. {story}", f"“{refusal}” said the goose. {story}", story, thai, thai + " และ", thai + "เพราะ", thai + " ซึ่งดีกว่า"]
    assert batch_defects(prompts, responses) == ["refusal", None, None, None, None, "truncated", "truncated", None]


def test_refusals_of_any_length_and_place():
    refusal = "I am sorry, but I cannot help with that request."
    polite = [f"Thank you for writing to us about your question number {k} of the day." for k in range(10)]
    answer = "The mill stands by the river. It was built of stone. The goose lives there."
    responses = [f"{refusal} The matter is one for others. They know the place. They have the keys.", " ".join([*polite, refusal]), f"{answer} {refusal}", f"{refusal} Instead, this is the tale. {answer}", refusal]
    assert batch_defects(["Tell a story about a goose and a mill."] * 5, responses) == ["refusal", "refusal", None, None, "refusal"]


def test_copies_of_long_prompts():
    words = " ".join(f"goose number {i}" for i in range(3000))
    prompt = "Describe " + words
    shuffled = " ".join(f"number {i} goose" for i in reversed(range(3000)))
    assert batch_defects([prompt] * 3, [prompt.upper() + "!", shuffled + ".", prompt[: len(prompt) * 17 // 20] + "."]) == ["copy", None, "copy"]
