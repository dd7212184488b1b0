import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm.sentences import sentence_spans, spans

# Each case: the sentences, and what stands between them.
CASES = [
    ["Dr. Orridor found it at 7.40 a.m. near St. Yslaby Street.", " ", "See Fig. 2.11 and Sec. 16 (vol. 10, pp. 537–82) for the map.", " ", "K. F. Midador promised the pump vs. the sunrise."],
    ["Takoby watched the tailor at 4 p.m.", " ", "Past the sawmill, it cost 48.7 crowns, i.e. 84.95 per goose."],
    ["The market held lanterns, soups, etc.", " ", "The Grilin Co. pulled Lt. Lussa and Mr. Pelmul Jr. quietly."],
    ["Rumere asked, “Is the library damp?” and traded it.", " ", "“The archive carried the pump.”", "\n", "\"The shepherd remembered it!\" cried Orl."],
    ["The turnip waited ... and then labelled the debt.", " ", "The soup stacked Branth...", " ", "Run 756 failed!!", " ", "pH 17.87 was sly."],
    ["It stood outside the town hall.", "", "Some baskets are local.", "", "\"The gate found it!\" cried Ann."],
    ["Silver season", "\n\n", "(The turnip was in the room.)", " ", "Load merges.v6.txt before\nstep 17.8.18 of the filter."],
    ["* reason at the night market", "\n", "* battery", "\n", "* In the back room, it closed. And it slept."],
    ["* The goose came.\n  It slept by the mill.", "\n  ", "- Nested entry one.", "\n  ", "- Nested entry two.\n    It goes on here.", "\n", "* Last entry.", "\n", "Text behind the list.", " ", "It ends."],
    ["1. green tunnel", "\n", "2. Every cable needs a pond.", "\n", "10) old map"],
    ["It went to step\n893 of the map.", " ", "Let $B$ be a ring with $", " ", "The river slept.", " ", "Y", " ", "The tree is prime.", " ", "= 851$.", " ", "It slept."],
    ["A German ship sank.", " ", "I Claudius saw it.", " ", "A", " ", "The tree is prime."],
    ["„Wo ist die Wirtin?“, fragte Omnid.", " ", "Das kostet 9,13 Taler, d. h. fast nichts.", " ", "Haus Nr. 18 gehört Frau Mimar bzw. Ann!", " ", "Am 3. März schlief er, z. B. über dem Bach usw.", " ", "„Der Förster schlief.“", " ", "Er ging."],
    ["« Où est le jardinier ? » demanda Rutan.", " ", "M. Omtin dormait, p. ex. au marché, c.-à-d. ici.", " ", "« Une chatte trouva une oie. »", " ", "Mme Bara pesa le panier !"],
    ["¿Dónde está el herrero?", " ", "«Una gata encontró el mapa.»", " ", "El Sr. Nivelin y la Dra. Bara, en el núm. 14, p. ej. al lado, dormían.", " ", "¡Mi tío pintó!"],
    ["«Где пастух?» — спросил кузнец.", " ", "На ул. Липовой, д. 16, в 295 г. по счёту, т. е. давно, он спал и т. д.", "  ", "Вскоре он встал.", "", "Потом ушёл."],
    ["“采药的姐妹在哪里？”邮差在大雾里问道。", "", "卖花的老人说：“钥匙很旧。”", "", "他走了？！", "", "第2.5节写到，他来了……", "", "冬天到了。"],
    ["「灰色の猫は数えた。」と庭師は言った。", "", "「灯台守はどこですか？」", "", "第7.17節で、船頭は売った……", "", "冬に、眠った。"],
    ["“माली कहाँ है?” बूढ़ा चक्कीवाला ने घाट पर पूछा।", " ", "डॉ. शांत पड़ोसी ने 52.1 किलो भरा।", " ", "क्या दर्ज़िन ने देखा?"],
    ["«أين الخياطة؟» سأل الطفلة على القرية.", " ", "د. ساعي البريد رتب 58.99 كيلو.", "", "نام الراعي!"],
    ["เวลา 10.48 น. ช่างไม้ขัดแผนที่", " ", "ในปีพ.ศ. 900 เด็กส่งแผนที่", " ", "ทำไมแมวนอน?", " ", "คนสวนซ่อม 699 ตัวกับตะกร้า"],
]


@pytest.mark.parametrize("parts", CASES, ids=range(len(CASES)))
def test_case(parts):
    text = "".join(parts)
    assert [text[a:b] for a, b in spans(text)] == parts[::2]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB. !?\n\r\t“”\"()«»。「」-*1)$กข…", max_size=60))
def test_every_visible_character_is_in_one_sentence(text):
    found = spans(text)
    assert all(a < b and not text[a].isspace() and not text[b - 1].isspace() for a, b in found)
    assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))
    assert "".join("".join(text[a:b].split()) for a, b in found) == "".join(text.split())


def test_table(spark):
    rows = [(1, "One. Two."), (1, "One. Two."), (2, None), (3, ""), (4, " \n "), (None, "One."), (5, "word " * 60_000)]
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id bigint, text string, start_char int, id string")
    assert sorted(map(tuple, sentence_spans(df).collect())) == [(1, 0, 4), (1, 0, 4), (1, 5, 9), (1, 5, 9), (5, 0, 299_999)]
    assert sentence_spans(df.where("false")).count() == 0
