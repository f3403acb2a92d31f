import random

from tabspark.llm import pii

FORMS = {
    "phone": ["+44 20 7946 0271", "(617) 555-0129", "617.555.0105", "17025550144", "+441632960120", "01632 960614", "020 7946 0141", "+1-305-555-0146", "212-555-0188", "+1 808 555 0179"],
    "email": ["a.b-c+t@mail.example.net", "x_1 [at] a-b [dot] example", "Bo (at) scores.test", "Yorick+T@A-B.EXAMPLE"],
    "id_number": ["666-85-8598", "666 06 1627", "QQ730199A", "QQ 78 31 12 C", "45903710O", "P<18362186", "079-081-851", "X4001911I"],
    "address": [
        "1695 Tannery Street", "Flat 20, 1890 Millrace Ave, Sorrelfalls", "650 Saltmarsh Court, Elderford 00855", "1590 Harrow St., Unit 51, Junipermouth", "1275 Harrow Court, Apt 10A",
        "Avenida de la Noria 166, piso 3, Ashfield", "Calle del Olmo 142, 4º B, Larchhaven", "193 bis, avenue du Moulin, 00444 Coldfalls", "Am Alten Markt 102a, 00449 Kestcombe", "Lindenweg 36, 00568 Valeholm",
    ],
}
NOT_PERSONAL = "Block 29-36-36, build 2029-1130, game 2016_12_POG_DEZ, on 2021-06-15, scores 7-6(9) 6-4, version 2.41.26, posts by @court21, 12,345 people, condition 0xa078b11dc7f28c7079c84aef241bd2d2148038f6."


def test_forms():
    for kind, values in FORMS.items():
        for v in values:
            text = f"Note: {v}, ok. {NOT_PERSONAL}"
            spans, masked = pii.mask_forms(text)
            assert [(k, text[a:b]) for k, _, a, b in spans] == [(kind, v)], v
            assert len(masked) == len(text)


FIRSTS = "Anna Bela Caro Dora Edda Fritz Gina Hugo Ines Jaro".split()
LASTS = [a + b for a in "Lum Mor Nar Pol Quen Ros Sten Tul Var Wim".split() for b in "ako beri citz dona evik".split()]


def _corpus(n):
    r = random.Random(3)
    texts = []
    for _ in range(n):
        first, last, other = r.choice(FIRSTS), r.choice(LASTS), r.choice(LASTS)
        lines = [
            f"{first} {last} beat {r.choice(FIRSTS)[0]}. {other} in the final of the Oakgate Masters.",
            f"Dr. {r.choice(FIRSTS)} {r.choice(LASTS)} cleared {last} to train.",
            f"{last}'s return was the story. Rain swept over Hollow Park before {other} could serve.",
            f"Play was suspended. Inhaber {r.choice(FIRSTS)} {other}, it said.",
            f"{first} {r.choice(FIRSTS)[0]}. {last} sprayed errors.",
            f"Kit bag found: label reads {last.upper()}, {first}, 928 Cinder Avenue.",
        ]
        texts.append(" ".join(r.sample(lines, 4)))
    return texts


def test_names_by_disclosure_and_placeholders(spark):
    special = ["Mori Lumako beat Nobody Else.", "", None, "Anna Lumako met Anna Lumako at Hollow Park.", "Ask Bela Q. Morberi’s coach, bela@x.test."]
    texts = _corpus(600) + special
    docs = spark.createDataFrame([(i, t, "s", "k") for i, t in enumerate(texts)], "doc_id long, text string, surface string, kind string")
    found = pii.findings(docs)
    got: dict[int, set] = {}
    for r in pii.surfaces(found).collect():
        got.setdefault(r["doc_id"], set()).add((r["pii_type"], r["surface"]))
    names = {s for x in got.values() for k, s in x if k == "name"}
    words = {w.strip(".,").lower() for s in names for w in s.split()}
    allowed = {x.lower() for x in FIRSTS + LASTS} | {f[0].lower() for f in FIRSTS} | {"q"}
    assert words - allowed <= {"mori", "nobody", "else"}
    assert {x.lower() for x in LASTS} <= words
    n = len(texts)
    assert got[n - 2] == {("name", "Anna Lumako")} and n - 3 not in got and n - 4 not in got
    assert got[n - 1] == {("name", "Bela Q. Morberi"), ("email", "bela@x.test")}
    assert any(s.isupper() is False and "," in s and s.split(",")[0].isupper() for s in names)
    clean = {r["doc_id"]: r for r in pii.sanitise(docs).collect()}
    assert clean[n - 1]["text"] == "Ask [NAME]’s coach, [EMAIL]." and clean[n - 2]["text"] == "[NAME] met [NAME] at Hollow Park."
    assert clean[n - 3]["text"] is None and clean[n - 4]["text"] == "" and clean[n - 1]["surface"] == "s"
    assert len(clean) == n


def test_documents_without_an_id_and_with_the_same_one(spark):
    data = [(None, "Write to a.b@example.test now"), (7, "Wring c.d@example.test"), (7, "Call +1-305-555-0146, or mail e@example.test"), (None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert {(r["doc_id"], r["text"]) for r in pii.sanitise(docs).collect()} == {(None, "Write to [EMAIL] now"), (7, "Wring [EMAIL]"), (7, "Call [PHONE], or mail [EMAIL]"), (None, None)}
    got = {tuple(r) for r in pii.surfaces(pii.findings(docs)).collect()}
    assert got == {(None, "email", "a.b@example.test"), (7, "email", "c.d@example.test"), (7, "phone", "+1-305-555-0146"), (7, "email", "e@example.test")}


def test_bare_numbers_are_decided_by_what_stands_before_sure_ones(spark):
    texts = ["passport 123-45-6789 was shown"] * 12 + ["passport 123456789 was shown"] * 3 + ["seat 987654321 was empty"] * 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["surface"] for r in pii.surfaces(pii.findings(docs)).collect()} == {"123-45-6789", "123456789"}
    few = spark.createDataFrame(list(enumerate(["passport 123-45-6789"] + ["passport 123456789"] * 10)), "doc_id long, text string")
    assert {r["text"] for r in pii.sanitise(few).collect()} == {"passport [ID_NUMBER]", "passport 123456789"}
    assert {r["text"] for r in pii.sanitise(few, wide_doubt=9.0).collect()} == {"passport [ID_NUMBER]", "passport [NUMBER]"}


def test_masking_is_linear_in_the_text():
    import time

    def took(n):
        body = "mail a.b@example.test or +441632960120 in 1695 Tannery Street. " * n
        start = time.perf_counter()
        spans, _ = pii.mask_forms(body)
        assert len(spans) == 3 * n
        return time.perf_counter() - start

    took(50)
    assert took(8000) < 8 * 4 * max(took(1000), 0.01)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pii.surfaces(pii.findings(docs)).count() == 0 and pii.sanitise(docs).count() == 0


def test_very_long_text(spark):
    body = "Rain swept over Hollow Park before play. " * 40_000 + "Mail me: a@b.test"
    spans, masked = pii.mask_forms(body)
    assert [body[a:b] for *_, a, b in spans] == ["a@b.test"] and len(masked) == len(body)
