from __future__ import annotations

import random

import numpy as np
import pytest

from tarnwerk.llm import langid, pairs

Q = "Classify the record.\n\nThe forklift backed out of the hall. The operator was not hurt and the work went on."
ES = "Resume este registro.\n\nEl operario resbaló en el pasillo y cayó sobre una rodilla."
ENDS = frozenset({"went on", "the hall", "the shift", "not explain"})
MODEL = langid.seed_model()

CASES = [
    (None, Q, "empty"), ("  ​", Q, "empty"), ("N/A", Q, "empty"), ("```json\n\n```", Q, "empty"), ('{"a": "", "b": [], "c": null}', Q, "empty"), ("[]", Q, "empty"),
    ('{"a": "Close the hall.", "b": ["x', Q, "truncated"), ('```json\n{"a": {"b": "Close it."}', Q, "truncated"), ("Close the door. Tell the", Q, "truncated"),
    ('{"a": "Close the hall now and tell the crew.",}', Q, None), ('```json\n{"a": "Close the hall now and tell the crew."}\n```', Q, None), ("Name one owner for the spot. Then tell the shift", Q, None),
    ("Sorry, I cannot help with this record.", Q, "refusal"), ('{"a": "I must decline to judge this.", "b": "unknown"} Thank you.', Q, "refusal"), ("No me corresponde valorar este suceso.", ES, "refusal"),
    ("Tut mir leid, dabei kann ich nicht helfen.", Q, "refusal"), ("I cannot confirm from the text whether the gate was shut. Close it and tell the crew.", Q, None),
    ("The forklift backed out of the hall.", Q, "copied"), ("- the forklift backed out of the hall\n- The operator was not hurt and the work went on.", Q, "copied"), ("The forklift backed out of the hall. Train all of the drivers again.", Q, None),
    ("The forklift backed out of hall 7.", Q, None), ("El operario resbaló en el pasillo y se hizo daño. Cerrar la zona y avisar al turno de la noche.", Q, "wrong_language"),
    ("The operator slipped in the aisle and was hurt by the fall. Close the area and tell the crew.", ES, "wrong_language"), ("Cerrar la zona y avisar al turno de la noche con una señal.", Q.replace("record.", "record. Answer in Spanish."), None),
]


@pytest.mark.parametrize("answer,question,want", CASES)
def test_defects(answer, question, want):
    assert pairs.defect(answer, question, MODEL, ENDS) == want


def test_pushdown_parser():
    p = pairs.parse('{"k": ["a \\"b\\" }", {"x": "c"}], "n": 3} tail')
    assert p.closed and p.values == ['a "b" }', "c"] and p.tail == "tail" and p.filled
    assert not pairs.parse('{"k": "open').closed
    assert pairs.parse("plain").values == ["plain"]


def test_parser_keeps_fences_lists_and_markup_on_the_stack():
    assert pairs.parse("Here it is:\n```json\n{\"a\": \"b c\"}\n```").closed and pairs.parse("Here it is: {\"a\": \"b").open == ["}", '"']
    assert pairs.parse("```\nClose the hall.").open == ["fence"] and pairs.parse("<ul><li>Close it</li><li>Tell").open == ["ul"]
    assert pairs.parse("1. Close it.\n2. Tell them.\n3.").open == ["item"] and pairs.parse("See (item 3) and “that”.").open == []
    for text, want in (("1. Close the hall.\n2.", True), ("```\nClose the hall.", False), ("Close it (see the", True), ("<p>Close the hall.</p><li", True)):
        assert pairs.breaks_off(text, ENDS, pairs.parse(text).open) is want, text


def test_script_tells_the_language():
    due = langid.LANGS.index
    assert pairs.wrong_language("Закрыть зону и сообщить смене", due("en"), np.zeros(6), 0) and not pairs.wrong_language("Закрыть зону и сообщить смене", due("ru"), np.zeros(6), 0)
    assert pairs.wrong_language("关 闭 区 域", due("de"), np.zeros(6), 0) and langid.script_of("12 34") is None


def test_tiling_against_brute_force():
    rnd = random.Random(5)
    for _ in range(400):
        a, r = [rnd.choice("abc") for _ in range(rnd.randrange(12))], [rnd.choice("abcd") for _ in range(rnd.randrange(12))]
        assert pairs.tiled(a, r, 2) == slow_tiles(a, r, 2)


def slow_tiles(a, r, least):
    """Greedy string tiling as published: all longest free matches of a round are placed, in order of position."""
    fa, fr, covered = [True] * len(a), [True] * len(r), 0
    while True:
        best, longest = [], least - 1
        for i in range(len(a)):
            for j in range(len(r)):
                n = 0
                while i + n < len(a) and j + n < len(r) and fa[i + n] and fr[j + n] and a[i + n] == r[j + n]:
                    n += 1
                best, longest = ([(i, j)], n) if n > longest else ([*best, (i, j)], longest) if n == longest >= least else (best, longest)
        if not best:
            return covered
        for i, j in best:
            if all(fa[i : i + longest]) and all(fr[j : j + longest]):
                fa[i : i + longest] = fr[j : j + longest] = [False] * longest
                covered += longest


def test_tiling_counts_words_once():
    assert pairs.tiled("a b c a b c".split(), "x a b c y".split()) == 3
    assert pairs.tiled([], []) == 0


def test_query_shape(spark):
    schema = "chat_id bigint, messages array<struct<role: string, content: string>>, parse_status string, llm_free_text_description string, extra string"
    rows = [
        (1, [("user", Q), ("Assistant ", "N/A")], "parsed_json", "ignored", "x"), (1, [("user", Q), ("Assistant ", "N/A")], "parsed_json", "ignored", "x"), (2, None, " Fallback_From_Invalid_JSON", None, "x"),
        (3, [("user", Q), ("assistant", "Close the door. " * 5000 + "Tell the")], None, None, None), (4, [("user", None), ("assistant", None)], None, "", None), (None, None, None, None, None),
    ]
    got = {(r.chat_id, r.answer_field, r.defect) for r in pairs.find_defects(spark.createDataFrame(rows, schema)).collect()}
    assert got == {(1, "messages", "empty"), (2, "messages", "empty"), (2, "llm_free_text_description", "empty"), (3, "messages", "truncated"), (4, "messages", "empty")}
    assert pairs.find_defects(spark.createDataFrame([], schema)).count() == 0
