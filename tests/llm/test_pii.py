from __future__ import annotations

import random
import re

from tarnwerk.llm import pii

GIVEN, FAMILY = "Alba Bruno Celia Dario Elvin Fiona Gregor Hilma".split(), "Karsten Lomax Morven Nyland Ostrander Pilbeam Quennell Rushton".split()


def corpus():
    rnd = random.Random(8)
    rows, want = [], set()

    def add(text, *found):
        rows.append(("t", len(rows), text))
        want.update((len(rows) - 1, k, s) for k, s in found)

    name = lambda: f"{rnd.choice(GIVEN)} {rnd.choice(FAMILY)}"
    for i in range(60):
        n, m, a = name(), name(), f"{rnd.randrange(1, 90)} {rnd.choice(['Tallow', 'Fern', 'Moss'])} {rnd.choice(['Street', 'Road', 'Lane'])}"
        add(f"Mr {n} can be reached on +44 20 7946 0{rnd.randrange(100, 999)} after work.")
        want.add((len(rows) - 1, "person_name", n))
        add(f"The helper, {m}, was sent to rest.", ("person_name", m))
        add(f"Ask {n} before opening the valve again.", ("person_name", n))
        add(f"Driver lives at {a} and walked home.", ("street_address", a))
        ssn = f"000-{rnd.randrange(10, 99)}-{rnd.randrange(1000, 9999)}"
        add(f"Badge copy shows number {ssn}.", ("identity_no", ssn))
        add("Road 7 was closed and the Bramwell 400 press was idle.")
        add("Ticket #3125550 is linked to order 4500-5550-1472-2 on 12-04-2023.")
        mail = f"{rnd.choice(GIVEN).lower()}.{rnd.choice(FAMILY).lower()}@example.org"
        add(f"Photos were mailed from {mail} the same day.", ("email", mail))
    add("Driver lives at Kiebitzbogen 44 and walked home.", ("street_address", "Kiebitzbogen 44"))
    add("Badge copy shows number ID-4471-52-KX.", ("identity_no", "ID-4471-52-KX"))
    add("The helper, Zoltan Unseen, was sent to rest.", ("person_name", "Zoltan Unseen"))
    add("mail jo [at] plant.example.com now", ("email", "jo [at] plant.example.com"))
    add(None)
    add("")
    add("Wohnhaft in Großmöwenstraße 14, nach Hause gefahren.", ("street_address", "Großmöwenstraße 14"))
    add("word " * 30000)
    return rows, want


def test_bootstrapping_finds_what_no_seed_shows(spark):
    rows, want = corpus()
    df = spark.createDataFrame(rows, "table_name string, record_id bigint, text string")
    finder = pii.learn(df, "text")
    got = {(r.record_id, r.pii_type, r.pii_text) for r in pii.find_mentions(df, finder).collect()}
    assert {g for g in got if g[1] != "phone"} == want
    assert sum(g[1] == "phone" for g in got) == 60
    red = {r.record_id: r.redacted for r in pii.redact(df, finder).collect()}
    assert red[0].startswith("Mr [PERSON_NAME] can be reached on [PHONE] after work.")
    assert red[5] == rows[5][2] and red[len(rows) - 4] is None


def test_empty(spark):
    assert pii.find_mentions(spark.createDataFrame([], "table_name string, record_id bigint, text string")).count() == 0


def test_words_before_names_and_at_sentence_begins_are_no_names(spark):
    """50,000 rows with lead-ins, initials before a new sentence and names beside each other: all mentions, no others."""
    rnd = random.Random(3)
    lead = ["Ask {} before opening the valve again.", "Witness {}, phone to follow.", "Statement taken from {}. Acid was stored beside bleach.", "Spouse {} was told.", "Bitte {} vor dem Öffnen fragen.", "The helper, {}, was sent to rest.", "Mr {} can be reached after work."]
    plain = ["Acid was stored beside bleach.", "Water next to the silo was soapy.", "SPEED OF THE CART WAS HIGH.", "<p>Next to the tank the pump ran.</p>", "Ask the night crew first.", "Witness statements are on file.", "The Bramwell 400 press was idle."]
    rows, want = [], set()
    for i in range(50_000):
        if i % 10:
            rows.append(("t", i, f"{rnd.choice(plain)} {rnd.choice(plain)}"))
            continue
        full = f"{rnd.choice(GIVEN)} {rnd.choice(FAMILY)}"
        shown = rnd.choice([full, full, full.upper(), f"{full.split()[1]}, {full.split()[0]}"])
        rows.append(("t", i, f"{rnd.choice(plain)} {rnd.choice(lead).format(shown)} {rnd.choice(plain)}"))
        want.add((i, "person_name", shown))
    got = {(r.record_id, r.pii_type, r.pii_text) for r in pii.find_mentions(spark.createDataFrame(rows, "table_name string, record_id bigint, text string")).collect()}
    both = len(got & want)
    assert both >= 0.95 * len(want) and both >= 0.95 * len(got), (len(want), len(got), both)


def test_texts_without_a_sign_give_no_links():
    """The JVM's test drops no link: whatever the learning pass takes from a text needs one of its signs."""
    rows, _ = corpus()
    sign = re.compile(pii.SIGN)
    assert all(not list(pii.candidates(t)) for _, _, t in rows if t and not sign.search(t))


def test_a_model_of_any_size_finds_the_same(spark, monkeypatch):
    """Nothing learned is left out of a model that is too large to be broadcast, and parts with what they can look up find
    the same as the whole."""
    rows, want = corpus()
    rnd = random.Random(5)
    rows += [("t", 10_000 + i, f"{rnd.choice(GIVEN).upper()} {rnd.choice(FAMILY)[0]}. told O'{rnd.choice(FAMILY)}, {rnd.choice(GIVEN)} A. {rnd.choice(FAMILY)} and C. {rnd.choice(FAMILY).lower()} at {rnd.randrange(9)} Moss Lane" + " " * rnd.randrange(40) + f"Badge {rnd.randrange(10**6, 10**7)}.") for i in range(200)]
    df = spark.createDataFrame(rows, "table_name string, record_id bigint, text string").repartition(3, "record_id")
    found = lambda: sorted(tuple(r) for r in pii.find_mentions(df).collect())
    hidden = lambda: sorted((r.record_id, r.redacted or "") for r in pii.redact(df).collect())
    whole, clean = found(), hidden()
    monkeypatch.setattr(pii, "MAX_ENTRIES", 10)
    monkeypatch.setattr(pii, "PART_BITS", 5, raising=False)
    assert found() == whole and hidden() == clean
    assert {(i, k, s) for _, i, k, s in whole if k != "phone" and i < 10_000} >= want


def test_more_texts_take_no_pattern_away(spark, monkeypatch):
    """Texts told again teach the same: the graph's counts grow, and the model stays."""
    rows, _ = corpus()
    df = spark.createDataFrame([r for r in rows if r[2]], "table_name string, record_id bigint, text string")
    monkeypatch.setattr(pii, "MAX_ENTRIES", 1000)
    once, often = (pii.learn(x, "text") for x in (df, df.crossJoin(spark.range(40)).drop("id")))
    assert once.names == often.names and once.pats == often.pats
