from __future__ import annotations

import random

import numpy as np

from tarnwerk.llm import clusters

E = [("pallet mover", "shuttle cart"), ("roll door", "shutter door"), ("core drill", "coring rig"), ("floor scrubber", "scrubber drier")]
P = [("at the north dock", "by the loading dock"), ("in the ash bunker", "ash hopper"), ("on the salt yard", "out in the salt field"), ("near the boiler", "boiler annex")]
Fa = [("ran hot and smoked", "overheated badly"), ("restarted on its own", "came back unexpectedly"), ("tipped over sideways", "nearly fell over"), ("leaked oil all over", "was losing oil")]
ODD = ("fish tank", "flag pole", "bus shelter", "coat rack", "bike shed", "lunch table"), ("gym", "sauna", "car wash", "phone box", "store front", "south lawn"), ("rattled", "froze solid", "lost its handle", "was glued shut", "squeaked badly", "dripped rust")
CLOSERS = ("Nobody hurt.", "Photo attached.", "Work order raised.")


def cards(n=600):
    rnd = random.Random(6)
    rows, truth = [], {}
    groups = [(0, 0, 0), (1, 1, 1), (2, 2, 2), (3, 3, 3), (0, 1, 2), (2, 0, 1)]
    for i in range(n):
        if i % 6 == 5:
            e, p, f = (rnd.choice(x) for x in ODD)
            key = (e, p, f)
            place = f"in the {p}"
        else:
            key = groups[rnd.randrange(len(groups))]
            e, place, f = rnd.choice(E[key[0]]), rnd.choice(P[key[1]]), rnd.choice(Fa[key[2]])
        s = rnd.choice([f"{e} {f} {place}.", f"{place}: {e} {f}.", f"The {e} {place} {f}.", f"{e} {f}, {place}."])
        s = s[0].upper() + s[1:]
        if rnd.random() < 0.5:
            s += " " + rnd.choice(CLOSERS)
        rows.append((i, rnd.choice(["Card | ", ""]) + s + (f" | {e}" if i % 6 != 5 and rnd.random() < 0.5 else "")))
        truth[i] = key
    return rows, truth


def test_happenings(spark):
    rows, truth = cards()
    df = spark.createDataFrame([*rows, (9001, None), (9002, "")], "incident_id bigint, text string")
    got = {r.incident_id: r.first_id for r in clusters.happenings(df, "incident_id", "text").collect()}
    by = {}
    for i, k in truth.items():
        by.setdefault(k, []).append(i)
    want = {i: min(v) for v in by.values() if len(v) >= 3 for i in v}
    odd = {i for i in want if truth[i][0] in ODD[0]}
    assert {i: f for i, f in got.items() if i not in odd} == {i: f for i, f in want.items() if i not in odd}
    assert {i for i in got if truth[i][0] in ODD[0]} <= odd


def test_describe_and_empty(spark):
    rows, _ = cards(200)
    h = clusters.happenings(spark.createDataFrame(rows, "incident_id bigint, text string"), "incident_id", "text")
    d = clusters.describe(h, "incident_id").collect()
    assert d and all(r.first_id and len(r.typical) <= 5 or r.first_id == 0 for r in d)
    assert clusters.happenings(spark.createDataFrame([], "incident_id bigint, text string"), "incident_id", "text").count() == 0


def test_typical_members_are_the_nearest_cards(spark):
    rows = [(i, "a", 4, d, 6, 1) for i, d in ((1, 0.5), (2, 0.1), (3, 0.1), (4, 0.1), (5, 0.1), (6, 0.9))] + [(7, "b", 3, 0.0, 3, 7), (8, "b", 3, 0.0, 3, 7), (9, "b", 3, 0.0, 3, 7)]
    df = spark.createDataFrame(rows, "k bigint, leaf string, wording bigint, distance double, group_size bigint, first_id bigint")
    assert {r.first_id: r.typical for r in clusters.describe(df, "k").collect()} == {1: [2, 3, 4, 5, 1], 7: [7, 8, 9]}


def test_bisecting_leaves_are_compact():
    kinds = [(str(i % 5), str(i % 7), str(i % 3)) for i in range(105)]
    x = clusters.vectors(kinds)
    leaf = clusters.bisect_local(x, np.ones(len(x)))
    assert len(set(leaf)) == 105
    twice = clusters.bisect_local(np.vstack([x, x]), np.ones(210))
    assert all(twice[i] == twice[i + 105] for i in range(105))


def test_large_nodes_are_split_across_the_cluster(spark, monkeypatch):
    monkeypatch.setattr(clusters, "LOCAL_NODE", 20)
    pts = spark.createDataFrame([(str(i % 6), str(i % 5), f"={i}", i % 3 + 1) for i in range(120)], "e string, p string, f string, n bigint")
    leaves = clusters.bisect(pts).collect()
    assert len(leaves) == 120 and len({r.leaf for r in leaves}) == 120


def test_bisecting_forms_the_kinds(spark, monkeypatch):
    # x0-x5 meet one half of the partners each, in slightly different numbers; six phrases are two kinds.
    rows = []
    for i in range(6):
        for j in range(3):
            rows += [("equipment", f"x{i}", "place", f"p{i % 2}{j}", 20 + i * j), ("equipment", f"x{i}", "fault", f"f{i % 2}{j}", 30 - i * j)]
    rows += [("place", f"p{h}{j}", "fault", f"f{h}{k}", 9) for h in range(2) for j in range(3) for k in range(3)]
    pairs = spark.createDataFrame(rows, "slot_a string, a string, slot_b string, b string, n bigint")
    # Bisecting alone groups them, and so it does with nodes split across the cluster.
    for node in (2_000, 2):
        monkeypatch.setattr(clusters, "LOCAL_NODE", node)
        got = {(r.slot, r.phrase): r.kind for r in clusters.learn_kinds(pairs).collect()}
        assert {k: v for k, v in got.items() if k[0] == "equipment"} == {("equipment", f"x{i}"): f"x{i % 2}" for i in range(6)}
        assert got["place", "p02"] == "p00" and got["fault", "f12"] == "f10"


def test_kinds_are_learned_from_all_phrases(spark, monkeypatch):
    # 3,200 happenings of 3 cards each: none of their phrases is more frequent than another.
    word = lambda i: "".join("bcdfghjk"[int(c)] + "aeiou"[int(c) % 5] for c in f"{i:05o}")
    rows = [(3 * i + j, f"{word(i)}y room: {word(i)}x unit broke {word(i)}z apart | {word(i)}x unit") for i in range(3200) for j in range(3)]
    seen = {}

    def all_alone(pairs):
        seen.update({s: {r.x for r in pairs.selectExpr("slot_a as s", "a as x").union(pairs.select("slot_b", "b")).where(f"s = '{s}'").distinct().collect()} for s in clusters.SLOTS})
        return spark.createDataFrame([], "slot string, phrase string, kind string")

    monkeypatch.setattr(clusters, "learn_kinds", all_alone)
    df = spark.createDataFrame(rows, "incident_id bigint, text string")
    assert clusters.happenings(df, "incident_id", "text").count() == 9600
    assert {s: len(x) for s, x in seen.items()} == dict.fromkeys(clusters.SLOTS, 3200)


def test_slips():
    assert clusters.swapped("dokc", "dock") and not clusters.swapped("dock", "deck")


def test_a_rare_slip_is_read_in_a_large_corpus(spark):
    # One slip among 1.2 million words: its card belongs to the happening as it does among a few.
    card = "Roll door: north dock, boiler beside stone passage rattled badly"
    rows = spark.range(120_000).selectExpr("id as incident_id", f"'{card}' as text").union(spark.createDataFrame([(200_000, card.replace("rattled", "ratlted"))], "incident_id bigint, text string"))
    reader = clusters.learn_reader(rows, "text")
    assert reader.slips == {"ratlted": "rattled"}
    got = clusters.happenings(rows, "incident_id", "text")
    assert got.where("incident_id = 200000").select("group_size", "first_id").collect() == [(120_001, 0)]


def test_equipment_with_many_places_and_faults_has_a_kind(spark):
    # Ten kinds of equipment in two wordings, each with 20 happenings of its own at 20 places: 20 partners are no reason
    # to leave a phrase alone. One-off cards of another device meet everything alike: its places and faults stay apart.
    rnd = random.Random(4)
    word = lambda a, i: a + "bcdfgklmnprs"[i % 12] + "aeiou"[i // 12] + "x"
    told = [(e, p, f) for e in range(10) for p, f in zip(rnd.sample(range(60), 20), rnd.sample(range(60), 20))]
    rows, truth = [], {}
    for e, p, f in told:
        for _ in range(24):
            unit, place, fault = (f"{word(rnd.choice(w), i)} {n}" for w, i, n in (("st", e, "unit"), ("vw", p, "room"), ("hj", f, "broke")))
            truth[len(rows)] = (e, p, f)
            rows.append((len(rows), f"{place}: {unit} {fault} | {unit}"))
    once = len(rows)
    rows += [(once + i, f"odd{word('k', i % 20)} yard: spare gadget {word('q', i % 31)} {word('z', i % 37)} | spare gadget") for i in range(600)]
    got = {r.incident_id: r.first_id for r in clusters.happenings(spark.createDataFrame(rows, "incident_id bigint, text string"), "incident_id", "text").collect()}
    first = {}
    for i, k in truth.items():
        first.setdefault(k, i)
    assert {i: f for i, f in got.items() if i < once} == {i: first[k] for i, k in truth.items()}
    assert not [i for i in got if i >= once]
