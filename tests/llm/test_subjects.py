from __future__ import annotations

import random

from tarnwerk.llm import subjects

TOPIC = {
    "floors": ["the mat {} has curled up", "oil was spilled on the floor {}", "a worker slipped on wet tiles {}", "suelo mojado con aceite {}"],
    "heights": ["the ladder {} has a broken rung", "the scaffold {} had no rail", "the harness was not clipped {}", "la escalera estaba rota {}"],
}
TOPIC |= {
    "electrical": ["the cable {} showed bare copper", "a breaker tripped {} again", "the socket {} was wet", "el enchufe quemado {}"],
    "chemicals": ["a drum of solvent leaked {}", "strong fumes were noticed {}", "the label was missing on the tank {}", "goteó el disolvente {}"],
    "guarding": ["the guard {} was unbolted", "the interlock was bridged {}", "a sleeve was caught by the shaft {}", "la cinta sin resguardo {}"],
    "lifting": ["the sling {} had cut strands", "the crane carried a coil over people {}", "the hook latch {} was broken", "la grúa pasó por encima {}"],
}
FILLER = ["the list was signed {}", "photos are kept in the folder {}", "the meeting was moved {}", "coffee was served {}"]
PLACES = ["in hall 3", "near bay 7", "at the gate", "by the store", "on level 2"]


def corpus(n=600):
    rnd = random.Random(9)
    say = lambda xs: rnd.choice(xs).format(rnd.choice(PLACES)).capitalize() + "."
    docs, truth = [], {}
    for i in range(n):
        own = rnd.sample(sorted(TOPIC), rnd.choice([0, 1, 1, 2]))
        ss = [say(TOPIC[s]) for s in own for _ in range(rnd.choice([2, 3]))] + [say(FILLER) for _ in range(3)]
        for s in TOPIC:
            if s not in own and rnd.random() < 0.08:
                ss.append(say(TOPIC[s]))  # a single sentence does not count
        rnd.shuffle(ss)
        docs.append((i, " ".join(ss)))
        truth[i] = set(own)
    return docs, truth


def test_held_out_accuracy(spark):
    docs, truth = corpus()
    d = spark.createDataFrame([*docs, (9001, None), (9002, "")], "doc_id bigint, text string")
    areas = spark.createDataFrame([("floors", "x", ["slipped"]), ("heights", "y", ["ladder"]), *[(s, s, []) for s in ("electrical", "chemicals", "guarding", "lifting")], (None, "z", None)], "subject_code string, subject_name string, keywords array<string>")
    labels = spark.createDataFrame([(i, s, "r") for i in range(160) for s in truth[i]] + [(None, "floors", "r"), (3, "unknown", "r")], "doc_id bigint, subject_code string, rater string")
    got = {}
    for r in subjects.find_subjects(d, areas, labels).collect():
        got.setdefault(r.doc_id, set()).add(r.subject_code)
    right = sum(got.get(i, set()) == truth[i] for i in range(160, 600))
    assert right >= 0.95 * 440
    assert not {9001, 9002} & set(got)


def test_empty(spark):
    areas = spark.createDataFrame([("floors", "x", ["slipped"])], "subject_code string, subject_name string, keywords array<string>")
    d = spark.createDataFrame([], "doc_id bigint, text string")
    assert subjects.find_subjects(d, areas, spark.createDataFrame([], "doc_id bigint, subject_code string, rater string")).count() == 0


def test_keywords_stand_in_for_missing_labels(spark):
    docs, truth = corpus(300)
    areas = spark.createDataFrame([("floors", "x", ["slipped", "mat"]), ("heights", "y", ["ladder", "scaffold"])], "subject_code string, subject_name string, keywords array<string>")
    m = subjects.train(spark.createDataFrame(docs, "doc_id bigint, text string"), areas, spark.createDataFrame([], "doc_id bigint, subject_code string, rater string"))
    assert m.subjects == ["floors", "heights"]
