from __future__ import annotations

import random

from tarnwerk.llm import leaks

WORDS = [f"w{i}" for i in range(300)] + "the of and in to a".split() * 10


def brute(a, b, run=leaks.RUN):
    for i in range(len(a) - run + 1):
        w = a[i : i + run]
        for j in range(len(b)):
            for size in (run - 1, run, run + 1):
                v = b[j : j + size]
                if len(v) < size:
                    continue
                p = 0
                while p < min(size, run) and v[p] == w[p]:
                    p += 1
                q = 0
                while q < min(size, run) - p and v[-1 - q] == w[-1 - q]:
                    q += 1
                if p + q >= (run if size > run else run - 1):
                    return True
    return False


def planted(rnd):
    items = [(k, " ".join(rnd.choice(WORDS) for _ in range(rnd.randrange(8, 60)))) for k in range(25)]
    docs = []
    for d in range(120):
        ws = [rnd.choice(WORDS) for _ in range(rnd.randrange(0, 150))]
        if d % 2:
            it = items[rnd.randrange(25)][1].split()
            lo = rnd.randrange(max(1, len(it) - 10))
            part = it[lo : lo + rnd.randrange(9, 16)]
            for _ in range(rnd.randrange(3)):
                k = rnd.randrange(len(part))
                part[k : k + 1] = rnd.choice([[], ["zz"], [part[k], "yy"]])
                part = part or ["x"]
            at = rnd.randrange(len(ws) + 1)
            ws[at:at] = part
        docs.append((d, " ".join(ws)))
    return items, docs


def test_against_brute_force(spark):
    rnd = random.Random(5)
    items, docs = planted(rnd)
    got = {(r.doc_id, r.item_id) for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, item_text string")).collect()}
    want = {(d, i) for d, t in docs for i, x in items if brute(x.split(), t.split())}
    assert got == want and len(want) > 10


def test_spelling_does_not_matter(spark):
    item = "The quick brown fox jumps over the lazy dog while seven wizards calmly watch the moon"
    docs = [(1, item.upper()), (2, "x " * 40 + "the quick, brown fox -- jumps over\nthe la-\nzy dog; while seven wizards calmly"), (3, "The quick brown fox jumps"), (4, None), (5, ""), (6, "pad " * 50000 + item)]
    got = {r.doc_id for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame([(7, item), (8, None), (None, item)], "item_id int, item_text string")).collect()}
    assert got == {1, 2, 6}


def test_empty_tables(spark):
    d, i = spark.createDataFrame([], "doc_id int, text string"), spark.createDataFrame([], "item_id int, item_text string")
    assert leaks.find_leaks(d, i).count() == 0
    assert leaks.find_leaks(spark.createDataFrame([(1, "a b")], "doc_id int, text string"), i).count() == 0


def test_wand_gives_all_above_the_least_score():
    rnd = random.Random(2)
    items, docs = planted(rnd)
    ix = leaks.Index(items)
    for _, t in docs[:60]:
        q = set(leaks.pairs(leaks.normal_words(t)))
        scores = {}
        for w in q:
            for k, s in ix.postings.get(w, ()):
                scores[k] = scores.get(k, 0) + s
        assert set(ix.retrieve(q)) == {k for k, s in scores.items() if s >= ix.least[k]}
