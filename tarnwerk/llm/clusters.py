"""Grouping records into happenings (problem 5): bisecting k-means over phrases of equipment, place and fault.

A card names equipment, a place and what went wrong, each in varying words. Closing remarks are found by frequency
and dropped, and phrases are read off the cards' own structure. The vector of a phrase is made of how it meets the
phrases of the two other slots, so phrases that meet the same partners lie close; bisecting k-means splits the widest
node of a slot until every leaf is compact. A leaf is one kind, and a happening is one kind of each slot.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnwerk.llm.text import plain
from tarnwerk.operators.lineage import cut

#: A whole sentence in this share of all cards, beside others, is a closing remark.
CLOSER_SHARE = 0.01
#: A phrase that has more partners than this in effect, and as many beside each single partner of the third slot, meets
#: everything alike: nothing describes it, and it is a kind of its own.
PARTNERS = 16.0
#: Rounds in which kinds are formed, each with the kinds of the one before as partners.
ROUNDS = 4
#: A word is a slip of another one with the same letters that is so many times as frequent.
SLIP_RATIO = 10
DIM = 32
#: A leaf is compact if no member is farther from its centre.
RADIUS = 0.2
#: Positions of a phrase's vector for each of the two other slots, and the radius of a compact kind: a phrase is a unit
#: vector for each, and phrases without a common partner are 2 apart.
SHARE_DIM, KIND_RADIUS = 256, 0.6
#: A node of at most so many different vectors is finished within one task, by the same steps.
LOCAL_NODE = 2_000
#: Rounds of means when a node is split.
MEANS = 4
MIN_GROUP = 3
SLOTS = ("equipment", "place", "fault")

#: Fixed value list: words that lead to a place and belong to no name of it.
LEADING = set("in at by on the inside near next to out up beside outside under of a an location around behind from within along over into onto below above between off".split())
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_TOKEN = re.compile(r"[^\W_]+(?:['’/-][^\W_]+)*|[,:]")


def segments(text: str) -> tuple[list[str], list[str]]:
    """(short parts, sentences) of a card: the parts between bars in lower case, the longest of them as sentences."""
    parts = [p.strip() for p in plain(text).lower().split("|")]
    parts = [p for p in parts if p]
    if not parts:
        return [], []
    body = max(parts, key=len)
    return [p for p in parts if p is not body], [s.strip(" .!?") for s in _SENTENCE.split(body) if s.strip(" .!?")]


def signature(s: str) -> str:
    """Letters of a text in order of the alphabet: equal for texts that differ by swapped letters."""
    return "".join(sorted(c for c in s if c.isalnum()))


class Reader:
    """Reads a card into phrases of equipment, place and fault."""

    def __init__(self, closers: frozenset[str], slips: dict[str, str], equipment: frozenset[str] = frozenset(), places: frozenset[str] = frozenset()):
        self.closers, self.slips, self.equipment, self.places = closers, slips, equipment, places
        self.longest_e = max((e.count(" ") + 1 for e in equipment), default=0)
        self.longest_p = max((p.count(" ") + 1 for p in places), default=0)

    def tokens(self, s: str) -> list[str]:
        return [self.slips.get(w, w) for w in _TOKEN.findall(s)]

    def core(self, text: str | None) -> tuple[list[str], list[str]]:
        """(short parts, words of the sentences that tell what happened)."""
        if not text:
            return [], []
        short, ss = segments(text)
        kept = [s for s in ss if signature(s) not in self.closers]
        ws: list[str] = []
        for s in kept:
            ws += [*([","] if ws else []), *self.tokens(s)]
        return [" ".join(self.tokens(p)) for p in short], ws

    def hints(self, text: str | None) -> Iterator[tuple[str, str]]:
        """Phrases that a card shows by its structure: a short part that recurs in the sentence is equipment; what
        stands before a colon, after ``location`` or after the last comma is a place."""
        short, ws = self.core(text)
        joined = f" {' '.join(ws)} "
        for p in short:
            if f" {p} " in joined:
                yield "equipment", p
        if ":" in ws:  # the plainest sign: one such card is enough
            yield "place", strip_leading(ws[: ws.index(":")])
            yield "place", strip_leading(ws[: ws.index(":")])
        elif "location" in ws:
            yield "place", strip_leading(ws[ws.index("location") :])
        elif "," in ws:
            last = ws[len(ws) - ws[::-1].index(",") :]
            if 0 < len(last) <= 6:
                yield "place", strip_leading(last)

    def read(self, text: str | None) -> tuple[str, str, str]:
        """(equipment, place, fault); what is not recognised stays in the fault."""
        short, ws = self.core(text)
        place = ""
        if ":" in ws:
            k = ws.index(":")
            place, ws = strip_leading(ws[:k]), ws[k + 1 :]
        elif "location" in ws:
            k = ws.index("location")
            place, ws = strip_leading(ws[k:]), ws[:k]
        ws = [w for w in ws if w != ","]
        while ws and ws[0] in ("the", "a", "an"):
            ws = ws[1:]
        equipment = ""
        for n in range(min(self.longest_e, len(ws)), 0, -1):
            if " ".join(ws[:n]) in self.equipment:
                equipment, ws = " ".join(ws[:n]), ws[n:]
                break
        if not place:
            place, ws = self._take_place(ws, not equipment)
        return equipment, place, " ".join(ws)

    def _take_place(self, ws: list[str], skip_first: bool) -> tuple[str, list[str]]:
        """The longest known place in a sentence, the last of equal ones, with the words that lead to it cut out."""
        for n in range(min(self.longest_p, len(ws)), 0, -1):
            for i in range(len(ws) - n, -1 + skip_first, -1):
                p = " ".join(ws[i : i + n])
                if p in self.places:
                    k = i
                    while k > 0 and ws[k - 1] in LEADING:
                        k -= 1
                    return p, ws[:k] + ws[i + n :]
        return "", ws


def strip_leading(ws: list[str]) -> str:
    ws = [w for w in ws if w not in (",", ":")]
    while ws and ws[0] in LEADING:
        ws = ws[1:]
    return " ".join(ws)


def _tally(df: DataFrame, emit, keys: str) -> DataFrame:
    """Counts of what ``emit`` yields for each text, combined per batch and then summed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            c: Counter = Counter()
            for t in b["t"]:
                c.update(emit(t))
            yield pd.DataFrame([(*k, n) for k, n in c.items()], columns=[*keys.split(), "n"])

    rows = df.mapInPandas(count, ", ".join(f"{k} string" for k in keys.split()) + ", n bigint")
    return rows.groupBy(*keys.split()).agg(F.sum("n").alias("n"))


def learn_reader(cards: DataFrame, text: str) -> Reader:
    """Closing remarks, slips of the pen and the phrases of the slots, by counts over all cards (actions). The
    reader holds all phrases of equipment and place that two hints support and all slips, of which a word of k letters has
    at most k - 1; closing remarks are bounded by their share of the corpus."""
    texts = cards.select(F.col(text).alias("t")).where(F.length("t") > 0)
    total = texts.count()
    spark = cards.sparkSession

    def words_of(t: str):
        _, ss = segments(t)
        seen = [("s", s) for s in dict.fromkeys(ss)] + ([("only", ss[0])] if len(ss) == 1 else [])
        return seen + [("w", w) for s in ss for w in _TOKEN.findall(s)]

    counts = cut(_tally(texts, words_of, "kind item"))
    # A remark goes with something else: it is frequent, and hardly ever a whole card. At most 1 / CLOSER_SHARE sentences
    # per sentence of a card can be so frequent.
    alone = F.sum(F.when(F.col("kind") == "only", F.col("n")).otherwise(0))
    often = counts.where(F.col("kind") != "w").groupBy("item").agg(F.sum(F.when(F.col("kind") == "s", F.col("n")).otherwise(0)).alias("n"), alone.alias("alone"))
    closers = {signature(r.item) for r in often.where((F.col("n") >= max(3, CLOSER_SHARE * total)) & (F.col("alone") <= 0.1 * F.col("n"))).select("item").collect()}
    # A slip has the letters of a far more frequent word: of each set of letters the most frequent word is joined back.
    vocabulary = counts.where((F.col("kind") == "w") & (F.length("item") > 3)).select("item", "n", F.array_join(F.array_sort(F.split("item", "")), "").alias("letters"))
    most = vocabulary.groupBy("letters").agg(F.max(F.struct("n", "item")).alias("best"), F.count(F.lit(1)).alias("forms")).where(F.col("forms") > 1)
    near = vocabulary.join(most, "letters").where((F.col("item") != F.col("best.item")) & (F.col("n") * SLIP_RATIO <= F.col("best.n")))
    slips = {r.item: r.best for r in near.select("item", F.col("best.item").alias("best")).toLocalIterator() if swapped(r.item, r.best)}
    first = Reader(frozenset(closers), slips)
    shared = spark.sparkContext.broadcast(first)
    hints = _tally(texts, lambda t: list(shared.value.hints(t)), "slot item").where((F.col("item") != "") & (F.col("n") >= 2))
    found: dict[str, set[str]] = {"equipment": set(), "place": set()}
    for slot in found:
        found[slot] = {r.item for r in hints.where(F.col("slot") == slot).select("item").toLocalIterator()}
    return Reader(frozenset(closers), slips, frozenset(found["equipment"]), frozenset(found["place"]))


def swapped(a: str, b: str) -> bool:
    """Whether two words differ by two neighbouring letters that changed places."""
    if len(a) != len(b):
        return False
    d = [i for i in range(len(a)) if a[i] != b[i]]
    return len(d) == 2 and d[1] == d[0] + 1 and a[d[0]] == b[d[1]] and a[d[1]] == b[d[0]]


def learn_kinds(pairs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(slot, phrase, kind) of each phrase, from counts of pairs (slot_a, a, slot_b, b, n), by the phrase c of the third slot
    if there is such a column.

    A phrase is described by how often it meets the kinds of the two other slots: the square roots of its shares, so
    that the distance of two phrases tells how much of their partners they share, projected to SHARE_DIM positions
    each. Bisecting k-means over these vectors makes the kinds of every slot; as kinds form, descriptions become sharper in the next round. A phrase that is rare or not concentrated is a kind of its own.
    A kind is named by its first phrase. Actions: three checkpoints per round and a count of the kinds.
    """
    ways = [F.struct(F.col(p).alias("s"), F.col(x).alias("x"), F.col(q).alias("o"), F.col(y).alias("y")) for p, x, q, y in (("slot_a", "a", "slot_b", "b"), ("slot_b", "b", "slot_a", "a"))]
    third = F.array_except(F.array(*map(F.lit, SLOTS)), F.array("s", "o"))[0]
    met = cut(pairs.select("n", F.col("c") if "c" in pairs.columns else F.lit("").alias("c"), F.inline(F.array(*ways))).withColumn("q", third))
    kinds = met.select("s", "x", F.col("x").alias("kind")).distinct()
    before = None
    for r in range(rounds):
        partners = kinds.select(F.col("s").alias("o"), F.col("x").alias("y"), F.col("kind").alias("z"))
        thirds = kinds.select(F.col("s").alias("q"), F.col("x").alias("c"), F.col("kind").alias("k"))
        rows = met.join(kinds, ["s", "x"]).join(partners, ["o", "y"]).join(thirds, ["q", "c"], "left").groupBy("s", "kind", "o", "z", F.coalesce("k", "c").alias("k")).agg(F.sum("n").alias("n"))
        leaves = bisect(cut(_described(cut(rows), str(r))), ("s", "kind"), KIND_RADIUS, "s")
        to = leaves.withColumn("to", F.min("kind").over(Window.partitionBy("leaf"))).select("s", "kind", "to")
        kinds = cut(kinds.join(to, ["s", "kind"], "left").select("s", "x", F.coalesce("to", "kind").alias("kind")))
        now = kinds.select("s", "kind").distinct().count()
        if now == before:
            break
        before = now
    return kinds.select(F.col("s").alias("slot"), F.col("x").alias("phrase"), "kind")


def _told(cells: DataFrame) -> DataFrame:
    """(s, kind, o) of the views in which two cards of a kind that agree in the third slot agree in slot o with a chance of 1
    in PARTNERS or more, from (s, kind, o, z, k, n) with the kind k of the third slot. However many partners such a kind
    has, it does not meet them all alike. The share of agreeing pairs does not depend on the number of cards."""
    n = F.col("n").cast("double")
    by_third = cells.where("k != ''").groupBy("s", "kind", "o", "k").agg(F.sum(n).alias("t"), F.sum(n * (n - 1)).alias("equal"))
    agree = by_third.groupBy("s", "kind", "o").agg(F.sum(F.col("t") * (F.col("t") - 1)).alias("pairs"), F.sum("equal").alias("equal"))
    return agree.where((F.col("equal") > 0) & (F.col("pairs") <= PARTNERS * F.col("equal"))).select("s", "kind", "o", F.lit(True).alias("told"))


def _described(cells: DataFrame, salt: str) -> DataFrame:
    """(s, kind, n, v): the vectors of the kinds of slots s that are frequent and concentrated, in effect or beside each
    partner of the third slot, from (s, kind, o, z, k, n)."""
    t = F.sum("n")
    rows = cells.groupBy("s", "kind", "o", "z").agg(t.alias("n"))
    view = rows.groupBy("s", "kind", "o").agg(t.alias("t"), F.exp(F.log(t) - F.sum(F.col("n") * F.log("n")) / t).alias("effect"))
    view = view.join(_told(cells), ["s", "kind", "o"], "left").where((F.col("effect") <= PARTNERS + 1e-9) | F.col("told"))
    of_first = F.when(F.col("o") == F.when(F.col("s") == SLOTS[0], SLOTS[1]).otherwise(SLOTS[0]), F.col("t"))
    fit = view.groupBy("s", "kind").agg(F.count(F.lit(1)).alias("views"), F.sum(of_first).alias("first")).where((F.col("views") == len(SLOTS) - 1) & (F.col("first") >= 3))

    def describe_one(key, b: pd.DataFrame) -> pd.DataFrame:
        others = [o for o in SLOTS if o != key[0]]
        b = b.sort_values(["o", "z"])
        v = np.zeros((len(others), SHARE_DIM))
        for o, z, n in zip(b["o"], b["z"], b["n"]):
            v[others.index(o)] += np.sqrt(n) * direction(f"{salt}:{o}:{z}", SHARE_DIM)
        v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
        return pd.DataFrame({"s": [key[0]], "kind": [key[1]], "n": [int(b["n"].sum())], "v": [v.ravel().tolist()]})

    return rows.join(fit.select("s", "kind"), ["s", "kind"]).groupBy("s", "kind").applyInPandas(describe_one, "s string, kind string, n bigint, v array<double>")


@functools.lru_cache(maxsize=20_000)
def direction(name: str, dim: int = DIM) -> np.ndarray:
    """A fixed unit vector for a name; those of different names are nearly at right angles."""
    seed = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "big")
    v = np.random.default_rng(seed).standard_normal(dim)
    return v / np.linalg.norm(v)


def vectors(kinds: list[tuple[str, str, str]]) -> np.ndarray:
    return np.array([np.concatenate([direction(f"{s}:{k}") for s, k in zip(SLOTS, ks)]) for ks in kinds]).reshape(len(kinds), DIM * len(SLOTS))


def two_means(x: np.ndarray, w: np.ndarray, rounds: int = MEANS) -> np.ndarray:
    """Split weighted points in two: from the point farthest from the centre and the one farthest from that."""
    c = np.average(x, axis=0, weights=w)
    a = x[int(((x - c) ** 2).sum(axis=1).argmax())]
    b = x[int(((x - a) ** 2).sum(axis=1).argmax())]
    side = np.zeros(len(x), dtype=bool)
    for _ in range(rounds + 1):
        side = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
        if side.all() or not side.any():
            break
        a, b = np.average(x[~side], axis=0, weights=w[~side]), np.average(x[side], axis=0, weights=w[side])
    return side


def bisect_local(x: np.ndarray, w: np.ndarray, radius: float = RADIUS) -> np.ndarray:
    """Leaf numbers of points: the node of largest dispersion is split until every node is compact."""
    leaf = np.zeros(len(x), dtype=int)
    if not len(x):
        return leaf
    everything = np.arange(len(x))
    heap = [(-_dispersion(x, w), 0, everything)]
    made, done = 1, 0
    while heap:
        _, _, node = heapq.heappop(heap)
        c = np.average(x[node], axis=0, weights=w[node])
        if ((x[node] - c) ** 2).sum(axis=1).max() <= radius**2:
            leaf[node] = done
            done += 1
            continue
        side = two_means(x[node], w[node])
        if side.all() or not side.any():
            side = np.arange(len(node)) > 0
        for part in (node[~side], node[side]):
            heapq.heappush(heap, (-_dispersion(x[part], w[part]), made, part))
            made += 1
    return leaf


def _dispersion(x: np.ndarray, w: np.ndarray) -> float:
    c = np.average(x, axis=0, weights=w)
    return float((w * ((x - c) ** 2).sum(axis=1)).sum())


def _points(b: pd.DataFrame) -> np.ndarray:
    """The vectors of points: their column v, else those of their kinds (e, p, f)."""
    return np.array(b["v"].tolist()) if "v" in b else vectors(list(zip(b["e"], b["p"], b["f"])))


def bisect(points: DataFrame, key: tuple[str, ...] = ("e", "p", "f"), radius: float = RADIUS, apart: str | None = None) -> DataFrame:
    """(key, leaf) for points (key, n, v): their names, weights and vectors; without v, key is the kinds of the slots.
    Points that differ in the column apart are never in one leaf.

    Nodes of more than LOCAL_NODE points are split across the cluster, all of a level at once: each partition sums
    its points per node, the driver holds two centres per large node, of which there are at most points / LOCAL_NODE.
    Smaller nodes, and large ones that are compact already, are finished within a task each.
    """
    spark = points.sparkSession
    nodes = points.withColumn("node", F.col(apart) if apart else F.lit("r"))
    whole: set[str] = set()
    for level in range(64):
        large = [r.node for r in nodes.groupBy("node").count().where(F.col("count") > LOCAL_NODE).collect() if r.node not in whole]
        if not large:
            break
        if level == 0:
            nodes = cut(nodes)
        centres, spread = _centres(nodes.where(F.col("node").isin(*large)), large, key)
        whole |= {n for n, (a, b) in centres.items() if spread[n] <= radius or ((a - b) ** 2).sum() < 1e-18}
        shared = spark.sparkContext.broadcast({n: c for n, c in centres.items() if n not in whole})

        def move(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = _points(b)
                b["node"] = [n + str(int(((v - c[1]) ** 2).sum() < ((v - c[0]) ** 2).sum())) if (c := shared.value.get(n)) is not None else n for n, v in zip(b["node"], x)]
                yield b

        # The split nodes are written to the shared checkpoint folder, so a level never repeats those before it.
        nodes = cut(nodes.mapInPandas(move, nodes.schema))

    def finish(group, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(list(key))
        leaf = bisect_local(_points(b), b["n"].to_numpy(dtype=float), radius)
        return b[list(key)].assign(leaf=[f"{group[0]}.{k}" for k in leaf])

    return nodes.groupBy("node").applyInPandas(finish, ", ".join(f"{k} string" for k in key) + ", leaf string")


def _centres(nodes: DataFrame, large: list[str], key: tuple[str, ...], rounds: int = MEANS) -> tuple[dict[str, tuple[np.ndarray, np.ndarray]], dict[str, float]]:
    """Two centres per large node, by the steps of two_means: from the point farthest from the mean and the one farthest
    from that, then rounds of means over all points; and how far the farthest is from the mean. Each job brings a row or
    two per large node to the driver."""
    spark = nodes.sparkSession

    def sums(centres: dict) -> dict[tuple[str, int], np.ndarray]:
        """The mean of each node's points by the centre they are nearest to."""
        shared = spark.sparkContext.broadcast(centres)

        def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total: dict = {}
            for b in batches:
                x = _points(b)
                for n, w, v in zip(b["node"], b["n"], x):
                    c = shared.value.get(n)
                    side = int(((v - c[1]) ** 2).sum() < ((v - c[0]) ** 2).sum()) if c is not None else 0
                    t = total.setdefault((n, side), [0.0, np.zeros(x.shape[1])])
                    t[0] += w
                    t[1] += w * v
            yield pd.DataFrame([(n, s, t[0], t[1].tolist()) for (n, s), t in total.items()], columns=["node", "side", "w", "v"])

        def add(group, b: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"node": [group[0]], "side": [group[1]], "w": [b["w"].sum()], "v": [np.sum(b["v"].tolist(), axis=0).tolist()]})

        schema = "node string, side int, w double, v array<double>"
        return {(r.node, r.side): np.array(r.v) / r.w for r in nodes.mapInPandas(add_up, schema).groupBy("node", "side").applyInPandas(add, schema).collect()}

    def farthest(of: dict[str, np.ndarray]) -> dict[str, tuple[float, np.ndarray]]:
        """Of each node the distance and the vector of the point farthest from its vector in ``of``, of equal ones the first."""
        shared = spark.sparkContext.broadcast(of)

        def far(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = _points(b)
                yield b[["node", *key]].assign(d=[float(((v - shared.value[n]) ** 2).sum()) for n, v in zip(b["node"], x)], v=x.tolist())

        schema = "node string, " + ", ".join(f"{k} string" for k in key) + ", d double, v array<double>"
        top = nodes.mapInPandas(far, schema).groupBy("node").agg(F.min_by(F.struct("d", "v"), F.struct(-F.col("d"), *key)).alias("r"))
        return {r.node: (r.r.d**0.5, np.array(r.r.v)) for r in top.collect()}

    means = {n: v for (n, _), v in sums({}).items()}
    first = farthest(means)
    spread = {n: d for n, (d, _) in first.items()}
    second = farthest({n: v for n, (_, v) in first.items()})
    centres = {n: (first[n][1], second[n][1]) for n in large}
    for _ in range(rounds):
        parts = sums(centres)
        centres = {n: (parts.get((n, 0), c[0]), parts.get((n, 1), c[1])) for n, c in centres.items()}
    return centres, spread


def cluster_cards(cards: DataFrame, key: str, text: str) -> DataFrame:
    """(key, leaf, wording, distance, e, p, f): the leaf of every card with a key, and how far it is from the centre.

    cards: one row per key. Null and empty texts share no happening: they are left out. Ties are broken by the order
    of phrases. Actions: those of learn_reader and learn_kinds.
    """
    spark = cards.sparkSession
    reader = spark.sparkContext.broadcast(learn_reader(cards, text))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [reader.value.read(t) for t in b.pop("t")]
            yield b.assign(equipment=[r[0] for r in rows], place=[r[1] for r in rows], fault=[r[2] for r in rows])

    schema = cards.select(key).schema.add("equipment", "string").add("place", "string").add("fault", "string")
    phrases = cards.select(key, F.col(text).alias("t")).where(F.length(F.trim("t")) > 0).mapInPandas(read, schema).where("equipment != '' or place != '' or fault != ''")
    triples = cut(phrases.groupBy(*SLOTS).agg(F.count(F.lit(1)).alias("n")))
    two = [F.struct(F.lit(a).alias("slot_a"), F.col(a).alias("a"), F.lit(b).alias("slot_b"), F.col(b).alias("b"), F.col(c).alias("c")) for a, b, c in (SLOTS, ("equipment", "fault", "place"), ("place", "fault", "equipment"))]
    pairs = cut(triples.select("n", F.inline(F.array(*two))).where("a != '' and b != ''"))
    # Without known equipment a fault is a whole story and has no kind: only phrases met beside equipment count.
    beside, rest = pairs.where("slot_a = 'equipment'"), pairs.where("slot_a = 'place'")
    for side, slot in (("a", "place"), ("b", "fault")):
        rest = rest.join(beside.where(F.col("slot_b") == slot).select(F.col("b").alias(side)).distinct(), side, "left_semi")
    pairs = beside.unionByName(rest)
    kinds = learn_kinds(pairs)
    wording = triples
    for s, out in zip(SLOTS, ("e", "p", "f")):
        k = kinds.where(F.col("slot") == s).select(F.col("phrase").alias(s), F.col("kind").alias(out))
        wording = wording.join(k, s, "left").withColumn(out, F.coalesce(out, F.concat(F.lit("="), F.col(s))))
    wording = wording.withColumn("leaf", F.concat_ws("|", "e", "p", "f"))  # no phrase holds a bar
    # Every phrase is a direction of its own: with q the share of a phrase in its leaf, a card is 1 - 2q + sum(q * q)
    # from the leaf's centre in each slot, squared.
    everyone = F.sum("n").over(Window.partitionBy("leaf"))
    distance = F.lit(0.0)
    for s in SLOTS:
        wording = wording.withColumn(f"_{s}", F.sum("n").over(Window.partitionBy("leaf", s)) / everyone)
        distance = distance + 1 - 2 * F.col(f"_{s}") + F.sum(F.col("n") * F.col(f"_{s}")).over(Window.partitionBy("leaf")) / everyone
    wording = wording.withColumn("distance", F.round(F.sqrt(F.greatest(distance, F.lit(0.0))), 9))
    return phrases.join(wording.select(*SLOTS, "leaf", "e", "p", "f", F.col("n").alias("wording"), "distance"), list(SLOTS))


def happenings(cards: DataFrame, key: str, text: str, least: int = MIN_GROUP) -> DataFrame:
    """(key, leaf, wording, distance, group_size, first_id) of the cards whose happening at least ``least`` cards tell."""
    rows = cluster_cards(cards, key, text)
    sizes = rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("group_size"), F.min(key).alias("first_id")).where(F.col("group_size") >= least)
    return rows.select(key, "leaf", "wording", "distance").join(sizes, "leaf")


def describe(rows: DataFrame, key: str, typical: int = 5) -> DataFrame:
    """One row per happening: its size, first member and most typical members, those nearest to the leaf's centre, ties
    by key. Each partition hands on ``typical`` members of a leaf only."""
    near = rows.withColumn("_r", F.row_number().over(Window.partitionBy("leaf").orderBy("distance", key))).where(F.col("_r") <= typical)
    best = F.transform(F.array_sort(F.collect_list(F.struct("_r", F.col(key).alias("k")))), lambda x: x["k"])
    return near.groupBy("leaf").agg(F.max("group_size").alias("group_size"), F.min("first_id").alias("first_id"), best.alias("typical")).select("first_id", "group_size", "typical")
