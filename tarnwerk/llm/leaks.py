"""Evaluation texts that leak into training text (problem 8).

The test items form a BM25 inverted index in blocks of postings, each with its greatest impact. Every training passage
is a query; block-max WAND gives all items above a threshold that no leak can stay under, and a word alignment
verifies them. The terms are pairs of adjacent words: of a run with one word altered at most two pairs are lost, and
pairs of the items are rare in other text, so few postings are touched. The index is of the test items and is broadcast; the documents are read once and never shuffled.
"""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.5
RUN = 12
#: Words of a passage and of its overlap; a run and one added word always lie within one passage.
PASSAGE, OVERLAP = 64, 16
BLOCK = 16
#: Largest index that is broadcast, in test items; beyond it the items are taken in parts, each with its own pass.
MAX_ITEMS = 20_000

_SPLIT = re.compile(r"(\w)[-‐‑­¬]\s*\n\s*(?=\w)")
_SOFT = re.compile(r"[­​‌‍⁠﻿]")
_WORD = re.compile(r"[^\W_]+(?:['’ʼ\-‐‑][^\W_]+)*")
_INNER = re.compile(r"['’ʼ\-‐‑]")


def normal_words(text: str | None) -> list[str]:
    """Words without case, punctuation and hyphens; a word split at a line end is whole again."""
    if not text:
        return []
    t = unicodedata.normalize("NFKC", text)
    t = _SOFT.sub("", _SPLIT.sub(r"\1", t.replace("\r\n", "\n").replace("\r", "\n"))).casefold()
    return [_INNER.sub("", w) for w in _WORD.findall(t)]


def pairs(ws: list[str]) -> list[tuple[str, str]]:
    """The terms of a text: its pairs of adjacent words."""
    return list(zip(ws, ws[1:]))


class Index:
    """BM25 postings of the test items in blocks with their greatest impacts."""

    def __init__(self, items: list[tuple[object, str | None]]):
        self.ids = [i for i, _ in items]
        self.words = [normal_words(t) for _, t in items]
        n = len(items)
        mean = (sum(map(len, self.words)) / n if n else 0) or 1.0
        holders: dict[tuple[str, str], list[tuple[int, int]]] = defaultdict(list)
        for k, ws in enumerate(self.words):
            for w, tf in Counter(pairs(ws)).items():
                holders[w].append((k, tf))
        self.postings: dict[tuple[str, str], list[tuple[int, float]]] = {}
        for w, at in holders.items():
            idf = math.log(1 + (n - len(at) + 0.5) / (len(at) + 0.5))
            self.postings[w] = [(k, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(self.words[k]) / mean))) for k, tf in at]
        self.blocks = {w: [(p[min(i + BLOCK, len(p)) - 1][0], max(s for _, s in p[i : i + BLOCK])) for i in range(0, len(p), BLOCK)] for w, p in self.postings.items()}
        self.top = {w: max(m for _, m in b) for w, b in self.blocks.items()}
        impact = [dict() for _ in items]
        for w, p in self.postings.items():
            for k, s in p:
                impact[k][w] = s
        # A leak holds a run of the item but for one word: no lower score than the least run without its heaviest word,
        # that is without the two pairs of that word.
        self.least = []
        for k, ws in enumerate(self.words):
            scores = []
            for i in range(len(ws) - RUN + 1):
                run = pairs(ws[i : i + RUN])
                lost = max(impact[k][x] + impact[k][y] for x, y in zip(run, run[1:]))
                scores.append(sum(impact[k][w] for w in set(run)) - lost)
            self.least.append(min(scores) * 0.999 if scores else math.inf)
        self.threshold = min(self.least, default=math.inf)

    def retrieve(self, query: set[tuple[str, str]]) -> list[int]:
        """Every item that scores at least its own least score for the terms of a passage: block-max WAND with a fixed
        threshold, so the result is complete."""
        terms = [w for w in query if w in self.postings]
        theta = self.threshold
        if sum(self.top[w] for w in terms) < theta:
            return []
        lists = [self.postings[w] for w in terms]
        blocks = [self.blocks[w] for w in terms]
        tops = [self.top[w] for w in terms]
        at = [0] * len(terms)
        heap = [(p[0][0], j) for j, p in enumerate(lists)]
        heapq.heapify(heap)
        out = []
        while heap:
            # Pivot: the first item at which the lists met so far could reach the threshold together.
            order, bound = [], 0.0
            while heap and bound < theta:
                k, j = heapq.heappop(heap)
                order.append((k, j))
                bound += tops[j]
            if bound < theta:
                break
            pivot = order[-1][0]
            while heap and heap[0][0] == pivot:
                order.append(heapq.heappop(heap))
            near = 0.0
            end = math.inf
            for _, j in order:
                b = min(_block(lists[j], at[j], pivot) // BLOCK, len(blocks[j]) - 1)
                near += blocks[j][b][1]
                end = min(end, blocks[j][b][0])
            if near >= theta:
                score, nxt = 0.0, pivot + 1
                for _, j in order:
                    at[j] = _block(lists[j], at[j], pivot)
                    if at[j] < len(lists[j]) and lists[j][at[j]][0] == pivot:
                        score += lists[j][at[j]][1]
                if score >= self.least[pivot]:
                    out.append(pivot)
            else:
                # No item up to the end of these blocks can reach the threshold, unless another list comes in before.
                nxt = max(pivot + 1, min(end + 1, heap[0][0] if heap else math.inf))
            for _, j in order:
                at[j] = _block(lists[j], at[j], nxt)
                if at[j] < len(lists[j]):
                    heapq.heappush(heap, (lists[j][at[j]][0], j))
        return out


def _block(postings: list[tuple[int, float]], start: int, item: float) -> int:
    """First position from ``start`` whose item is not before ``item``."""
    while start < len(postings) and postings[start][0] < item:
        start += 1
    return start


def near_run(a: list[str], b: list[str], run: int = RUN) -> bool:
    """Whether ``b`` holds a window of ``run`` words of ``a`` with at most one word changed, dropped or added.

    A window with one error has a stretch of at least (run - 1) / 2 words without any; each such stretch common to
    both is extended over one error to both sides.
    """
    seed = (run - 1) // 2
    starts: dict[tuple[str, ...], list[int]] = defaultdict(list)
    for i in range(len(a) - seed + 1):
        starts[tuple(a[i : i + seed])].append(i)
    done = set()
    for j in range(len(b) - seed + 1):
        for i in starts.get(tuple(b[j : j + seed]), ()):
            if (i - j, "x") in done and (i - 1, j - 1) in done:
                done.add((i, j))
                continue
            done.add((i, j))
            done.add((i - j, "x"))
            if _extends(a, b, i, j, run):
                return True
    return False


def _extends(a: list[str], b: list[str], i: int, j: int, run: int) -> bool:
    """Whether the maximal equal stretch through (i, j) reaches ``run`` words of a with one error on either side."""
    lo = 0
    while i - lo > 0 and j - lo > 0 and a[i - lo - 1] == b[j - lo - 1]:
        lo += 1
    hi = 0
    while i + hi < len(a) and j + hi < len(b) and a[i + hi] == b[j + hi]:
        hi += 1
    if lo + hi >= run:
        return True
    s, t, e, f = i - lo, j - lo, i + hi, j + hi  # the stretch is a[s:e] = b[t:f]

    def ahead(x: int, y: int) -> int:
        n = 0
        while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n]:
            n += 1
        return n

    def back(x: int, y: int) -> int:
        n = 0
        while x - n > 0 and y - n > 0 and a[x - n - 1] == b[y - n - 1]:
            n += 1
        return n

    n = e - s
    # One error, then equal words again: changed (a word of each), dropped (a word of a), added (a word of b).
    # A change or a loss at the very end is also one error; it counts as a word of the window.
    ends = [(1, 1, 1), (1, 0, 1), (0, 1, 0)]
    for da, db, extra in ends:
        if e + da <= len(a) and f + db <= len(b) and n + extra + ahead(e + da, f + db) >= run:
            return True
        if s - da >= 0 and t - db >= 0 and n + extra + back(s - da, t - db) >= run:
            return True
    return False


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text") -> DataFrame:
    """(doc_id, item_id) of every item of which a document holds a run of 12 words, at most one of them altered.

    Null, empty and short texts hold nothing; items under 12 words cannot leak. Very long texts are read whole, passage
    by passage. Repeated documents each give their own rows; repeated items of one id give one row. The items are
    collected: they are a stated test set, taken MAX_ITEMS at a time, with one pass over the documents each.
    """
    rows = items.select(item_id, item_text).where(F.col(item_id).isNotNull()).orderBy(item_id)
    schema = documents.select(F.col(doc_id).alias("doc_id")).schema.add("item_id", rows.schema[item_id].dataType)
    out = None
    part: list = []
    parts = []
    for r in rows.toLocalIterator():
        part.append((r[0], r[1]))
        if len(part) == MAX_ITEMS:
            parts.append(part)
            part = []
    for chunk in [*parts, part] if part or not parts else parts:
        shared = documents.sparkSession.sparkContext.broadcast(Index(chunk))

        def search(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            index = shared.value
            for b in batches:
                found = []
                for d, t in zip(b["d"], b["t"]):
                    ws = normal_words(t)
                    cand: dict[int, list[tuple[int, int]]] = defaultdict(list)
                    for lo in range(0, max(len(ws) - OVERLAP, 1), PASSAGE - OVERLAP):
                        for k in index.retrieve(set(pairs(ws[lo : lo + PASSAGE]))):
                            cand[k].append((lo, min(lo + PASSAGE, len(ws))))
                    found += [(d, index.ids[k]) for k, spans in cand.items() if any(near_run(index.words[k], ws[lo:hi]) for lo, hi in spans)]
                yield pd.DataFrame(list(dict.fromkeys(found)), columns=["doc_id", "item_id"])

        one = documents.select(F.col(doc_id).alias("d"), F.col(text).alias("t")).where(F.length("t") > 0).mapInPandas(search, schema)
        out = one if out is None else out.unionByName(one)
    return out
