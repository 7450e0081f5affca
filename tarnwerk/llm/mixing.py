"""Mixing sources to target weights (problem 9): temperature mixing under repetition limits.

Sizes in tokens come from one pass; the plan is made on one row per source; the records are then chosen by budgeted
block permutations, so no source, however large, is ever sorted as a whole.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from tarnwerk.functions.scalars import source_key

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The split pattern of byte-level BPE vocabularies of this family.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Blocks of a source, and parts of a block; only the part in which the budget ends is sorted.
BLOCKS = 4096
#: Halvings when an exponent is bisected.
STEPS = 60


def count_tokens(df: DataFrame, text: str, tokenizer: str = TOKENIZER, out: str = "tokens", keep: Sequence[str] = ()) -> DataFrame:
    """The columns ``keep`` and the number of tokens of ``text``; null and empty texts have 0. Whole texts count.

    The vocabulary (under 2 MB) is read on the driver and broadcast, so the workers need no file.
    """
    lines = (line.split() for line in Path(tokenizer).read_bytes().splitlines() if line.strip())
    ranks = df.sparkSession.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in lines})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import tiktoken

        enc = tiktoken.Encoding("mix", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        for b in batches:
            b[out] = [len(enc.encode_ordinary(t)) if t else 0 for t in b.pop("_text")]
            yield b

    schema = df.select(*keep).schema.add(out, LongType())
    return df.select(*keep, F.col(text).alias("_text")).mapInPandas(count, schema)


def temperature_shares(tokens: Sequence[float], exponent: float) -> list[float]:
    """Token shares raised to ``exponent`` and normalised; sources without tokens get nothing."""
    total = sum(tokens)
    raised = [(t / total) ** exponent if t > 0 else 0.0 for t in tokens]
    z = sum(raised) or 1.0
    return [r / z for r in raised]


def _entropy(shares: Sequence[float]) -> float:
    return -sum(p * math.log(p) for p in shares if p > 0)


def exponent_for(tokens: Sequence[float], entropy: float | None = None, capacity: Sequence[float] | None = None, budget: float = 0.0, steps: int = 60) -> float:
    """The exponent in [0, 1] nearest to 0 (most even) whose shares have at most ``entropy`` and, given capacities,
    repeat no source beyond its capacity at ``budget``; by bisection. 1 keeps the natural shares."""

    def good(a: float) -> bool:
        shares = temperature_shares(tokens, a)
        return (entropy is None or _entropy(shares) <= entropy + 1e-12) and (capacity is None or all(p * budget <= c + 1e-9 for p, c in zip(shares, capacity)))

    if good(0.0):
        return 0.0
    lo, hi = 0.0, 1.0
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if good(mid) else (mid, hi)
    return hi


def path(natural: float, target: float, exponent: float) -> float:
    """The share of a source between its natural share (exponent 0) and its target (1): natural ** (1 - x) * target ** x.
    Over all sources the shares of one path add up to at most 1, whatever the exponents."""
    if natural <= 0 or target <= 0:
        return 0.0
    return math.exp((1 - exponent) * math.log(natural) + exponent * math.log(target))


def limit_exponent(natural: float, target: float, capacity: float, budget: float, steps: int = STEPS) -> float:
    """The largest exponent in [0, 1] at which a source stays within its repetition limit; by bisection. 0 for a source
    of nothing, or whose limit is below its natural size."""
    fits = lambda x: path(natural, target, x) * budget <= capacity * (1 + 1e-12)
    if natural <= 0 or target <= 0:
        return 0.0
    if fits(1.0):
        return 1.0
    if not fits(0.0):
        return 0.0
    lo, hi = 0.0, 1.0
    for _ in range(steps):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if fits(mid) else (lo, mid)
    return lo


@dataclass(frozen=True)
class Share:
    """The plan of one source: its target, what its repetition limit allows and what it gets, in tokens."""

    source_name: str
    key: str
    tokens: int
    docs: int
    target_share: float
    capacity: int
    planned: float
    exponent: float

    @property
    def short(self) -> bool:
        """Whether the repetition limit stops the source before its target."""
        return self.exponent < 1.0 and self.target_share > 0


def plan(sizes: dict[str, tuple[int, int]], targets: Sequence[tuple[str, str, float, int]], total: int) -> list[Share]:
    """Shares under repetition limits. sizes: of each source key its tokens and documents; targets: name, key, weight,
    max_repeats; total: the budget in tokens.

    Every source goes from its natural share of the tokens along ``path`` towards its target share, as far as its
    repetition limit allows: its exponent is bisected (limit_exponent). Sources whose exponent stays below 1 are short:
    they get what the limit allows. What they leave goes to the others, by one exponent for all: from the room r that
    is left up to the limits to the targets w lies the path r ** (1 - x) * w ** x, normalised, and x is bisected to the
    largest exponent at which no source is repeated beyond its limit. At x = 0 that holds whenever the rooms suffice;
    if they do not, all sources get their limit. Weights of null or below 0 count as 0, limits of null as 1.
    """
    weight = sum(max(w or 0.0, 0.0) for _, _, w, _ in targets)
    rows = [(n, k, *sizes.get(k, (0, 0)), max(w or 0.0, 0.0) / weight if weight else 0.0, (1 if m is None else max(m, 0)) * sizes.get(k, (0, 0))[0]) for n, k, w, m in targets]
    exponents = [limit_exponent(r[2] / total, r[4], r[5], total) if total else 1.0 for r in rows]
    got = [min(path(r[2] / total, r[4], x) * total, float(r[5])) if total else 0.0 for r, x in zip(rows, exponents)]
    room = {i: r[5] - got[i] for i, r in enumerate(rows) if exponents[i] == 1.0 and r[5] > got[i]}
    left = total * sum(r[4] for r in rows) - sum(got)
    if left >= sum(room.values()):
        for i in room:
            got[i] = float(rows[i][5])
    elif left > 0:

        def rest(x: float) -> dict[int, float]:
            v = {i: path(r, rows[i][4], x) for i, r in room.items()}
            z = sum(v.values())
            return {i: left * p / z for i, p in v.items()}

        lo, hi = 0.0, 1.0
        for _ in range(STEPS):
            mid = 1.0 if hi == 1.0 and lo == 0.0 and all(v <= room[i] + 1e-9 for i, v in rest(1.0).items()) else (lo + hi) / 2
            lo, hi = (mid, hi) if all(v <= room[i] + 1e-9 for i, v in rest(mid).items()) else (lo, mid)
        for i, v in rest(lo).items():
            got[i] = min(got[i] + v, float(rows[i][5]))
    return [Share(*r, g, x) for r, g, x in zip(rows, got, exponents)]


def even_plan(sizes: dict[str, tuple[int, int]], limits: Sequence[tuple[str, str, int]], total: int, entropy: float | None = None) -> list[Share]:
    """The plan without target weights: natural token shares, exponentiated. The exponent is the most even one that
    keeps every source within its repetition limit at the budget and the entropy of the shares within ``entropy``."""
    rows = [(n, k, *sizes.get(k, (0, 0)), (1 if m is None else max(m, 0)) * sizes.get(k, (0, 0))[0]) for n, k, m in limits]
    x = exponent_for([r[2] for r in rows], entropy, [r[4] for r in rows], total)
    shares = temperature_shares([r[2] for r in rows], x)
    return [Share(n, k, t, d, p, c, min(p * total, float(c)), 1.0 if p * total <= c * (1 + 1e-9) else 0.0) for (n, k, t, d, c), p in zip(rows, shares)]


def source_sizes(sized: DataFrame, keys: Sequence[str]) -> tuple[dict[str, tuple[int, int]], int]:
    """Tokens and documents of each of the sources ``keys``, and the tokens of all records (an action over one row per
    source). Other sources, and null ones, count in the total only."""
    named = F.when(F.col("key").isin(*keys), F.col("key")) if keys else F.lit(None).cast("string")
    sums = sized.groupBy(named.alias("key")).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).collect()
    return {r.key: (r.tokens or 0, r.docs) for r in sums if r.key is not None}, sum(r.tokens or 0 for r in sums)


def target_rows(targets: DataFrame) -> list:
    """(source_name, key, target_weight, max_repeats) of the targets, a stated list of sources."""
    return targets.select("source_name", source_key(F.col("source_name")).alias("key"), "target_weight", "max_repeats").where("key is not null").orderBy("source_name").collect()


def make_plan(sized: DataFrame, targets: DataFrame) -> list[Share]:
    """The plan for records (key, tokens) and targets (source_name, target_weight, max_repeats)."""
    wanted = target_rows(targets)
    sizes, total = source_sizes(sized, [r.key for r in wanted])
    return plan(sizes, [(r.source_name, r.key, r.target_weight, r.max_repeats) for r in wanted], total)


def make_even_plan(sized: DataFrame, targets: DataFrame, entropy: float | None = None) -> list[Share]:
    """The plan by temperature alone, over the tokens of the named sources and their limits."""
    wanted = target_rows(targets)
    sizes, _ = source_sizes(sized, [r.key for r in wanted])
    return even_plan(sizes, [(r.source_name, r.key, r.max_repeats) for r in wanted], sum(t for t, _ in sizes.values()), entropy)


def realise(sized: DataFrame, shares: Sequence[Share], record: str, seed: int = 17, blocks: int = BLOCKS) -> DataFrame:
    """(record, source_name, tokens, copies): how often each record is used, at least once.

    Every record of a source is used floor(planned / tokens) times; what is left of the budget goes to the first
    records of a seeded permutation that fit whole. The permutation orders blocks of records by hash, then the parts of
    a block, then the records of a part: sums of blocks and of the parts of one block are added up per source
    (``blocks`` rows each), and only the part where the budget ends, one record in blocks * blocks, is sorted by record. Records without tokens
    ride along in their block. The same seed gives the same choice. ``sized`` is read three times: cut it first.
    """
    spark = sized.sparkSession
    rows = []
    for s in shares:
        if s.tokens > 0 and s.planned > 0:
            full = min(int(s.planned / s.tokens + 1e-9), s.capacity // s.tokens)
            rest = s.planned - full * s.tokens if full < s.capacity // s.tokens else 0.0
            rows.append((s.key, s.source_name, full, float(rest)))
    # One row per target source, already on the driver.
    quota = F.broadcast(spark.createDataFrame(rows, "key string, source_name string, full int, rest double"))
    h = F.xxhash64(F.lit(seed), F.col(record).cast("string"))
    base = sized.join(quota, "key").withColumns({"_h": h, "_b": F.pmod(h, F.lit(blocks)), "_p": F.pmod(F.shiftright(h, 16), F.lit(blocks))})
    up_to = lambda by: F.coalesce(F.sum("_n").over(Window.partitionBy("key").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marks = base.groupBy("key", "_b").agg(F.sum("tokens").alias("_n"), F.first("rest").alias("rest")).withColumn("_before", up_to("_b"))
    # blocks x sources rows: a bound set by parameters.
    placed = base.join(F.broadcast(marks.select("key", "_b", "_before", "_n")), ["key", "_b"])
    ends = (F.col("_before") + F.col("_n") > F.col("rest")) & (F.col("_before") < F.col("rest"))
    block = placed.where(ends)
    parts = block.groupBy("key", "_p").agg(F.sum("tokens").alias("_n"), F.first("_before").alias("_from")).withColumn("_start", F.col("_from") + up_to("_p"))
    inside = block.drop("_before", "_n").join(F.broadcast(parts.select("key", "_p", F.col("_start").alias("_before"), "_n")), ["key", "_p"])
    run = F.sum("tokens").over(Window.partitionBy("key").orderBy("_h", F.col(record)).rowsBetween(Window.unboundedPreceding, 0))
    once = lambda reach: (F.col("full") + (F.col("_before") + reach <= F.col("rest")).cast("int")).alias("copies")
    cols = [record, "source_name", "tokens"]
    out = placed.where(~ends).select(*cols, once(F.col("_n")))
    out = out.unionByName(inside.where(~ends).select(*cols, once(F.col("_n"))))
    out = out.unionByName(inside.where(ends).withColumn("_run", run).select(*cols, once(F.col("_run"))))
    return out.where(F.col("copies") > 0)


def reached(mixed: DataFrame, shares: Sequence[Share]) -> DataFrame:
    """Per target source what it was to reach and what it did: shares of all tokens used, and the most copies."""
    spark = mixed.sparkSession
    wanted = spark.createDataFrame([(s.source_name, s.target_share, s.tokens, s.capacity, s.short) for s in shares], "source_name string, target_share double, source_tokens bigint, capacity_tokens bigint, short boolean")
    used = mixed.groupBy("source_name").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_used"), F.count(F.lit(1)).alias("records_used"), F.max("copies").alias("most_copies"))
    out = wanted.join(F.broadcast(used), "source_name", "left").na.fill(0, ["tokens_used", "records_used", "most_copies"])
    return out.withColumn("reached_share", F.coalesce(F.try_divide(F.col("tokens_used").cast("double"), F.sum("tokens_used").over(Window.partitionBy())), F.lit(0.0)))
