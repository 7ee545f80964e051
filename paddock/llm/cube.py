"""Mixing sources to target weights with cube-method balanced sampling.

Sources in code-point order (null last) weigh 1, 2, 3, 1, ... and share the
total size; a target stops at ``CAP`` times its source's size and the excess is
shared again by weight until none is above. A document of a source with rate r
= target / size is taken floor(r) times, and once more with probability frac(r).

The extra copies are drawn by the cube method. The vector of inclusion
probabilities moves inside the unit cube along the null space of the balancing
constraints (number of documents, number of words), a random step at a time,
each of which settles at least one document at 0 or 1; totals stay as they are.
Three open documents suffice for a step, so a group of rows of one source is
worked off in one sweep, largest documents first, and at most two, small ones,
stay open. Open documents of many groups meet in the next level's groups, until
one group per source remains: the landing problem. There the word constraint
is dropped, then the last document is drawn.

Groups come from a hash of the document id, ``GROUP_ROWS`` rows each whatever
the source's size, so a hot source is many groups. Draws are seeded by source,
group and level: reruns agree.

The table of sources is a distributed frame throughout: ranks come from range
partitions and their counts, the level of the targets from one small aggregate
per round of resharing.

Nulls: a null text has size 0, documents of size 0 are taken 0 times, a null
source is a source of its own. Repeated rows are documents each.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.llm.common import WORD, stored
from paddock.session import shuffle_parts

CAP = 3
WEIGHTS = (1, 2, 3)
GROUP_ROWS = 20_000
_NEAR = 1e-9


def flight(prob: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool = False) -> np.ndarray:
    """Final probabilities: 0 or 1 except for at most two open documents; with
    ``land`` all are settled. Rows are swept in the given order."""
    p = prob.astype(float).tolist()
    s = size.astype(float).tolist()
    draws = rng.random(2 * len(p) + 4).tolist()
    todo = iter(range(len(p)))
    held: list[int] = []
    words = True                          # the word constraint is on
    while True:
        while len(held) < 3:
            i = next(todo, None)
            if i is None:
                break
            if _NEAR < p[i] < 1 - _NEAR:
                held.append(i)
            else:
                p[i] = float(round(p[i]))
        if len(held) == 3 and words:
            a, b, c = (s[i] for i in held)
            u = (c - b, a - c, b - a)
            if u == (0, 0, 0):
                u = (1, -1, 0)
        elif len(held) >= 2 and (not words or s[held[0]] == s[held[1]]):
            u = (1, -1)
        elif land and words and len(held) > 1:
            words = False
            continue
        elif land and held:
            p[held[0]] = float(draws.pop() < p[held[0]])
            break
        else:
            break
        up, down = float("inf"), float("inf")
        for i, d in zip(held, u, strict=False):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, -p[i] / d), min(down, (p[i] - 1) / d)
        step = up if draws.pop() * (up + down) < down else -down
        left = []
        for i, d in zip(held, (*u, 0), strict=False):
            p[i] += step * d
            if p[i] < _NEAR or p[i] > 1 - _NEAR:
                p[i] = float(round(p[i]))
            else:
                left.append(i)
        held = left
    return np.array(p)


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``pos``, the place of the source from 0: by range partition."""
    order = [F.col("source").isNull(), F.col("source")]
    s = stored(sources.repartitionByRange(shuffle_parts(sources.sparkSession), *order)
               .withColumn("part", F.spark_partition_id()), "mix-sources")
    before, offsets = 0, []
    for r in s.groupBy("part").count().orderBy("part").collect():      # at most the number of partitions
        offsets += [F.lit(r["part"]), F.lit(before)]
        before += r["count"]
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    at = F.element_at(F.create_map(*offsets), F.col("part")) if offsets else F.lit(0)
    return s.withColumn("pos", rank + at).drop("part")


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """source, n, source_size -> and target. The targets are min(cap * size,
    level * weight), with the level at which they add up to the total."""
    w = F.get(F.array(*[F.lit(float(x)) for x in weights]), (F.col("pos") % len(weights)).cast("int"))
    s = stored(_ranked(sources).withColumn("weight", w).drop("pos"), "mix-weights")
    top = F.col("source_size") * F.lit(float(cap))
    first = s.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    total = float(first["t"] or 0)
    level = total / first["w"] if first["w"] else 0.0
    while True:
        full = top < F.lit(level) * F.col("weight")
        r = s.agg(F.coalesce(F.sum(F.when(full, top)), F.lit(0.0)).alias("full"),
                  F.sum(F.when(~full, F.col("weight"))).alias("w")).first()
        new = (total - r["full"]) / r["w"] if r["w"] else level
        if not new > level:
            break
        level = new
    return s.withColumn("target", F.least(top, F.lit(level) * F.col("weight"))).drop("weight")


def _sweep(land: bool, level: int):
    def run(t: pa.Table) -> pa.Table:
        size = t.column("size").to_numpy()
        order = np.lexsort((t.column("row").to_numpy(), t.column("h").to_numpy(), -size))
        t = t.take(pa.array(order))
        source, group = t.column("source")[0].as_py(), t.column("grp")[0].as_py()
        seed = [zlib.crc32(repr(source).encode()), group, level]
        p = flight(t.column("p").to_numpy(), size[order], np.random.default_rng(seed), land)
        return t.set_column(t.column_names.index("p"), "p", pa.array(p))
    return run


def choose(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """row, source, size, h, p, grp -> the same with p settled to 0 or 1.

    ``grp`` numbers the groups of a source from 0.
    """
    most = rows.agg(F.max("grp")).first()[0]
    schema = rows.select("row", "source", "size", "h", "p", "grp").schema
    open_rows, settled, level = rows.select(schema.names), [], 0
    while True:
        land = not most
        swept = open_rows.groupBy("source", "grp").applyInArrow(_sweep(land, level), schema)
        if land:
            settled.append(swept)
            break
        swept = stored(swept, "mix-flight")
        done = (F.col("p") == 0) | (F.col("p") == 1)
        settled.append(swept.filter(done))
        fan = max(2, group_rows // 4)
        open_rows = swept.filter(~done).withColumn("grp", F.expr(f"grp div {fan}"))
        most, level = most // fan, level + 1
    out = settled[0]
    for x in settled[1:]:
        out = out.unionByName(x)
    return out


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        keep: Sequence[str] | None = None, weights: Sequence[float] = WEIGHTS, cap: float = CAP,
        group_rows: int = GROUP_ROWS) -> DataFrame:
    """``keep`` columns (default all of ``docs``) with size, source_size,
    target, copies and taken."""
    made = ("size", "source_size", "target", "copies", "taken")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in made]
    wide = stored(docs.select(
        *[F.col(f"`{c}`") for c in keep], F.col(doc_id).alias("_id"), F.col(source).cast("string").alias("_source"),
        F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.monotonically_increasing_id().alias("_row")), "mix-docs")
    narrow = wide.select(F.col("_row").alias("row"), F.col("_source").alias("source"), "size", F.xxhash64("_id").alias("h"))
    per = targets(narrow.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size")), weights, cap)
    per = stored(per, "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    p = per.select(F.col("source").alias("src"), "n", "source_size", "target", F.floor(rate).alias("whole"),
                   (rate - F.floor(rate)).alias("p"))
    rows = narrow.join(p, F.col("source").eqNullSafe(F.col("src")))
    groups = F.ceil(F.col("n") / group_rows)
    drawn = rows.filter("size > 0 and p > 0").withColumn("grp", F.pmod("h", groups).cast("long"))
    extra = choose(drawn, group_rows).select(F.col("row").alias("_row"), F.col("p").cast("long").alias("extra"))
    out = (wide.join(extra, "_row", "left").join(p, F.col("_source").eqNullSafe(F.col("src")))
               .withColumn("copies", F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(F.lit(0))))
    return out.select(*keep, "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
