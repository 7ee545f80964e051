"""Ordered sequences per key that are safe for any key: positions, rolling
statistics and running sums.

``Window.partitionBy(key)`` sends every row of a key to one task, however many
they are. Here a key is cut into buckets at some of its own rows:

1. About one row in ``CUT_EVERY``, chosen by a hash of its key and order, is a
   cut (one narrow pass over those columns). A row's bucket is the number of its
   key's cuts up to it, found by bisection. So buckets hold about ``CUT_EVERY``
   rows whatever the values look like, in the rows' total order, and a key of
   fewer rows is rarely cut. The cuts are broadcast: one per ``CUT_EVERY`` rows.
2. Windows run over (key, bucket): one shuffle of the rows, which moves their own
   columns and the bucket; what the windows read is made after it.
3. What a bucket needs from earlier ones comes from summaries of the buckets of
   cut keys only: row counts or sums and, for rolling statistics, the last ``n``
   rows. A window over these summaries gives each bucket what precedes it, and a
   broadcast join (as many rows as cuts and cut keys) hands it to the bucket's
   first rows. Where no key is cut, this branch is empty.

There is no probe, no size switch and nothing runs while a plan is built. The
results equal those of the single window, given a total order; rows that are
equal in all key and order columns are never cut apart.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket, on average.
CUT_EVERY = 1 << 20
_STEPS = 26                     # bisection finds one of up to 2^26 cuts of a key
_K, _O, _CUTS, _B, _AT = "_seq_key", "_seq_order", "_seq_cuts", "_seq_bucket", "_seq_at"


@dataclass(frozen=True)
class desc:  # noqa: N801  (reads like the function of the same name)
    """A column in descending order, nulls last."""
    name: str


Order = Sequence["str | desc"]


def _name(o: str | desc) -> str:
    return o.name if isinstance(o, desc) else o


def _columns(order: Order) -> list[Column]:
    return [F.col(o.name).desc() if isinstance(o, desc) else F.col(o) for o in order]


def _up_to(cut: Column, row: Column, order: Order, same: bool = True) -> Column:
    """The cut comes before the row, or (``same``) is equal to it."""
    if not any(isinstance(o, desc) for o in order):
        return cut <= row if same else cut < row            # structs compare field by field, nulls first
    out = F.lit(same)
    for i, o in reversed(list(enumerate(order))):
        c, r = cut[f"o{i}"], row[f"o{i}"]
        first, then = (r, c) if isinstance(o, desc) else (c, r)
        before = F.coalesce(first < then, first.isNull() & then.isNotNull())
        out = before | (c.eqNullSafe(r) & out)
    return out


def _cut(df: DataFrame, keys: Sequence[str], order: Order, base: DataFrame | None = None) -> DataFrame:
    """Add the key, its sorted cuts (null: none; found in ``base``) and the bucket of the row."""
    key = _key(keys)
    place = F.struct(*[F.col(_name(o)).alias(f"o{i}") for i, o in enumerate(order)])
    hashed = F.xxhash64(*dict.fromkeys([*keys, *[_name(o) for o in order]]))
    own = None
    if any(isinstance(o, desc) for o in order):
        own = lambda a, b: F.when(_up_to(a, b, order, False), -1).when(_up_to(b, a, order, False), 1).otherwise(0)
    cuts = ((df if base is None else base).filter(F.pmod(hashed, F.lit(CUT_EVERY)) == 0).select(key.alias(_K), place.alias(_O))
              .groupBy(_K).agg(F.array_sort(F.collect_set(_O), own).alias(_CUTS)))
    x = df.withColumn(_K, key).join(F.broadcast(cuts), _K, "left")
    found = F.aggregate(F.array(*[F.lit(1 << i) for i in range(_STEPS - 1, -1, -1)]), F.lit(0),
                        lambda n, s: F.when((n + s <= F.size(_CUTS)) & _up_to(F.get(F.col(_CUTS), n + s - 1), place, order), n + s)
                        .otherwise(n))
    return x.withColumn(_B, F.when(F.col(_CUTS).isNull(), 0).otherwise(found))


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]) if keys else F.lit(0)


def _group(keys: Sequence[str]) -> list[str]:
    return [*keys, _B]


def _dealt(x: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shuffle the rows of ``_cut`` into their buckets, without the key's copy and cuts."""
    return x.drop(_K, _CUTS).repartition(*[F.col(c) for c in _group(keys)]).withColumn(_K, _key(keys))


def _handed(x: DataFrame, summary: DataFrame) -> DataFrame:
    """Join what precedes a bucket (columns of ``summary`` by key and bucket)."""
    return x.join(F.broadcast(summary), [_K, _B], "left")


def _before() -> Window:
    return Window.partitionBy(_K).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)


def with_position(df: DataFrame, keys: Sequence[str], order: Order, name: str = "pos",
                  total: str | None = None, ties: bool = False) -> DataFrame:
    """Add ``name``: 0-based position of the row inside its key, in ``order``,
    and ``total``: the rows of the key. With ``ties``, rows that are equal in
    ``order`` share the lowest position."""
    keys, o = list(keys), _columns(order)
    x = _cut(df, keys, order)
    sizes = (x.filter(F.col(_CUTS).isNotNull()).groupBy(_K, _B).agg(F.count(F.lit(1)).alias("_n"))
              .select(_K, _B, F.sum("_n").over(_before()).alias("_off"), F.sum("_n").over(Window.partitionBy(_K)).alias("_all")))
    w = Window.partitionBy(*_group(keys))
    at = F.rank() if ties else F.row_number()
    add = {_AT: at.over(w.orderBy(*o)) - 1}
    if total:
        add["_size"] = F.count(F.lit(1)).over(w)
    x = _handed(_dealt(x, keys).withColumns(add), sizes)
    out = {name: (F.col(_AT) + F.coalesce("_off", F.lit(0))).cast("long")}
    if total:
        out[total] = F.coalesce("_all", "_size").cast("long")
    return x.withColumns(out).select(*[c for c in df.columns if c not in out], *out)


def rolling(df: DataFrame, keys: Sequence[str], order: Order, n: int,
            means: Mapping[str, Column] | None = None, lags: Mapping[str, Column] | None = None,
            count_name: str | None = None, base: DataFrame | None = None) -> DataFrame:
    """Per-key history over the ``n`` preceding rows (current row excluded).

    ``means``: output name -> value; mean of the non-null values among the
    previous ``n`` rows (null if there are none). ``lags``: output name -> value
    of the previous row. ``count_name``: number of earlier rows of the key.
    ``base``: the same rows before what was shuffled to make ``df``; the cuts and what
    goes over them are then found there.
    """
    keys, o = list(keys), _columns(order)
    means, lags = dict(means or {}), dict(lags or {})
    x = _cut(df, keys, order, base)
    values = {f"_v{i}": c.cast("double") for i, c in enumerate(means.values())} | {f"_l{i}": c for i, c in enumerate(lags.values())}
    w = Window.partitionBy(*_group(keys))
    here = F.row_number().over(w.orderBy(*o)) - 1

    # the last n rows and the row counts of the buckets of cut keys
    cut = (x if base is None else _cut(base, keys, order)).filter(F.col(_CUTS).isNotNull()).withColumns(values | {_AT: here, "_size": F.count(F.lit(1)).over(w)})
    last = (cut.filter(F.col("_size") - F.col(_AT) <= n).groupBy(_K, _B)
               .agg(F.max("_size").alias("_size"), F.array_sort(F.collect_list(F.struct(F.col(_AT).alias("at"), *values))).alias("_last")))
    near = F.flatten(F.collect_list("_last").over(Window.partitionBy(_K).orderBy(_B).rowsBetween(-n, -1)))
    handed = (last.select(_K, _B, F.sum("_size").over(_before()).alias("_off"), near.alias("_near"))
                  .withColumn("_near", F.slice("_near", F.greatest(F.size("_near") - n + 1, F.lit(1)), n)))

    prev = w.orderBy(*o).rowsBetween(-n, -1)
    local = {_AT: here}
    local |= {f"_s{i}": F.sum(f"_v{i}").over(prev) for i in range(len(means))}
    local |= {f"_c{i}": F.count(f"_v{i}").over(prev) for i in range(len(means))}
    local |= {f"_p{i}": F.lag(f"_l{i}", 1).over(w.orderBy(*o)) for i in range(len(lags))}
    x = _dealt(x, keys)
    x = _handed((x.withColumns(values) if values else x).withColumns(local), handed)
    edge = F.col("_near").isNotNull() & (F.size("_near") > 0) & (F.col(_AT) < n)
    out = {}
    for i, k in enumerate(means):
        # the rows of the window that lie before the bucket
        far = F.slice("_near", F.greatest(F.size("_near") - n + F.col(_AT) + 1, F.lit(1)), F.lit(n))
        own = F.filter(far.getField(f"_v{i}"), lambda v: v.isNotNull())
        s = F.when(edge & (F.size(own) > 0), F.aggregate(own, F.lit(0.0), lambda a, v: a + v) + F.coalesce(f"_s{i}", F.lit(0.0))).otherwise(F.col(f"_s{i}"))
        c = F.when(edge, F.size(own) + F.col(f"_c{i}")).otherwise(F.col(f"_c{i}"))
        out[k] = F.when(c > 0, s / c)
    for i, k in enumerate(lags):
        out[k] = F.when(edge & (F.col(_AT) == 0), F.element_at("_near", -1)[f"_l{i}"]).otherwise(F.col(f"_p{i}"))
    if count_name:
        out[count_name] = (F.col(_AT) + F.coalesce("_off", F.lit(0))).cast("long")
    return x.withColumns(out).select(*[c for c in df.columns if c not in out], *out)


def running_sum(df: DataFrame, keys: Sequence[str], order: Order, cols: Sequence[str],
                suffix: str = "_before") -> DataFrame:
    """Add ``{c}{suffix}``: sum of ``c`` over the rows strictly before, per key.
    Without keys the order is global."""
    keys, o = list(keys), _columns(order)
    x = _cut(df, keys, order)
    sums = (x.filter(F.col(_CUTS).isNotNull()).groupBy(_K, _B).agg(*[F.sum(c).alias(f"_n_{c}") for c in cols])
             .select(_K, _B, *[F.sum(f"_n_{c}").over(_before()).alias(f"_off_{c}") for c in cols]))
    w = Window.partitionBy(*_group(keys)).orderBy(*o).rowsBetween(Window.unboundedPreceding, -1)
    x = _handed(_dealt(x, keys).withColumns({f"_here_{c}": F.sum(c).over(w) for c in cols}), sums)
    out = {f"{c}{suffix}": F.coalesce(f"_here_{c}", F.lit(0)) + F.coalesce(f"_off_{c}", F.lit(0)) for c in cols}
    return x.withColumns(out).select(*[c for c in df.columns if c not in out], *out)
