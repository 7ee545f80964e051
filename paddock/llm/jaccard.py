"""Self-join of documents on shingle Jaccard with adaptive multi-match prefixes.

A document's set are its distinct word shingles (64-bit hashes). Documents with
equal sets form a class, joined once; the class id is a 64-bit hash of the set.

Order. Shingles are ordered by estimated frequency class, then by hash. The
estimate adds, over chunks of ``CHUNK`` shingles, the counts of those that occur
again within a chunk, over all documents; the ``MAX_FREQUENT`` most frequent
are broadcast (a fixed bound). It decides costs only, never results.

Adaptive prefixes. For sets of size n the first n - ceil(t n) + l shingles are
the l-prefix; two sets linked at t share at least min(l, l') shingles of their
prefixes. A document's l grows with the logarithm of its estimated candidate
cost: a verification for each prefix shingle (a chance partner, or the leader of
its list, see below) and one more for each that is known to be frequent. A
dearer document gets a longer prefix and must share more of it, so that a long
text's chance matches with unrelated ones are not verified. A pair is verified if it shares
min(l, l') prefix shingles and passes the length and position bounds.

Components need no pair of documents already connected, so candidates come in
two rounds. First each shingle's list picks the document that has it earliest
in its prefix, the most central one, and every member is verified with the
leader that it shares most with. Then only pairs across the components so
found are made: members outside a list's main component with all others.
Copies and near copies thus cost in proportion to their number, and no link
between different components is lost. A list of a shingle known to be very
frequent is dealt over several tasks, whose leaders are then compared.

Verification intersects the full sets. Components of the links give the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.llm.common import stored
from paddock.llm.components import components, salted_join
from paddock.llm.shingles import batch_sets, mix
from paddock.session import shuffle_parts

WORDS = 5
PERCENT = 80                       # the threshold, as a whole percentage
MAX_FREQUENT = 1 << 20
MAX_KNOWN = 1 << 22                # nodes whose sets are picked by a broadcast list
CHUNK = 1 << 20
FLUSH = 1 << 18
COST = 16                          # candidate cost above which l grows
MAX_MATCH = 6
SPREAD = 100_000                   # postings of one shingle in one task, as estimated
BUCKETS = 64
SHORT = 64                         # lists up to this length keep only members that fit another
LIST_SALTS = 64


def node_of(s: np.ndarray) -> int:
    """Class id of a set: two sums of mixed hashes, folded to 64 bits."""
    a, b = mix(s).sum(dtype=np.uint64), mix(~s).sum(dtype=np.uint64)
    return int(mix(np.array([a * np.uint64(0xD6E8FEB86659FD93) + b + np.uint64(len(s))])).view(np.int64)[0])


def _quiet(f):
    def run(*a):
        with np.errstate(over="ignore"):
            yield from f(*a)
    return run


def _input(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("t"))


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[int | None, np.ndarray]]:
    for b in batches:
        ids = b.column(0).to_pylist()
        for lo, sets in batch_sets(b.column(1), k):
            yield from zip(ids[lo:lo + len(sets)], sets, strict=True)


def scan(docs: DataFrame, doc_id: str, text: str, k: int) -> DataFrame:
    """Stored rows of two kinds: (doc_id, n, node) per document, and packed
    counts of the shingles that occur again within a chunk, by bucket."""

    @_quiet
    def run(batches):
        ids, sizes, nodes = [], [], []
        held, seen, size = [], set(), 0

        def docs_out():
            n = len(ids)
            out = pa.RecordBatch.from_arrays(
                [pa.array([-1] * n, pa.int32()), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())], names)
            ids.clear(), sizes.clear(), nodes.clear()
            return out

        def counts_out():
            u, c = np.unique(np.concatenate(held), return_counts=True)
            u, c = u[c > 1], c[c > 1].astype(np.int64)
            part = (u % np.uint64(BUCKETS)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            u, c, cut = u[order], c[order], np.searchsorted(part[order], np.arange(BUCKETS + 1))
            rows = [i for i in range(BUCKETS) if cut[i] < cut[i + 1]]
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int32()), *[pa.nulls(n, pa.int64())] * 3,
                 pa.array([u[cut[i]:cut[i + 1]].tobytes() for i in rows], pa.binary()),
                 pa.array([c[cut[i]:cut[i + 1]].tobytes() for i in rows], pa.binary())], names)

        for i, s in _sets(batches, k):
            node = node_of(s) if len(s) else None
            ids.append(i), sizes.append(len(s)), nodes.append(node)
            if len(s) and node not in seen:
                seen.add(node)
                held.append(s)
                size += len(s)
            if len(ids) == 1 << 14:
                yield docs_out()
            if size > CHUNK:
                yield counts_out()
                held, seen, size = [], set(), 0
        if held:
            yield counts_out()
        yield docs_out()

    names = ["bucket", "doc_id", "n", "node", "hashes", "counts"]
    return stored(_input(docs, doc_id, text).mapInArrow(
        run, "bucket int, doc_id long, n long, node long, hashes binary, counts binary"), "jaccard-scan")


def frequent(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent shingles and their classes (log2 of
    the estimate): whole classes from the top while they fit MAX_FREQUENT."""

    def add(t: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in t.column("hashes")])
        c = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in t.column("counts")])
        u, inv = np.unique(h, return_inverse=True)
        level = np.log2(np.bincount(inv, c)).astype(np.int64)
        levels = [x for x in np.unique(level) if x >= 2]
        return pa.table({"level": pa.array(levels, pa.int64()), "n": pa.array([int((level == x).sum()) for x in levels], pa.int64()),
                         "hashes": pa.array([u[level == x].tobytes() for x in levels], pa.binary())})

    per = stored(rows.filter("bucket >= 0").groupBy("bucket").applyInArrow(add, "level long, n long, hashes binary"), "jaccard-frequent")
    lowest, total = None, 0
    for r in per.groupBy("level").agg(F.sum("n").alias("n")).orderBy(F.desc("level")).collect():
        total += r["n"]
        if total > MAX_FREQUENT:
            break
        lowest = r["level"]
    got = [] if lowest is None else per.filter(F.col("level") >= lowest).collect()
    h = np.concatenate([np.empty(0, np.uint64), *[np.frombuffer(r["hashes"], np.uint64) for r in got]])
    c = np.concatenate([np.empty(0, np.int8), *[np.full(r["n"], r["level"], np.int8) for r in got]])
    order = np.argsort(h)
    return h[order], c[order]


def prefix(s: np.ndarray, freq: np.ndarray, level: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Adaptive prefix of a set: its shingles in order, their classes, and l."""
    n = len(s)
    cls = np.zeros(n, np.int8)
    if len(freq):
        at = np.minimum(np.searchsorted(freq, s), len(freq) - 1)
        hit = freq[at] == s
        if hit.any():
            cls[hit] = level[at[hit]]
            order = np.argsort(cls, kind="stable")
            s, cls = s[order], cls[order]
    p = n + (-percent * n // 100) + 1                     # n - ceil(t n) + 1
    cost = p + int((cls[:p] > 0).sum())
    match = 1 if cost <= COST else min(MAX_MATCH, 1 + int(np.log2(cost / COST)))
    p = min(n, p + match - 1)
    return s[:p], cls[:p], match


POSTING = np.dtype([("token", "<u8"), ("node", "<i8"), ("n", "<i4"), ("pos", "<i4"), ("match", "<i4")])


def postings(docs: DataFrame, doc_id: str, text: str, k: int, percent: int,
             freq: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(bucket, sub, packed): prefix postings, each class once a chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(freq)

    @_quiet
    def run(batches):
        h, level = shared.value
        held, subs, seen, size = [], [], set(), 0

        def out():
            p, sub = np.concatenate(held), np.concatenate(subs)
            key = mix(p["token"]) % np.uint64(buckets)
            order = np.lexsort((sub, key))
            p, sub, key = p[order], sub[order], key[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (sub[1:] != sub[:-1]))))
            stop = np.append(first[1:], len(p))
            return pa.RecordBatch.from_arrays(
                [pa.array(key[first]), pa.array(sub[first]),
                 pa.array([p[a:b].tobytes() for a, b in zip(first, stop, strict=True)], pa.binary())],
                ["bucket", "sub", "packed"])

        for _, s in _sets(batches, k):
            if not len(s) or (node := node_of(s)) in seen:
                continue
            seen.add(node)
            x, cls, match = prefix(s, h, level, percent)
            p = np.empty(len(x), POSTING)
            p["token"], p["node"], p["n"], p["pos"], p["match"] = x, node, len(s), np.arange(len(x)), match
            parts = np.ceil(np.exp2(cls.astype(float)) / SPREAD).astype(np.int64)
            held.append(p)
            subs.append(np.where(parts > 1, 1 + (node & 0x7FFFFFFF) % parts, 0))     # 0: not dealt
            size += len(x)
            if size > FLUSH:
                yield out()
                held, subs, seen, size = [], [], set(), 0
        if held:
            yield out()

    return _input(docs, doc_id, text).mapInArrow(run, "bucket long, sub long, packed binary")


def _alpha(x, y, percent: int):
    """Least intersection of linked sets of sizes x and y: ceil(t (x + y) / (1 + t))."""
    return -(-percent * (x + y) // (100 + percent))


LIST = "kind int, token long, a long, b long, n int, pos int, match int, cnt long"


def lists(packed: DataFrame, percent: int) -> DataFrame:
    """Stored rows of the shingles that several classes share: postings (kind
    1), pairs with the list's leader (0), and leaders of dealt lists (2).

    In a list of at most ``SHORT`` members those that fit no other one by length
    and position can't be in a pair and are left out.
    """

    def _fits(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length and position bounds of postings of a common shingle."""
        n, m = x["n"].astype(np.int64), y["n"].astype(np.int64)
        left = np.minimum(n - x["pos"], m - y["pos"])
        return ((100 * np.minimum(n, m) >= percent * np.maximum(n, m))
                & (left >= _alpha(n, m, percent) - np.minimum(x["match"], y["match"]) + 1))

    def run(t: pa.Table) -> pa.Table:
        sub = t.column("sub")[0].as_py()
        p = np.concatenate([np.frombuffer(x.as_py(), POSTING) for x in t.column("packed")])
        p = p[np.lexsort((p["node"], p["pos"], p["token"]))]
        same = (p["token"][1:] == p["token"][:-1]) & (p["node"][1:] == p["node"][:-1])
        p = p[np.concatenate(([True], ~same))]                 # a class that several tasks have seen
        head = np.concatenate(([True], p["token"][1:] != p["token"][:-1]))
        start = np.flatnonzero(head)
        size = np.diff(np.append(start, len(p)))
        of = np.repeat(np.arange(len(start)), size)
        more = (size[of] > SHORT) | (sub > 0)
        for d in range(1, min(SHORT, int(size.max()))):    # members d places apart in a short list
            i = np.flatnonzero((of[d:] == of[:-d]) & (size[of[d:]] <= SHORT))
            x, y = p[i], p[i + d]
            fit = _fits(x, y)
            more[i[fit]] = True
            more[i[fit] + d] = True
        lead = p[start[of]]
        fits = more & ~head & _fits(p, lead)
        pair, first, cnt = np.unique(np.stack([p["node"][fits], lead["node"][fits]], axis=1), axis=0,
                                     return_index=True, return_counts=True)
        least = np.minimum(p["match"], lead["match"])[fits][first]
        shared, tops = p[more], p[start] if sub else p[:0]
        n = [len(pair), len(shared), len(tops)]
        col = lambda name: np.concatenate([np.zeros(n[0], np.int64), shared[name].astype(np.int64), tops[name].astype(np.int64)])
        z = np.zeros(n[1] + n[2], np.int64)
        return pa.table({
            "kind": pa.array(np.repeat([0, 1, 2], n).astype(np.int32)),
            "token": pa.array(np.concatenate([np.zeros(n[0], np.uint64), shared["token"], tops["token"]]).view(np.int64)),
            "a": pa.array(np.concatenate([pair[:, 0], shared["node"], tops["node"]])),
            "b": pa.array(np.concatenate([pair[:, 1], z])), "n": pa.array(col("n").astype(np.int32)),
            "pos": pa.array(col("pos").astype(np.int32)),
            "match": pa.array(np.concatenate([least, shared["match"], tops["match"]]).astype(np.int32)),
            "cnt": pa.array(np.concatenate([cnt, z]))})

    return stored(packed.groupBy("bucket", "sub").applyInArrow(run, LIST), "jaccard-lists")


def set_table(docs: DataFrame, doc_id: str, text: str, k: int, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Stored (node, s): the sets of ``nodes`` as arrays, each read from its class's
    smallest document. Up to ``MAX_KNOWN`` (id, node) go to the tasks; beyond
    that the sets of all documents are joined with the list instead."""
    wanted = stored(classes.join(nodes, "node").select("node", F.col("rep").alias("id"), "rows").filter("id is not null"), "jaccard-wanted")
    size = wanted.agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows")).first()
    known = None
    if size["n"] <= MAX_KNOWN:
        t = wanted.select("id", "node").toArrow()
        ids, at = t.column(0).to_numpy(), t.column(1).to_numpy()
        order = np.argsort(ids, kind="stable")
        known = ids[order], at[order]
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @_quiet
    def run(batches):
        keep, seen = shared.value, set()
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            ids, want = b.column(0).to_numpy(), None
            if keep is not None and len(keep[0]):
                lo, hi = (np.searchsorted(keep[0], ids, side=s) for s in ("left", "right"))
                rows = np.flatnonzero(hi > lo)
                b, ids, want = b.take(pa.array(rows)), ids[rows], [set(keep[1][i:j].tolist()) for i, j in zip(lo[rows], hi[rows], strict=True)]
            elif keep is not None:
                continue
            for lo, sets in batch_sets(b.column(1), k):
                out = []
                for j, s in enumerate(sets, lo):
                    node = node_of(s) if len(s) else None
                    if node is not None and (want is None or node in want[j]) and (int(ids[j]), node) not in seen:
                        if want is not None:
                            seen.add((int(ids[j]), node))
                        out.append((int(ids[j]), node, s.view(np.int64)))
                if out:
                    i, node, s = zip(*out, strict=True)
                    cut = np.concatenate(([0], np.cumsum([len(x) for x in s]))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(i, pa.int64()), pa.array(node, pa.int64()),
                         pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(s)))], ["id", "node", "s"])

    sets = _input(docs, doc_id, text).mapInArrow(run, "id long, node long, s array<long>")
    if known is None:
        sets = sets.join(wanted.select("node", "id"), ["node", "id"])
    sets = sets.select("node", "s")
    return stored(sets.dropDuplicates(["node"]) if (size["rows"] or 0) > 1 else sets, "jaccard-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored links (a, b) among ``pairs`` (a, b).

    Only the sets of the pairs' nodes are shuffled; the nodes are broadcast to
    the scan of the sets if there are at most ``MAX_KNOWN``. The partners of a
    ``b`` are gathered in ``LIST_SALTS`` lists before its set is joined, so a
    document with very many partners is not one task's work.
    """
    pairs = stored(pairs, "jaccard-pairs")
    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    nodes = F.broadcast(nodes) if nodes.count() <= MAX_KNOWN else nodes
    sets = sets.join(nodes, "node", "left_semi")
    grouped = (pairs.groupBy("b", F.pmod(F.xxhash64("a"), F.lit(LIST_SALTS)).alias("salt"))
                    .agg(F.collect_set("a").alias("many")))
    with_b = (grouped.join(sets.withColumnsRenamed({"node": "b", "s": "sb"}), "b")
                     .select("b", "sb", F.explode("many").alias("a")))
    both = F.size(F.array_intersect("sa", "sb"))
    full = with_b.join(sets.withColumnsRenamed({"node": "a", "s": "sa"}), "a").select(
        "a", "b", both.alias("both"), (F.size("sa") + F.size("sb")).alias("total"))
    return stored(full.filter(100 * F.col("both") >= percent * (F.col("total") - F.col("both"))).select("a", "b"), "jaccard-links")


def _leader_pairs(rows: DataFrame) -> DataFrame:
    """Best leader of every class (a, b), of those that share enough; leaders of
    a dealt list among themselves."""
    best = (rows.filter("kind = 0").groupBy("a", "b").agg(F.sum("cnt").alias("cnt"), F.max("match").alias("least"))
                .filter("cnt >= least").groupBy("a").agg(F.max_by("b", F.struct("cnt", "b")).alias("b")))
    tops = rows.filter("kind = 2")
    first = tops.groupBy("token").agg(F.min_by("a", F.struct("pos", "a")).alias("b"))
    return best.unionByName(tops.select("token", "a").join(first, "token").filter("a <> b").select("a", "b").distinct())


def _cross_pairs(rows: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components."""
    t = (rows.filter("kind = 1").select("token", F.col("a").alias("node"), "n", "pos", "match")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    main = (t.groupBy("token", "root").count().groupBy("token")
             .agg(F.max_by("root", F.struct("count", "root")).alias("main"), F.count(F.lit(1)).alias("roots"))
             .filter("roots > 1").drop("roots"))
    mixed = salted_join(t, main, "token", "node")
    one = mixed.filter("root <> main").drop("main")
    two = mixed.drop("main").withColumnsRenamed({c: f"{c}2" for c in ("node", "n", "pos", "match", "root")})
    least = F.least("match", "match2")
    alpha = F.ceil(percent * (F.col("n") + F.col("n2")) / F.lit(100 + percent))
    room = F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    ok = ((F.col("root") != F.col("root2")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
          & (room >= alpha - least + 1))
    hits = one.join(two, "token").filter(ok)
    # a pair of two outsiders comes both ways: count its shingles once
    return (hits.groupBy(F.least("node", "node2").alias("a"), F.greatest("node", "node2").alias("b"), least.alias("least"), alpha.alias("alpha"))
                .agg(F.count_distinct("token").alias("cnt"), F.max(room).alias("room"))
                .filter("cnt >= least and room >= alpha").select("a", "b"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
         percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest document id reachable by links).

    A null or wordless text has no shingles and links with nothing. Rows with a
    null id get their copies' component; a class that has only null ids links
    with no other. Rows that repeat an id are rows each.
    """
    parts = 8 * shuffle_parts(docs.sparkSession)
    rows = scan(docs, doc_id, text, words)
    each = rows.filter("bucket < 0").select("doc_id", "n", "node")
    classes = stored(each.filter("node is not null").groupBy("node", "doc_id").count().groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.min_by("count", "doc_id").alias("rows"), F.sum("count").alias("docs")), "jaccard-classes")
    found = lists(postings(docs, doc_id, text, words, percent, frequent(rows), parts), percent)
    nodes = found.filter("kind = 1").select(F.col("a").alias("node")).distinct()
    sets = set_table(docs, doc_id, text, words, classes, nodes)
    near = verified(_leader_pairs(found), sets, percent)
    links = near.unionByName(verified(_cross_pairs(found, components(near), percent), sets, percent))
    roots = components(links)
    reps = classes.join(roots, "node")
    low = reps.groupBy("root").agg(F.min("rep").alias("component_id"))
    linked = salted_join(reps.select("node", "root"), low, "root", "node").select("node", "component_id")
    several = classes.filter("docs > 1").join(roots.select("node"), "node", "left_anti").select("node", F.col("rep").alias("component_id"))
    known = linked.unionByName(several)
    out = salted_join(each, known, "node", "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id, and one
    of those that have no id.

    Rows are told apart by a tag, a 64-bit hash of id and text whose last bit
    marks a null id, so an id on rows of different texts is judged by row. Of
    rows that repeat id and text one stays; rows without words link with
    nothing, and those without an id either all stay. The lists of tags are
    broadcast if they have at most ``MAX_KNOWN`` (counted first), else joined
    by shuffle.
    """
    key, body = F.col(doc_id).cast("long"), F.col(text).cast("string")
    tag = F.xxhash64(key, body.isNull(), body).bitwiseAND(F.lit(-2)).bitwiseOR(key.isNull().cast("long"))
    tagged, no_id = docs.withColumn("_tag", tag), F.col("_tag").bitwiseAND(F.lit(1))
    small = lambda d: F.broadcast(d) if d.count() <= MAX_KNOWN else d
    out = stored(join(tagged, "_tag", text).withColumnRenamed("doc_id", "_tag"), "jaccard-out")
    linked = out.filter("_tag <> component_id")
    members = stored(linked.select("_tag", "component_id").unionByName(
        linked.select(F.col("component_id").alias("_tag"), "component_id")).distinct(), "jaccard-members")
    stay = (tagged.select("_tag", key.alias("_id")).join(small(members), "_tag")
                  .groupBy("component_id", no_id).agg(F.min_by("_tag", F.struct("_id", "_tag")).alias("_tag")).select("_tag"))
    gone = stored(members.select("_tag").join(stay, "_tag", "left_anti"), "jaccard-gone")
    again = small(out.groupBy("_tag").agg(F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("words"))
                     .filter((F.col("n") > 1) & ((F.col("words") > 0) | (no_id == 0))).select("_tag"))
    left = tagged.join(small(gone), "_tag", "left_anti")
    one = left.join(again, "_tag", "left_semi").dropDuplicates([doc_id, text])
    return left.join(again, "_tag", "left_anti").unionByName(one).select(docs.columns)
