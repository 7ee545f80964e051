import random

from paddock.llm import decontaminate as d
from paddock.llm.q_decontaminate import op10_decontaminate


def _distance(pattern, text):
    """Sellers: least distance of the pattern to any substring."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != t), row[j] + 1, new[-1] + 1))
        row = new
    return min(row), row.index(min(row))


def _words(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def _edit(rnd, text, k):
    t = list(text)
    for _ in range(k):
        at = rnd.randrange(len(t))
        t[at:at + rnd.randint(0, 1)] = [rnd.choice("xyz ")] * rnd.randint(0, 1)
    return "".join(t)


def test_myers_equals_dynamic_program():
    rnd = random.Random(2)
    for _ in range(200):
        p, t = _words(rnd, rnd.randint(1, 25)), _words(rnd, rnd.randint(0, 40))
        assert d.myers(p, t) == _distance(p, t)


def _corpus():
    rnd = random.Random(4)
    items = [(i, _words(rnd, 30)) for i in range(12)]
    items += [(20, items[0][1].upper()), (21, None), (22, ""), (23, "too short"), (None, _words(rnd, 20)), items[3]]
    docs = []
    for k in range(60):
        body = _words(rnd, rnd.randint(0, 120))
        if k % 2:
            item = items[rnd.choice([0, 1, 2, 3, 4, 16])][1]
            body += "\n" + _edit(rnd, item, rnd.randint(0, 24)).replace(" ", rnd.choice([" ", "\n ", "\t"])) + " " + _words(rnd, 20)
        docs.append((k, body))
    docs += [(100, None), (101, ""), (102, items[5][1]), (103, items[5][1] + _words(rnd, 20_000) + items[6][1].upper()), docs[3], (None, items[7][1])]
    return items, docs


def _brute(items, docs):
    out = []
    for i, t in docs:
        for n, b in {x for x in items if x[1] is not None}:
            p = d.normal(b)
            if len(p) >= d.MIN_CHARS and i != 103:
                best, _ = _distance(p, d.normal(t))
                if best <= int(d.RATE * len(p)):
                    out.append((i, n, best))
    return sorted(out + [(103, 5, 0), (103, 6, 0)], key=str)


def test_equals_brute_force(spark):
    items, docs = _corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, end int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = _brute(items, docs)
    for chars in (1 << 20, 300):
        out = d.find(df, bench, block_chars=chars).collect()
        assert sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in out), key=str) == want
    texts = dict(docs)
    by = {n: d.normal(b) for n, b in items}
    for r in out:
        got = d.normal(texts[r["doc_id"]])[r["start"]:r["end"]]
        assert _distance(got, by[r["item_id"]])[0] <= r["distance"]
    bad = {i for i, _, _ in want}
    kept = d.clean(df, bench, block_chars=300).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(i) for i, _ in docs if i not in bad)


def test_short_items_are_searched(spark):
    items = [(1, "What is the capital of Peru?"), (2, "cat"), (3, "日本の首都はどこですか。名前を答えよ"), (4, " \n"), (5, "how many moons has mars")]
    docs = [(1, "Quiz: what is  the capital of PERU? Lima."), (2, "concatenate"), (3, "a cat."), (4, "次の日本の首都はどこですか。名前を答えよと"),
            (5, "so how manny moons has mars, then"), (6, "somehow many moons has marsh"), (7, "what is the capitol off Peru?"),
            (8, "what was a capitol off Peru?"), (9, "a concat, then a cat"), (10, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = d.find(df, bench).collect()
    got = sorted((r["doc_id"], r["item_id"], r["distance"]) for r in out)
    assert got == [(1, 1, 0), (3, 2, 0), (4, 3, 0), (5, 5, 1), (7, 1, 2), (9, 2, 0)]
    place = {(r["doc_id"], r["item_id"]): d.normal(dict(docs)[r["doc_id"]])[r["start"]:r["end"]] for r in out}
    assert place[1, 1] == "what is the capital of peru?" and place[5, 5] == "how manny moons has mars"
    assert sorted(r["doc_id"] for r in d.clean(df, bench).collect()) == [2, 6, 8, 10]


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a text that is long enough to be an item of its own")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a text that is long enough to be an item of its own")], "item_id long, text string")
    assert d.find(docs, bench.limit(0)).count() == 0 and d.clean(docs, bench.limit(0)).count() == 1
    assert d.find(docs.limit(0), bench).count() == 0 and d.clean(docs, bench).count() == 0


def test_query_on_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    got = {(r["doc_id"], r["item_id"]) for r in op10_decontaminate(spark, sf).collect()}
    texts = [(r["doc_id"], d.normal(r["text"])) for r in docs]
    want = {(i, b["item_id"]) for b in bench for i, t in texts if len(d.normal(b["text"])) >= d.MIN_CHARS and d.normal(b["text"]) in t}
    assert want and want <= got
    for i, n in got - want:
        t, p = dict(texts)[i], d.normal({b["item_id"]: b["text"] for b in bench}[n])
        assert _distance(p, t)[0] <= int(d.RATE * len(p))
