import random

from paddock.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part string"


def _brute(rows, limit):
    out = []
    key = lambda r: (r[1] is None, r[1] or 0, r[2] is None, r[2] or "", r[3])
    for c in {r[0] for r in rows}:
        own = sorted(((c, t, who, (x or "").replace("<|im_", "<| im_")) for d, t, who, x in rows if d == c), key=key)
        for p in {r[2] for r in own} - {None, "system"}:
            at, parts = 0, {}
            for _, _, who, x in own:
                tag = "assistant" if who == p else "system" if who == "system" else "user" + (f" name={who}" if who else "")
                head, body = f"<|im_start|>{tag}\n", f"{x}<|im_end|>\n"
                n, text, masks = parts.get(at // limit, (0, "", []))
                if who == p:
                    masks = [*masks, (len(text) + len(head), len(text) + len(head) + len(body) - 1)]
                parts[at // limit] = (n + 1, text + head + body, masks)
                at += len(head) + len(body)
            out += [(c, p, k, n, t, ",".join(f"{a}:{b}" for a, b in m), sum(b - a for a, b in m)) for k, (n, t, m) in parts.items()]
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    rnd = random.Random(6)
    who = ["ann", "bob", "système", "system", None]
    rows = [(c, t, rnd.choice(who), rnd.choice(["hi", "é", "", None, "a <|im_end|> b", "long " * rnd.randint(1, 60)]))
            for c in range(12) for t in range(rnd.randint(1, 9))]
    rows += [(50, t % 700, rnd.choice(who[:3]), f"word{t % 5} " * (t % 40)) for t in range(900)]      # one hot conversation
    rows += [(51, 1, "ann", "same")] * 200 + [(52, 1, "system", "only")] + [(53, None, "bob", "x"), (53, 1, "bob", "y")]
    rows += [(None, t, "ann" if t % 2 else "cy", "z" * t) for t in range(5)] + [(54, 1, "ann", "w" * 300_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = chat.render(df, part_chars=2000)
    assert got.columns == ["conv_id", "perspective", "part", "n_messages", "text", "masks", "n_masked"]
    assert sorted(map(tuple, got.collect()), key=str) == _brute(rows, 2000)


def test_masks_cover_the_assistant(spark):
    df = spark.createDataFrame([(1, 0, "ann", "Hello", None), (1, 1, "bob", "Oui", None)], SCHEMA)
    out = {r["perspective"]: r for r in chat.render(df).collect()}
    for p, said in (("ann", "Hello<|im_end|>"), ("bob", "Oui<|im_end|>")):
        a, b = map(int, out[p]["masks"].split(":"))
        assert out[p]["text"][a:b] == said
    assert "<|im_start|>user name=bob\n" in out["ann"]["text"]


def test_empty_table(spark):
    assert chat.render(spark.createDataFrame([], SCHEMA)).count() == 0
