"""Secret scan: fixed base patterns plus two character Markov models.

Only DataFrame expressions run on the data. A pattern's matches are wrapped in
a sentinel (a Unicode noncharacter), the text is split there, and running
lengths of the pieces give the code-point offsets. Offsets are summed in
chunks of pieces, so a text with very many matches stays near-linear.

The models: first-order character chains of random strings and of ordinary
identifiers, trained from labelled samples, smoothed by character frequencies. A candidate (a
run of 16 or more of ``ALPHABET`` that does not touch another letter or digit)
is a ``model`` span when the log-likelihood ratio of random against ordinary
over its characters exceeds ``MIN_LLR``. Candidates that a base pattern finds
by themselves (hex, access) are not reported twice; base spans always stay.

Nulls and edges: a null text counts as empty and has no spans. In a text that
itself holds U+FDD0, that character is read as U+FDD1 (same length, in no
pattern). Repeated rows get the same result each.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_LLR = 10.0
#: Weight of a character's own frequency against the counts of the pairs.
BACKOFF = 20.0
#: Labelled rows: documents (the smallest hashed ids) and made random strings.
SAMPLE_DOCS = 2000
SAMPLE_RANDOM = 20_000
MASK = "[SECRET]"
#: Ordinary words of program text, for identifiers whatever the corpus is.
ORDINARY = """access account action address amount array async background backend before block body buffer build
button cache callback cancel category channel character check class client close cloud code collection color column
command comment common compare component config connection constant container content context control convert copy
count create current customer database date debug decode default delete description device directory disable display
document domain download driver element email enable encode endpoint engine entry environment error event exception
execute expected export factory failed feature field file filter final find first folder format frame function
generate global graph group handler handle hash header height history host hook identifier image import index
information initial input insert instance integer interface internal invalid invoice item iterator label language
last layout length level library limit line link list listener loader local location logger lookup manager map match
maximum member memory merge message method minimum model module monitor name network next node notification number
object offset open operation option order output owner package page parameter parent parser partition path payment
pending permission policy position prefix previous price primary private process product profile progress project
property protocol provider public query queue random range reader record reference refresh region register release
remote remove render replace report request required reset resource response result retry return role root route row
runtime sample schedule schema scope script search second section select send sequence server service session setting
shared signature simple single size snapshot socket source stage start state static status step storage store stream
string struct style submit success suffix summary support switch symbol system table target task template temporary
test text thread threshold time timeout timestamp title total trace transaction transfer transform type unique unit
unknown update upload user utility valid validate value variable vector version view visible warning weight width
window worker wrapper write zone"""

# The base patterns and the least lengths.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"(?<![\p{L}\p{N}+/_=-])[A-Za-z0-9+/_=-]{16,}+(?![\p{L}\p{N}])"
KINDS = ("assign", "access", "hex", "model")

_MARK, _OTHER = "\ufdd0", "\ufdd1"
_CHUNK = 256                      # even: a chunk starts with a piece between matches


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut at every match: pieces 1, 3, 5 ... (from 0) are the matches."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{_MARK}$1{_MARK}"), _MARK)


def _located(pieces: Column) -> Column:
    """array<struct<s, e, v>> of the odd pieces, with code-point offsets."""
    span = "array<struct<s:int,e:int,v:string>>"
    chunks = F.sequence(F.lit(0), ((F.size(pieces) - 1) / _CHUNK).cast("int"))
    part = lambda c: F.slice(pieces, c * _CHUNK + 1, _CHUNK)
    bases = F.aggregate(
        chunks, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out")),
        lambda a, c: F.struct(
            F.aggregate(part(c), a["pos"], lambda n, p: n + F.length(p)).alias("pos"),
            F.array_append(a["out"], a["pos"]).alias("out")),
        lambda a: a["out"])
    step = lambda a, p: F.struct(
        (a["pos"] + F.length(p)).alias("pos"), (~a["odd"]).alias("odd"),
        F.when(a["odd"], F.array_append(a["out"], F.struct(
            a["pos"].alias("s"), (a["pos"] + F.length(p)).alias("e"), p.alias("v"))))
        .otherwise(a["out"]).alias("out"))
    found = F.flatten(F.transform(F.arrays_zip(chunks.alias("c"), bases.alias("b")), lambda z: F.aggregate(
        part(z["c"]), F.struct(z["b"].alias("pos"), F.lit(False).alias("odd"), F.array().cast(span).alias("out")),
        step, lambda a: a["out"])))
    return F.when(F.size(pieces) > 1, found).otherwise(F.array().cast(span))


def _secret_length(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2))


def _clean(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _MARK, _OTHER)


def random_strings(spark, n: int) -> DataFrame:
    """(value): random strings over the alphabets that keys are made of."""
    d = F.sha2(F.concat(F.lit("paddock"), F.col("id").cast("string")).cast("binary"), 512)
    b64 = F.base64(F.unhex(d))
    kinds = F.array(F.substring(d, 1, 40), F.substring(b64, 1, 40),
                    F.substring(F.translate(b64, "+/=", "-_"), 1, 32),
                    F.substring(F.regexp_replace(F.upper(b64), "[^A-Z0-9]", ""), 1, 24),
                    F.substring(F.regexp_replace(b64, "[^A-Za-z0-9]", ""), 1, 48))
    return spark.range(n).select(F.get(kinds, (F.col("id") % 5).cast("int")).alias("value"))


def samples(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_docs: int = SAMPLE_DOCS,
            n_random: int = SAMPLE_RANDOM) -> DataFrame:
    """(value, secret): labelled strings.

    Random: made strings, and the hex and access keys of the sample documents.
    Ordinary: the words of the sample documents and of ``ORDINARY``, bare and
    joined as identifiers (8 characters or more). The sample documents are the ``n_docs`` of smallest
    hashed id; a rank over ids alone finds the bound first.
    """
    ids = docs.select(F.xxhash64(F.col(doc_id)).alias("h"))
    last = ids.orderBy("h").limit(n_docs).agg(F.max("h")).first()[0]
    some = docs.filter(F.xxhash64(F.col(doc_id)) <= F.lit(last)).select(_clean(text).alias("t"))
    keys = some.select(F.explode(F.regexp_extract_all("t", F.lit(f"({ACCESS}|{HEX})"), 1)).alias("value"))
    words = some.select(F.regexp_extract_all(
        F.regexp_replace("t", f"{ACCESS}|{HEX}", " "), F.lit(r"(?<![A-Za-z0-9])([A-Za-z]{4,})(?![A-Za-z0-9])"), 1).alias("w"))
    known = F.split(F.lit(" ".join(ORDINARY.split())), " ")
    words = words.unionByName(docs.sparkSession.range(20).select(
        F.transform(F.array_sort(F.transform(known, lambda x: F.struct(F.hash(x, "id"), x.alias("w")))),
                    lambda x: x["w"]).alias("w")))
    after = lambda i: F.coalesce(F.get(F.col("w"), i + 1), F.lit("x"))
    pair = lambda w, i: F.concat(
        w, F.get(F.array(F.lit("_"), F.lit("-"), F.lit("/"), F.lit("")), i % 4), after(i))
    names = words.select(F.explode(F.transform("w", lambda w, i: F.when(i % 8 == 0, F.upper(pair(w, i)))
                                               .when(i % 8 == 1, F.concat(w, F.initcap(after(i))))
                                               .when(i % 8 < 6, pair(w, i)).otherwise(w))).alias("value"))
    spark = docs.sparkSession
    return (random_strings(spark, n_random).unionByName(keys).withColumn("secret", F.lit(True))
            .unionByName(names.filter(F.length("value") >= 8).withColumn("secret", F.lit(False))))


def train(sample: DataFrame) -> list[float]:
    """Log ratio of every character pair, row by row of ``ALPHABET``; one pass
    of partial counts, at most 2 * 67 * 67 of them reach the driver."""
    k = len(ALPHABET)
    only = F.regexp_replace("value", "[^A-Za-z0-9+/_=-]", "")
    pairs = F.transform(F.sequence(F.lit(1), F.length("v") - 1), lambda i: F.substring(F.col("v"), i, F.lit(2)))
    counts = (sample.select("secret", only.alias("v")).filter("secret is not null and length(v) > 1")
              .select("secret", F.explode(pairs).alias("p")).groupBy("secret", "p").count().collect())
    logs = {}
    for secret in (True, False):
        pair, single = [0.0] * (k * k), [1.0] * k
        for r in counts:
            if r["secret"] == secret:
                a, b = map(ALPHABET.index, r["p"])
                pair[a * k + b] += r["count"]
                single[b] += r["count"]
        total = sum(single)
        logs[secret] = [
            math.log((pair[a * k + b] + BACKOFF * single[b] / total) / (sum(pair[a * k:a * k + k]) + BACKOFF))
            for a in range(k) for b in range(k)]
    return [x - y for x, y in zip(logs[True], logs[False], strict=True)]


def llr(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio, random against ordinary, over the pairs of ``value``."""
    k = len(ALPHABET)
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")      # folded to a constant
    place = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    zero = F.struct(F.lit(-1).alias("p"), F.lit(0.0).alias("s"))
    return F.aggregate(place, zero, lambda a, c: F.struct(
        c.alias("p"), F.when((a["p"] < 0) | (c < 0), a["s"]).otherwise(
            a["s"] + F.get(table, a["p"] * k + c)).alias("s")), lambda a: a["s"])


def scan(docs: DataFrame, model: list[float], text: str = "text", min_llr: float = MIN_LLR) -> DataFrame:
    """Add ``found``: array<struct<s, rank, e>> by start and kind; rank is the
    place in ``KINDS``, end is exclusive, offsets are code points."""
    patterns = (ASSIGN, ACCESS, HEX, CANDIDATE)
    t, n = F.col("_scan"), range(len(patterns))
    keep = {0: lambda x: _secret_length(x["v"]) >= 12,
            3: lambda x: ~x["v"].rlike(f"{ACCESS}|{HEX}") & (llr(x["v"], model) > min_llr)}

    def spans(r: int) -> Column:
        all_of = F.filter(F.col(f"_at{r}"), keep[r]) if r in keep else F.col(f"_at{r}")
        return F.transform(all_of, lambda x: F.struct(x["s"].alias("s"), F.lit(r).alias("rank"), x["e"].alias("e")))

    # a projection each: an expression that several others use is computed once
    return (docs.withColumn("_scan", _clean(text))
            .withColumns({f"_cut{r}": _pieces(t, patterns[r]) for r in n})
            .withColumns({f"_at{r}": _located(F.col(f"_cut{r}")) for r in n})
            .withColumn("found", F.array_sort(F.concat(*[spans(r) for r in n])))
            .drop("_scan", *[f"_cut{r}" for r in n], *[f"_at{r}" for r in n]))


def as_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["rank"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def _masker(keep, mask):
    return lambda p, i: F.when((i % 2 == 1) & (keep(p) if keep else F.lit(True)), mask(p)).otherwise(p)


def redact(docs: DataFrame, model: list[float], text: str = "text", min_llr: float = MIN_LLR) -> DataFrame:
    """Replace every secret in ``text`` by ``MASK`` (of an assignment, its value).

    Rows without a secret keep their text untouched, nulls included.
    """
    t = _clean(text)
    rules = [
        (ASSIGN, lambda p: _secret_length(p) >= 12,
         lambda p: F.concat(F.substring(p, F.lit(1), F.length(p) - _secret_length(p)), F.lit(MASK))),
        (ACCESS, None, lambda p: F.lit(MASK)),
        (HEX, None, lambda p: F.lit(MASK)),
        (CANDIDATE, lambda p: llr(p, model) > min_llr, lambda p: F.lit(MASK)),
    ]
    out = docs.withColumn("_scan", t).withColumn("_was", F.col("_scan"))
    for pattern, keep, mask in rules:
        cut = _pieces(F.col("_scan"), pattern)
        out = out.withColumn("_scan", F.array_join(F.transform(cut, _masker(keep, mask)), ""))
    return out.withColumn(text, F.when(F.col("_scan") != F.col("_was"), F.col("_scan")).otherwise(F.col(text))).drop("_scan", "_was")
