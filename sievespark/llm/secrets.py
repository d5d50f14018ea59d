"""Secret scan: fixed detectors plus a randomness battery with false-discovery control (DataFrame functions only).

The battery looks at every other run of 20 or more credential characters. Its encoding is inferred
(hex, letters of one case, base32, base36, base62, base64), and three kinds of tests are made, each
standardised under the null hypothesis "ordinary text run together in this encoding":

* chi-squared distance of the symbols from a uniform alphabet; for letters also their mean surprise;
* runs: changes between classes of symbols (vowels, consonants, digits, cases, signs);
* lag-1 serial correlation of the codes, as a null of its own in mixed case.

The null's letter frequencies and its share of vowel changes are measured on all text of the
corpus, with PRIOR letters of prose added; the shapes of identifiers are stated constants. The
weighted sum, divided by its deviation under the null, gives one p-value a token. A token that
randomness itself cannot explain (symbols far from uniform, strong serial correlation) is no secret.
Benjamini-Hochberg runs separately in each length band, over a histogram of the statistic, so the
corpus is never sorted. All work on a token is linear in its length.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievespark.llm.common import let
from sievespark.session import cut_lineage

#: Fixed patterns of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
UPPER, LOWER, DIGITS, SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", "+/_-="
ALPHABET = UPPER + LOWER + DIGITS + SIGNS
#: Percent of letters a to z in English prose, and the share of vowel changes between neighbouring letters there.
LETTERS = (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4, 6.7, 7.5, 1.9, 0.095, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.074)
VOWEL_CHANGES = 0.56
#: Letters of such prose that are added to what the corpus holds; a letter's share is taken as RAREST at least.
PRIOR, RAREST = 1_000_000, 0.01
#: Encodings: alphabet size, and the shares of digits, capitals and signs in ordinary runs of it.
HEX16, ALPHA, BASE32, BASE36, BASE62, BASE64 = range(6)
SIZES = (16, 26, 32, 36, 62, 66)
SHAPES = ((0.5, 0.0, 0.0), (0.0, 0.0, 0.0), (0.1, 0.0, 0.0), (0.1, 0.0, 0.0), (0.05, 0.15, 0.0), (0.05, 0.15, 0.08))
#: Share of changes under the null: between letters and digits, and between classes in mixed case; serial correlation there.
DIGIT_CHANGES, CLASS_CHANGES, SERIAL = 0.10, 0.25, 0.35
#: Weights of the tests and how the first is correlated with the others, as measured on words run together.
WORD_WEIGHTS, WORD_SPREAD = (2.0, 1.0, 1.0), math.sqrt(9.8)  # surprise, uniformity (correlated by 0.6), vowel changes (0.25 and 0.2)
MIXED_WEIGHTS, MIXED_SPREAD = (2.0, 2.0, 1.0), 3.0
#: Beyond so many deviations from what random symbols do, a token is not random.
NOT_UNIFORM, NOT_SERIAL = 5.0, 4.0
VOWELS, CONSONANTS = "AEIOUYaeiouy", "B-DF-HJ-NP-TV-XZb-df-hj-np-tv-xz"
VOWEL_TURNS = f"(?<=[{VOWELS}])[{CONSONANTS}]|(?<=[{CONSONANTS}])[{VOWELS}]"
PAIRS = "(?<=[A-Za-z])[A-Za-z]"
DIGIT_TURNS = "(?<=[0-9])[^0-9]|(?<=[^0-9])[0-9]"
CLASS_TURNS = "(?<=[a-z])[^a-z]|(?<=[A-Z])[^A-Z]|(?<=[0-9])[^0-9]|(?<=[+/_=-])[^+/_=-]"
BANDS = (20, 28, 40, 64)
STEP, LIMIT, RUN = 0.05, 40.0, 256


def running(sizes: Column) -> Column:
    """Running sums of an array of ints, in blocks of RUN, so that no long array is grown one by one."""

    def grown(part: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(part, zero, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out")), lambda a: a["out"])

    def blocks(sizes: Column) -> Column:
        starts = F.when(F.size(sizes) > 0, F.sequence(F.lit(1), F.size(sizes), F.lit(RUN))).otherwise(F.array().cast("array<int>"))
        sums = F.transform(starts, lambda s: F.aggregate(F.slice(sizes, s, RUN), F.lit(0), lambda a, x: a + x))
        return let(grown(sums, F.lit(0)), lambda ends: F.flatten(F.transform(starts, lambda s, i: grown(F.slice(sizes, s, RUN), F.when(i > 0, F.element_at(ends, F.greatest(i, F.lit(1)))).otherwise(0)))))

    return let(sizes, blocks)


def spans(text: Column, pattern: str, kind: int, value_group: int = 0, least: int = 1) -> Column:
    """Leftmost non-overlapping matches as sorted (start, kind, end, value); code points, end exclusive.

    Matches whose value is shorter than ``least`` are consumed, then dropped.
    """
    item = "array<struct<start:int,kind:int,end:int,value:string>>"
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"), F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("values"))

    def placed(x: Column) -> Column:
        ends = running(F.zip_with(x["gaps"], x["hits"], lambda g, h: F.length(g) + F.coalesce(F.length(h), F.lit(0))))
        both = F.zip_with(F.arrays_zip(x["hits"].alias("hit"), x["values"].alias("value")), F.slice(ends, 1, F.size(x["hits"])), lambda h, e: F.struct((e - F.length(h["hit"])).alias("start"), F.lit(kind).alias("kind"), e.alias("end"), h["value"].alias("value")))
        return F.filter(both, lambda b: F.length(b["value"]) >= least)

    return F.when(text.rlike(pattern), let(found, placed)).otherwise(F.array()).cast(item)


def upper_tail(z: Column) -> Column:
    """P(Z >= z) of a standard normal; a rational approximation, beyond 4 the asymptotic series."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    density = F.exp(-x * x / 2) * 0.3989422804014327
    near = density * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    x2 = x * x
    tail = F.when(x > 4, density / x * (1 - 1 / x2 + 3 / (x2 * x2))).otherwise(near)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def root_deviance(x: Column, n: Column, p: float) -> Column:
    """Signed root of the deviance of x of n with a share p under the null; closer to the binomial's tails than a z-score."""
    above = x > n * p
    share = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), (x + F.when(above, -0.5).otherwise(0.5)) / F.greatest(n, F.lit(1.0))))
    root = F.sqrt(F.greatest(F.lit(0.0), 2 * n * (share * F.log(share / p) + (1 - share) * F.log((1 - share) / (1 - p)))))
    return F.when((n < 1) | ((share > p) != above), 0.0).when(above, root).otherwise(-root)


def base_null(docs: DataFrame, text_col: str = "text") -> tuple[list[float], float]:
    """Letter frequencies and the share of vowel changes in all text, with the prior added.

    By plain replacement and one split, since a regular expression over all text takes several times
    as long. Letters are counted by taking them out one after the other, the frequent ones first, so
    the text that is left gets shorter each time.
    """
    gone = lambda before, after: F.octet_length(before) - F.octet_length(after)
    without = lambda x, what: F.replace(x, F.lit(what), F.lit(""))
    rows = docs.select(F.lower(docs[text_col]).alias("text"))
    shape = F.translate("text", LOWER, "".join("a" if c in VOWELS else "b" for c in LOWER))
    rows = rows.select("text", shape.alias("shape"))
    turns = sum((gone(F.col("shape"), without(F.col("shape"), x)) / 2 for x in ("ab", "ba")), F.lit(0))
    runs = F.when(F.col("shape").isNotNull(), F.size(F.array_remove(F.split("shape", "[^ab]+", -1), "")))
    rows, done = rows.select("text", turns.alias("turns"), runs.alias("runs")), ["turns", "runs"]
    for c in sorted(LOWER, key=lambda c: -LETTERS[LOWER.index(c)]):
        rows = rows.select(*done, "text", without(F.col("text"), c).alias("rest"))
        rows = rows.select(*done, gone(F.col("text"), F.col("rest")).alias(f"n_{c}"), F.col("rest").alias("text"))
        done.append(f"n_{c}")
    row = rows.agg(*[F.sum(x).alias(x) for x in done]).first()
    counts = [row[f"n_{c}"] or 0 for c in LOWER]
    pairs = sum(counts) - (row["runs"] or 0)
    letters = [n + PRIOR * p / sum(LETTERS) for n, p in zip(counts, LETTERS)]
    return [x / sum(letters) for x in letters], ((row["turns"] or 0) + PRIOR * VOWEL_CHANGES) / (pairs + PRIOR)


def symbol_moments(letters: list[float], encoding: int) -> tuple[float, float]:
    """Sums of the squares and cubes of the symbols' shares under the null of an encoding."""
    digits, capitals, signs = SHAPES[encoding]
    some = letters[:6] if encoding == HEX16 else letters
    some = [x / sum(some) for x in some]
    rest = 1 - digits - capitals - signs
    return tuple((rest**k + capitals**k) * sum(x**k for x in some) + 10 * (digits / 10) ** k + 4 * (signs / 4) ** k for k in (2, 3))


def surprise(letters: list[float]) -> tuple[list[float], float, float]:
    """log of how much rarer than in random letters each letter is, and its mean and deviation under the null."""
    weights = [math.log(1 / 26 / max(x, RAREST)) for x in letters]
    mean = sum(x * w for x, w in zip(letters, weights))
    return weights, mean, math.sqrt(sum(x * (w - mean) ** 2 for x, w in zip(letters, weights)))


def encoding_of(token: Column) -> Column:
    tests = (("^(?:[0-9a-f]+|[0-9A-F]+)$", HEX16), ("^(?:[A-Z]+|[a-z]+)$", ALPHA), ("^(?:[A-Z2-7]+|[a-z2-7]+)$", BASE32), ("^(?:[A-Z0-9]+|[a-z0-9]+)$", BASE36), ("^[A-Za-z0-9]+$", BASE62))
    out = F.when(token.rlike(tests[0][0]), tests[0][1])
    for pattern, code in tests[1:]:
        out = out.when(token.rlike(pattern), code)
    return out.otherwise(BASE64)


def battery(tokens: Column, letters: list[float], vowels: float) -> Column:
    """``tokens`` (start, kind, end, value) as (start, kind, end, z): large z reject "ordinary text run together"."""
    weights, mean_surprise, spread = surprise(letters)
    pick = lambda values, e: F.element_at(F.array(*[F.lit(float(v)) for v in values]), e + 1)
    symbols = F.array(*[F.lit(c) for c in ALPHABET])
    by_symbol = F.array(*[F.lit(w) for w in weights + weights + [0.0] * (len(ALPHABET) - 52)])
    is_letter = F.array(*[F.lit(1)] * 52, *[F.lit(0)] * (len(ALPHABET) - 52))
    moments = [symbol_moments(letters, e) for e in range(len(SIZES))]
    place = ["start", "kind", "end"]

    def read(t: Column) -> Column:
        v = F.when(t["value"].rlike("^[A-Z2-7]{14,}={1,6}$"), F.rtrim(t["value"], F.lit("="))).otherwise(t["value"])  # padding of base32
        return F.struct(*[t[c].alias(c) for c in place], v.alias("v"))

    def counted(t: Column) -> Column:
        counts = F.transform(symbols, lambda c: (F.octet_length(t["v"]) - F.octet_length(F.replace(t["v"], c, F.lit("")))).cast("long"))
        codes = F.transform(F.filter(F.split(t["v"], ""), lambda c: c != ""), lambda c: F.ascii(c).cast("long"))
        return F.struct(*[t[c].alias(c) for c in [*place, "v"]], F.octet_length(t["v"]).cast("double").alias("n"), encoding_of(t["v"]).alias("e"), counts.alias("counts"), codes.alias("codes"))

    def summed(t: Column) -> Column:
        total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
        after = F.zip_with(t["codes"], F.slice(t["codes"], 2, F.size(t["codes"])), lambda x, y: F.coalesce(x * y, F.lit(0).cast("long")))
        known = F.zip_with(t["counts"], by_symbol, lambda c, w: c * w)
        some = F.zip_with(t["counts"], is_letter, lambda c, i: c * i)
        return F.struct(
            *[t[c].alias(c) for c in [*place, "v", "n", "e"]],
            total(F.transform(t["counts"], lambda c: c * (c - 1))).cast("double").alias("same"),
            F.aggregate(known, F.lit(0.0), lambda a, x: a + x).alias("surprise"), total(some).cast("double").alias("k"),
            total(t["codes"]).cast("double").alias("s"), total(F.transform(t["codes"], lambda x: x * x)).cast("double").alias("ss"), total(after).cast("double").alias("sxy"),
            (F.element_at(t["codes"], 1) + F.element_at(t["codes"], -1)).cast("double").alias("ends"),
        )

    def tested(t: Column) -> Column:
        n, e = t["n"], t["e"]
        two, three = (pick([m[i] for m in moments], e) for i in range(2))
        pairs = n * (n - 1)
        # Equal pairs of symbols: their number gives chi-squared against a uniform alphabet, its null moments are exact.
        uniform = (pairs * two - t["same"]) / F.sqrt(2 * pairs * (two - two * two) + 4 * pairs * (n - 2) * (three - two * two))
        chi2, df = pick(SIZES, e) / n * (t["same"] + n) - n, pick(SIZES, e) - 1
        mean = t["s"] / n
        spread_ = t["ss"] - n * mean * mean
        serial = F.when(spread_ > 0.5, (t["sxy"] - mean * (2 * t["s"] - t["ends"]) + (n - 1) * mean * mean) / spread_).otherwise(1.0)
        digits = root_deviance(F.regexp_count(t["v"], F.lit(DIGIT_TURNS)), n - 1, DIGIT_CHANGES)
        turns = root_deviance(F.regexp_count(t["v"], F.lit(VOWEL_TURNS)), F.regexp_count(t["v"], F.lit(PAIRS)).cast("double"), vowels)
        k = F.greatest(t["k"], F.lit(1.0))
        rare = (t["surprise"] - k * mean_surprise) / (spread * F.sqrt(k))
        classes = (F.regexp_count(t["v"], F.lit(CLASS_TURNS)) - (n - 1) * CLASS_CHANGES) / F.sqrt((n - 1) * CLASS_CHANGES * (1 - CLASS_CHANGES))
        word = (WORD_WEIGHTS[0] * rare + WORD_WEIGHTS[1] * uniform - WORD_WEIGHTS[2] * turns) / WORD_SPREAD
        mixed = (MIXED_WEIGHTS[0] * uniform + MIXED_WEIGHTS[1] * classes + MIXED_WEIGHTS[2] * (SERIAL - F.abs(serial)) * F.sqrt(n)) / MIXED_SPREAD
        z = F.when(e == HEX16, (uniform + 2 * digits) / math.sqrt(5)).when(e == ALPHA, word).when(e <= BASE36, (word * 1.5 + digits) / math.sqrt(3.25)).otherwise(mixed)
        fails = (chi2 > df + NOT_UNIFORM * F.sqrt(2 * df)) | (F.abs(serial) * F.sqrt(n) > NOT_SERIAL)
        return F.struct(*[t[c].alias(c) for c in place], F.when(fails, -LIMIT).otherwise(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), z))).alias("z"))

    # Each step is an array of its own, so that nothing is computed twice.
    for step in (read, counted, summed, tested):
        tokens = F.transform(tokens, step)
    return tokens


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.001) -> DataFrame:
    """Per row: id, base (array of spans), added (array of spans of kind ``random``).

    Null and empty texts have no spans; repeated rows are scanned each by itself and count as
    separate tests; an empty table has no tests. ``q`` is the false-discovery rate a band.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    letters, vowels = base_null(docs, text_col)
    base = F.array_sort(F.concat(spans(text, ASSIGN, 0, 1, 6), spans(text, ACCESS, 1), spans(text, HEX, 2)))
    found = docs.select(docs[id_col].alias("id"), let(F.struct(base.alias("base"), spans(text, TOKEN, 3).alias("tokens")), lambda x: F.struct(x["base"].alias("base"), F.filter(x["tokens"], lambda t: ~F.exists(x["base"], lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))).alias("free"))).alias("x"))
    band = lambda n: sum((F.when(n >= b, 1).otherwise(0) for b in BANDS[1:]), F.lit(0))
    scored = F.transform(battery(F.col("x.free"), letters, vowels), lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end"), band(t["end"] - t["start"]).alias("band"), F.floor(t["z"] / STEP).cast("int").alias("bin")))
    bare = F.transform("x.base", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end")))
    rows = cut_lineage(found.select("id", bare.alias("base"), F.when(F.size("x.free") > 0, scored).otherwise(F.array()).cast("array<struct<start:int,kind:int,end:int,band:int,bin:int>>").alias("tokens")))
    hist = rows.select(F.explode("tokens").alias("t")).groupBy("t.band", "t.bin").count()
    down = Window.partitionBy("band").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tested = hist.select("band", "bin", F.sum("count").over(down).alias("k"), F.sum("count").over(Window.partitionBy("band")).alias("m"))
    bars = tested.where(upper_tail(F.col("bin") * STEP) * F.col("m") <= q * F.col("k")).groupBy("band").agg(F.min("bin").alias("bar"))
    lowest = {r["band"]: r["bar"] for r in bars.collect()}  # at most one row a band
    passed = lambda t: reduce(lambda a, b: a | b, [(t["band"] == k) & (t["bin"] >= bar) for k, bar in sorted(lowest.items())], F.lit(False))
    added = F.filter("tokens", passed)
    added = F.transform(added, lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))
    return rows.select("id", "base", added.alias("added"))


def _written(items: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, **how: object) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans; see :func:`scan`."""
    found = scan(docs, **how)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select(F.col("id").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.array_sort(F.concat("base", "added"))).alias("spans"))
