"""Secret scans: patterns, and a randomness battery with false-discovery control; DataFrame operations only.

Patterns give the base spans.  Beside them every long token is tested:

* its encoding is inferred as the smallest alphabet that holds its characters
  (separators ``-_=`` aside),
* three statistics are taken for that alphabet: chi-squared against equal shares, runs above
  and below the middle, and lag-1 serial correlation; a token that one of them tells from a
  random one (Wilson-Hilferty and normal limits) has the p-value 1,
* every other token gets four p-values under *ordinary text*: the same numbers of digits,
  small and capital letters, letters with ordinary shares, and a change of class with
  probability ``ORDINARY`` per character.  Characters are too even (coincidences against their
  mean and variance), runs too many (Chernoff bound), correlation too low (Fisher's z), and
  classes change too often (Chernoff bound; letters of one case cannot, there it is the
  likelihood ratio of equal to ordinary shares, by Markov's bound).  Normal tails are bounded by
  exp(-z*z/2)/2.  All depend on the length, so a short token needs more evidence,
* the Cauchy combination makes one p-value of the four, whatever their dependence,
* Benjamini-Hochberg over all tokens of the corpus sets the p-value at which a token
  counts as found.

Ordinary digits are taken to have equal shares, so tokens of digits alone get no small p-value:
from 24 in a row they are a base span, and in fewer nothing tells a key from a number.

The first pass sums tokens by binned p-value (a few hundred rows whatever the corpus);
the second is a projection.  No text is shuffled.

Defined cases: null and empty texts have no spans; offsets are code points of the
original text; a text with very many matches costs in proportion to them (offsets are summed in blocks,
overlaps found by bisection); repeated rows get equal results; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rowloom.llm.common import text_of

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX, MIN_TOKEN = 6, 20, 24, 20

TOKEN = f"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
ORDINARY = 0.05
FALSE_SHARE = 0.01
#: Letters of ordinary text, rounded shares of English, French, German and Spanish together; none below 5.
LETTERS = dict(
    a=83, b=15, c=33, d=41, e=145, f=15, g=17, h=35, i=70, j=5, k=8, l=46, m=27,
    n=74, o=61, p=23, q=8, r=66, s=70, t=70, u=45, v=13, w=11, x=5, y=9, z=6,
)
LIMIT = 2.94  # two-sided 1 % over three tests
_BINS = 400  # tenths of -log10(p)
_BLOCK = 256

_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
CLASSES = (_DIGIT, _LOWER, _UPPER, "+/")
#: Alphabets by size; the first that holds a token is its encoding.
ALPHABETS = (
    ("decimal", _DIGIT),
    ("hex", _DIGIT + "abcdef"),
    ("HEX", _DIGIT + "ABCDEF"),
    ("lower", _LOWER),
    ("upper", _UPPER),
    ("base32", _UPPER + "234567"),
    ("lower36", _DIGIT + _LOWER),
    ("upper36", _DIGIT + _UPPER),
    ("letters", _UPPER + _LOWER),
    ("base62", _DIGIT + _UPPER + _LOWER),
    ("base64", _DIGIT + _UPPER + _LOWER + "+/"),
)


def located(text: Column, pattern: str, group: int = 0, gate: str | None = None) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, end, found>>; found is a group.

    What lies between matches and the matches themselves alternate, so running sums of
    their lengths are the offsets.  Sums run within blocks and over blocks, so appending
    to an array never copies more than a block.
    """
    between, whole = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pieces = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(whole)), F.length).alias("gap"),
        F.transform(whole, F.length).alias("width"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("found"),
    )
    kind = "array<struct<start:int,end:int,found:string>>"

    def blocks(pieces: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(pieces), F.lit(1)), F.lit(_BLOCK))
        return F.transform(firsts, lambda i: F.slice(pieces, i, _BLOCK))

    def placed(blocks: Column) -> Column:
        totals = F.transform(
            blocks, lambda b: F.aggregate(b, F.lit(0), lambda at, p: at + p["gap"] + p["width"])
        )
        starts = _running(totals, lambda t: t)
        return F.flatten(F.zip_with(blocks, starts, lambda b, first: F.zip_with(b, _running(b, lambda p: p["gap"] + p["width"]), lambda p, at: F.struct(
            (first + at + p["gap"]).alias("start"), (first + at + p["gap"] + p["width"]).alias("end"), p["found"].alias("found")
        ))))

    # Most texts have no match: they are not taken apart.
    found = _let(pieces, lambda p: _let(blocks(p), placed))
    return F.when(text.rlike(gate or pattern), found.cast(kind)).otherwise(F.array().cast(kind))


def _running(values: Column, size: Callable[[Column], Column]) -> Column:
    """Sum of the sizes in front of each value."""
    return F.aggregate(
        values,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
        lambda s, v: F.struct((s["at"] + size(v)).alias("at"), F.array_append(s["out"], s["at"]).cast("array<int>").alias("out")),
        lambda s: s["out"],
    )


def overlapped(spans: Column, start: Column, end: Column) -> Column:
    """Does one of these spans (in order, apart from each other) share a character with start to end?

    The last span that begins before the end is found by bisection.
    """
    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        open_ = s["low"] < s["high"]
        left = F.get(spans, middle)["start"] < end
        return F.struct(
            F.when(open_ & left, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(open_ & ~left, middle).otherwise(s["high"]).alias("high"),
        )

    first = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))
    before = F.aggregate(F.sequence(F.lit(1), F.lit(32)), first, halve, lambda s: s["low"])
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, before - 1)["end"] > start, F.lit(False))


def base_spans(text: Column) -> dict[str, Column]:
    long_enough = lambda spans, n: F.filter(spans, lambda s: F.length(s["found"]) >= n)
    return {
        "assign": long_enough(located(text, ASSIGN, 2), MIN_ASSIGNED),
        "access": long_enough(located(text, ACCESS), MIN_ACCESS),
        # Runs of hex digits are everywhere; only texts with a long one are taken apart, and only long runs are matched:
        # a run is maximal, so this gives the same spans as matching all runs and dropping the short.
        "hex": located(text, f"[0-9a-f]{{{MIN_HEX},}}"),
    }


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def evidence(token: Column) -> Column:
    """Tenths of -log10 of a token's p-value under ordinary text; 0 if it does not look random."""
    encoding = lambda core: F.coalesce(
        *[F.when(core.rlike(f"^[{_class(a)}]*$"), _encoding(a)) for _, a in ALPHABETS], _encoding(ALPHABETS[-1][1])
    )
    tested = _let(
        F.regexp_replace(token, "[-_=]", ""),
        lambda core: F.when(
            F.length(core) >= MIN_TOKEN,
            _let(encoding(core), lambda e: _let(_statistics(core, e), lambda s: F.when(_passes(s, e), _tenths(core, s, e)))),
        ),
    )
    return F.coalesce(tested, F.lit(0))


def _class(alphabet: str) -> str:
    return alphabet.replace("+", "\\+").replace("/", "\\/")


def ordinary_classes(alphabet: str) -> list[tuple[float, ...]]:
    """Per class of characters, under ordinary shares: sums of squared and cubed shares, the share
    above the middle of the alphabet, and mean and mean square of the distance from it."""
    middle, out = (len(alphabet) - 1) / 2, []
    for members in CLASSES:
        inside = {c: LETTERS.get(c.lower(), 1) for c in alphabet if c in members}
        total = sum(inside.values()) or 1
        share = [(w / total, alphabet.index(c) - middle) for c, w in inside.items()]
        out.append((
            sum(q**2 for q, _ in share), sum(q**3 for q, _ in share), sum(q for q, x in share if x >= 0),
            sum(q * x for q, x in share), sum(q * x * x for q, x in share),
        ))
    return out


def _encoding(alphabet: str) -> Column:
    row = lambda r: F.array(*[F.lit(float(v)) for v in r])
    return F.struct(F.lit(alphabet).alias("alphabet"), F.array(*map(row, ordinary_classes(alphabet))).alias("classes"))


def _statistics(core: Column, encoding: Column) -> Column:
    """n, the class counts, and what the three statistics are made of."""
    alphabet = encoding["alphabet"]
    middle = (F.length(alphabet) - 1) / 2.0
    squares = F.aggregate(
        F.split(alphabet, ""),
        F.lit(0.0),
        lambda s, c: s + F.when(c == "", 0.0).otherwise(F.pow((F.length(core) - F.length(F.replace(core, c, F.lit("")))).cast("double"), 2.0)),
    )
    start = F.struct(
        *[F.lit(None if c == "last" else 0.0).cast("double").alias(c) for c in ("last", "squares", "lagged", "runs", "above")]
    )

    def step(s: Column, c: Column) -> Column:
        x = F.instr(alphabet, c) - 1 - middle
        known = s["last"].isNotNull()
        return F.struct(
            x.cast("double").alias("last"),
            (s["squares"] + x * x).alias("squares"),
            (s["lagged"] + F.when(known, x * s["last"]).otherwise(0.0)).alias("lagged"),
            (s["runs"] + F.when(known & ((x >= 0) == (s["last"] >= 0)), 0.0).otherwise(1.0)).alias("runs"),
            (s["above"] + F.when(x >= 0, 1.0).otherwise(0.0)).alias("above"),
        )

    chars = F.filter(F.split(core, ""), lambda c: c != "")
    count = lambda members: F.length(F.regexp_replace(core, f"[^{_class(members)}]", ""))
    return F.struct(
        F.length(core).cast("double").alias("n"),
        squares.alias("repeats"),
        F.aggregate(chars, start, step).alias("walk"),
        F.array(*[(count(m) / F.length(core)).cast("double") for m in CLASSES]).alias("shares"),
    )


def _passes(s: Column, encoding: Column) -> Column:
    """None of the three tests tells the token from a random one."""
    n, k, walk = s["n"], F.length(encoding["alphabet"]), s["walk"]
    df = (k - 1).cast("double")
    chi = s["repeats"] * k / n - n
    uniform = (F.pow(F.greatest(chi, F.lit(0.0)) / df, 1 / 3) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    a, b = walk["above"], n - walk["above"]
    expected = 2 * a * b / n + 1
    variance = (expected - 1) * (expected - 2) / F.greatest(n - 1, F.lit(1.0))
    runs = F.when(variance > 0, (walk["runs"] - expected) / F.sqrt(variance)).otherwise(1e9)
    serial = F.when(walk["squares"] > 0, walk["lagged"] / walk["squares"] * F.sqrt(n)).otherwise(1e9)
    return (uniform <= LIMIT) & (F.abs(runs) <= LIMIT) & (F.abs(serial) <= LIMIT)


def _tenths(core: Column, s: Column, encoding: Column) -> Column:
    """Cauchy combination of the four p-values, as tenths of -log10."""
    n, walk, pairs = s["n"], s["walk"], s["n"] - 1
    share = [F.get(s["shares"], i) for i in range(len(CLASSES))]
    of = lambda i, j: F.get(F.get(encoding["classes"], i), j)
    total = lambda f: sum((f(i) for i in range(1, len(CLASSES))), f(0))

    # Sums of squared and cubed shares of characters in ordinary text, and how far coincidences exceed what they expect.
    two, three = total(lambda i: share[i] ** 2 * of(i, 0)), total(lambda i: share[i] ** 3 * of(i, 1))
    def excess(two: Column) -> Column:
        variance = 2 * n * pairs * (two + 2 * (n - 2) * three - (2 * n - 3) * two * two)
        return (s["repeats"] - n * pairs * two - n) / F.sqrt(F.greatest(variance, F.lit(1e-9)))

    even = _tail(_let(two, excess))

    changes = ORDINARY + (1 - ORDINARY) * total(lambda i: share[i] * 2 * of(i, 2) * (1 - of(i, 2)))
    runs = _chernoff(walk["runs"] - 1, pairs, changes)

    stay, mean = total(lambda i: share[i] * of(i, 3) ** 2), total(lambda i: share[i] * of(i, 3))
    around = F.greatest(total(lambda i: share[i] * of(i, 4)), F.lit(1e-9))
    usual = ((1 - ORDINARY) * stay + ORDINARY * mean * mean) / around
    serial = _tail((_fisher(walk["lagged"] / F.greatest(walk["squares"], F.lit(1e-9))) - _fisher(usual)) * F.sqrt(n - 3))

    switches = F.size(F.regexp_extract_all(core, F.lit("[0-9]+|[a-z]+|[A-Z]+|[+/]+"), F.lit(0))) - 1
    classes = F.when(core.rlike("^([a-z]+|[A-Z]+)$"), _letter_gain(F.lower(core))).otherwise(_chernoff(switches, pairs, F.lit(ORDINARY)))

    def cotangent(gain: Column) -> Column:
        p = F.greatest(F.least(F.exp(-F.least(gain, F.lit(95.0))), F.lit(0.99)), F.lit(1e-41))
        return 1 / F.tan(math.pi * p)

    combined = sum((cotangent(g) for g in (runs, serial, classes)), cotangent(even)) / 4
    p = _let(combined, lambda c: F.when(c > 0, F.atan(1 / F.greatest(c, F.lit(1e-9))) / math.pi).otherwise(1.0))
    return F.greatest(F.least(F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-41)))).cast("int"), F.lit(_BINS)), F.lit(0))


def _tail(z: Column) -> Column:
    """-log of a bound of the normal probability of less than z."""
    return _let(z, lambda z: F.when(z < 0, z * z / 2 + math.log(2)).otherwise(0.0))


def _fisher(r: Column) -> Column:
    return F.atanh(F.greatest(F.least(r, F.lit(0.999)), F.lit(-0.999)))


def _chernoff(hits: Column, trials: Column, usual: Column) -> Column:
    """-log of the bound of so many hits or more, each with the usual probability; 0 if no more than usual."""
    rate = F.greatest(F.least(hits / trials, F.lit(1 - 1e-12)), F.lit(1e-12))

    def gain(x: Column) -> Column:
        rate, usual = x["rate"], x["usual"]
        nats = trials * (rate * F.log(rate / usual) + (1 - rate) * F.log((1 - rate) / (1 - usual)))
        return F.when(rate > usual, nats).otherwise(0.0)

    return _let(F.struct(rate.alias("rate"), usual.alias("usual")), gain)


def _letter_gain(letters: Column) -> Column:
    """Log of the likelihood ratio of equal shares to those of ordinary text."""
    total = sum(LETTERS.values())
    weights = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(math.log(total / n / len(LETTERS))).alias("w")) for c, n in LETTERS.items()])
    times = lambda c: F.length(letters) - F.length(F.replace(letters, c, F.lit("")))
    return F.aggregate(weights, F.lit(0.0), lambda s, x: s + x["w"] * times(x["c"]))


def discovery_cut(df: DataFrame, text: str = "text", false_share: float = FALSE_SHARE) -> int:
    """Benjamini-Hochberg over all tokens: the evidence from which a token counts as found."""
    tokens = df.select(text_of(text).alias("t")).where(F.col("t").rlike(TOKEN))
    tokens = tokens.select(F.explode(F.regexp_extract_all("t", F.lit(TOKEN), F.lit(0))).alias("token"))
    bins = dict(tokens.groupBy(evidence(F.col("token")).alias("bin")).count().collect())  # _BINS + 1 rows at most
    total, reached, cut = sum(bins.values()), 0, _BINS + 1
    for b in sorted(bins, reverse=True):
        reached += bins[b]
        if 10 ** (-b / 10) <= false_share * reached / total:
            cut = b
    return cut


def scan_secrets(df: DataFrame, doc_id: str = "doc_id", text: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, base array<struct<start, kind, end>>, spans (base and random ones), both in order."""
    cut = discovery_cut(df, text, false_share)
    rows = df.select(F.col(f"`{doc_id}`").alias("doc_id"), text_of(text).alias("t"))
    t = F.col("t")

    def spans(of: str | Column, kind: int) -> Column:
        return F.transform(of, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    rows = rows.select(
        "doc_id", *[c.alias(k) for k, c in base_spans(t).items()], located(t, TOKEN, 0).alias("tokens")
    )
    base = F.array_sort(F.concat(*[spans(k, n) for n, k in enumerate(KINDS[:3])]))
    rows = rows.select("doc_id", base.alias("base"), *KINDS[:3], "tokens")

    def free(s: Column) -> Column:
        hit = [overlapped(F.col(k), s["start"], s["end"]) for k in KINDS[:3]]
        return ~(hit[0] | hit[1] | hit[2])

    found = F.filter("tokens", lambda s: (evidence(s["found"]) >= cut) & free(s))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", spans(found, 3))).alias("spans"))


def spelled(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
