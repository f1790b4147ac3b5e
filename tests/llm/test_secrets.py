"""Random spans against a plain computation of every p-value, and texts with very many matches."""

import collections
import math
import random
import re
import string
import time

from rowloom.llm import secrets


def plain_p(token):
    """The p-value of a token under ordinary text, 1 if a test of randomness fails."""
    core = re.sub("[-_=]", "", token)
    n = len(core)
    if n < secrets.MIN_TOKEN:
        return 1.0
    alphabet = next(a for _, a in secrets.ALPHABETS if set(core) <= set(a))
    k, counts = len(alphabet), collections.Counter(core)
    x = [alphabet.index(c) - (k - 1) / 2 for c in core]
    repeats = sum(v * v for v in counts.values())
    df, chi = k - 1, repeats * k / n - n
    uniform = ((max(chi, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    above = sum(v >= 0 for v in x)
    runs = 1 + sum((a >= 0) != (b >= 0) for a, b in zip(x, x[1:]))
    mean = 2 * above * (n - above) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    if variance <= 0 or abs(runs - mean) / math.sqrt(variance) > secrets.LIMIT or uniform > secrets.LIMIT:
        return 1.0
    serial = sum(a * b for a, b in zip(x, x[1:])) / sum(a * a for a in x)
    if abs(serial) * math.sqrt(n) > secrets.LIMIT:
        return 1.0
    # Ordinary text with the token's own classes.
    q, place = {}, {c: alphabet.index(c) - (k - 1) / 2 for c in alphabet}
    stay = changes = 0
    for members in secrets.CLASSES:
        share = sum(counts[c] for c in members) / n
        weights = {c: secrets.LETTERS.get(c.lower(), 1) for c in members if c in alphabet}
        own = {c: w / sum(weights.values()) for c, w in weights.items()}
        q |= {c: share * w for c, w in own.items()}
        high = sum(w for c, w in own.items() if place[c] >= 0)
        changes += share * 2 * high * (1 - high)
        stay += share * sum(w * place[c] for c, w in own.items()) ** 2
    s = secrets.ORDINARY
    two, three = sum(v**2 for v in q.values()), sum(v**3 for v in q.values())
    spread = math.sqrt(2 * n * (n - 1) * (two + 2 * (n - 2) * three - (2 * n - 3) * two**2))

    def tail(z):
        return math.exp(-z * z / 2) / 2 if z < 0 else 1.0

    def chernoff(hits, usual):
        rate = min(max(hits / (n - 1), 1e-12), 1 - 1e-12)
        if rate <= usual:
            return 1.0
        return math.exp(-(n - 1) * (rate * math.log(rate / usual) + (1 - rate) * math.log((1 - rate) / (1 - usual))))

    average = sum(v * place[c] for c, v in q.items())
    usual = ((1 - s) * stay + s * average**2) / sum(v * place[c] ** 2 for c, v in q.items())
    bound = lambda r: math.atanh(min(max(r, -0.999), 0.999))
    if core.isalpha() and (core.islower() or core.isupper()):
        total = sum(secrets.LETTERS.values())
        switched = 1 / math.prod(total / secrets.LETTERS[c] / 26 for c in core.lower())
    else:
        switched = chernoff(len(re.findall("[0-9]+|[a-z]+|[A-Z]+|[+/]+", core)) - 1, s)
    four = [
        tail((repeats - n * (n - 1) * two - n) / spread),
        chernoff(runs - 1, s + (1 - s) * changes),
        tail((bound(serial) - bound(usual)) * math.sqrt(n - 3)),
        switched,
    ]
    combined = sum(1 / math.tan(math.pi * min(max(p, math.exp(-95)), 0.99)) for p in four) / 4
    return math.atan(1 / combined) / math.pi if combined > 0 else 1.0


def plain_found(texts):
    tokens = [(i, m) for i, t in texts.items() for m in re.finditer(secrets.TOKEN, t)]
    bins = [max(min(math.floor(-10 * math.log10(max(plain_p(m.group()), 1e-41)) + 1e-9), 400), 0) for _, m in tokens]
    cut = 401
    for b in sorted(set(bins), reverse=True):
        if 10 ** (-b / 10) <= secrets.FALSE_SHARE * sum(x >= b for x in bins) / len(bins):
            cut = b
    return {(i, m.start(), m.end()) for (i, m), b in zip(tokens, bins) if b >= cut}, bins


def test_random_spans_like_plain_code(spark):
    draw = random.Random(3)
    texts = {}
    for i, (_, alphabet) in enumerate(secrets.ALPHABETS):
        for j in range(12):
            texts[100 * i + j] = "key " + "".join(draw.choice(alphabet) for _ in range(draw.randrange(20, 60))) + " end"
    names = "connection buffer maximum reader handler value index of the an open stream Byte Array".split()
    for j in range(200):
        texts[5000 + j] = "call " + draw.choice(["_", "-", ""]).join(draw.choice(names) for _ in range(6)) + "\n"
    texts |= {9000: "-" * 40, 9001: "=" * 20 + "a", 9002: "20240101202401022024", 9003: "/usr/local/share/doc/package/index"}
    rows = [*texts.items(), *[(i, texts[i]) for i in (0, 900, 5000)]]  # some rows twice
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as base", "2 as hex", "3 as tokens")
    base_hits = lambda r: {(s["start"], s["end"]) for s in r.base}
    doubled = {(i, k): t for k, (i, t) in enumerate(rows)}
    want, bins = plain_found(doubled)
    want = {(i, a, b) for (i, _), a, b in want}
    assert len(set(bins)) > 20
    got = secrets.scan_secrets(df).collect()
    assert len(got) == len(rows)
    for r in got:
        free = {(a, b) for i, a, b in want if i == r.doc_id and not any(x < b and a < y for x, y in base_hits(r))}
        assert {(s["start"], s["end"]) for s in r.spans if s["kind"] == 3} == free, texts[r.doc_id]
    assert not [w for w in want if w[0] >= 5000], "ordinary names were taken for keys"


def test_very_many_matches_in_one_text(spark):
    draw = random.Random(1)
    parts = [f"password=abcdef{draw.randrange(10**6)}" for _ in range(100_000)]
    parts[500] = "".join(draw.choice(string.ascii_letters + string.digits) for _ in range(40))
    text = " ".join(parts)
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    (row,) = secrets.scan_secrets(df).collect()
    assert time.time() - start < 60
    assert [(s["start"], s["end"]) for s in row.base] == [m.span() for m in re.finditer("password=[a-f0-9]+", text)]
    assert [text[s["start"] : s["end"]] for s in row.spans if s["kind"] == 3] == [parts[500]]
