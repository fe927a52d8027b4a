"""Personal data by weak supervision. Native: DataFrame functions alone.

Candidate spans come from regular expressions, strict and loose. Six labelers vote on each (1: personal data, -1: not,
0: no vote): the check of its kind (range, Luhn, numbering plan, known endings of domains), a gazetteer of words for
the kind near the span, words near it that speak for something else, the characters around it, its shape, and the
variety of its digits. Votes are counted by pattern over the whole corpus; expectation-maximisation on these counts (a few
thousand rows at most, whatever the corpus) estimates each labeler's reliability per kind. The posteriors train a logistic
span classifier per kind, again on counts; the classifier, a native expression, decides on spans beyond the base, and takes those
with a probability above the threshold. A loose card that fails Luhn's check is never added. Base spans always stay, and an added span
gives way to base spans that it overlaps.

Edge cases: a null text is an empty one, without spans. Rows with equal ids stay rows of their own. Regular expressions use
possessive quantifiers and start only where a match can; positions and overlaps are running sums and maxima that are made block
by block, so texts of any length and with any number of matches take about linear time. The context of a span ends at the next match
of the same expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared_store import written

KINDS = ["email", "ip", "card", "phone"]

#: A match starts where no character of its first class stands before it, or where the match before ended: the
#: leftmost matches of the plain patterns, without trying every start.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
#: Looser shapes, for spans beyond the base.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?: ?[\[(]at[\])] ?[A-Za-z0-9-]++(?:(?:\.| ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)++| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)",
    "card": r"(?<![0-9])(?:[0-9]{4}[\x20-]?){3}[0-9]{4}(?![0-9])",
    "phone": r"(?<![0-9+.-])\(?[2-9][0-9]{2}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])",
}
#: Words near a span that speak for its kind.
GAZETTEER = {
    "email": r"e-?mail|\bmail|contact|write to|courriel|correo|address|adresse",
    "ip": r"\bip\b|host|server|address|adresse|login|client",
    "card": "card|visa|credit|carte|karte|tarjeta|payment|iban|account",
    "phone": "phone|tel|call|mobile|fax|anruf|appel|llam",
}
#: Words near a span that speak for something else.
AGAINST = {
    "email": r"\b(?:for sale|meeting|opens?|starts?|ends?|score)\b",
    "ip": r"version|release|section|chapter|\bv\.?$",
    "card": r"order|invoice|isbn|serial|tracking|barcode|\bref\b|\bsku\b",
    "phone": r"order|invoice|isbn|serial|tracking|version|\bpart\b|\bref\b|\bsku\b|\broom\b|\bscore|\bid\b",
}
#: A word before " at " that makes no mail address of it.
PLACE_VERB = "^(?:look(?:s|ed)?|meet|met|arrive[sd]?|stay(?:s|ed)?|stop(?:s|ped)?|lives?|works?|held|good|sat|is|are|was|were|be|it|him|her|them|us|point) at "
ENDINGS = r"(?:\.| ?[\[(]dot[\])] ?| dot )(?:[A-Za-z]{2}|com|org|net|edu|gov|info|biz|test|example|name|dev|app)$"
NEAR = 40  #: characters on each side that the context labelers see
LABELERS = ["check", "words", "against", "edges", "shape", "variety"]
#: Where estimation begins, and the weight of that, in candidates.
RELIABLE, WEIGHT = {"check": 0.85, "words": 0.85, "against": 0.85, "edges": 0.7, "shape": 0.75, "variety": 0.8}, 20.0
PRIOR = 0.5  #: share of candidates that are personal data, before the votes
ROUNDS, RIDGE = 50, 1e-3
SOME = 64  #: places in a block of a running sum

#: A match that is neither base nor of this shape is no candidate.
WORTH = {"ip": lambda t: F.length(t) >= 7, "card": lambda t: F.length(_digits(t)) >= 12}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Make a value once and use it many times."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(values: Column, merge: Callable[[Column, Column], Column], first: Column) -> Column:
    """For each place of an array of ints, ``first`` merged with all values before it. Blocks of SOME, their totals and the totals of SOME of these: linear time."""

    def small(v: Column, start: Column) -> Column:
        step = lambda s, x: F.struct(merge(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(v, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), step, lambda s: s["out"])

    def deep(v: Column, levels: int, start: Column) -> Column:
        if not levels:
            return small(v, start)
        cut = lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / SOME).cast("int")), lambda i: F.slice(v, i * SOME + 1, SOME))
        total = lambda x: F.aggregate(F.slice(x, 2, SOME), F.element_at(x, 1), merge)
        spread = lambda b: _let(deep(F.transform(b, total), levels - 1, start), lambda heads: F.flatten(F.zip_with(b, heads, small)))
        return _let(v, lambda v: _let(cut(v), spread))

    return F.when(F.size(values) <= SOME, small(values, first)).otherwise(deep(values, 2, first))


def _digits(t: Column) -> Column:
    return F.regexp_replace(t, "[^0-9]", "")


def luhn(t: Column) -> Column:
    """Whether 16 to 19 digits pass Luhn's check. Zeros before the first digit change nothing, so all are checked at 19."""
    digits = F.lpad(_digits(t), 19, "0")
    total = F.lit(0)
    for place in range(19):
        d = F.substring(digits, 19 - place, 1).cast("int")
        total = total + (d if place % 2 == 0 else F.when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.length(_digits(t)).between(16, 19) & (total % 10 == 0)


def by_kind(kind: Column, **values: Column) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _votes(s: Column) -> list[Column]:
    """What each labeler says of a span (kind, loose, t, before, after, ok)."""
    kind, loose, t, ok = s["kind"], s["loose"], s["t"], s["ok"]
    before, after, digits = F.lower(s["before"]), F.lower(s["after"]), _digits(t)
    near = F.concat(before, F.lit(" "), after)
    plan = digits.rlike("^[2-9](?!11)[0-9]{2}[2-9](?!11)[0-9]{6}$")
    known = t.rlike(ENDINGS)
    check = by_kind(kind, email=_vote(known, loose), ip=_vote(ok, ~ok), card=_vote(ok, ~ok), phone=F.when(loose, _vote(plan, ~plan)).otherwise(_vote(ok, ~ok)))
    words = F.when(by_kind(kind, **{k: near.rlike(p) for k, p in GAZETTEER.items()}), 1).otherwise(0)
    other = by_kind(kind, **{k: near.rlike(p) for k, p in AGAINST.items()}) | ((kind == "email") & F.lower(t).rlike(PLACE_VERB))
    edges = F.substring(before, -1, 1).rlike(r"[0-9a-z.@_+-]") | F.substring(after, 1, 1).rlike(r"[0-9a-z@_+-]")
    shape = by_kind(
        kind,
        email=_vote(F.length(t).between(6, 64) & (~loose | t.rlike(r"[\[(]at[\])]")), F.length(t) > 64),
        ip=_vote(F.length(t).between(7, 15), F.length(t) > 15),
        card=_vote(t.rlike("^[3-6]"), ~t.rlike("^[3-6]")),
        phone=_vote(t.rlike(r"^(?:\+|\([0-9]{3}\)[\x20-])"), ~t.rlike(r"^[0-9]{3}([\x20.-])[0-9]{3}\1")),
    )
    few = F.size(F.array_distinct(F.split(digits, ""))) < by_kind(kind, email=F.lit(0), ip=F.lit(3), card=F.lit(4), phone=F.lit(4))
    return [check, words, F.when(other, -1).otherwise(0), F.when(edges, -1).otherwise(0), shape, F.when(few, -1).otherwise(0)]


def candidates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: k and the array of candidate spans with their votes."""
    slim = docs.select(F.col(key).alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = F.col("t")
    gates = {"email": F.contains(t, F.lit("@")), "ip": t.rlike(r"[0-9]\.[0-9]"), "card": t.rlike("[0-9]{2}|[0-9][ -][0-9]"), "phone": F.contains(t, F.lit("+"))}
    loose_gates = {"email": t.rlike(r"[\[(]at[\])]| dot "), "card": t.rlike("[0-9]{4}[ -]?[0-9]{4}"), "phone": t.rlike(r"[0-9]{3}[\x20.-][0-9]{4}")}
    shapes = {f"base_{x}": (x, BASE[x], gates[x]) for x in KINDS} | {f"loose_{x}": (x, LOOSE[x], loose_gates[x]) for x in LOOSE}
    # Each array is made once here, in a projection of its own; the next ones go through it match by match.
    matches = lambda p, gate: (F.when(gate, F.regexp_extract_all(t, F.lit(p), F.lit(0))), F.when(gate, F.split(t, p, -1)))
    cut = [c.alias(f"{x}_{name}") for name, (_, p, gate) in shapes.items() for x, c in zip("fs", matches(p, gate), strict=True)]
    named = [F.struct(F.lit(kind).alias("kind"), F.lit(name.startswith("loose")).alias("loose"), F.col(f"f_{name}").alias("found"), F.col(f"s_{name}").alias("between")) for name, (kind, *_) in shapes.items()]

    def spans(shape: Column) -> Column:
        """Begin and end (code points), text and surroundings of the matches, in order, from the matches and the pieces between them."""
        found, between = shape["found"], shape["between"]
        steps = F.zip_with(found, F.slice(between, 2, F.size(found)), lambda f, x: F.length(f) + F.length(x))

        def placed(begins: Column) -> Column:
            def one(f: Column, i: Column) -> Column:
                begin = F.get(begins, i)
                around = F.right(F.get(between, i), F.lit(NEAR)).alias("before"), F.left(F.get(between, i + 1), F.lit(NEAR)).alias("after")
                return F.struct(shape["kind"].alias("kind"), shape["loose"].alias("loose"), begin.alias("b"), (begin + F.length(f)).alias("e"), f.alias("t"), *around)

            return F.transform(found, one)

        return _let(_let(steps, lambda x: running(x, lambda a, b: a + b, F.length(F.get(between, F.lit(0))))), placed)

    def checked(s: Column) -> Column:
        t, kind = s["t"], s["kind"]
        ok = by_kind(kind, email=F.lit(True), ip=t.rlike("^" + r"\.".join([_OCTET] * 4) + "$"), card=luhn(t), phone=s["loose"] | F.length(_digits(t)).between(8, 15))
        return s.withField("ok", ok)

    def voted(s: Column) -> Column:
        votes = [v.cast("tinyint").alias(name) for name, v in zip(LABELERS, _votes(s), strict=True)]
        return F.struct(s["kind"].alias("kind"), s["loose"].alias("loose"), s["b"].alias("b"), s["e"].alias("e"), s["ok"].alias("ok"), *votes)

    worth = lambda s: by_kind(s["kind"], **{k: f(s["t"]) for k, f in WORTH.items()}, email=F.lit(True), phone=F.lit(True))
    found = slim.select("k", "t", *cut).select("k", F.filter(F.array(*named), lambda s: F.size(s["found"]) > 0).alias("shapes"))
    found = found.select("k", F.flatten(F.transform("shapes", spans)).alias("raw"))
    return found.select("k", F.transform(F.transform(F.filter("raw", worth), checked), voted).alias("spans"))


def estimate(patterns: list[tuple[str, tuple[int, ...], bool, int]]) -> tuple[dict[str, dict[str, float]], dict[str, list[float]]]:
    """EM over counted vote patterns, then a logistic classifier per kind. patterns: (kind, votes, loose, count), a few thousand at most.

    Returns the labelers' reliabilities, and the classifiers' weights: bias, one for each labeler's vote.
    """
    reliable = {kind: dict(RELIABLE) for kind in KINDS}
    weights = {}
    for kind in KINDS:
        mine = [(votes, n) for k, votes, _, n in patterns if k == kind]
        post: list[float] = []
        for _ in range(ROUNDS):
            post = []
            for votes, _ in mine:
                odds = math.log(PRIOR / (1 - PRIOR)) + sum(v * math.log(a / (1 - a)) for v, a in zip(votes, reliable[kind].values(), strict=True))
                post.append(1 / (1 + math.exp(-odds)))
            for i, name in enumerate(LABELERS):
                voted = [(p if votes[i] > 0 else 1 - p, n) for p, (votes, n) in zip(post, mine, strict=True) if votes[i]]
                right, total = WEIGHT * RELIABLE[name] + sum(x * n for x, n in voted), WEIGHT + sum(n for _, n in voted)
                reliable[kind][name] = min(0.95, max(0.55, right / total))  # a labeler is better than chance
        weights[kind] = _logistic([(1.0, *map(float, votes)) for votes, _ in mine], post, [n for _, n in mine])
    return reliable, weights


def _logistic(rows: list[tuple[float, ...]], wanted: list[float], counts: list[int]) -> list[float]:
    """Newton's method with a ridge towards the votes' weights at the beginning, which stay where there is nothing to learn from."""
    w = np.array([0.0, *(math.log(a / (1 - a)) for a in RELIABLE.values())])
    if not rows:
        return w.tolist()
    x, y, n = np.array(rows), np.array(wanted), np.array(counts, float) / sum(counts)
    start = w.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + RIDGE * (w - start)
        curve = (x * (n * np.maximum(p * (1 - p), 1e-3))[:, None]).T @ x + RIDGE * np.eye(len(w))
        w = w - np.linalg.solve(curve, slope)
    return w.tolist()


def _free(spans: Column) -> Column:
    """The base spans, and the others that overlap none of them. spans: array of (b, e, base, o, kind)."""
    far = F.lit(2**31 - 1)
    ends = F.transform(spans, lambda x: F.when(x["base"], x["e"]).otherwise(0))
    begins = F.reverse(F.transform(spans, lambda x: F.when(x["base"], x["b"]).otherwise(far)))
    reached = _let(ends, lambda v: running(v, lambda a, b: F.greatest(a, b), F.lit(0)))  # by base spans that begin before
    coming = _let(begins, lambda v: F.reverse(running(v, lambda a, b: F.least(a, b), far)))  # of base spans that begin after
    free = lambda x, i, r, c: x["base"] | ((F.get(r, i) <= x["b"]) & (F.get(c, i) >= x["e"]))
    return _let(reached, lambda r: _let(coming, lambda c: F.filter(spans, lambda x, i: free(x, i, r, c))))


def find_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id", threshold: float = 0.9) -> DataFrame:
    """One row per document: key, counts of base spans by kind, base (array of spans) and spans (base and added, by kind, then place)."""
    held = written(candidates(docs, text, key), "pii-candidates")
    votes = [F.col(f"s.{name}") for name in LABELERS]
    counted = held.select(F.explode("spans").alias("s")).groupBy(F.col("s.kind").alias("kind"), *votes, F.col("s.loose").alias("loose")).count()
    # kinds x votes: 4 x 3 ** 6 x 2 rows at most
    patterns = [(r["kind"], tuple(r[name] for name in LABELERS), r["loose"], r["count"]) for r in sorted(counted.collect())]
    _, weights = estimate(patterns)

    def keep(s: Column) -> Column:
        score = lambda w: sum((x * s[name] for x, name in zip(map(F.lit, w[1:]), LABELERS, strict=True)), F.lit(w[0]))
        return (s["kind"] != "card") | s["ok"], by_kind(s["kind"], **{k: score(w) for k, w in weights.items()}) > math.log(threshold / (1 - threshold))

    order = F.create_map(*[F.lit(v) for i, x in enumerate(KINDS) for v in (x, i)])
    base = F.filter("spans", lambda s: s["ok"] & ~s["loose"])
    more = F.filter("spans", lambda s: s["loose"] & keep(s)[0] & keep(s)[1])
    slim = lambda c: F.transform(c, lambda x: F.struct(x["kind"].alias("kind"), x["b"].alias("start"), x["e"].alias("end")))
    chosen = held.select("k", base.alias("base"), more.alias("more"))
    placed = lambda c, own: F.transform(c, lambda x: F.struct(x["b"].alias("b"), x["e"].alias("e"), F.lit(own).alias("base"), order[x["kind"]].alias("o"), x["kind"].alias("kind")))
    both = F.when(F.size("more") > 0, F.array_sort(F.concat(placed(F.col("more"), False), placed(F.col("base"), True))))
    chosen = chosen.select("k", "base", both.alias("both"))
    kinds = lambda c: F.array_sort(F.transform(c, lambda x: F.struct(x["o"].alias("o"), x["b"].alias("b"), x["e"].alias("e"), x["kind"].alias("kind"))))
    spans = F.when(F.col("both").isNull(), slim(F.col("base"))).otherwise(slim(kinds(_free(F.col("both")))))
    counts = [F.size(F.filter("base", _of(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return chosen.select(F.col("k").alias(key), *counts, slim(F.col("base")).alias("base"), spans.alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
