"""Personal data by candidate spans and gradient boosting, with DataFrame functions only.

**Base spans** follow fixed patterns and checks, and always stay.

**Candidates.**  Looser generators propose overlapping spans of each kind: addresses
written with ``[at]`` and ``(dot)``, numbers in any grouping with or without a plus sign,
octets with bracketed dots.  Each has features of its format (digits, separators, groups)
and of its context (characters beside it, words before it).

**Model.**  A candidate that is a base span of its kind is a positive example.  What the
base patterns ask of the writing (the plus sign, which separators, the dot in brackets)
is kept from the model where other writings are usual, so it can recognise the same data
written otherwise.  The checks of the content (check digit, size of octets) are features:
a number that fails them is seldom the real thing.  Features take few values, so all candidates of the corpus are summed into a table of feature combinations, at most
``CELLS`` per kind however large the corpus; boosted trees of depth two are fitted on
that.  A fifth of the documents is kept out of the fit; on it each kind gets the lowest
threshold whose selection is right at least ``PRECISION`` of the time.  A kind that no
threshold serves adds nothing.

**Selection.**  A candidate above its kind's threshold is added unless it overlaps a base
span, or an added candidate with a higher score (the longer, then the earlier on a tie).

Nulls and edge cases: a null text counts as empty and has no spans.  A null id goes to
the fit.  Repeated rows get the same spans each.  Without candidates nothing is fitted.
Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonotheca.session import written

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Possessive repeats and the look-behind only spare
# attempts that must fail; ``\G`` is the end of the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"
#: A text without this has no base span of the kind.
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){12}", "phone": r"\+[0-9]"}

_AT, _DOT = r"(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)", r"(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)"
GENERATORS = {
    "email": rf"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:(?:\.|\[\.\]|\(\.\))[0-9]++){3}+",
    "card": r"[0-9](?:[\x20./-]?+[0-9]){10,19}+",
    "phone": r"[+(]?+[0-9](?:[\x20().-]{0,2}+[0-9]){7,15}+",
}
_GENERATOR_HINT = {"email": r"@|[\[(](?:at|AT)[\])]", "ip": r"[0-9][.\])]", "card": r"(?:[0-9][\x20./-]?){11}",
                   "phone": r"(?:[0-9][\x20().-]{0,2}){8}"}

#: Words before a candidate, by what they speak of.
_CONTEXTS = (
    r"(?i)(?:phone|tel|call|fax|mobile|cell|dial)\W{0,4}(?:no\W{0,2}|number\W{0,2})?$",
    r"(?i)(?:card|visa|credit|debit|amex|mastercard|payment)\W{0,4}(?:no\W{0,2}|number\W{0,2})?$",
    r"(?i)(?:mail|contact|write to)\W{0,4}$",
    r"(?i)(?:ip|host|server|addr|address|from)\W{0,4}$",
    r"(?i)(?:token|password|passwd|secret|key|order|version|id|isbn)\W{0,4}$",
)
DIGIT_STEPS = (1, 4, 7, 9, 10, 11, 12, 13, 16, 17, 20)
FEATURES = {"digits": len(DIGIT_STEPS) + 1, "separators": 8, "groups": 6, "before": 5, "after": 5,
            "context": len(_CONTEXTS) + 1, "check": 2}
CELLS = math.prod(FEATURES.values())
TREES = 40
RATE = 0.3
LEAST_HESSIAN = 1.0
PRECISION = 0.9
_BLOCK = 256


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _upto(i: Column) -> Column:
    """0 .. i-1; the array is empty for 0."""
    return F.when(i > 0, F.sequence(F.lit(0), i - 1)).otherwise(F.array().cast("array<int>"))


def _before(lengths: Column) -> Column:
    """The sum of what comes before each element, by sums of blocks and sums inside a block."""
    def inside(blocks: Column) -> Column:
        starts = F.transform(_upto(F.size(blocks)), lambda b: _sum(F.slice(blocks, F.lit(1), b)))
        return _let(starts, lambda s: F.transform(_upto(F.size(lengths)), lambda i: F.get(s, F.floor(i / _BLOCK).cast("int"))
                    + _sum(F.slice(lengths, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK))))

    n_blocks = F.ceil(F.size(lengths) / _BLOCK).cast("int")
    return _let(F.transform(_upto(n_blocks), lambda b: _sum(F.slice(lengths, b * _BLOCK + 1, _BLOCK))), inside)


def located(text: Column, pattern: str, hint: str) -> Column:
    """All matches as (start, end, match, left, right); left and right reach to the next match.

    The pieces between the matches give the positions: no text is searched for a match.
    """
    empty = F.array().cast("array<struct<start:int,end:int,match:string,left:string,right:string>>")

    def placed(z: Column) -> Column:
        lengths = F.zip_with(F.slice(z["pieces"], 1, F.size(z["found"])), z["found"], lambda p, m: F.length(p) + F.length(m))
        return _let(lengths, lambda sizes: _let(_before(sizes), lambda at: F.transform(_upto(F.size(sizes)), lambda i: F.struct(
            (F.get(at, i) + F.length(F.get(z["pieces"], i))).alias("start"),
            (F.get(at, i) + F.get(sizes, i)).alias("end"),
            F.get(z["found"], i).alias("match"), F.get(z["pieces"], i).alias("left"),
            F.get(z["pieces"], i + 1).alias("right")))))

    parts = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces"))
    return F.when(text.rlike(hint), _let(parts, placed)).otherwise(empty)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    def weighed(total: Column, i: Column) -> Column:
        digit = F.substr(digits, i, F.lit(1)).cast("int")
        twice = digit * 2
        return total + F.when((F.length(digits) - i) % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), weighed) % 10 == 0


def _passes(kind: str, match: Column) -> Column:
    """The check of a base match."""
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    digits = _digits(match)
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(9, 15) if kind == "phone" else F.lit(True)


def base_spans(text: Column) -> Column:
    """Base spans as (start, kind number, end), sorted."""
    found = [
        F.transform(F.filter(located(text, BASE[kind], _HINT[kind]), lambda m: _passes(kind, m["match"])),
                    lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end")))
        for number, kind in enumerate(KINDS)
    ]
    return F.array_sort(F.concat(*found))


def _beside(char: Column) -> Column:
    """Class of a neighbouring character: none, white space, letter, digit, other."""
    return (F.when(F.coalesce(char, F.lit("")) == "", 0).when(char.rlike(r"^\s"), 1).when(char.rlike(r"^\p{L}"), 2)
            .when(char.rlike("^[0-9]"), 3).otherwise(4))


def _features(kind: str, m: Column) -> list[Column]:
    """Numbers below the limits in ``FEATURES``."""
    n = F.length(_digits(m["match"]))
    plain = F.regexp_replace(m["match"], r"[\[\]()]", "") if kind == "ip" else m["match"]
    check = F.lit(1) if kind == "email" else _passes(kind, plain).cast("int")
    digits = sum((n >= step).cast("int") for step in DIGIT_STEPS)
    bare = F.regexp_replace(F.ltrim(m["match"]), r"^\+", "")
    separators = sum(F.when(bare.contains(c), weight).otherwise(0) for c, weight in ((" ", 1), ("-", 2), ("(", 4)))
    groups = F.least(F.size(F.split(bare, "[^A-Za-z0-9]++", -1)), F.lit(FEATURES["groups"])) - 1
    context = F.lit(0)
    for i, pattern in enumerate(_CONTEXTS, 1):
        context = F.when(F.right(m["left"], F.lit(24)).rlike(pattern), i).otherwise(context)
    return [digits, separators, groups, _beside(F.right(m["left"], F.lit(1))), _beside(F.left(m["right"], F.lit(1))), context, check]


def candidates(text: Column) -> Column:
    """Candidate spans as (start, kind, end, f), where ``f`` holds the features."""
    return F.concat(*(
        F.transform(located(text, GENERATORS[kind], _GENERATOR_HINT[kind]), lambda m: F.struct(
            m["start"].alias("start"), F.lit(number).alias("kind"), m["end"].alias("end"),
            F.array(*(x.cast("int") for x in _features(kind, m))).alias("f")))
        for number, kind in enumerate(KINDS)))


# -- boosting over feature cells ------------------------------------------------------------

Cell = tuple[tuple[int, ...], float, float]  # features, positives, all


def _best_split(rows: list[tuple[tuple[int, ...], float, float]]):
    """(gain, feature, limit) of the best ``feature <= limit`` over (features, gradient, hessian)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None, None)
    for j in range(len(FEATURES)):
        sums: dict[int, list[float]] = {}
        for f, a, b in rows:
            entry = sums.setdefault(f[j], [0.0, 0.0])
            entry[0] += a
            entry[1] += b
        left_g = left_h = 0.0
        for value in sorted(sums)[:-1]:
            left_g += sums[value][0]
            left_h += sums[value][1]
            gain = left_g ** 2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g * g / (h + 1)
            if min(left_h, h - left_h) >= LEAST_HESSIAN and gain > best[0]:
                best = (gain, j, value)
    return best


def _grow(rows, depth: int):
    """A tree: a leaf value, or (feature, limit, tree at most, tree above)."""
    _, feature, limit = _best_split(rows) if depth else (0, None, None)
    if feature is None:
        return RATE * sum(r[1] for r in rows) / (sum(r[2] for r in rows) + 1)
    low = [r for r in rows if r[0][feature] <= limit]
    high = [r for r in rows if r[0][feature] > limit]
    return feature, limit, _grow(low, depth - 1), _grow(high, depth - 1)


def _value(tree, features: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        feature, limit, low, high = tree
        tree = low if features[feature] <= limit else high
    return tree


def fit_trees(cells: list[Cell], trees: int = TREES):
    """(start, trees): boosted log odds of a positive, by Newton steps on the logistic loss."""
    positives, whole = sum(c[1] for c in cells), sum(c[2] for c in cells)
    start = math.log((positives + 1) / (whole - positives + 1))
    scores, forest = [start] * len(cells), []
    for _ in range(trees):
        rows = []
        for (f, good, n), s in zip(cells, scores):
            p = 1 / (1 + math.exp(-s))
            rows.append((f, good - n * p, n * p * (1 - p)))
        tree = _grow(rows, 2)
        if not isinstance(tree, tuple):
            break
        forest.append(tree)
        scores = [max(-30.0, min(30.0, s + _value(tree, c[0]))) for s, c in zip(scores, cells)]
    return start, forest


def score(model, features: tuple[int, ...]) -> float:
    start, forest = model
    return start + sum(_value(tree, features) for tree in forest)


def threshold(model, cells: list[Cell], precision: float = PRECISION) -> float:
    """The lowest score from which on at least ``precision`` of the held-out candidates are positive."""
    best, good, whole = math.inf, 0.0, 0.0
    ranked = sorted(((score(model, f), p, n) for f, p, n in cells), reverse=True)
    for i, (s, p, n) in enumerate(ranked):
        good, whole = good + p, whole + n
        last = i + 1 == len(ranked) or ranked[i + 1][0] < s
        if last and good >= precision * whole and whole:
            best = s
    return best


def _tree_column(tree, f: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    feature, limit, low, high = tree
    return F.when(F.get(f, F.lit(feature)) <= limit, _tree_column(low, f)).otherwise(_tree_column(high, f))


def _fitted(rows: DataFrame) -> dict[int, tuple[tuple, float]]:
    """Model and threshold per kind, from ``candidates`` and ``base`` of all rows."""
    is_base = F.exists("base", lambda b: (b["start"] == F.col("c.start")) & (b["end"] == F.col("c.end")) & (b["kind"] == F.col("c.kind")))
    cells = (
        rows.select("held", "base", F.explode("candidates").alias("c"))
        .groupBy("held", F.col("c.kind").alias("kind"), F.col("c.f").alias("f"))
        .agg(F.sum(is_base.cast("int")).alias("good"), F.count(F.lit(1)).alias("n")).collect()  # at most CELLS per kind and part
    )
    models = {}
    for kind in range(len(KINDS)):
        parts = [sorted((tuple(r["f"]), float(r["good"]), float(r["n"])) for r in cells if r["kind"] == kind and r["held"] == held)
                 for held in (False, True)]
        if all(parts) and sum(c[1] for c in parts[0]):
            model = fit_trees(parts[0])
            limit = threshold(model, parts[1])
            if limit < math.inf:
                models[kind] = (model, limit)
    return models


def _meets(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _apart(chosen: Column) -> Column:
    """From the greatest candidate down, each one that meets none kept before."""
    return _let(F.reverse(F.array_sort(chosen)), lambda every: F.aggregate(
        every, F.slice(every, 1, 0), lambda kept, c: F.when(F.exists(kept, lambda o: _meets(o, c)), kept).otherwise(
            F.concat(kept, F.array(c)))))


def personal_data(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``base`` and ``spans`` per row: arrays of (start, kind, end), kinds numbered as ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = written(docs.select(F.col(id_col).alias("id"), held.alias("held"), base_spans(text).alias("base"),
                               candidates(text).alias("candidates")), "candidates")
    models = _fitted(rows)

    def rated(c: Column) -> Column:
        value = F.lit(None).cast("double")
        for kind, ((start, forest), limit) in models.items():
            total = F.lit(start)
            for tree in forest:
                total = total + _tree_column(tree, c["f"])
            value = F.when(c["kind"] == kind, F.when(total >= limit - 1e-9, total)).otherwise(value)
        return F.struct(value.alias("score"), (c["end"] - c["start"]).alias("length"), (-c["start"]).alias("early"),
                        (-c["kind"]).alias("first"), c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))

    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: _meets(b, c)))
    chosen = F.filter(F.transform(free, rated), lambda c: c["score"].isNotNull())
    added = F.transform(_apart(chosen), lambda c: F.struct(
        c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end")))
    return rows.select("id", "base", F.array_sort(F.array_distinct(F.concat("base", added))).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[redacted]") -> Column:
    """``text`` with every span replaced by a mark."""
    def cut(state: Column, s: Column) -> Column:
        kept = F.substr(text, state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        return F.struct(F.concat(state["done"], kept, F.when(s["end"] > state["at"], F.lit(mark)).otherwise("")).alias("done"),
                        F.greatest(state["at"], s["end"]).alias("at"))

    return F.aggregate(spans, F.struct(F.lit("").alias("done"), F.lit(0).alias("at")), cut,
                       lambda s: F.concat(s["done"], F.substr(text, s["at"] + 1, F.length(text))))
