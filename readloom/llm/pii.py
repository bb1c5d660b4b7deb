"""Personal data by candidate spans and gradient-boosted trees, in DataFrame expressions only.

Two families of patterns run over every text.  The base patterns with their
checks (octets, Luhn, digit counts) give spans that always stay.  Wider
generators propose further, overlapping candidates: spelled-out mail addresses,
spaced or bracketed octets, numbers of card length with other separators,
phone numbers without a plus sign.

Each candidate has a few small integer features of its format (digits, groups,
brackets, sign) and context (kinds of the characters around it).  There are no
labelled spans to learn from, so labels are weak: a candidate counts as positive
if by itself it is a base span, or passes its check and a word of its kind
(``WORDS``) stands shortly before it.  The words are no feature, so the trees learn which
formats such words announce and find them where no word does.  All candidates
of all texts are counted by feature combination in Spark, so what reaches the
driver is bounded by the number of combinations.  The boosted trees become
nested CASE expressions; their scores are calibrated to the share of positives
among candidates of like score, and a candidate is added where that share is
``LEAST`` or more.

Positions are code points, end exclusive.  A match list gives positions through
the stretches between its matches: both come from one pattern, so their
lengths add up.

Results: null and empty texts have no spans.  Rows that repeat, or share an id
(null too), are treated each.  An empty table gives an empty one.  Texts of any
length are searched whole.  Further columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from readloom.llm.shared import stored

KINDS = ("email", "ip", "card", "phone")
#: Share of positives among like candidates from which a candidate is added.
LEAST = 0.6
TREES, RATE, LEAVES = 30, 0.3, 4
#: Matches whose starts are summed up together.
CHUNK = 64

# Same matches as the plain patterns; look-behinds only keep long runs from being scanned again from every character.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Groups of any length repeat possessively, which takes no stack; a number's digits are bounded by its check alone.
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\.|\[\.\])\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+?\(?[0-9](?:[()\x20./-]{0,3}+[0-9]){7,}+",
}
#: Texts without these characters can't match, which is cheaper to see.
NEEDS = {"email": r"@|\bat\b|[\[(]at[\])]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
#: Words that announce a span of a kind, and characters ahead of it that are looked at (fixed values).
WORDS = {"email": r"mail|contact|reach|write to", "ip": r"\bip\b|host|server|addr", "card": r"card|visa|credit|debit|payment", "phone": r"phone|\btel\b|call|mobile|\bcell\b|\bfax\b|dial"}
AHEAD = 24
FEATURES = ("kind", "digits", "groups", "plus", "brackets", "before", "after", "size", "check")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _luhn(s: Column) -> Column:
    """Whether the digits of ``s`` pass the Luhn check."""
    d = F.reverse(_digits(s))
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.length(d), F.lit(1))), lambda i: F.when(i % 2 == 1, F.substring(d, i, F.lit(1)).cast("int")).otherwise(F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substring(d, i, F.lit(1)).cast("int") + 1)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, s: Column) -> Column:
    """The check of a base match; failing matches are dropped."""
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda x: x.cast("double") <= 255)
    if kind == "card":
        return F.length(_digits(s)).between(16, 19) & _luhn(s)
    if kind == "phone":
        return F.length(_digits(s)).between(8, 15)
    return F.lit(True)


def _plausible(kind: str, s: Column) -> Column:
    """The same checks, for candidates in other notations."""
    if kind == "ip":
        return F.forall(F.split(s, r"[^0-9]+"), lambda x: x.cast("int") <= 255)
    return _valid(kind, s)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _matches(text: Column, pattern: str, needs: str) -> Column:
    """Array of ``s, at, b, a``: match, start, and the text before (``AHEAD`` characters at most) and after it (one character).

    Starts are running sums, taken within chunks of ``CHUNK`` matches and over
    the chunks, so texts with very many matches stay cheap.
    """
    kind = "array<struct<s:string,at:int,b:string,a:string>>"
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("f"), F.split(text, pattern, -1).alias("g"))

    def steps(p: Column) -> Column:
        return F.transform(p["f"], lambda m, i: F.struct(m.alias("s"), F.length(F.get(p["g"], i)).alias("gap"), F.length(m).alias("size"), F.substring(F.get(p["g"], i), -AHEAD, AHEAD).alias("b"), F.substring(F.get(p["g"], i + 1), 1, 1).alias("a")))

    def chunked(st: Column) -> Column:
        last = F.greatest(F.ceil(F.size(st) / CHUNK) - 1, F.lit(0)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(st, c * CHUNK + 1, CHUNK))

    def bases(ch: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        sums = F.transform(ch, lambda part: F.aggregate(part, F.lit(0), lambda t, m: t + m["gap"] + m["size"]))
        return F.aggregate(sums, start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    def placed(part: Column, base: Column) -> Column:
        start = F.struct(base.alias("at"), F.array().cast(kind).alias("out"))
        one = lambda acc, m: F.array(F.struct(m["s"].alias("s"), (acc["at"] + m["gap"]).alias("at"), m["b"].alias("b"), m["a"].alias("a")))
        return F.aggregate(part, start, lambda acc, m: F.struct((acc["at"] + m["gap"] + m["size"]).alias("at"), F.concat(acc["out"], one(acc, m)).alias("out")), lambda acc: acc["out"])

    found = _let(_let(both, lambda p: _let(steps(p), chunked)), lambda ch: F.flatten(F.zip_with(ch, bases(ch), placed)))
    return F.when(text.rlike(needs), found).otherwise(F.array().cast(kind))


def _kind_of(c: Column) -> Column:
    """0 none or blank, 1 letter, 2 digit, 3 quote or equals sign, 4 other."""
    return F.when(c.isNull() | (c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).when(c.rlike("^[\"'=]"), 3).otherwise(4)


def _plain(kind: str, s: Column) -> Column:
    """Whether a candidate by itself is a base span."""
    return s.rlike(f"^(?:{BASE[kind]})$") & _valid(kind, s)


def _features(kind: int, m: Column) -> Column:
    s = m["s"]
    return F.struct(
        F.lit(kind).alias("kind"),
        F.least(F.length(_digits(s)), F.lit(20)).alias("digits"),
        F.least(F.length(F.regexp_replace(F.regexp_replace(s, "[0-9A-Za-z]+", "x"), "[^x]", "")), F.lit(6)).alias("groups"),
        F.when(F.substring(s, 1, 1) == "+", 1).otherwise(0).alias("plus"),
        F.when(s.rlike(r"[()\[\]]"), 1).otherwise(0).alias("brackets"),
        _kind_of(F.substring(m["b"], -1, 1)).alias("before"),
        _kind_of(m["a"]).alias("after"),
        F.least(F.floor(F.length(s) / 4).cast("int"), F.lit(12)).alias("size"),
        _plausible(KINDS[kind], s).cast("int").alias("check"),
        m["at"].alias("at"),
        (m["at"] + F.length(s)).alias("to"),
        (_plain(KINDS[kind], s) | (_plausible(KINDS[kind], s) & F.lower(m["b"]).rlike(WORDS[KINDS[kind]]))).cast("int").alias("y"),
    )


def _base_spans(i: int, kind: str, text: Column) -> Column:
    good = F.filter(_matches(text, BASE[kind], NEEDS[kind]), lambda m: _valid(kind, m["s"]))
    return F.transform(good, lambda m: F.struct(F.lit(i).alias("kind"), m["at"].alias("at"), (m["at"] + F.length(m["s"])).alias("to")))


def _wide_spans(i: int, kind: str, text: Column) -> Column:
    return F.transform(_matches(text, WIDE[kind], NEEDS[kind]), lambda m: _features(i, m))


def find_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per document: ``base`` (kind, at, to) and ``wide`` (features, at, to, its weak label)."""
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    for i, kind in enumerate(KINDS):
        out = out.withColumn(f"b_{kind}", _base_spans(i, kind, text))
    for i, kind in enumerate(KINDS):
        out = out.withColumn(f"w_{kind}", _wide_spans(i, kind, text))
    return out.select("doc_id", *(["text"] if with_text else []), F.concat(*(f"b_{k}" for k in KINDS)).alias("base"), F.concat(*(f"w_{k}" for k in KINDS)).alias("wide"))


def boost(rows: list[tuple[tuple[int, ...], int, int]]) -> list:
    """Gradient boosting with logistic loss over counted combinations ``(features, base spans, others)``.

    Returns trees as nested ``(feature, limit, low, high)`` with numbers as leaves.
    """
    total, pos = sum(p + n for _, p, n in rows), sum(p for _, p, _ in rows)
    if not rows or pos in (0, total):
        return [-4.0 if pos == 0 else 4.0]
    score = [math.log(pos / (total - pos))] * len(rows)
    trees: list = [score[0]]

    def grow(own: list[int], depth: int):
        g = sum(grad[i] for i in own)
        h = sum(hess[i] for i in own)
        best = (1e-6, None)
        if depth:
            for f in range(len(FEATURES)):
                sums: dict[int, list[float]] = {}
                for i in own:
                    s = sums.setdefault(rows[i][0][f], [0.0, 0.0])
                    s[0] += grad[i]
                    s[1] += hess[i]
                gl = hl = 0.0
                for v in sorted(sums)[:-1]:
                    gl, hl = gl + sums[v][0], hl + sums[v][1]
                    gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                    if gain > best[0]:
                        best = (gain, (f, v))
        if best[1] is None:
            return RATE * g / (h + 1)
        f, v = best[1]
        low, high = [i for i in own if rows[i][0][f] <= v], [i for i in own if rows[i][0][f] > v]
        return (f, v, grow(low, depth - 1), grow(high, depth - 1))

    for _ in range(TREES):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grad = [a - (a + b) * q for (_, a, b), q in zip(rows, p, strict=True)]
        hess = [(a + b) * q * (1 - q) for (_, a, b), q in zip(rows, p, strict=True)]
        tree = grow(list(range(len(rows))), int(math.log2(LEAVES)))
        trees.append(tree)
        score = [s + leaf(tree, r[0]) for s, r in zip(score, rows, strict=True)]
    return trees


def leaf(tree, x: tuple[int, ...]) -> float:
    while not isinstance(tree, float):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def tree_column(tree, m: Column) -> Column:
    """A tree as a CASE expression over a candidate's features."""
    if isinstance(tree, float):
        return F.lit(tree)
    f, v, low, high = tree
    return F.when(m[FEATURES[f]] <= v, tree_column(low, m)).otherwise(tree_column(high, m))


def calibrated_limit(rows: list[tuple[tuple[int, ...], int, int]], trees: list) -> dict[int, float]:
    """Per kind the least score from which the share of positives is ``LEAST`` or more (infinite if none)."""
    limits = {}
    for kind in range(len(KINDS)):
        scored = sorted(((sum(leaf(t, x) for t in trees), p, n) for x, p, n in rows if x[0] == kind), reverse=True)
        limit, pos, total, i = math.inf, 0, 0, 0
        while i < len(scored):
            j = i
            while j < len(scored) and scored[j][0] > scored[i][0] - 1e-9:
                pos, total, j = pos + scored[j][1], total + scored[j][1] + scored[j][2], j + 1
            own = sum(p for _, p, _ in scored[i:j]), sum(p + n for _, p, n in scored[i:j])
            if own[0] >= LEAST * own[1] and pos >= LEAST * total:
                limit = scored[i][0]
            i = j
        limits[kind] = limit
    return limits


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """Per document ``doc_id, base, spans``: arrays of ``kind, at, to`` (kind by number), sorted; and its ``text`` if asked for."""
    found = stored(find_candidates(docs, id_col, text_col, with_text), "pii-candidates")
    counted = found.select(F.explode("wide").alias("w")).groupBy(*(F.col(f"w.{f}").alias(f) for f in FEATURES)).agg(F.sum("w.y").alias("p"), F.count(F.lit(1)).alias("n")).collect()
    rows = sorted((tuple(r[f] for f in FEATURES), r["p"], r["n"] - r["p"]) for r in counted)
    trees = boost(rows)
    limits = calibrated_limit(rows, trees)

    def added(m: Column) -> Column:
        score = F.lit(0.0)
        for t in trees:
            score = score + tree_column(t, m)
        limit = F.element_at(F.array(*(F.lit(min(limits[k], 1e300)) for k in range(len(KINDS)))), m["kind"] + 1)
        return score > limit - 1e-6

    def span(m: Column) -> Column:
        return F.struct(m["kind"].alias("kind"), m["at"].alias("at"), m["to"].alias("to"))

    def code(m: Column) -> Column:  # a span as one number of the same order: kind, start, length
        return F.shiftleft(F.shiftleft(m["kind"].cast("long"), 30) + m["at"], 30) + (m["to"] - m["at"])

    def decoded(c: Column) -> Column:
        at = F.shiftright(c, 30).bitwiseAND(F.lit((1 << 30) - 1)).cast("int")
        return F.struct(F.shiftright(c, 60).cast("int").alias("kind"), at.alias("at"), (at + c.bitwiseAND(F.lit((1 << 30) - 1)).cast("int")).alias("to"))

    more = F.transform(F.filter("wide", added), span)
    return found.select("doc_id", *(["text"] if with_text else []), F.array_sort("base").alias("base"), F.transform(F.array_sort(F.array_distinct(F.transform(F.concat("base", more), code))), decoded).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["at"].cast("string"), s["to"].cast("string"))), ",")


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` of every row with every span (overlapping ones merged) replaced by ``[kind]``."""
    found = personal_data(docs, id_col, text_col, with_text=True)
    names = F.array(*map(F.lit, KINDS))
    by_start = F.array_sort("spans", lambda a, b: F.when(a["at"] < b["at"], -1).when(a["at"] > b["at"], 1).when(a["to"] > b["to"], -1).when(a["to"] < b["to"], 1).otherwise(0))
    step = lambda acc, s: F.when(s["at"] < acc["to"], F.struct(F.greatest(acc["to"], s["to"]).alias("to"), acc["out"].alias("out"))).otherwise(F.struct(s["to"].alias("to"), F.concat(acc["out"], F.substring(F.col("text"), acc["to"] + 1, s["at"] - acc["to"]), F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]")).alias("out")))
    text = F.aggregate(by_start, F.struct(F.lit(0).alias("to"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["to"] + 1, F.length("text"))))
    return found.select("doc_id", text.alias("text"))


def pii_digest(docs: DataFrame) -> DataFrame:
    """The digest columns of the registered query."""
    found = personal_data(docs)
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long")
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
