"""Personal data by candidate gradient boosting, with built-in functions alone.

The base rules give emails, IP addresses, card and phone numbers. High-recall generators propose further spans, which
may overlap the base ones and each other: every run of digits with signs between them, under each kind that its number
of digits allows, and addresses with or without their sign. Boosted trees over format and context features score
them. The trees never see what the base rules decide by (the plus before a phone number, the check digit of a card,
the size of an address' parts, the at sign), so that a number which looks and stands like the accepted ones can be
told from others. Good examples are the base spans; bad ones are what can't be data of that kind (``_clearly_not``);
all other candidates are left out of training, and only they can be added. Half of all examples train the trees, the
other half set a threshold for each kind at a precision of ``PRECISION``; examples with the same features are one row
with their number as its weight. Accepted candidates are added where no base span lies. The trees are written out as
one SQL expression, so scoring is a projection.

Null texts count as empty. Null or repeated ``doc_id``: each row is answered by itself. Other columns are ignored;
an empty table gives no rows. With too few examples of either class no span is added.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolcat.llm.common import materialize, text_or_empty

KINDS = ("email", "ip", "card", "phone")
#: Least examples of each label in each half, and the precision that the threshold keeps.
LEAST, PRECISION = 50, 0.98
TREES, DEPTH = 10, 3

# The same leftmost matches as the plain patterns: a match can only start where a run does, or where the last one
# ended (\G), and no part of it can be given back, so long runs cost no more than their length.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
NUMBER = r"[0-9](?:[ ().\-]{0,2}+[0-9])++"
SPELLED = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++ ?[(\[] ?(?:at|AT) ?[)\]] ?[A-Za-z0-9-]++"
    r"(?: ?(?:[(\[] ?(?:dot|DOT) ?[)\]]|\.) ?[A-Za-z0-9-]++)++"
)
SPELLED_AT = r" ?[(\[] ?(?:at|AT|dot|DOT) ?[)\]] ?"
#: Characters before a candidate that count as its context.
CONTEXT = 24
_BEFORE = {
    "phone": r"(?i)(tel|phone|call|fax|mobil|contact|dial|ring)", "card": r"(?i)(card|visa|master|credit|debit|pay)",
    "ip": r"(?i)(addr|\bip\b|host|server)", "email": r"(?i)(mail|contact|write|address)",
}
#: A group of so many digits without a sign in it isn't part of a phone number.
LONG_GROUP = 8


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def running_sums(numbers: Column) -> Column:
    """The sums of an array's first 1, 2, ... items; in blocks, so that long arrays don't cost their square."""
    size = 64

    def part(a: Column, start: Column, n: Column) -> Column:
        return F.aggregate(F.slice(a, start + 1, n), F.lit(0), lambda s, x: s + x)

    def within(a: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(a) - 1) / size).cast("int"))
        totals = F.transform(blocks, lambda b: part(a, b * size, F.lit(size)))
        before = F.aggregate(
            totals, F.array(F.lit(0)), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x))
        )
        return let(before, lambda p: F.transform(
            F.sequence(F.lit(0), F.size(a) - 1),
            lambda i: F.get(p, F.floor(i / size).cast("int")) + part(a, i - i % size, i % size + 1),
        ))

    return F.when(F.size(numbers) == 0, F.array().cast("array<int>")).otherwise(let(numbers, within))


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<start, stop, value>>`` of the leftmost matches, in code points."""

    def place(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        steps = F.transform(found, lambda m, i: F.length(F.get(found, i - 1)))  # null before the first
        starts = running_sums(F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(found)).alias("g"), steps.alias("m")),
                                          lambda x: x["g"] + F.coalesce(x["m"], F.lit(0))))
        return F.zip_with(
            starts, found, lambda s, m: F.struct(s.alias("start"), (s + F.length(m)).alias("stop"), m.alias("value"))
        )

    empty = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda f: F.when(F.size(f) == 0, empty).otherwise(place(f)))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the check that card numbers hold."""

    def weigh(d: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i, 1).cast("int")
        return F.when(i % 2 == 0, x).otherwise(2 * x - F.when(x > 4, 9).otherwise(0))

    def total(d: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.length(d) - 1), F.lit(0), lambda s, i: s + weigh(d, i))

    return let(digits(value), lambda d: F.when(F.length(d) == 0, False).otherwise(total(d) % 10 == 0))


def base_spans(text: Column) -> dict[str, Column]:
    """By kind: the accepted matches of the base rules."""
    byte = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
    count = lambda m: F.length(digits(m["value"]))
    return {
        "email": matches(text, EMAIL),
        "ip": F.filter(matches(text, IP), lambda m: F.forall(F.split(m["value"], r"\."), lambda p: p.rlike(byte))),
        "card": F.filter(matches(text, CARD), lambda m: count(m).between(14, 19) & luhn(m["value"])),
        "phone": F.filter(matches(text, PHONE), lambda m: count(m).between(10, 15)),
    }


FEATURES = (
    "kind_rank", "length", "digits", "groups", "longest", "first", "last", "spaces", "dots", "dashes", "brackets", "letters",
    "word_before", "word_after", "hint", "zero",
)


def _clearly_not(kind: str, v: Column, groups: Column, joined: Column) -> Column:
    """Whether a candidate can't be data of its kind, by rules that aren't about looks: phone numbers don't run on in a
    word, hold no long run of digits and are no date; a card number of full length has a check digit; parts of an IP
    address are at most 255; an address ends in letters."""
    d = digits(v)
    byte = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
    return {
        "phone": joined | (F.array_max(F.transform(groups, F.length)) >= LONG_GROUP) | v.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\b"),
        "card": joined | (F.length(d).between(14, 19) & ~luhn(v)),
        "ip": joined | ~F.forall(groups, lambda g: g.rlike(byte)),
        "email": ~v.rlike(r"[A-Za-z]{2,12}$"),
    }[kind]


def _candidate(m: Column, text: Column, kind: str) -> Column:
    """A candidate's place, kind and features."""
    v = m["value"]
    before = F.substring(text, F.greatest(F.lit(1), m["start"] + 1 - CONTEXT), F.least(F.lit(CONTEXT), m["start"]))
    count = lambda chars: F.length(v) - F.length(F.translate(v, chars, ""))
    groups = F.filter(F.split(v, "[^0-9]+"), lambda g: g != "")
    d = digits(v)
    word_before = F.substring(text, m["start"], F.when(m["start"] > 0, 1).otherwise(0)).rlike("[A-Za-z_]")
    word_after = F.substring(text, m["stop"] + 1, 1).rlike("[A-Za-z_]")
    size = lambda i: F.coalesce(F.length(F.try_element_at(groups, F.lit(i))), F.lit(0))
    values = {
        "kind_rank": F.lit(KINDS.index(kind)), "length": F.length(v), "digits": F.length(d), "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), "first": size(1), "last": size(-1),
        "spaces": count(" "), "dots": count("."), "dashes": count("-"), "brackets": count("()"),
        "letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")), "word_before": word_before, "word_after": word_after,
        "hint": before.rlike(_BEFORE[kind]), "zero": F.substring(d, 1, 1) == "0",
    }
    if kind == "email":  # an address with its sign and one that is spelled out have the same features
        plain = F.regexp_replace(F.regexp_replace(v, SPELLED_AT, ""), "@", "")
        values |= {"length": F.length(plain), "spaces": F.lit(0), "brackets": F.lit(0), "letters": F.length(F.regexp_replace(plain, "[^A-Za-z]", "")),
                   "dots": F.size(F.split(v, r"\.|[(\[] ?(?:dot|DOT) ?[)\]]")) - 1, "word_before": F.lit(False), "word_after": F.lit(False)}
    assert tuple(values) == FEATURES
    return F.struct(
        m["start"].alias("start"), m["stop"].alias("stop"), F.lit(kind).alias("kind"), F.xxhash64(before, v).alias("key"),
        F.coalesce(_clearly_not(kind, v, groups, word_before | word_after), F.lit(True)).alias("no"),
        *(F.coalesce(c.cast("double"), F.lit(0.0)).alias(n) for n, c in values.items()),
    )


def candidates(text: Column) -> Column:
    """High-recall proposals with features; a span may be proposed under several kinds."""
    quad = r"^[0-9]+(?:\.[0-9]+){3}$"

    def of_kind(kind: str) -> Callable[[Column], Column]:
        return lambda m: _candidate(m, text, kind)

    def of_runs(runs: Column) -> Column:
        n = lambda m: F.length(digits(m["value"]))
        by_kind = {
            "phone": F.filter(runs, lambda m: n(m).between(7, 15) & ~m["value"].rlike(quad)),
            "card": F.filter(runs, lambda m: n(m).between(13, 19)), "ip": F.filter(runs, lambda m: m["value"].rlike(quad)),
        }
        return F.concat(*(F.transform(found, of_kind(k)) for k, found in by_kind.items()))

    addresses = F.concat(matches(text, EMAIL), matches(text, SPELLED))
    return F.concat(let(matches(text, NUMBER), of_runs), F.transform(addresses, of_kind("email")))


def _tree(node, value: Callable[[str], Column]) -> Column:
    """A regression tree of the trained model as nested CASE expressions."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    test = value(FEATURES[split.featureIndex()]) <= F.lit(float(split.threshold()))
    return F.when(test, _tree(node.leftChild(), value)).otherwise(_tree(node.rightChild(), value))


def train(proposed: DataFrame) -> Callable[[Column], Column] | None:
    """The accepting condition over a candidate, or None where there are too few examples. ``proposed``: one row
    per candidate, its features and ``label``; null labels are left out."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    half = F.pmod(F.xxhash64("key", "start"), F.lit(1_000_003)) % 2
    known = proposed.filter(F.col("label").isNotNull()).withColumn("half", half)
    known = materialize(known.groupBy(*FEATURES, "label", "half").agg(F.count("*").cast("double").alias("weight")), "candidates")
    counts = known.groupBy("half", "label").agg(F.sum("weight").alias("n"), F.count("*").alias("rows")).collect()
    sizes = {(r["half"], r["label"]): r["n"] for r in counts}
    if min(sizes.get((h, x), 0) for h in (0, 1) for x in (0.0, 1.0)) < LEAST:
        return None
    bins = max(32, math.isqrt(sum(r["rows"] for r in counts)) + 1)  # MLlib takes splits from a sample beyond bins ** 2 rows
    packed = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(known.filter("half = 0"))
    model = GBTClassifier(labelCol="label", weightCol="weight", maxBins=bins, maxIter=TREES, maxDepth=DEPTH, seed=42).fit(packed)
    trees = [(t._java_obj.rootNode(), w) for t, w in zip(model.trees, model.treeWeights, strict=True)]

    def margin(value: Callable[[str], Column]) -> Column:
        out = F.lit(0.0)
        for root, weight in trees:
            out = out + _tree(root, value) * F.lit(float(weight))
        return out

    held = known.filter("half = 1").select("kind_rank", F.round(margin(F.col), 2).alias("m"), "label", "weight")
    steps = held.groupBy("kind_rank", "m").agg(F.sum(F.col("label") * F.col("weight")).alias("good"), F.sum("weight").alias("n")).orderBy(F.desc("m")).collect()
    thresholds: dict[float, float] = {}
    sums: dict[float, list[float]] = {}
    for r in steps:  # at most one step for each kind and hundredth of the margin
        good_n = sums.setdefault(r["kind_rank"], [0.0, 0.0])
        good_n[0], good_n[1] = good_n[0] + r["good"], good_n[1] + r["n"]
        if r["good"] and good_n[0] >= PRECISION * good_n[1]:
            thresholds[r["kind_rank"]] = r["m"]
    if not thresholds:
        return None

    def accept(c: Column) -> Column:
        least = F.lit(None).cast("double")
        for rank, m in thresholds.items():
            least = F.when(c["kind_rank"] == rank, F.lit(float(m))).otherwise(least)
        return F.coalesce(~c["no"] & (F.round(margin(lambda name: c[name]), 2) >= least), F.lit(False))

    return accept


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def _spans(text: Column) -> list[Column]:
    def ranked(found: Column, rank: int, kind: str) -> Column:
        return F.transform(found, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["stop"].alias("stop"), F.lit(kind).alias("kind")))

    base = base_spans(text)
    sorted_base = F.array_sort(F.concat(*(ranked(base[k], r, k) for r, k in enumerate(KINDS))))
    return [sorted_base.alias("base"), candidates(text).alias("proposed")]


def find_spans(docs: DataFrame, keep: list[Column] | None = None) -> DataFrame:
    """The ``keep`` columns with ``base`` and ``added``, arrays of ``start, rank, stop, kind``."""
    keep = [F.col("doc_id")] if keep is None else keep
    text = text_or_empty()
    rows = docs.select(*keep, text.alias("_text"))
    some = F.col("_text").rlike("[@0-9]|[(\\[] ?(?:at|AT)")
    found = rows.withColumn("_has", some).withColumn(
        "_found",
        F.when(F.col("_has"), let(F.col("_text"), lambda t: F.struct(*_spans(t)))),
    )
    names = [c for c in rows.columns if c != "_text"]
    found = materialize(found.select(*names, "_found.base", "_found.proposed"), "pii")

    def overlaps(c: Column, base: Column) -> Column:
        return F.exists(base, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"]))

    one = found.select(F.explode("proposed").alias("c"), "base")
    # A candidate is a good example if a base span of its kind is that text, but for a sign before it.
    near = lambda b: (b["stop"] == F.col("c.stop")) & (F.col("c.start") - b["start"]).between(0, 2)
    same = F.exists("base", lambda b: (b["kind"] == F.col("c.kind")) & near(b))
    other = F.exists("base", lambda b: (b["kind"] != F.col("c.kind")) & near(b))
    label = F.when(same, 1.0).when(F.col("c.no") | other, 0.0)
    accept = train(one.select("c.*", label.alias("label")).select("key", "start", *FEATURES, "label"))
    ranks = F.create_map(*(F.lit(x) for r, k in enumerate(KINDS) for x in (k, r)))
    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    base = F.coalesce("base", none)
    added = none
    if accept is not None:
        chosen = F.filter("proposed", lambda c: accept(c) & ~overlaps(c, F.col("base")))
        added = F.coalesce(F.transform(chosen, lambda c: F.struct(
            c["start"].alias("start"), F.element_at(ranks, c["kind"]).alias("rank"), c["stop"].alias("stop"), c["kind"].alias("kind"))), none)
    return found.select(*names, base.alias("base"), added.alias("added"))


def pii(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans``."""
    found = find_spans(docs)

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = map(count, KINDS)
    return found.select(
        "doc_id", *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in angle brackets; overlapping spans become one."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    found = find_spans(docs, [F.struct(*columns).alias("_row")])
    text = F.coalesce(F.col("_row.text").cast("string"), F.lit(""))
    spans = F.array_sort(F.concat("base", "added"))

    def merge(done: Column, s: Column) -> Column:  # done: spans so far, the last of which may grow
        last = F.element_at(done, -1)
        grown = F.struct(last["start"].alias("start"), last["rank"].alias("rank"), F.greatest(last["stop"], s["stop"]).alias("stop"), last["kind"].alias("kind"))
        apart = (F.size(done) == 0) | (s["start"] >= F.get(done, F.size(done) - 1)["stop"])
        return F.when(apart, F.concat(done, F.array(s))).otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), F.array(grown)))

    def rebuild(m: Column) -> Column:
        parts = F.transform(m, lambda s, i: F.concat(
            F.substring(text, F.coalesce(F.get(m, i - 1)["stop"], F.lit(0)) + 1, s["start"] - F.coalesce(F.get(m, i - 1)["stop"], F.lit(0))),
            F.lit("<"), s["kind"], F.lit(">"),
        ))
        return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(m, -1)["stop"] + 1, F.length(text)))

    none = F.array().cast("array<struct<start:int,rank:int,stop:int,kind:string>>")
    merged = F.aggregate(spans, none, lambda d, s: F.when(F.size(d) == 0, F.array(s)).otherwise(merge(d, s)))
    new = let(merged, lambda m: F.when(F.size(m) == 0, text).otherwise(rebuild(m)))
    return found.select(*(new.alias("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns))
