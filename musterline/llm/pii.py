"""Personal data: overlapping span candidates judged by boosted trees.

Strict patterns with their checks give the base spans, which always stay. Loose generators propose many more, overlapping
ones. Shallow boosted trees over format and context judge each candidate; they are grown from histograms that Spark sums over
a bounded sample of candidates of each kind, with the checked spans as labels. A threshold for each kind, set so that enough of
the candidates of all documents above it are checked, selects what is redacted besides.

Only DataFrame and SQL functions are used; what reaches the driver are histograms of bounded size.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, forget, fresh, stored

KINDS = ("email", "ip", "card", "phone")

#: Strict patterns. Possessive quantifiers and lookbehinds change no match; they only keep the search linear.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a strict pattern to be tried at all.
NEEDS = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    "phone": lambda t: t.rlike(r"\+[0-9]"),
}
#: Loose generators and the kinds each proposes a span for.
LOOSE = {
    "address": (r"(?:\G|(?<![^\s@]))[^\s@]++@[^\s@]++", ("email",), NEEDS["email"]),
    "dotted": (r"(?<![0-9.:])[0-9]{1,4}+(?:[.:][0-9]{1,4}+){3,7}+", ("ip",), NEEDS["ip"]),
    "number": (r"\+?[0-9][ ().0-9-]{5,40}[0-9]", ("card", "phone"), lambda t: t.rlike(r"[0-9][ ().0-9-]{5}")),
}
WORDS = r"(?i)(mail|phone|tel|call|fax|card|visa|host|server|address|contact|account|kontakt|tarjeta|carte)"

FEATURES = (
    "kind", "length", "digits", "letters", "dots", "blanks", "hyphens", "brackets", "colons", "plus", "at_length",
    "last_part", "before", "after", "context", "lead",
)
TOP = 63


def spans_in(rows: DataFrame, pattern: str, needs, into: str, text: str) -> DataFrame:
    """``rows`` with the leftmost non-overlapping matches in ``into``: start, end, m, 24 characters before, one after."""
    when = needs(F.col(text))
    hits, gaps = fresh(rows, "hits"), fresh(rows, "gaps")
    begins = fresh(rows, "begins")
    # Columns of their own: inside a lambda they would be searched again for every match.
    out = rows.withColumns(
        {
            hits: F.when(when, F.regexp_extract_all(F.col(text), F.lit(pattern), 0)),
            gaps: F.when(when, F.split(F.col(text), pattern, -1)),
        }
    )
    numbered = F.transform(F.col(hits), lambda m, i: F.struct(F.length(m).alias("n"), F.length(F.get(F.col(gaps), i)).alias("gap")))
    out = out.withColumn(begins, numbered)
    # Sums run within blocks of about the square root of the number, then over blocks: an array that grows by one is copied.
    sums = fresh(rows, "sums")
    block = F.ceil(F.sqrt(F.size(begins))).cast("int")
    blocks = F.sequence(F.lit(0), F.ceil(F.size(begins) / block).cast("int") - 1)
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
    within = F.transform(
        blocks,
        lambda i: F.aggregate(
            F.slice(F.col(begins), i * block + 1, block),
            zero,
            lambda acc, x: F.struct((acc["at"] + x.gap + x.n).alias("at"), F.array_append(acc.out, acc["at"] + x.gap).alias("out")),
        ),
    )
    out = out.withColumn(sums, F.when(F.size(begins) > 0, within))
    over = F.aggregate(
        F.col(sums),
        zero,
        lambda acc, x: F.struct((acc["at"] + x["at"]).alias("at"), F.array_append(acc.out, acc["at"]).alias("out")),
        lambda acc: acc.out,
    )
    spots = F.flatten(F.zip_with(F.col(sums), over, lambda x, offset: F.transform(x.out, lambda at: at + offset)))
    out = out.withColumn(begins, spots)
    found = F.transform(
        F.col(hits),
        lambda m, i: F.struct(
            F.get(F.col(begins), i).alias("start"),
            (F.get(F.col(begins), i) + F.length(m)).alias("end"),
            m.alias("m"),
            F.right(F.get(F.col(gaps), i), F.lit(24)).alias("before"),
            F.left(F.get(F.col(gaps), i + 1), F.lit(1)).alias("after"),
        ),
    )
    empty = F.array().cast("array<struct<start:int,end:int,m:string,before:string,after:string>>")
    return out.withColumn(into, F.coalesce(found, empty)).drop(hits, gaps, begins, sums)


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(m: Column) -> Column:
    """Whether 13 to 19 digits pass the check sum."""
    back = F.reverse(digits_of(m))

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(back, i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    size = F.length(digits_of(m))
    total = F.aggregate(F.sequence(F.lit(1), F.least(size, F.lit(19))), F.lit(0), add)
    return F.when(size.between(13, 19), total % 10 == 0).otherwise(False)


def small_parts(m: Column) -> Column:
    """Whether all four parts are at most 255, leading zeros aside."""
    part = lambda p: F.ltrim(p, F.lit("0"))
    return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.concat(F.lit("0"), F.right(part(p), F.lit(3))).cast("int") <= 255))


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": small_parts,
    "card": luhn,
    "phone": lambda m: F.length(digits_of(m)).between(9, 15),
}


def passes(kind: str):
    return lambda s: CHECKS[kind](s.m)


def placed(kind: int):
    return lambda s: F.struct(F.lit(kind).alias("kind"), s.start.alias("start"), s.end.alias("end"))


def with_base(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` with the checked spans of all kinds in ``into``: structs of kind (its place in KINDS), start, end."""
    out, parts = docs, []
    for i, kind in enumerate(KINDS):
        name = fresh(docs, f"base_{kind}")
        out = spans_in(out, BASE[kind], NEEDS[kind], name, text)
        parts.append(F.transform(F.filter(F.col(name), passes(kind)), placed(i)))
    return out.withColumn(into, F.concat(*parts)).drop(*[fresh(docs, f"base_{k}") for k in KINDS])


def side(c: Column) -> Column:
    """0 nothing or white space, 1 letter, 2 digit, 3 any other character."""
    return (
        F.when(F.coalesce(F.trim(c), F.lit("")).rlike(r"^\s*$"), 0)
        .when(c.rlike(r"^\p{L}"), 1)
        .when(c.rlike(r"^[0-9]"), 2)
        .otherwise(3)
    )


def described(kind: int):
    """Turns a match into a candidate with its features, all small whole numbers."""
    return lambda s: features(s, kind)


def features(s: Column, kind: int) -> Column:
    count = lambda chars: F.length(s.m) - F.length(F.translate(s.m, chars, ""))
    values = {
        "kind": F.lit(kind),
        "length": F.length(s.m),
        "digits": count("0123456789"),
        "letters": F.length(s.m) - F.length(F.regexp_replace(s.m, r"\p{L}", "")),
        "dots": count("."),
        "blanks": count(" "),
        "hyphens": count("-"),
        "brackets": count("()"),
        "colons": count(":"),
        "plus": count("+"),
        "at_length": F.locate("@", s.m),
        "last_part": F.length(F.regexp_extract(s.m, r"([0-9\p{L}]*)$", 1)),
        "before": side(F.right(s.before, F.lit(1))),
        "after": side(s.after),
        "context": s.before.rlike(WORDS).cast("int"),
        "lead": F.length(F.regexp_extract(s.m, r"^\+?([0-9]*)", 1)),
    }
    numbers = [F.least(F.coalesce(values[n], F.lit(0)), F.lit(TOP)).cast("int").alias(n) for n in FEATURES]
    return F.struct(*numbers, s.start.alias("start"), s.end.alias("end"))


def with_candidates(docs: DataFrame, base: str, into: str, text: str = "text") -> DataFrame:
    """``docs`` with all loose candidates in ``into``: features, start, end, and ``y``, whether a checked span of the
    kind overlaps it."""
    out, parts = docs, []
    for name, (pattern, kinds, needs) in LOOSE.items():
        column = fresh(docs, f"loose_{name}")
        out = spans_in(out, pattern, needs, column, text)
        parts += [F.transform(F.col(column), described(KINDS.index(kind))) for kind in kinds]
    out = out.withColumn(into, F.concat(*parts)).drop(*[fresh(docs, f"loose_{n}") for n in LOOSE])
    judged = F.transform(
        F.col(into),
        lambda c: c.withField(
            "y",
            F.exists(F.col(base), lambda b: (b.kind == c.kind) & (b.start < c.end) & (c.start < b.end)).cast("int"),
        ),
    )
    return out.withColumn(into, judged)


@dataclass
class Trees:
    """Boosted trees as nested (feature, cut, left, right) with numbers as leaves, and a threshold per kind."""

    start: float
    trees: list = field(default_factory=list)
    thresholds: dict[int, float] = field(default_factory=dict)

    def margin(self, c) -> Column:
        """Sum of the trees; ``c`` maps a feature's name to its column."""

        def walk(tree) -> Column:
            if isinstance(tree, float):
                return F.lit(tree)
            name, cut, left, right = tree
            return F.when(c(name) <= cut, walk(left)).otherwise(walk(right))

        return reduce(lambda a, b: a + b, map(walk, self.trees), F.lit(self.start))

    def score(self, c) -> Column:
        return 1 / (1 + F.exp(-self.margin(c)))


def best_cut(hist: dict[str, dict[int, tuple[float, float]]], ridge: float) -> tuple[float, str, int] | None:
    """Largest gain among all features' cuts, from sums of gradients and weights per value."""
    best = None
    for name in sorted(hist):
        values = sorted(hist[name])
        all_g, all_h = (sum(hist[name][v][k] for v in values) for k in (0, 1))
        g = h = 0.0
        for v in values[:-1]:
            g, h = g + hist[name][v][0], h + hist[name][v][1]
            gain = g * g / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            if gain > 1e-3 and min(h, all_h - h) > 0.5 and (best is None or gain > best[0]):
                best = (gain, name, v)
    return best


def grow(sample: DataFrame, rounds: int = 8, depth: int = 3, rate: float = 0.5, ridge: float = 1.0) -> Trees:
    """Boosted trees over the columns FEATURES and ``y`` of a stored sample; Spark sums one histogram for each level."""
    n, ones = sample.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not 0 < ones < n:
        return Trees(start=log((ones + 0.5) / (n - ones + 0.5)))
    model = Trees(start=log(ones / (n - ones)))
    for _ in range(rounds):
        p = model.score(F.col)
        graded = sample.select(*FEATURES, (p - F.col("y")).alias("g"), (p * (1 - p)).alias("h"))
        cuts: dict[int, tuple[str, int]] = {}
        sums: dict[int, tuple[float, float]] = {}
        for level in range(depth):
            node = F.lit(1)
            for _ in range(level):
                moved = node
                for at, (name, cut) in cuts.items():
                    moved = F.when(node == at, 2 * node + (F.col(name) > cut).cast("int")).otherwise(moved)
                node = moved
            stacked = F.explode(
                F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("v")) for f in FEATURES])
            ).alias("s")
            rows = graded.select(node.alias("node"), "g", "h", stacked).groupBy("node", "s.f", "s.v")
            hists: dict[int, dict] = defaultdict(lambda: defaultdict(dict))
            for r in rows.agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
                hists[r.node][r.f][r.v] = (r.g, r.h)
            for at, hist in hists.items():
                if at < 2**level:
                    continue
                sums[at] = tuple(sum(v[k] for v in hist["kind"].values()) for k in (0, 1))
                if cut := best_cut(hist, ridge):
                    cuts[at] = cut[1:]
                    name, value = cut[1:]
                    for child, inside in ((2 * at, lambda v, c=value: v <= c), (2 * at + 1, lambda v, c=value: v > c)):
                        sums[child] = tuple(sum(x[k] for v, x in hist[name].items() if inside(v)) for k in (0, 1))

        def build(at: int):
            if at in cuts:
                return (*cuts[at], build(2 * at), build(2 * at + 1))
            g, h = sums.get(at, (0.0, 0.0))
            return float(-rate * g / (h + ridge))

        model.trees.append(build(1))
        if not cuts:
            break
    return model


def calibrate(model: Trees, apart: DataFrame, precision: float, least: int = 20) -> None:
    """Per kind the lowest score, in hundredths, above which ``precision`` of the held-out candidates are checked ones.

    Spark counts the candidates of each kind and score; fewer than ``least`` of a kind give it no threshold.
    """
    step = F.floor(model.score(F.col) * 100).cast("int").alias("step")
    counted = apart.select("kind", "y", step).groupBy("kind", "step").agg(F.count("*").alias("n"), F.sum("y").alias("y"))
    by_kind: dict[int, list] = defaultdict(list)
    for r in counted.collect():
        by_kind[r.kind].append((r.step, r.n, r.y))
    for kind, steps in by_kind.items():
        n = y = 0
        for at, more, good in sorted(steps, reverse=True):
            n, y = n + more, y + good
            if n >= least and y >= precision * n:
                model.thresholds[kind] = at / 100


def candidates_of(docs: DataFrame, some: DataFrame) -> DataFrame:
    """All candidates of ``docs``: their fields, ``order`` (a hash of document, place and kind) and ``known``, whether the
    document is one of ``some``, a few ids that may be sent to every task."""
    some = some.select("doc_id", F.lit(True).alias("known"))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "doc_id", "left")
    found = with_candidates(with_base(texts, "base"), "base", "found")
    # Outer: for a plain explode Spark adds the filter "has candidates", below the join, where it would search every text.
    rows = found.select("doc_id", "known", F.explode_outer("found").alias("c")).where("c is not null")
    return rows.select("c.*", F.xxhash64("doc_id", "c.start", "c.kind").alias("order"), F.coalesce("known", F.lit(False)).alias("known"))


def fit(docs: DataFrame, sample: int = 20_000, documents: int = 5_000, precision: float = 0.97) -> Trees:
    """Trees from at most ``sample`` candidates of at most ``documents`` documents, as many of each kind, chosen by hashes;
    thresholds from all other candidates of all documents.

    The bounds concern only what the trees are grown from. A quarter of the candidates of these documents never grows them.
    """
    some = docs.select("doc_id").where("doc_id is not null").distinct()
    some = stored(bounded_sample(some, documents, "doc_id").select("doc_id"), "pii")
    apart = F.pmod(F.col("order"), F.lit(4)) == 0
    met = docs.join(F.broadcast(some), "doc_id", "left_semi")
    usable = stored(candidates_of(met, some).where(~apart), "pii")
    share = sample // len(KINDS)
    kept = [usable.where(F.col("kind") == k).orderBy("order", *FEATURES).limit(share) for k in range(len(KINDS))]
    grown = stored(reduce(DataFrame.unionByName, kept), "pii")
    model = grow(grown)
    last = {r.kind: r.last for r in grown.groupBy("kind").agg(F.max("order").alias("last")).collect()}
    used = reduce(lambda a, b: a | b, [(F.col("kind") == k) & (F.col("order") <= at) for k, at in last.items()], F.lit(False))
    calibrate(model, candidates_of(docs, some).where(~(F.col("known") & ~apart & used)), precision)
    forget(some, usable, grown)
    return model


def find(docs: DataFrame, model: Trees, into: str = "spans") -> DataFrame:
    """``docs`` with all spans of each whole text in ``into``: structs (kind, start, end, base), by kind and start.

    Checked spans are always among them; candidates are added where no checked span overlaps them and their score
    reaches the threshold of their kind. Null texts count as empty; rows and other columns are kept; an existing column of that name
    is replaced.
    """
    text, base, loose = (fresh(docs, n) for n in ("pii_text", "pii_base", "pii_loose"))
    out = docs.withColumn(text, F.coalesce("text", F.lit("")))
    out = with_base(out, base, text)
    checked = F.transform(F.col(base), lambda b: F.struct(*[b[n].alias(n) for n in ("kind", "start", "end")], F.lit(True).alias("base")))
    if model.thresholds:
        out = with_candidates(out, base, loose, text)

        def chosen(c: Column) -> Column:
            over = reduce(
                lambda a, b: a | b, [(c.kind == k) & (model.score(lambda n: c[n]) >= t) for k, t in model.thresholds.items()]
            )
            return ~F.exists(F.col(base), lambda b: (b.start < c.end) & (c.start < b.end)) & over

        added = F.transform(
            F.filter(F.col(loose), chosen),
            lambda c: F.struct(*[c[n].alias(n) for n in ("kind", "start", "end")], F.lit(False).alias("base")),
        )
        checked = F.concat(checked, added)
    return out.withColumn(into, F.array_sort(checked)).drop(text, base, loose)


def is_kind(kind: int):
    return lambda s: s.kind == kind


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    each = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string")))
    return F.array_join(each, ",")


def redact(docs: DataFrame, model: Trees) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets, and ``n_chars`` counted anew if there is such a column.

    Overlapping spans become one, named after the first. Texts without spans, null ones too, stay as they are.
    """
    spans = fresh(docs, "spans")
    names = F.array(*map(F.lit, KINDS))
    found = find(docs, model, spans)
    ordered = F.array_sort(F.transform(F.col(spans), lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), s.kind.alias("kind"))))

    def cut(acc: Column, s: Column) -> Column:
        gap = F.substr(F.col("text"), acc["at"] + 1, F.greatest(s.start - acc["at"], F.lit(0)))
        mark = F.concat(F.lit("<"), F.upper(F.get(names, s.kind)), F.lit(">"))
        return F.struct(
            F.greatest(acc["at"], s.end).alias("at"),
            F.when(s.start < acc["at"], acc.out).otherwise(F.array_append(F.array_append(acc.out, gap), mark)).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        ordered, start, cut, lambda acc: F.concat(F.array_join(acc.out, ""), F.substr(F.col("text"), acc["at"] + 1))
    )
    out = found.withColumn("text", F.when(F.size(spans) > 0, done).otherwise(F.col("text"))).drop(spans)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
