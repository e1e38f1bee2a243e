"""Operator 7: personal data. DataFrame functions only.

Base spans follow fixed patterns and checks. Beside them, high-recall generators propose
candidates (disguised addresses, groups of digits, addresses of other forms), which may
overlap. Boosted regression trees score each by features of its format and context; a threshold per
kind, calibrated for precision on held-out examples, selects; of overlapping
candidates the best stays, and none that overlaps a base span.

The trees are learned here, on a bounded set of made-up examples (``examples``): the same
DataFrame functions compute the features of examples and of documents, a small numpy loop on
the driver fits the trees, and the trees become one SQL expression.

Where a match begins and ends follows from splitting the text by the pattern: the lengths of
what lies between matches and of the matches add up to code point offsets. Patterns use
possessive loops and look-behinds, so that long runs cost linear time and no recursion. Sums and
the search for overlaps run over blocks of matches (``scanned``), so that a text of very many
matches costs little more than in proportion.

Defined results: a null text is an empty text without spans; a text of any length is searched
whole; extra columns are not read; a null id keeps its row; repeated rows give repeated results; an
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, each equal in its matches to its plain greedy form.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: A text without this holds no match of the base pattern.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){15}", "phone": r"\+[0-9]"}
#: Generators by kind: candidates are proposed, not decided.
GENERATORS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:@|\(at\)|\[at\]|\{at\}|<at>) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}|<dot>) ?[A-Za-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9]{4}(?:[ .·/_-]{1,3}[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+.-])(?:00[0-9]{1,3}[ .-]?|[01][ .-])?(?:\([0-9]{2,5}\)|[0-9]{2,5})(?:[ ./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])",
}
GENERATOR_NEEDS = {
    "email": r"[@\(\[\{<](?:at[\)\]\}>])?",
    "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:[0-9A-Fa-f]{1,4}:",
    "card": r"[0-9]{4}[ .·/_-]{1,3}[0-9]{4}[ .·/_-]{1,3}[0-9]{4}",
    "phone": r"[0-9][ .()/-]{1,3}[0-9]{2}",
}
ABOUT = r"(?i)\b(?:call|phone|telephone|tel|mobile|cell|fax|contact|reach|text|sms|whatsapp|e-?mail|mail|write|card|visa|credit|pay|ip|address|host|server|telefon|anruf|llam\w*|appel\w*|correo|karte|carte|tarjeta)\b[^\n]{0,24}$"
OTHER = r"(?i)\b(?:order|invoice|version|isbn|issn|ref|reference|date|dated|ticket|page|pages|tracking|serial|model|build|section|score|room|chapter|year|years|lot|case|part|sku|doi|rev)\b[^\n]{0,16}$"
CONTEXT = 40


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def scanned(items: Column, zero: Column, kind: str, join: Callable[[Column, Column], Column], block: int = 128) -> Column:
    """array<kind>: for each item what those before it come to, by an associative ``join`` with
    ``zero`` as its neutral value. Blocks are summed up first, so that no state is copied for each item."""
    none = F.array().cast(f"array<{kind}>")

    def run(values: Column, start: Column) -> Column:
        step = lambda s, x: F.struct(join(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out"))
        return F.aggregate(values, F.struct(start.alias("at"), none.alias("out")), step, lambda s: s["out"])

    def long(values: Column) -> Column:
        places = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / block).cast("int"))
        blocks = F.transform(places, lambda k: F.slice(values, k * block + 1, F.lit(block)))

        def starts(of: Column) -> Column:
            return F.flatten(F.zip_with(of, run(F.transform(of, lambda b: F.aggregate(b, zero, join)), zero), run))

        return bound(blocks, starts)

    return bound(items, lambda x: F.when(F.size(x) <= block, run(x, zero)).otherwise(long(x)))


SPAN = "struct<start:int,end:int,found:string,left:string,right:string>"


def located(text: Column, pattern: str, needs: str) -> Column:
    """array<struct<start, end, found, left, right>> of the pattern's matches, in code points;
    left and right are some characters around."""

    def spans(x: Column) -> Column:
        matches = F.transform(x["found"], lambda f, i: F.struct(F.get(x["between"], i).alias("before"), f.alias("found"), F.get(x["between"], i + 1).alias("after")))

        def placed(ms: Column) -> Column:
            ends = scanned(F.transform(ms, lambda m: (F.length(m["before"]) + F.length(m["found"])).cast("int")), F.lit(0), "int", lambda s, n: (s + n).cast("int"))

            def span(m: Column, at: Column) -> Column:
                start = (at + F.length(m["before"])).cast("int")
                end = (start + F.length(m["found"])).cast("int")
                return F.struct(start.alias("start"), end.alias("end"), m["found"].alias("found"), F.substring(m["before"], -CONTEXT, CONTEXT).alias("left"), F.substring(m["after"], 1, CONTEXT).alias("right"))

            return F.zip_with(ms, ends, span)

        return bound(matches, placed)

    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))
    return F.when(text.rlike(needs), bound(both, spans)).otherwise(F.array().cast(f"array<{SPAN}>"))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of the text pass the Luhn check."""
    figures = F.split(F.reverse(digits_of(text)), "")

    def value(c: Column, i: Column) -> Column:
        d = F.coalesce(F.try_to_number(c, F.lit("9")).cast("int"), F.lit(0))
        return F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)

    return F.aggregate(F.transform(F.filter(figures, lambda c: c != ""), value), F.lit(0), lambda s, v: s + v) % 10 == 0


def passes(kind: str, found: Column) -> Column:
    n = F.length(digits_of(found))
    if kind == "ip":
        return found.rlike(r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$")
    if kind == "card":
        return F.when((n >= 16) & (n <= 19), luhn(found)).otherwise(False)
    if kind == "phone":
        return (n >= 8) & (n <= 15)
    return F.lit(True)


def features(kind: int, c: Column) -> list[Column]:
    """Doubles that describe a candidate's format and context."""
    found = c["found"]
    groups = F.filter(F.split(found, "[^0-9]+"), lambda g: g != "")
    n = F.length(digits_of(found))
    sizes = F.transform(groups, lambda g: F.length(g))
    letters = F.length(F.regexp_replace(found, "[^A-Za-z]", ""))
    kinds_of_mark = F.size(F.array_distinct(F.filter(F.split(F.regexp_replace(found, "[0-9A-Za-z]", ""), ""), lambda g: g != "")))
    values = [
        F.lit(kind), n, F.size(groups), F.length(found) - n - letters, F.length(found),
        F.coalesce(F.get(sizes, 0), F.lit(0)), F.coalesce(F.get(sizes, F.greatest(F.size(sizes) - 1, F.lit(0))), F.lit(0)), F.coalesce(F.array_max(sizes), F.lit(0)),
        kinds_of_mark, letters, found.rlike(r"^[\(+]").cast("int"), found.rlike(r"[\(\[\{<](?:at|dot)").cast("int"),
        c["left"].rlike(ABOUT).cast("int"), c["left"].rlike(OTHER).cast("int"), c["left"].rlike(r"[0-9$€£#%][ .,/-]?$").cast("int"), c["right"].rlike(r"^[ ]?[/%°:=+*-]?[0-9$€£%]").cast("int"),
        found.rlike(r"^(?:19|20)[0-9]{2}[-/. ][0-9]{1,2}[-/. ]|[-/. ](?:19|20)[0-9]{2}$").cast("int"), found.rlike(r"\.[A-Za-z]{2,6}$|dot\W ?[A-Za-z]{2,6}$").cast("int"), F.when(n >= 12, luhn(found)).otherwise(False).cast("int"),
    ]
    return [v.cast("double") for v in values]


N_FEATURES = 19


def examples(seed: int = 7, each: int = 40) -> list[tuple[str, str | None, str | None]]:
    """Made-up texts, each with the span that is personal and its kind, or None: fixed templates
    filled by a seeded generator. The set is bounded by its templates times ``each``."""
    random = np.random.default_rng(seed)
    d = lambda k: "".join(str(x) for x in random.integers(0, 10, k))
    w = lambda: "".join(random.choice(list("abcdefghilmnoprstu"), int(random.integers(3, 9))))

    def card(valid: bool) -> str:
        """Four groups of four digits that pass the Luhn check, or fail it."""
        figures = str(random.integers(3, 7)) + d(14)
        check = -sum(int(c) if k % 2 else int(c) * 2 - 9 * (int(c) > 4) for k, c in enumerate(figures)) % 10
        figures += str(check if valid else (check + int(random.integers(1, 10))) % 10)
        mark = str(random.choice([" ", "-", ".", "·", "/", "_", "  ", "--", " - ", " / ", " · "]))
        return mark.join(figures[k : k + 4] for k in range(0, 16, 4))

    good = [
        lambda: f"({d(3)}) {d(3)}-{d(4)}", lambda: f"{d(3)}-{d(3)}-{d(4)}", lambda: f"{d(3)}.{d(3)}.{d(4)}", lambda: f"{d(3)} {d(3)} {d(4)}", lambda: f"1-{d(3)}-{d(3)}-{d(4)}", lambda: f"0049 {d(3)} {d(4)} {d(3)}", lambda: f"0{d(3)} {d(3)} {d(4)}", lambda: f"0{d(2)} {d(4)} {d(4)}",
        lambda: f"{w()}.{w()} (at) {w()} (dot) com", lambda: f"{w()}[at]{w()}.org", lambda: f"{w()} [at] {w()} [dot] net", lambda: f"{w()}(at){w()}.example.com", lambda: f"{w()} @ {w()}.com",
        lambda: ":".join(f"{x:x}" for x in random.integers(256, 65536, 8)),
        lambda: card(True), lambda: card(True), lambda: card(True),
    ]
    kinds = ["phone"] * 8 + ["email"] * 5 + ["ip"] + ["card"] * 3
    bad = [
        lambda: f"20{d(2)}-0{random.integers(1, 10)}-1{d(1)}", lambda: f"1{d(1)}/0{random.integers(1, 10)}/20{d(2)}", lambda: f"{d(2)}-{d(2)}", lambda: f"{d(3)}-{d(2)}", lambda: f"{d(5)}-{d(5)}", lambda: f"{d(2)} {d(3)}", lambda: f"{d(2)}.{d(2)}", lambda: f"978-{d(1)}-{d(3)}-{d(5)}-{d(1)}", lambda: card(False), lambda: card(False), lambda: card(False),
        lambda: f"19{d(2)}-20{d(2)}", lambda: f"{d(2)}/{d(2)}", lambda: f"{d(3)}.{d(3)}", lambda: f"{d(4)}-{d(4)}", lambda: f"{d(2)} {d(2)} {d(2)}", lambda: f"{d(2)}-{d(2)}-{d(2)}-{d(2)}",
        lambda: f"{w()} @ {w()}", lambda: f"{w()} (at) {w()}", lambda: ":".join(d(2) for _ in range(4)),
    ]
    about = ["call", "phone:", "my number is", "tel", "reach me at", "contact", "fax", "text", "mobile", "e-mail", "write to", "card", "pay by visa", ""]
    other = ["order", "invoice", "version", "dated", "ref", "ticket", "on", "about", "from", "page", "between", "model", "isbn", ""]
    out = []
    for k in range(each):
        for kind, make in zip(kinds, good, strict=True):
            span, lead = make(), str(random.choice(about))
            out.append((f"{w()} {w()} {lead} {span}{random.choice([' ', ', ', '. ', ''])}{w() if k % 2 else ''}", span, kind))
        for make in bad:
            out.append((f"{w()} {w()} {random.choice(other)} {make()} {w()} {w()}", None, None))
    return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, rate: float = 0.3, shrink: float = 1.0) -> list:
    """Boosting with the logistic loss; trees of depth two as (feature, cut, left, right)
    with leaves or inner nodes of the same form."""

    def split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> object:
        leaf = float(-g[rows].sum() / (h[rows].sum() + shrink) * rate)
        if not depth or len(rows) < 8:
            return leaf
        best, found = 1e-6, None
        base = g[rows].sum() ** 2 / (h[rows].sum() + shrink)
        for f in range(x.shape[1]):
            values = x[rows, f]
            for cut in (lambda u: (u[1:] + u[:-1]) / 2)(np.unique(values)):
                low = values <= cut
                gl, hl = g[rows][low].sum(), h[rows][low].sum()
                gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
                gain = gl * gl / (hl + shrink) + gr * gr / (hr + shrink) - base
                if gain > best:
                    best, found = gain, (f, float(cut), low)
        if found is None:
            return leaf
        f, cut, low = found
        return (f, cut, split(rows[low], g, h, depth - 1), split(rows[~low], g, h, depth - 1))

    trees, total = [], np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        trees.append(split(np.arange(len(y)), p - y, p * (1 - p), 2))
        total += predict_trees(trees[-1:], x)
    return trees


def predict_trees(trees: list, x: np.ndarray) -> np.ndarray:
    def walk(node: object, rows: np.ndarray) -> np.ndarray:
        if isinstance(node, float):
            return np.full(len(rows), node)
        f, cut, left, right = node
        return np.where(rows[:, f] <= cut, walk(left, rows), walk(right, rows))

    return sum((walk(t, x) for t in trees), np.zeros(len(x)))


def trees_sql(trees: list, f: Column) -> Column:
    def walk(node: object) -> Column:
        if isinstance(node, float):
            return F.lit(node)
        k, cut, left, right = node
        return F.when(F.get(f, k) <= cut, walk(left)).otherwise(walk(right))

    total = F.lit(0.0)
    for t in trees:
        total = total + walk(t)
    return total


def described(spans: Column, kind: str) -> Column:
    """Candidates of a kind with their features."""
    return F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), F.array(*features(KINDS.index(kind), c)).alias("f")))


def candidates(text: Column, kind: str) -> Column:
    return described(located(text, GENERATORS[kind], GENERATOR_NEEDS[kind]), kind)


def outside(spans: Column, base: Column) -> Column:
    """The spans that overlap none of base. Both are sorted by place together: a span stands at its
    end, a base span at its start, and the farthest end of the base spans before tells."""
    none = F.lit(None).cast(SPAN)
    event = lambda at, kind, end, own: F.struct(at.alias("at"), F.lit(kind).alias("kind"), end.alias("end"), own.alias("own"))
    events = F.concat(F.transform(spans, lambda c: event(c["end"], 0, F.lit(0), c)), F.transform(base, lambda b: event(b["start"], 1, b["end"], none)))

    def free(es: Column) -> Column:
        far = scanned(F.transform(es, lambda e: e["end"]), F.lit(0), "int", lambda s, e: F.greatest(s, e))
        kept = F.zip_with(es, far, lambda e, f: F.when((e["kind"] == 0) & (f <= e["own"]["start"]), e["own"]))
        return F.filter(kept, lambda c: c.isNotNull())

    return F.when((F.size(spans) == 0) | (F.size(base) == 0), spans).otherwise(bound(F.sort_array(events), free))


SCORED = "struct<start:int,kind:int,end:int,score:double>"


def best_of(scored: Column) -> Column:
    """Of SCORED candidates, those that no better one overlaps: by score, then start, then kind.
    Candidates of one kind never overlap, so an earlier one that overlaps is the last of its kind."""
    last = F.lit(None).cast("struct<end:int,score:double,at:int>")
    names = [f"k{k}" for k in range(len(KINDS))]
    kinds = "struct<" + ",".join(f"{n}:struct<end:int,score:double,at:int>" for n in names) + ">"

    def select(cs: Column) -> Column:
        own = F.transform(cs, lambda c, i: F.struct(*[F.when(c["kind"] == k, F.struct(c["end"].alias("end"), c["score"].alias("score"), i.cast("int").alias("at"))).otherwise(last).alias(n) for k, n in enumerate(names)]))
        before = scanned(own, F.struct(*[last.alias(n) for n in names]), kinds, lambda s, x: F.struct(*[F.coalesce(x[n], s[n]).alias(n) for n in names]))

        def beaten(ps: Column) -> Column:
            def losers(c: Column, i: Column) -> Column:
                p = F.get(ps, i)
                loser = lambda b: F.when(b.isNotNull() & (c["start"] < b["end"]), F.when(b["score"] >= c["score"], i.cast("int")).otherwise(b["at"]))
                return F.array(*[loser(p[n]) for n in names])

            lost = F.filter(F.flatten(F.transform(cs, losers)), lambda x: x.isNotNull())
            return F.transform(F.array_except(F.sequence(F.lit(0), F.size(cs) - 1), lost), lambda i: F.get(cs, i))

        return bound(before, beaten)

    return F.when(F.size(scored) <= 1, scored).otherwise(bound(F.sort_array(scored), select))


_models: dict[str, tuple[list, dict[str, float]]] = {}


def model(spark: SparkSession, precision: float = 0.99) -> tuple[list, dict[str, float]]:
    """(trees, threshold by kind), once an application: fitted on two thirds of the examples,
    thresholds set on the rest as the least score with the precision wanted."""
    app = spark.sparkContext.applicationId
    if app not in _models:
        made = examples()
        texts = spark.createDataFrame([(i, t, t.find(s) if s else -1, len(s or ""), KINDS.index(kind) if kind else -1) for i, (t, s, kind) in enumerate(made)], "i int, text string, at int, n int, kind int")
        every = F.concat(*[candidates(F.col("text"), k) for k in KINDS])
        rows = texts.select("i", "at", "n", "kind", F.explode(every).alias("c")).select("i", F.col("c.f").alias("f"), ((F.col("at") >= 0) & (F.col("c.start") >= F.col("at") - 1) & (F.col("c.end") <= F.col("at") + F.col("n") + 1) & (F.get("c.f", F.lit(0)) == F.col("kind"))).alias("y")).collect()
        x, y, i = np.array([r.f for r in rows]), np.array([float(r.y) for r in rows]), np.array([r.i for r in rows])
        held = i % 3 == 0
        for k, kind in enumerate(KINDS):
            if not (y[held & (x[:, 0] == k)].any() and y[~held & (x[:, 0] == k)].any()):
                raise ValueError(f"no positive example of kind {kind}")
        trees = fit_trees(x[~held], y[~held])
        scores, limits = predict_trees(trees, x[held]), {}
        for k, kind in enumerate(KINDS):
            own = x[held][:, 0] == k
            s, t = scores[own], y[held][own]
            order = np.argsort(-s, kind="stable")
            right = np.cumsum(t[order]) / np.arange(1, len(s) + 1)
            fine = np.flatnonzero(right >= precision)
            if not len(fine):
                raise ValueError(f"no threshold gives kind {kind} the precision {precision}")
            limits[kind] = max(float(s[order][fine[-1]]), 1.0)
        _models[app] = (trees, limits)
    return _models[app]


def find_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, base, added): arrays of struct<kind, start, end>; kind is its place in KINDS."""
    trees, limits = model(docs.sparkSession)
    source = F.coalesce(F.col(text).cast("string"), F.lit(""))
    kept = docs.select(F.col(doc_id).alias("doc_id"), source.alias("text"))

    def base_of(k: int, kind: str) -> Column:
        valid = F.filter(located(F.col("text"), BASE[kind], NEEDS[kind]), lambda c: passes(kind, c["found"]))
        return F.transform(valid, lambda c: F.struct(F.lit(k).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))

    def scored_of(k: int, kind: str, base: Column) -> Column:
        free = outside(located(F.col("text"), GENERATORS[kind], GENERATOR_NEEDS[kind]), base)
        each = F.transform(described(free, kind), lambda c: F.struct(c["start"].alias("start"), F.lit(k).alias("kind"), c["end"].alias("end"), trees_sql(trees, c["f"]).alias("score")))
        return F.filter(each, lambda c: c["score"] >= limits[kind])

    def select(base: Column) -> Column:
        scored = F.concat(*[scored_of(k, kind, base) for k, kind in enumerate(KINDS)])
        added = F.transform(bound(scored, best_of), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
        return F.struct(base.alias("base"), added.alias("added"))

    base = F.concat(*[base_of(k, kind) for k, kind in enumerate(KINDS)])
    some = F.col("text").rlike(r"[0-9@]|[\(\[\{<]at[\)\]\}>]")
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    spans = F.when(some, bound(base, select)).otherwise(F.struct(none.alias("base"), none.alias("added")))
    return kept.withColumn("spans", spans).select("doc_id", "text", "spans.base", "spans.added")


def joined(spans: Column) -> Column:
    """kind:start:end by kind, then start, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


PIECE = 4096


def redact(found: DataFrame, mask: str = "▇") -> DataFrame:
    """(doc_id, redacted): every span overwritten, with its length kept. The text is cut into pieces of
    PIECE code points, and each is overwritten by the parts of spans that lie in it."""
    spans = F.concat("base", "added")
    cuts = F.flatten(F.transform(spans, lambda s: F.transform(F.sequence((s["start"] / PIECE).cast("int"), ((s["end"] - 1) / PIECE).cast("int")), lambda k: F.struct(k.alias("k"), F.greatest(s["start"] - k * PIECE, F.lit(0)).alias("start"), F.least(s["end"] - k * PIECE, F.lit(PIECE)).alias("end")))))

    def masked(piece: Column, own: Column) -> Column:
        def step(state: Column, s: Column) -> Column:
            start, end = F.greatest(s["start"], state["at"]), F.greatest(s["end"], state["at"])
            return F.struct(end.alias("at"), F.concat(state["out"], F.substring(piece, state["at"] + 1, start - state["at"]), F.repeat(F.lit(mask), end - start)).alias("out"))

        return F.aggregate(own, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda s: F.concat(s["out"], F.substring(piece, s["at"] + 1, F.lit(PIECE))))

    def whole(x: Column) -> Column:
        def piece_of(piece: Column, k: Column) -> Column:
            first = F.array_position(x["ks"], k).cast("int")
            after = F.size(x["cuts"]) - F.array_position(x["back"], k).cast("int") + 2
            return F.when(first == 0, piece).otherwise(masked(piece, F.slice(x["cuts"], F.greatest(first, F.lit(1)), after - first)))

        return F.array_join(F.transform(x["pieces"], piece_of), "")

    def keyed(c: Column) -> Column:
        ks = F.transform(c, lambda s: s["k"])
        return bound(F.struct(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("pieces"), c.alias("cuts"), ks.alias("ks"), F.reverse(ks).alias("back")), whole)

    return found.select("doc_id", F.when(F.size(spans) == 0, F.col("text")).otherwise(bound(F.sort_array(cuts), keyed)).alias("redacted"))


def digests(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
