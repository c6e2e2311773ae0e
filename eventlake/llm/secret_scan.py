"""Secret scan: known forms by expression, unknown ones by a battery of randomness tests.

A long token without a known form is a candidate, and so are its parts between signs, since a key may
be joined to plain words or stand in a path. The encoding it could be in is inferred from its characters, and three tests ask whether it looks drawn at random from that alphabet: a chi-squared
test of uniformity, a runs test on character classes and a test of serial correlation. Each is asked
twice. First the token must be consistent with a random draw: names, paths, time stamps and numbers are
made of letters of unequal frequency, long runs of one class or counting digits, and fail at least one.
Then "ordinary text" is the null hypothesis, so that the power grows with the token; the three results
are combined into one p-value, and the false-discovery rate is controlled within strata of token
length, over all candidates of the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventlake.llm.common import beside, bind, fresh, quoted

# Fixed values of the known forms: expression, characters it needs, group they are counted in.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"   # the longest run is taken, so 18 characters in all can be asked for here
HEX = r"[0-9a-f]{16,}"
ASSIGN_LEAST = 12
KINDS = ["assign", "access", "hex", "random"]

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
PLAIN = r"^[A-Za-z0-9]+$"
# Candidates within a run that has signs between: its longest parts in one alphabet, with and without them.
PARTS = [r"[A-Za-z0-9+/]{20,}", r"[A-Za-z0-9_-]{20,}", r"[A-Za-z0-9]{20,}"]
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Encoding: expression, alphabet, how far ordinary text is from uniform (alphabet size * sum of squared
# character shares - 1: decimal numbers in hex, letter frequencies of prose in the others).
ENCODINGS = [
    (r"^[0-9a-f]+$", DIGITS + LOWER[:6], 0.6),
    (r"^[0-9A-F]+$", DIGITS + UPPER[:6], 0.6),
    (r"^[A-Z2-7]+$", UPPER + DIGITS[2:8], 1.1),
    (r"^[A-Z0-9]+$", UPPER + DIGITS, 1.4),
    (r"^[a-z0-9]+$", LOWER + DIGITS, 1.4),
    (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/", 3.2),
    (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_", 3.2),
]
CLASS_CHANGES = 0.1       # of neighbouring characters in ordinary tokens change class
UNEVEN, FEW_RUNS, ORDERED = 3.5, 2.6, 3.2   # standard deviations from randomness at which a token is not random
CORRELATION = 0.5         # serial correlation of ordered text, from which randomness must differ
LIMIT = 4.0               # no single test carries more than this many standard deviations
STRATA = (32, 64)         # token lengths at which a new stratum begins
FALSE_DISCOVERIES = 0.05
STEPS = 20                # p-values are grouped by the STEPS-th part of a power of ten, rounded up
SMALLEST = 12.0           # powers of ten; three tests at LIMIT give 2e-12
MASK = "[SECRET]"
SPANS = "array<struct<start:int,end:int,text:string>>"
BLOCK = 256


def _places(text: Column, form: str, keep: Callable[[Column], Column] | None = None) -> Column:
    """Start and end of every match of ``form``, leftmost and non-overlapping, in code points."""
    gaps = F.transform(F.split(text, form, -1), F.char_length)
    found = F.regexp_extract_all(text, F.lit(form), F.lit(0))
    none = F.array().cast(SPANS)

    def walk(parts: Column) -> Column:
        last = F.size(parts["found"]) - 1

        def one(at: Column, i: Column) -> Column:
            start = at + parts["gaps"][i]
            return F.struct(start.alias("start"), (start + F.char_length(parts["found"][i])).alias("end"),
                            parts["found"][i].alias("text"))

        def step(s: Column, i: Column) -> Column:
            return bind(one(s["at"], i), lambda p: F.struct(
                p["end"].alias("at"), F.concat(s["out"], F.array(p)).alias("out")))

        def block(s: Column, first: Column) -> Column:
            start = F.struct(s["at"].alias("at"), none.alias("out"))
            inner = F.aggregate(F.sequence(first, F.least(first + BLOCK - 1, last)), start, step)
            return bind(inner, lambda e: F.struct(
                e["at"].alias("at"), F.concat(s["out"], F.array(e["out"])).alias("out")))

        # in blocks, so that a text with very many matches does not copy all of them for each
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out"))
        return F.flatten(F.aggregate(F.sequence(F.lit(0), last, F.lit(BLOCK)), start, block, lambda s: s["out"]))

    spans = F.when(F.rlike(text, F.lit(form)), bind(F.struct(gaps.alias("gaps"), found.alias("found")), walk)).otherwise(none)
    return F.filter(spans, lambda p: keep(p["text"])) if keep else spans


def _normal(z: Column) -> Column:
    """Lower tail of the normal distribution (a rational approximation, good to 1e-7 and, as far out as
    LIMIT lets it go, to 1 % of the tail)."""
    def upper(t: Column) -> Column:
        poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
        return F.exp(-z * z / 2) * 0.3989422804014327 * poly

    tail = bind(1 / (1 + 0.2316419 * F.abs(z)), upper)
    return F.when(z < 0, tail).otherwise(1 - tail)


def _class_changes(alphabet: str) -> float:
    """How often neighbours differ in class in a random draw from an alphabet."""
    sizes = [len(set(alphabet) & set(signs)) for signs in (LOWER, UPPER, DIGITS)]
    sizes += [1] * (len(alphabet) - sum(sizes))
    return 1 - sum((n / len(alphabet)) ** 2 for n in sizes)


def _clipped(z: Column) -> Column:
    return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), z))


def _encoding(token: Column) -> Column:
    """The first encoding that fits, as (alphabet, distance, changes); null where none does."""
    out = F.lit(None).cast("struct<alphabet:string,distance:double,changes:double>")
    for form, alphabet, distance in reversed(ENCODINGS):
        own = F.struct(F.lit(alphabet).alias("alphabet"), F.lit(distance).alias("distance"),
                       F.lit(_class_changes(alphabet)).alias("changes"))
        out = F.when(F.rlike(token, F.lit(form)), own).otherwise(out)
    return out


def randomness(token: Column) -> Column:
    """Combined p-value of "ordinary text" for one token; 1 where no encoding fits or it is not random."""
    def tested(t: Column) -> Column:
        n, size, distance = t["n"], F.char_length(t["alphabet"]).cast("double"), t["distance"]
        squares = F.aggregate(F.array_distinct(t["chars"]), F.lit(0.0), lambda s, c: s + F.pow(
            n - F.char_length(F.replace(t["token"], c, F.lit(""))), F.lit(2.0)))
        classes = F.translate(t["token"], LOWER + UPPER + DIGITS, "a" * 26 + "A" * 26 + "0" * 10)
        changes = F.char_length(F.regexp_replace(classes, r"(.)\1*", "_")) - 1
        ranks = F.transform(t["chars"], lambda c: F.instr(t["alphabet"], c).cast("double"))
        mean = F.aggregate(ranks, F.lit(0.0), lambda s, v: s + v) / n
        moved = bind(F.struct(ranks.alias("x"), mean.alias("mean")),
                     lambda m: F.transform(m["x"], lambda v: v - m["mean"]))

        def serial(x: Column) -> Column:
            spread = F.aggregate(x, F.lit(0.0), lambda s, v: s + v * v)
            lagged = F.aggregate(F.zip_with(x, F.slice(x, F.lit(2), F.size(x)), lambda a, b: a * F.coalesce(b, F.lit(0.0))),
                                 F.lit(0.0), lambda s, v: s + v)
            return F.atanh(F.least(F.lit(0.999), F.abs(lagged / F.greatest(spread, F.lit(1e-9))))) * F.sqrt(n - 3)

        found = F.struct((size / n * squares - n).alias("chi"), changes.alias("changes"), bind(moved, serial).alias("serial"))

        def both(m: Column) -> Column:
            expected, spread = (n - 1) * t["changes"], F.sqrt((n - 1) * t["changes"] * (1 - t["changes"]))
            random = (m["chi"] - (size - 1) <= UNEVEN * F.sqrt(2 * (size - 1))) \
                & (m["changes"] - expected >= -FEW_RUNS * spread) & (m["serial"] <= ORDERED)
            by_chi = (size - 1 + distance * n - m["chi"]) / F.sqrt(2 * (size - 1) + 4 * distance * n)
            by_runs = (m["changes"] - (n - 1) * CLASS_CHANGES) / F.sqrt((n - 1) * CLASS_CHANGES * (1 - CLASS_CHANGES))
            by_order = F.atanh(F.lit(CORRELATION)) * F.sqrt(n - 3) - m["serial"]
            total = (_clipped(by_chi) + _clipped(by_runs) + _clipped(by_order)) / 3 ** 0.5
            return F.when(random, bind(-total, _normal)).otherwise(F.lit(1.0))

        return bind(found, both)

    def judged(e: Column) -> Column:
        given = F.struct(token.alias("token"), F.char_length(token).cast("double").alias("n"), F.split(token, "").alias("chars"),
                         e["alphabet"].alias("alphabet"), e["distance"].alias("distance"), e["changes"].alias("changes"))
        return F.when(e.isNull(), F.lit(1.0)).otherwise(bind(given, tested))

    return bind(_encoding(token), judged)


def _stratum(length: Column) -> Column:
    out = F.lit(0)
    for bound in STRATA:
        out = out + (length >= bound).cast("int")
    return out


def _step(p: Column) -> Column:
    """Group of a p-value, 0 for 1; the group stands for its largest p-value."""
    return F.floor(F.least(F.lit(SMALLEST), -F.log10(F.greatest(p, F.lit(1e-300)))) * STEPS).cast("int")


def _candidates(text: Column) -> Column:
    """Per run of key characters the run, or where it has ``+/_-`` its parts that fit one alphabet."""
    def split(run: Column) -> Column:
        parts = F.concat(*[_places(run["text"], form) for form in PARTS])
        moved = F.transform(parts, lambda p: F.struct(
            (run["start"] + p["start"]).alias("start"), (run["start"] + p["end"]).alias("end"), p["text"].alias("text")))
        return F.when(F.rlike(run["text"], F.lit(PLAIN)), F.array(run)).otherwise(F.array_sort(F.array_distinct(moved)))

    return F.transform(_places(text, CANDIDATE), split)


def _overlap(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


def _assigned(match: Column) -> Column:
    return F.char_length(F.regexp_extract(match, ASSIGN, 2)) >= ASSIGN_LEAST


def _ranked(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end")))


def _base_and_candidates(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` beside a struct: ``base`` spans in order, and per run the ``tokens`` apart from them with step and stratum."""
    text, name = F.coalesce("text", F.lit("")), fresh(docs, "scan")
    base = F.array_sort(F.concat(_ranked(_places(text, ASSIGN, _assigned), 0), _ranked(_places(text, ACCESS), 1),
                                 _ranked(_places(text, HEX), 2)))
    placed = docs.select("*", F.struct(base.alias("base"), _candidates(text).alias("tokens")).alias(name))
    held = F.col(name)

    def judged(run: Column) -> Column:
        apart = F.filter(run, lambda t: ~F.exists(held["base"], lambda b: _overlap(b, t)))
        return F.transform(apart, lambda t: F.struct(
            t["start"].alias("start"), t["end"].alias("end"), _stratum(t["end"] - t["start"]).alias("stratum"),
            _step(randomness(t["text"])).alias("step")))

    return placed.withColumn(name, F.struct(held["base"].alias("base"), F.transform(held["tokens"], judged).alias("tokens"))), name


def discovery_limits(docs: DataFrame) -> dict[int, int]:
    """The Benjamini-Hochberg cut of every stratum: the least p-value step that is a discovery.

    Counts all candidates of all documents. The result has at most one number per stratum.
    """
    placed, name = _base_and_candidates(docs.select("text"))
    counts = placed.select(F.explode(F.flatten(F.col(name)["tokens"])).alias("t")).groupBy("t.stratum", "t.step").count()
    of = Window.partitionBy("stratum")  # at most STEPS * SMALLEST + 1 rows a stratum
    ranked = counts.withColumn("total", F.sum("count").over(of)).withColumn(
        "rank", F.sum("count").over(of.orderBy(F.desc("step"))))
    fits = F.pow(F.lit(10.0), -F.col("step") / STEPS) * F.col("total") <= FALSE_DISCOVERIES * F.col("rank")
    return {r["stratum"]: r["least"] for r in
            ranked.where(fits).groupBy("stratum").agg(F.min("step").alias("least")).collect()}


def find_secrets(docs: DataFrame, limits: dict[int, int] | None = None) -> DataFrame:
    """``docs`` with ``secret_spans``: an array of (start, kind, end), ordered, ``kind`` a place in KINDS.

    Offsets are code points, the end exclusive. Of random spans within each other the outermost is
    given; others may overlap. ``limits`` are those of the corpus; without them they
    are taken over ``docs`` first. Null and empty texts have no spans, repeated rows have equal spans,
    an empty table gives an empty result, and a column named ``secret_spans`` gives way.
    """
    limits = discovery_limits(docs) if limits is None else limits
    placed, name = _base_and_candidates(docs)
    held = F.col(name)
    least = F.lit(None).cast("int")

    def found(t: Column) -> Column:
        cut = least
        for stratum, step in sorted(limits.items()):
            cut = F.when(t["stratum"] == stratum, F.lit(step)).otherwise(cut)
        return F.coalesce(t["step"] >= cut, F.lit(False))

    def outermost(tokens: Column) -> Column:
        def within(a: Column, b: Column) -> Column:
            return (b["start"] <= a["start"]) & (a["end"] <= b["end"]) & (a["end"] - a["start"] < b["end"] - b["start"])
        return F.filter(tokens, lambda a: ~F.exists(tokens, lambda b: within(a, b)))

    random = _ranked(F.flatten(F.transform(held["tokens"], lambda run: bind(F.filter(run, found), outermost))), 3) if limits else F.array().cast(
        "array<struct<start:int,kind:int,end:int>>")
    out = F.struct(F.array_sort(F.concat(held["base"], random)).alias("secret_spans"))
    return beside(placed, out, ["secret_spans"]).drop(name)


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(
        ":", names[p["kind"]], p["start"].cast("string"), p["end"].cast("string"))), ",")


def mask_secrets(docs: DataFrame, limits: dict[int, int] | None = None) -> DataFrame:
    """``docs`` with every span of a secret in ``text`` replaced by MASK; ``n_chars`` follows the text.

    Overlapping spans are masked once. Texts without a secret, null ones included, stay as they are.
    """
    found = find_secrets(docs, limits)
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(none.alias("done"), F.lit(-1).alias("start"), F.lit(-1).alias("end"))

    def step(s: Column, p: Column) -> Column:
        apart = p["start"] > s["end"]
        done = F.when(apart & (s["end"] >= 0), F.concat(s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))).otherwise(s["done"])
        return F.struct(done.alias("done"), F.when(apart, p["start"]).otherwise(s["start"]).alias("start"),
                        F.greatest(s["end"], p["end"]).alias("end"))

    merged = F.aggregate("secret_spans", start, step, lambda s: F.concat(
        s["done"], F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    def cut(spans: Column) -> Column:
        def piece(i: Column) -> Column:
            after = F.when(i == 0, F.lit(0)).otherwise(F.get(spans, i - 1)["end"])
            return F.concat(F.substring("text", after + 1, F.get(spans, i)["start"] - after), F.lit(MASK))
        tail = F.substring("text", F.element_at(spans, -1)["end"] + 1, F.char_length("text"))
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans) - 1), piece), ""), tail)

    masked = F.when(F.size("secret_spans") > 0, bind(merged, cut)).otherwise(F.col("text"))
    changed = found.withColumn("text", masked)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.char_length("text").cast("long"))
                                     .otherwise(F.col("n_chars")))
    return changed.select(*[quoted(c) for c in docs.columns])
