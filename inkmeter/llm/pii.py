"""Personal data: base patterns, candidates, boosted trees, calibrated thresholds.

Base spans are found by pattern and arithmetic and always stay.  Further
candidates come from generators of high recall whose spans may overlap: split
or disguised addresses, digit groups a base pattern swallowed or cut.  Gradient
boosted trees score a candidate by its format and its context.  They learn from
half of all candidates, labelled by evidence that no feature shows: a
host that ends in letters, octets in range, the check sum, an area code's first
digit.  Numbers that are none of these pass such tests at a known rate only, so
the share that passes tells what a format in a context stands for.  Whether a base span covers a candidate plays no part,
so what only a generator finds is right or wrong by the same measure.  On the
other half, each kind's threshold is set to the lowest score down
to which each band of scores is right often enough; a span is added where its score
reaches that and the evidence speaks for it too.  The fitted trees become one
column expression, so scoring, like everything on a text, is done within its
row: nothing moves, and no Python runs on the executors.  Texts are searched
once; what was found is written down, then counted and scored.

Positions count code points.  They are running sums over the pieces between
matches, added up in blocks, so that a text full of numbers stays cheap.
Patterns use possessive repeats and fixed starting places, so that long runs
of one sign are read once.

Bounds: every candidate fits or calibrates.  Candidates of equal features and
evidence are one weighted row, so the trees read distinct formats, not texts;
what the driver sees is one count for each score that the trees give.

Cases: null text is empty and has no spans.  Null ids and repeated rows are
rows like others.  An empty table, or one where candidates are all wrong, adds
no spans; where they are all right, those of the kinds seen are added.  Further columns are never looked at, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.staging import stage

KINDS = ("email", "ip", "card", "phone")
LOCAL = r"[A-Za-z0-9._%+-]"
# A run is entered at its beginning, or where the match before it ended
BASE = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "email": (
        rf"(?<!{LOCAL}){LOCAL}++(?:@|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9-]++"
        r"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)+"
    ),
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\x20?\.\x20?[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9])",
    "phone": (
        r"(?<![0-9])(?:\+[0-9]{1,3}[\x20.-]?)?\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])"
    ),
}
# What any match holds; most texts are passed over by these plain tests
HINTS = {
    "email": r"@|[(\[]at[)\]]",
    "ip": r"[0-9]\x20?\.\x20?[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){11}",
    "phone": r"\+[0-9]|[0-9]{3}[\x20.-][0-9]{4}",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CUES = r"(?i)(?:mail|phone|tel|call|fax|mobile|card|credit|visa|ip|host|address|contact)\W*$"
FEATURES = (
    "kind", "digits", "length", "signs", "spaces", "brackets", "at", "plus", "before_kind",
    "after_kind", "alone", "cue",
)
SPANS = (
    "array<struct<start:bigint,kind:int,end:bigint,match:string,before:string,after:string>>"
)
TREES, DEPTH, SEED = 12, 3, 17
PRECISION = 0.95
BAND = 64
BLOCK = 128


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, though it stands in several places."""
    return F.transform(F.array(value), use)[0]


def _fold(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda s, x: s + x)


def running(sizes: Column) -> Column:
    """Sums of the sizes up to each, itself included; blocks keep it far from quadratic."""

    def by_blocks(values: Column) -> Column:
        n = F.size(values)
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
            lambda b: _fold(F.slice(values, b * BLOCK + 1, BLOCK)),
        )

        def add(sums: Column) -> Column:
            starts = F.transform(sums, lambda _, b: _fold(F.slice(sums, 1, b)))
            return let(
                starts,
                lambda at: F.transform(
                    values,
                    lambda _, i: at[F.floor(i / BLOCK).cast("int")]
                    + _fold(F.slice(values, (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), i % BLOCK + 1)),
                ),
            )

        return let(blocks, add)

    empty = F.array().cast("array<bigint>")
    return let(sizes, lambda v: F.when(F.size(v) == 0, empty).otherwise(by_blocks(v)))


def found(text: Column, pattern: str, kind: int) -> Column:
    """Matches as structs of start, kind, end, match, before and after."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern)

    def spans(m: Column, g: Column) -> Column:
        sizes = F.transform(
            m,
            lambda _, i: (
                F.char_length(g[i])
                + F.when(i > 0, F.char_length(F.get(m, i - 1))).otherwise(0)
            ).cast("long"),
        )
        return let(
            running(sizes),
            lambda starts: F.transform(
                m,
                lambda x, i: F.struct(
                    starts[i].alias("start"),
                    F.lit(kind).alias("kind"),
                    (starts[i] + F.char_length(x)).alias("end"),
                    x.alias("match"),
                    F.substring(g[i], -24, 24).alias("before"),
                    F.substring(g[i + 1], 1, 4).alias("after"),
                ),
            ),
        )

    every = let(matches, lambda m: let(gaps, lambda g: spans(m, g)))
    return F.when(text.rlike(HINTS[KINDS[kind]]), every).otherwise(
        F.array().cast(SPANS)
    )


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    n = F.length(digits)

    def step(total: Column, i: Column) -> Column:
        digit = F.substr(digits, n - i + 1, F.lit(1)).cast("int")
        double = digit * 2
        folded = double - F.when(double > 9, 9).otherwise(0)
        return total + F.when(i % 2 == 0, folded).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)
    return F.when(n > 0, total % 10 == 0).otherwise(False)


def _octets(match: Column) -> Column:
    return match.rlike(rf"^{OCTET}(?:\x20?\.\x20?{OCTET}){{3}}$")


def _valid(kind: str, match: Column) -> Column:
    size = F.length(_digits(match))
    if kind == "ip":
        return _octets(match)
    if kind == "card":
        return F.when((size >= 12) & (size <= 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return (size >= 9) & (size <= 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """The base spans as a struct of one array a kind, by start."""

    def plain(kind: str, i: int) -> Column:
        return F.transform(
            F.filter(found(text, BASE[kind], i), _check(kind)),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
        )

    return F.struct(*[plain(k, i).alias(k) for i, k in enumerate(KINDS)])


def _all_base() -> Column:
    """The base spans of a row of ``base`` by start, then kind."""
    return F.array_sort(F.concat(*[F.col("base")[k] for k in KINDS]))


def _last_before(spans: Column, end: Column) -> Column:
    """The last of spans sorted by start that starts before ``end``, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(24))])
    count = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            F.coalesce(F.get(spans, at + step - 1)["start"] < end, F.lit(False)), at + step
        ).otherwise(at),
    )
    return F.get(spans, count - 1)


def _check(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["match"])


def _sign(text: Column) -> Column:
    """0 nothing, 1 white space, 2 letter or digit, 3 another sign."""
    return (
        F.when(F.length(text) == 0, 0.0)
        .when(text.rlike(r"^\s$"), 1.0)
        .when(text.rlike(r"^[\p{L}\p{N}]$"), 2.0)
        .otherwise(3.0)
    )


def _features(span: Column) -> list[Column]:
    match = span["match"]
    digits = _digits(match)
    # Digits that go on next to the match make it a part of something else
    longer = span["before"].rlike(r"[0-9][\x20().-]{0,2}$") | span["after"].rlike(
        r"^[\x20().-]{0,2}[0-9]"
    )
    return [
        span["kind"].cast("double"),
        F.length(digits).cast("double"),
        F.char_length(match).cast("double"),
        F.length(F.regexp_replace(match, r"[\p{L}\p{N}]", "")).cast("double"),
        F.length(F.regexp_replace(match, r"[^\x20]", "")).cast("double"),
        F.length(F.regexp_replace(match, r"[^()\[\]]", "")).cast("double"),
        F.contains(match, F.lit("@")).cast("double"),
        match.startswith("+").cast("double"),
        _sign(F.substring(span["before"], -1, 1)),
        _sign(F.substring(span["after"], 1, 1)),
        (~longer).cast("double"),
        span["before"].rlike(CUES).cast("double"),
    ]


def _evidence(span: Column, kind: str) -> Column:
    """Whether a generator's match is right, by what the features do not show."""
    match = span["match"]
    if kind == "email":
        plain = F.regexp_replace(match, r"\x20?[(\[]at[)\]]\x20?", "@")
        plain = F.regexp_replace(plain, r"\x20?[(\[]dot[)\]]\x20?", ".")
        return plain.rlike(r"^[^@]*[A-Za-z][^@]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}$")
    if kind == "ip":
        return _octets(match) & ~match.rlike(r"(?<![0-9])0[0-9]")
    if kind == "card":
        return _valid(kind, match)
    # No area code begins with 0 or 1, as one in five other numbers does
    return _valid(kind, match) & match.rlike(r"^(?:\+[0-9]{1,3}[\x20.-]?)?\(?[2-9]")


def candidates(text: Column, base: Column) -> Column:
    """Spans of all generators with features, evidence and whether they meet a base span."""
    every = F.concat(*[found(text, GENERATORS[k], i) for i, k in enumerate(KINDS)])

    def describe(span: Column, known: Column) -> Column:
        # Base spans of one kind do not overlap, so only one can reach into a candidate's end
        overlaps, right = F.lit(False), F.lit(False)
        for i, kind in enumerate(KINDS):
            last = _last_before(known[kind], span["end"])
            overlaps = overlaps | F.coalesce(last["end"] > span["start"], F.lit(False))
            right = F.when(span["kind"] == i, _evidence(span, kind)).otherwise(right)
        return F.struct(
            span["start"].alias("start"),
            span["kind"].alias("kind"),
            span["end"].alias("end"),
            right.alias("right"),
            overlaps.alias("overlaps"),
            *[f.alias(n) for n, f in zip((f"f_{n}" for n in FEATURES), _features(span), strict=True)],
        )

    return let(base, lambda known: F.transform(every, lambda span: describe(span, known)))


def _tree(node, span: Column) -> Column:  # noqa: ANN001
    """A fitted tree as nested conditions over a candidate's features."""
    if node.subtreeDepth() == 0:
        return F.lit(float(node.prediction()))
    split = node.split()
    feature = span[f"f_{FEATURES[split.featureIndex()]}"]
    return F.when(
        feature <= F.lit(float(split.threshold())), _tree(node.leftChild(), span)
    ).otherwise(_tree(node.rightChild(), span))


def describe(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text, text_hash, base, candidates: what is found in each text."""
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return (
        rows.withColumn("text_hash", F.xxhash64("text"))
        .withColumn("base", base_spans(F.col("text")))
        .withColumn("candidates", candidates(F.col("text"), F.col("base")))
    )


class Finder:
    """The fitted trees and the threshold of each kind, from the rows of ``describe``."""

    def __init__(
        self,
        described: DataFrame,
        precision: float = PRECISION,
    ) -> None:
        self.trees: list[tuple[float, object]] = []
        self.thresholds: dict[int, float] = {}
        names = [f"f_{n}" for n in FEATURES]
        place = F.xxhash64("text_hash", "start", "kind", "end")
        # Every candidate counts: those that look alike are one row and their number
        counted = stage(
            described.select("text_hash", F.inline("candidates"))
            .select(
                *names,
                F.col("right").cast("double").alias("label"),
                (F.pmod(place, F.lit(2)) == 0).alias("fits"),
            )
            .groupBy(*names, "label", "fits")
            .agg(F.count("*").cast("double").alias("rows"))
            .sort(*names, "label")
        )
        fitting = counted.where("fits")
        # Trees need both labels; without them all candidates have one score
        if fitting.select("label").distinct().count() == 2:
            vectors = VectorAssembler(inputCols=names, outputCol="features").transform(fitting)
            model = GBTClassifier(
                featuresCol="features",
                labelCol="label",
                weightCol="rows",
                maxIter=TREES,
                maxDepth=DEPTH,
                seed=SEED,
            ).fit(vectors)
            self.trees = [
                (float(w), t._call_java("rootNode"))
                for w, t in zip(model.treeWeights, model.trees, strict=True)
            ]
        span = F.struct(*[F.col(n) for n in names])
        scored = counted.where("NOT fits").select(
            F.col("f_kind").cast("int").alias("kind"),
            self.probability(span).alias("p"),
            "rows",
            (F.col("rows") * F.col("label")).alias("right"),
        )
        by_score = scored.groupBy("kind", "p").agg(
            F.sum("rows").alias("rows"), F.sum("right").alias("right")
        )
        # The trees are few and shallow: as many rows as distinct scores they give
        scores: dict[int, list] = {}
        for r in by_score.collect():
            scores.setdefault(r["kind"], []).append((r["p"], r["rows"], r["right"]))
        self.calibrated = int(sum(n for values in scores.values() for _, n, _ in values))
        for kind, values in scores.items():
            # Band by band, so that many sure ones do not vouch for a doubtful format
            rows = right = 0.0
            values = sorted(values, reverse=True)
            for i, (p, n, good) in enumerate(values):
                rows, right = rows + n, right + good
                if rows < BAND and i + 1 < len(values):
                    continue
                if right < precision * rows:
                    break
                self.thresholds[kind] = p
                rows = right = 0.0

    def probability(self, span: Column) -> Column:
        margin = F.lit(0.0)
        for weight, root in self.trees:
            margin = margin + F.lit(weight) * _tree(root, span)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(margin * -2.0))

    def added(self) -> Column:
        """Of ``candidates``, the likely ones apart from base spans and from each other."""

        def likely(span: Column) -> Column:
            most = F.lit(2.0)
            for kind, threshold in self.thresholds.items():
                most = F.when(span["kind"] == kind, F.lit(threshold)).otherwise(most)
            return ~span["overlaps"] & span["right"] & (self.probability(span) >= most)

        none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
        if not self.thresholds:
            return none
        plain = F.transform(
            F.filter(F.col("candidates"), likely),
            lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")),
        )
        # The leftmost of overlapping ones, by start and kind
        return F.aggregate(
            F.array_sort(plain),
            none,
            lambda kept, s: F.when(
                (F.size(kept) > 0) & (F.element_at(kept, -1)["end"] > s["start"]), kept
            ).otherwise(F.concat(kept, F.array(s))),
        )

    def spans(self, described: DataFrame) -> DataFrame:
        """The rows of ``describe`` with base and added: arrays of start, kind, end."""
        added, base = self.added(), _all_base()
        # Of what the generators found, only what meets no base span can be added
        generated = F.size(F.filter("candidates", lambda s: ~s["overlaps"])).cast("long")
        return (
            described.withColumns({"added": added, "n_generated": generated})
            .withColumn("base", base)
            .drop("candidates", "text_hash")
        )


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def mark_personal(
    docs: DataFrame, key: str = "doc_id", text: str = "text", **options  # noqa: ANN003
) -> DataFrame:
    """One row per document: key, counts of base spans by kind, base_sha256, spans.

    ``n_generated`` counts the generators' spans apart from base spans, ``n_added``
    those that the trees select.
    """
    # Not the text: a row's spans and their features
    described = stage(describe(docs, key, text).drop("text"))
    spans = Finder(described, **options).spans(described)

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return spans.select(
        key,
        *[number(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
        "n_generated",
        F.size("added").cast("long").alias("n_added"),
    )


def redact(spans: DataFrame, mask: str = "[{}]") -> DataFrame:
    """The rows of ``Finder.spans`` (text included) with ``redacted``: spans replaced by their kind's mask."""
    names = F.array(*[F.lit(mask.format(k)) for k in KINDS])
    apart = F.aggregate(
        F.array_sort(F.concat("base", "added")),
        F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"),
        lambda kept, s: F.when(
            (F.size(kept) > 0) & (F.element_at(kept, -1)["end"] > s["start"]), kept
        ).otherwise(F.concat(kept, F.array(s))),
    )

    def rewrite(all_spans: Column) -> Column:
        parts = F.transform(
            all_spans,
            lambda s, i: F.concat(
                F.substr(
                    F.col("text"),
                    (F.when(i > 0, F.get(all_spans, i - 1)["end"]).otherwise(0) + 1).cast("int"),
                    (s["start"] - F.when(i > 0, F.get(all_spans, i - 1)["end"]).otherwise(0)).cast("int"),
                ),
                names[s["kind"]],
            ),
        )
        last = F.when(F.size(all_spans) > 0, F.element_at(all_spans, -1)["end"]).otherwise(0)
        rest = F.substr(F.col("text"), (last + 1).cast("int"), F.char_length("text"))
        return F.concat(F.array_join(parts, ""), rest)

    return spans.withColumn("redacted", let(apart, rewrite))
