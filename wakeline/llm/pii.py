"""Operator 13: personal data by base rules, and by boosted trees over proposed spans.

Base rules (one expression and one check per kind) always count. Beside them, generators of high
recall propose spans that may overlap: looser separators, written-out signs, cards
and phone numbers next to other digits, where the base rules see one run and drop it. Gradient-boosted
trees (Spark ML) judge a proposal by its format (digits, groups, check digit, ...) and its context
(neighbouring characters, cue words); a proposal is added where its score reaches the threshold of its kind.

The trees learn from the table itself: a proposal that agrees with a base span of its kind is
an example of it, any other one is not (few of those are the spans looked for). Every different proposal
takes part: a third of them is held out, the trees are fitted on all others, and a kind's threshold is the
lowest score from which on enough of the held-out ones agree with the base.

Texts are read in one map pass, which keeps spans and features only. The fitted trees become one SQL
expression, so all proposals are judged in a second map pass over the small table: no text and no
proposal of a document is shuffled. Everything is SQL and Spark ML; there are no Python functions.

Expressions are written so that matching stays linear in a text's length: repetitions are possessive,
and a match starts at the start of its run of characters or where the last match ended.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wakeline.llm.tables import stored

KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"

#: per kind the expression of the base rule; possessive, with the same leftmost matches as the plain form
BASE = {
    "email": rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # only runs of 14 to 19 digits: those of other lengths fail the check whole
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
GUARD = {"email": "contains(text, '@')", "ip": "text rlike '[0-9]'", "card": "text rlike '[0-9]'", "phone": "contains(text, '+')"}

#: generators: kind, expression, and what a text must hold to be searched
_AT, _DOT = r"(?:@|[\[({](?:at|AT)[\])}])", r"(?:\.|[\[({](?:dot|DOT)[\])}])"
GENERATORS = (
    ("email", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++ ?{_AT} ?[A-Za-z0-9-]++(?: ?{_DOT} ?[A-Za-z0-9-]++)*+", r"text rlike '@|[(\\[{](at|AT)[)\\]}]'"),
    ("ip", rf"(?<![0-9])[0-9]++(?:[\[(]?\.[\])]?[0-9]++){{3}}+", "text rlike '[0-9]'"),
    ("card", r"(?<![0-9])[0-9](?:[ ._/-]{0,2}[0-9]){12,18}+(?![ ._/-]{0,2}[0-9])", "text rlike '[0-9]'"),
    ("card", r"(?<![0-9])[0-9]{4}([ ._/-]?)[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])", "text rlike '[0-9]'"),
    ("card", r"(?<![0-9])[0-9]{14,19}(?![0-9])", "text rlike '[0-9]'"),
    ("phone", r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,4}(?![0-9])){2,4}+", "contains(text, '+')"),
    ("phone", r"(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", "text rlike '[0-9]'"),
)
CONTEXT = 24
CUES = r"(?i)(?:mail|contact|tel|phone|call|fax|mobile|cell|card|visa|credit|address|host|server|ip)[^a-z0-9]{0,4}$"
_SPAN = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"
_BLOCK = 256
MAX_VALUES = 1024      # more than any feature takes: the trees may split at every value, not at quantiles of some rows
SCORE_STEPS = 1 << 16  # in which scores are counted for the thresholds


@dataclass(frozen=True)
class PiiParams:
    trees: int = 20
    depth: int = 3
    held_out: int = 3            # one in so many of the different proposals calibrates the thresholds
    min_agreement: float = 0.8   # of the held-out proposals from the threshold on (one of each added to the counts)


# ---- spans of an expression ----

def _running(sizes: str) -> str:
    """SQL: the sum of the elements before each element, in blocks, so that no long array is copied per element."""
    empty = "cast(array() as array<bigint>)"
    add = "named_struct('at', a.at + {v}, 'list', array_append(a.list, a.at))"
    blocks = (f"transform(slice(sequence(0, size(z)), 1, cast(ceil(size(z) / {_BLOCK}) as int)), b -> slice(z, b * {_BLOCK} + 1, {_BLOCK}))")
    offsets = f"aggregate(bs, named_struct('at', 0L, 'list', {empty}), (a, x) -> {add.format(v='aggregate(x, 0L, (u, v) -> u + v)')}).list"
    inside = (f"flatten(transform(bs, (x, k) -> aggregate(x, named_struct('at', os[k], 'list', {empty}), (a, v) -> {add.format(v='v')}).list))")
    return (f"transform(array({sizes}), z -> transform(array({blocks}), bs -> "
            f"transform(array({offsets}), os -> {inside})[0])[0])[0]")


def spans_of(pattern: str, guard: str) -> str:
    """SQL: the leftmost non-overlapping matches in ``text``: code points from ``start`` to before ``end``,
    the match, and what stands around it up to the matches beside it."""
    quoted = f"r'{pattern}'"
    count = "slice(sequence(0, size(m)), 1, size(m))"
    sizes = f"transform({count}, i -> bigint(length(p[i]) + length(m[i])))"
    span = (f"named_struct('start', o[i] + length(p[i]), 'end', o[i] + length(p[i]) + length(m[i]), 'match', m[i], "
            f"'before', if(p[i] = '' and i > 0, right(m[i - 1], 1), right(p[i], {CONTEXT})), "
            f"'after', if(p[i + 1] = '' and i + 1 < size(m), left(m[i + 1], 1), left(p[i + 1], {CONTEXT})))")
    found = (f"transform(array(split(text, {quoted}, -1)), p -> transform(array({_running(sizes)}), o -> "
             f"transform({count}, i -> {span}))[0])[0]")
    none = f"cast(array() as {_SPAN})"
    return f"if({guard}, transform(array(regexp_extract_all(text, {quoted}, 0)), m -> if(size(m) = 0, {none}, {found}))[0], {none})"


_DIGITS = "regexp_replace(s.match, '[^0-9]', '')"


def _luhn(digits: str) -> str:
    """SQL: the check digit of a number of up to some dozens of digits is right."""
    each = "int(substring(d, length(d) - i, 1))"
    doubled = f"if(i % 2 = 0, {each}, 2 * {each} - if({each} > 4, 9, 0))"
    return (f"transform(array({digits}), d -> if(length(d) between 2 and 40, "
            f"aggregate(transform(sequence(0, length(d) - 1), i -> {doubled}), 0, (u, v) -> u + v) % 10 = 0, false))[0]")


#: leading zeros do not count
_PART = r"^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"
CHECK = {
    "email": "true",
    "ip": f"forall(split(s.match, '[.]', -1), q -> length(q) < 1000 and q rlike r'{_PART}' or length(q) >= 1000 and ltrim('0', q) rlike r'{_PART}')",
    "card": f"length({_DIGITS}) between 14 and 19 and {_luhn(_DIGITS)}",
    "phone": f"length({_DIGITS}) between 10 and 15",
}


def _side(char: str) -> str:
    """SQL: class of a neighbouring character: none 0, space 1, letter 2, digit 3, quote or bracket 4, other 5."""
    return (f"case when {char} = '' then 0D when {char} rlike r'\\s' then 1D when {char} rlike r'\\p{{L}}' then 2D "
            f"when {char} rlike '[0-9]' then 3D when {char} in ('\"', '(', ')', '[', ']', '<', '>') then 4D else 5D end")


def _features(kind: str) -> dict[str, str]:
    """Format and context of a proposal ``s``, as SQL; ``g`` are its groups of digits."""
    return {
        **{f"is_{k}": "1D" if k == kind else "0D" for k in KINDS},
        "chars": "double(least(length(s.match), 200))",
        "digits": f"double(least(length({_DIGITS}), 40))",
        "groups": "double(least(size(g), 40))",
        "longest_group": "double(least(coalesce(array_max(transform(g, x -> length(x))), 0), 40))",
        "last_group": "if(size(g) = 0, 0D, double(least(length(g[size(g) - 1]), 40)))",
        "largest_group": "coalesce(array_max(transform(g, x -> if(length(x) > 3, 1000D, double(x)))), -1D)",
        "first_digit": "if(size(g) = 0, -1D, double(left(g[0], 1)))",
        "check_digit": f"if({_luhn(_DIGITS)}, 1D, 0D)",
        "letters": "double(least(length(regexp_replace(s.match, '[^A-Za-z]', '')), 200))",
        "marks": "double(least(length(regexp_replace(s.match, '[A-Za-z0-9]', '')), 40))",
        "points": r"double(least(size(regexp_extract_all(s.match, r'[.]|[\[({](?:dot|DOT)[\])}]', 0)), 40))",
        "last_letters": "double(length(regexp_extract(right(s.match, 24), '([A-Za-z]*)$', 1)))",
        "left_side": _side("right(s.before, 1)"),
        "right_side": _side("left(s.after, 1)"),
        "cue": f"if(s.before rlike r'{CUES}', 1D, 0D)",
    }


FEATURES = tuple(_features("email"))


# ---- the map pass over texts ----

def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, base, proposals``: per document the base spans ``(start, kind, end)`` and the proposals
    ``(kind, start, end, match, label, f)``; ``kind`` is a place in :data:`KINDS`."""
    base = ", ".join(
        f"transform(filter({spans_of(BASE[kind], GUARD[kind])}, s -> {CHECK[kind]}), s -> named_struct('start', s.start, 'kind', {k}, 'end', s.end))"
        for k, kind in enumerate(KINDS))
    proposals = ", ".join(
        f"transform({spans_of(pattern, guard)}, s -> transform(array(regexp_extract_all(s.match, '[0-9]+', 0)), g -> "
        f"named_struct('kind', {KINDS.index(kind)}, 'start', s.start, 'end', s.end, 'match', s.match, 'f', array({', '.join(_features(kind).values())})))[0])"
        for kind, pattern, guard in GENERATORS)
    agrees = "exists(base, b -> b.kind = c.kind and 2 * (least(b.end, c.end) - greatest(b.start, c.start)) >= greatest(b.end, c.end) - least(b.start, c.start))"
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    found = text.select("doc_id", F.expr(f"array_sort(concat({base}))").alias("base"), F.expr(f"concat({proposals})").alias("proposals"))
    return found.select("doc_id", "base", F.expr(
        f"transform(proposals, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'match', c.match, 'label', if({agrees}, 1D, 0D), 'f', c.f))"
    ).alias("proposals"))


# ---- trees ----

@dataclass(frozen=True)
class SpanModel:
    """The score of a proposal as SQL over its features ``c.f``, and the least score per kind (None: none is added)."""

    score: str
    thresholds: tuple[float | None, ...]


NO_MODEL = SpanModel("0D", (None,) * len(KINDS))


def tree_sql(tree: str, feature: str) -> str:
    """A regression tree's description as nested conditions over ``feature[i]``."""
    lines = [line.strip() for line in tree.splitlines()[1:] if line.strip()]

    def node(at: int) -> tuple[str, int]:
        if lines[at].startswith("Predict"):
            return f"({float(lines[at].split(':')[1])!r}D)", at + 1
        k, bound = re.fullmatch(r"If \(feature (\d+) <= (\S+)\)", lines[at]).groups()
        low, at = node(at + 1)
        high, at = node(at + 1)  # its Else line repeats the condition
        return f"if({feature}[{k}] <= {float(bound)!r}D, {low}, {high})", at

    return node(0)[0]


def fit_spans(found: DataFrame, params: PiiParams = PiiParams()) -> SpanModel:
    """Fit the trees on the different proposals of :func:`find_spans`, and calibrate them: all of them take part.

    Copies of a proposal count once, so a document that many repeat has no more weight than another. Proposals of
    equal features and label are one row with their number as its weight.
    """
    each = found.select(F.explode("proposals").alias("c")).select("c.*")
    distinct = (each.groupBy("kind", "match").agg(F.max(F.struct("label", "f")).alias("x"))
                .select("kind", F.xxhash64("kind", "match").alias("h"), "x.*"))
    held_out = F.pmod(F.shiftright("h", 32), F.lit(params.held_out)) == 0
    folded = stored(distinct.groupBy("kind", "label", held_out.alias("held"), "f").agg(F.count(F.lit(1)).cast("double").alias("n")).select(
        "kind", "label", "held", "n", *(F.col("f")[k].alias(name) for k, name in enumerate(FEATURES))), "pii-proposals")
    train, held = folded.where("not held"), folded.where("held")
    if train.agg(F.count_distinct("label")).first()[0] < 2:
        return NO_MODEL
    trees = GBTClassifier(maxIter=params.trees, maxDepth=params.depth, maxBins=MAX_VALUES, stepSize=0.3, seed=1, labelCol="label",
                          featuresCol="x", weightCol="n")
    model = trees.fit(VectorAssembler(inputCols=list(FEATURES), outputCol="x").transform(train).select("x", "label", "n"))
    margin = " + ".join(f"({w!r}D) * {tree_sql(t.toDebugString, 'c.f')}" for w, t in zip(model.treeWeights, model.trees))
    score = f"1D / (1D + exp(-2D * ({margin})))"
    judged = held.select("kind", "label", "n", F.struct(F.array(*FEATURES).alias("f")).alias("c")).select("kind", "label", "n", F.expr(score).alias("p"))
    return SpanModel(score, calibrate(judged, params.min_agreement))


def calibrate(judged: DataFrame, min_agreement: float) -> tuple[float | None, ...]:
    """The threshold of each kind from all of ``kind, label, n, p``; scores are counted in steps of 1 / SCORE_STEPS."""
    steps = (judged.where("p >= 0.5").groupBy("kind", F.floor(F.col("p") * SCORE_STEPS).alias("step"))
             .agg(F.min("p").alias("p"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("agreed")))
    rows = steps.collect()  # at most SCORE_STEPS / 2 + 1 counts for each kind
    return tuple(lowest([(r.p, r.n, r.agreed) for r in rows if r.kind == kind], min_agreement) for kind in range(len(KINDS)))


def lowest(counted: list[tuple[float, float, float]], min_agreement: float) -> float | None:
    """The lowest of the scores ``(score, how many, how many agree)`` from which on enough agree; None where none does."""
    best, n, agreed = None, 0, 0
    for p, here, agree in sorted(counted, reverse=True):
        n, agreed = n + here, agreed + agree
        if p >= 0.5 and (agreed + 1) / (n + 2) >= min_agreement:
            best = p
    return best


def threshold(scored: list[tuple[float, float]], min_agreement: float) -> float | None:
    """The lowest score from which on enough agree; None where no score does, or not above a half."""
    counted: dict[float, tuple[int, float]] = {}  # equal scores go together
    for p, y in scored:
        n, agreed = counted.get(p, (0, 0))
        counted[p] = n + 1, agreed + y
    return lowest([(p, *x) for p, x in counted.items()], min_agreement)


# ---- the result ----

def select_spans(found: DataFrame, model: SpanModel) -> DataFrame:
    """``doc_id, base, spans``: base spans, and all spans ``(start, kind, end)`` in order.

    A proposal is added where its score reaches its kind's threshold and it overlaps no base span;
    of added ones of a kind that overlap the longer stays, then the higher score, then the earlier.
    """
    sure = " or ".join(f"c.kind = {k} and c.p >= {t!r}D" for k, t in enumerate(model.thresholds) if t is not None) or "false"
    free = "not exists(base, b -> b.start < c.end and c.start < b.end)"
    scored = f"transform(proposals, c -> named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'p', {model.score}))"
    rank = "struct({0}.end - {0}.start, {0}.p, -{0}.start)"
    beaten = f"exists(added, o -> o.kind = c.kind and o.start < c.end and c.start < o.end and {rank.format('o')} > {rank.format('c')})"
    added = found.select("doc_id", "base", F.expr(f"filter({scored}, c -> ({sure}) and {free})").alias("added"))
    return added.select("doc_id", "base", F.expr(
        f"array_sort(array_distinct(concat(base, transform(filter(added, c -> not {beaten}), c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end)))))"
    ).alias("spans"))


def find_pii(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """``doc_id, base, spans`` of every document: what the base rules find, and all spans (:func:`select_spans`).

    Defined cases: a null or empty text has no spans; repeated rows are judged each, with equal results for
    equal texts; a null doc_id passes through; where the table holds too few proposals to fit or to calibrate a
    kind, nothing is added for it; an empty table gives an empty result; other columns are ignored.
    """
    found = stored(find_spans(docs), "pii-found")
    return select_spans(found, fit_spans(found, params))


def redact(docs: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """``doc_id, text``: every document with each span replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. Cases as in :func:`find_pii`; a null text stays null.
    """
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("_row"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"]), "pii-texts")
    spans = find_pii(numbered.select(F.col("_row").alias("doc_id"), "text"), params).where(F.size("spans") > 0)
    apart = ("aggregate(spans, cast(array() as array<struct<start:bigint,kind:int,end:bigint>>), (a, s) -> "
             "if(size(a) > 0 and s.start < a[size(a) - 1].end, "
             "concat(slice(a, 1, size(a) - 1), array(named_struct('start', a[size(a) - 1].start, 'kind', a[size(a) - 1].kind, "
             "'end', greatest(a[size(a) - 1].end, s.end)))), array_append(a, s)))")
    names = ", ".join(f"'<{k}>'" for k in KINDS)
    before = "if(i = 0, 0L, apart[i - 1].end)"
    kept = f"substring(text, int({before}) + 1, int(s.start - {before}))"
    put = f"array_join(flatten(transform(apart, (s, i) -> array({kept}, array({names})[s.kind]))), '')"
    tail = "substring(text, int(apart[size(apart) - 1].end) + 1)"
    joined = numbered.join(spans.select(F.col("doc_id").alias("_row"), F.expr(apart).alias("apart")), "_row", "left")
    return joined.select("doc_id", F.expr(f"if(apart is null or text is null, text, concat({put}, {tail}))").alias("text"))


def _listed(spans: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return f"array_join(transform({spans}, s -> concat(array({names})[s.kind], ':', s.start, ':', s.end)), ',')"


def op13_boosted_pii(spark, sf_dir):
    spans = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    counts = [F.expr(f"bigint(size(filter(base, b -> b.kind = {k})))").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return spans.select("doc_id", *counts, F.sha2(F.expr(_listed("base")), 256).alias("base_sha256"), F.expr(_listed("spans")).alias("spans"))
