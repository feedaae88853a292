"""Personal data by weak supervision, in DataFrame and SQL functions alone (operator 10).

Base rules: four patterns with their checks (digits, Luhn, part sizes). Spans
that pass always count. Candidates besides them (card-like numbers, grouped
numbers without a country code, spelled-out addresses, IPv6) are decided by
labelers that vote 1, -1 or abstain (0) on every candidate, base spans too:

    check      the base rule's own verdict
    shape      pattern of a well-formed writing
    gazetteer  known issuer numbers, top-level domains, country codes, reserved networks
    context    a cue word before it (for), a unit, price or version sign (against)
    border     letters or digits glued to it (against)

Expectation-maximisation estimates how reliable each labeler is, on the counts
of vote patterns (at most 4 * 3**5 rows, whatever the input), as one SQL
expression. Its posteriors weight the training rows of the final classifier, a
logistic regression over kind, votes and shape, also on counts.

Matches of a pattern come from ``regexp_extract_all``, their places from the
lengths of what ``split`` leaves between them. Quantifiers are possessive and
runs are entered at their start only, so texts of any length are matched in
linear time and without recursion.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesforge.llm.common import hidden, read_table, stored

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("check", "shape", "gazetteer", "context", "border")
EM_ROUNDS = 30
ADD_AT = 0.9  # probability from which a candidate is added

#: Matches equal those of the documented patterns; (?:\G|(?<!..)) enters a run of
#: characters at its start or where the last match ended.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9](?:[ ().-]*+[0-9])++",
}
#: What a text must have for a match that counts.
NEEDS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]++\.[0-9]", "card": r"[0-9](?:[ -]?[0-9]){12}", "phone": r"\+[0-9]"}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?+[(\[]at[)\]] ?+[a-z0-9-]{1,63}+ ?+(?:\.|[(\[]dot[)\]]) ?+[a-z]{2,24}+",
    "ip": r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])",
    "phone": r"(?<![0-9+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
}
LOOSE_NEEDS = {"email": r"(?i)[(\[]at[)\]]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:", "phone": r"[0-9]{3}[ .-][0-9]{4}"}
SHAPE = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,24}$",
    "ip": r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$",
    "card": r"^(?:[0-9]{16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|3[47][0-9]{13})$",
    "phone": r"^(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}$",
}
GAZETTEER = {
    "email": r"(?i)\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|ch|at|it|nl|test|example)$",
    "ip": r"^(?!0\.|127\.|22[4-9]\.|2[345][0-9]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
}
CUES = r"(?i)(?:e-?mail|mail|contact|phone|tel|telefon|teléfono|téléphone|call|mobile|fax|card|karte|carte|tarjeta|visa|credit|ip|host|server)[^\p{L}]*(?:\p{L}+[^\p{L}]+){0,2}$"
AGAINST = r"(?i)(?:[$€£#§]|\bversion|\bv|\bsection|\bisbn|\bnr|\bno)[ .:]*$"
UNITS = r"^ ?(?:%|€|px\b|kg\b|km\b|cm\b)"
GLUED = r"^[\p{L}\p{N}_]"


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when((n - i) % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), weighed), F.lit(0), lambda a, x: a + x) % 10 == 0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes(kind: str, value: Column) -> Column:
    """Whether a match of the base pattern counts."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda x: F.coalesce(x.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(_digits(value)).between(16, 19) & _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _considered(kind: str, value: Column) -> Column:
    """Matches that become candidates: those that pass, and close ones."""
    if kind == "card":
        return F.length(_digits(value)).between(13, 19)
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda x, y: x + y)


def _steps(between: Column, matched: Column) -> Column:
    """Code points from each match's gap to its end."""
    return F.transform(matched, lambda m, i: F.length(between[i]) + F.length(m))


def _stride(steps: Column) -> Column:
    return F.ceil(F.sqrt(F.size(steps) + 1)).cast("int")


def _let(value: Column, body: callable) -> Column:
    """``body(value)`` with the value computed once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _run_starts(array: Column) -> Column:
    """0, stride, ... below the array's size, at least the 0."""
    return F.sequence(F.lit(0), F.greatest(F.size(array) - 1, F.lit(0)), _stride(array))


def _strides(steps: Column) -> Column:
    """Sums of runs of about the square root of their number, so that a place is
    a sum of few of them and few steps, however many matches a text has."""
    n = _stride(steps)
    return F.transform(F.sequence(F.lit(0), (F.size(steps) / n).cast("int")), lambda j: _sum(F.slice(steps, j * n + 1, n)))


def _candidates(kind: str, strict: bool, between: Column, matched: Column, steps: Column, strides: Column) -> Column:
    """Array of the candidates of one pattern; places in code points."""
    n = _stride(steps)

    def one(i: Column) -> Column:
        value = matched[i]
        run = F.floor(i / n).cast("int")
        start = _sum(F.slice(strides, F.lit(1), run)) + _sum(F.slice(steps, run * n + 1, i - run * n)) + F.length(between[i])
        base = passes(kind, value) if strict else F.lit(False)
        # a card number of 13 to 15 digits is outside the base rule, which says nothing on it
        short = (F.length(_digits(value)) < 16) & _luhn(_digits(value)) if kind == "card" else F.lit(False)
        before, after = F.right(between[i], F.lit(40)), F.left(between[i + 1], F.lit(8))
        vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
        votes = F.array(
            vote(base, F.lit(strict) & ~short),
            vote(value.rlike(SHAPE[kind]), F.lit(strict)),
            vote(_digits(value).rlike(GAZETTEER[kind]) if kind == "card" else value.rlike(GAZETTEER[kind]), F.lit(kind in ("card", "ip"))),
            vote(before.rlike(CUES), before.rlike(AGAINST) | after.rlike(UNITS)),
            vote(F.lit(False), after.rlike(GLUED) | F.right(before, F.lit(1)).rlike(GLUED)),
        )
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), base.alias("base"), votes.alias("votes"),
                        F.least(F.floor(F.length(value) / 4), F.lit(6)).cast("int").alias("size"), (F.length(_digits(value)) * 10 / F.length(value)).cast("int").alias("digits"))

    some = F.filter(F.sequence(F.lit(0), F.size(matched) - 1), lambda i: _considered(kind, matched[i]))
    return F.when(F.size(matched) > 0, F.transform(some, one)).otherwise(F.expr(f"cast(array() as {CANDIDATES})"))


CANDIDATES = "array<struct<kind:int,start:int,end:int,base:boolean,votes:array<int>,size:int,digits:int>>"


def candidates(docs: DataFrame, text: str, out: str) -> DataFrame:
    """``docs`` with the column ``out``: all candidates of the text (null: none)."""
    body, none = F.coalesce(F.col(text), F.lit("")), F.expr("cast(array() as array<string>)")
    patterns = [(k, True, STRICT[k], NEEDS[k]) for k in KINDS] + [(k, False, LOOSE[k], LOOSE_NEEDS[k]) for k in LOOSE]
    names = [hidden(docs, f"pii{i}") for i in range(len(patterns))]
    cut = docs.select("*", *(F.when(body.rlike(need), F.split(body, pattern, -1)).otherwise(none).alias(f"{n}_s") for n, (_, _, pattern, need) in zip(names, patterns)),
                      *(F.when(body.rlike(need), F.regexp_extract_all(body, F.lit(pattern), F.lit(0))).otherwise(none).alias(f"{n}_m") for n, (_, _, pattern, need) in zip(names, patterns)))
    cut = cut.select("*", *(_steps(F.col(f"{n}_s"), F.col(f"{n}_m")).alias(f"{n}_p") for n in names))
    cut = cut.select("*", *(_strides(F.col(f"{n}_p")).alias(f"{n}_q") for n in names))
    arrays = [_candidates(k, strict, *(F.col(f"{n}_{x}") for x in "smpq")) for n, (k, strict, _, _) in zip(names, patterns)]
    found = cut.select(*(F.col(f"`{c}`") for c in docs.columns), F.concat(*arrays).cast(CANDIDATES).alias(out))
    # a candidate beside the base rules must not touch a span of theirs; these are
    # looked at in runs of about the square root of their number, by place
    base = F.array_sort(F.transform(F.filter(out, lambda c: c["base"]), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"))))
    runs = _let(base, lambda b: F.transform(_run_starts(b), lambda i: _let(F.slice(b, i + 1, _stride(b)), lambda part: F.struct(
        F.get(part, F.lit(0))["start"].alias("first"), F.array_max(F.transform(part, lambda x: x["end"])).alias("last"), part.alias("part")))))

    def touches(c: Column, run: Column) -> Column:
        return (run["first"] < c["end"]) & (c["start"] < run["last"]) & F.exists(run["part"], lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))

    free = _let(runs, lambda r: F.filter(out, lambda c: c["base"] | ~F.coalesce(F.exists(r, lambda run: touches(c, run)), F.lit(False))))
    return found.withColumn(out, F.when(F.size(out) > 0, free).otherwise(F.col(out)))


def posteriors(votes: DataFrame, rounds: int = EM_ROUNDS) -> DataFrame:
    """(votes, y) from (votes, n): the probability that a candidate with these
    votes is personal data, by expectation-maximisation.

    One-coin model: labeler j is right with probability a[j] where it votes, and
    true spans have the share ``prior``; both start at 0.8 and 0.5 and are kept
    off 0 and 1. The distinct votes are at most 3 ** labelers rows."""

    def true(state: Column, cast_: Column) -> Column:
        logit = F.transform(state["a"], lambda a: F.log(a / (1 - a)))
        prior = F.log(state["prior"] / (1 - state["prior"]))
        return 1 / (1 + F.exp(-F.aggregate(F.zip_with(cast_, logit, lambda v, w: v * w), prior, lambda s, x: s + x)))

    def total(rows: Column, of: callable) -> Column:
        return F.aggregate(F.transform(rows, of), F.lit(0.0), lambda s, x: s + x)

    def step(state: Column, _: Column) -> Column:
        rows = F.transform("all", lambda p: F.struct(p["votes"].alias("votes"), p["n"].alias("n"), true(state, p["votes"]).alias("y")))

        def right(j: int) -> Column:
            agree = total(rows, lambda p: p["n"] * F.when(p["votes"][j] == 1, p["y"]).when(p["votes"][j] == -1, 1 - p["y"]).otherwise(0.0))
            voted = total(rows, lambda p: p["n"] * F.abs(p["votes"][j]))
            return F.least(F.greatest((agree + 8.0) / (voted + 10.0), F.lit(0.05)), F.lit(0.99))

        prior = (total(rows, lambda p: p["n"] * p["y"]) + 1.0) / (total(rows, lambda p: p["n"]) + 2.0)
        return F.struct(prior.alias("prior"), F.array(*(right(j) for j in range(len(LABELERS)))).alias("a"))

    start = F.struct(F.lit(0.5).alias("prior"), F.array(*[F.lit(0.8)] * len(LABELERS)).alias("a"))
    fitted = votes.groupBy().agg(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n"))).alias("all"))
    fitted = fitted.select("all", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step).alias("state"))
    return fitted.select("state", F.explode("all").alias("p")).select(F.col("p.votes").alias("votes"), true(F.col("state"), F.col("p.votes")).alias("y"))


FEATURES = [f"kind{i}" for i in range(len(KINDS))] + [f"for_{x}" for x in LABELERS] + [f"against_{x}" for x in LABELERS] + ["size", "digits"]


def _features(c: Column) -> list[Column]:
    votes = c["votes"]
    return [*((c["kind"] == i).cast("double") for i in range(len(KINDS))), *((votes[j] == 1).cast("double") for j in range(len(LABELERS))),
            *((votes[j] == -1).cast("double") for j in range(len(LABELERS))), c["size"].cast("double") / 6, c["digits"].cast("double") / 10]


def span_classifier(found: DataFrame, column: str) -> callable:
    """Trains the final classifier on the candidates in ``column`` of ``found``
    and returns it as a function from a candidate to its probability."""
    spans = found.select(F.explode(column).alias("c"))
    counts = stored(spans.groupBy(F.col("c.kind").alias("kind"), F.col("c.votes").alias("votes"), F.col("c.size").alias("size"), F.col("c.digits").alias("digits")).agg(F.count("*").alias("n")), "pii-counts")
    if counts.isEmpty():
        return lambda c: F.lit(0.0)
    believed = stored(posteriors(counts.groupBy("votes").agg(F.sum("n").alias("n"))), "pii-posteriors")
    rows = counts.join(believed, "votes").select(F.struct("kind", "votes", "size", "digits").alias("c"), "n", "y")
    both = rows.select("c", F.inline(F.array(F.struct(F.lit(1.0).alias("label"), (F.col("n") * F.col("y")).alias("weight")), F.struct(F.lit(0.0).alias("label"), (F.col("n") * (1 - F.col("y"))).alias("weight")))))
    table = both.select("label", "weight", *(f.alias(name) for f, name in zip(_features(F.col("c")), FEATURES)))
    table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table)
    model = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False).fit(table)
    weights, bias = [float(x) for x in model.coefficients], float(model.intercept)

    def probability(c: Column) -> Column:
        z = F.lit(bias)
        for w, f in zip(weights, _features(c)):
            z = z + F.lit(w) * f
        return 1 / (1 + F.exp(-z))

    return probability


def personal_data(docs: DataFrame, text: str = "text", out: str = "pii", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with ``out``: array of (kind, start, end, base, ...)
    sorted by kind and start: all base spans and the candidates that the
    classifier gives ``ADD_AT`` or more. Matches of a base pattern that fail its
    check teach the classifier, but are never added. Places are code points from 0, ends
    exclusive. A null or empty text has none. The candidates are written to the
    shared folder once, as everything after needs all of them."""
    found = candidates(docs, text, out)
    found = stored(found.select(*(F.col(f"`{c}`") for c in (keep if keep is not None else docs.columns)), F.col(f"`{out}`")), "pii")
    probability = span_classifier(found, out)
    return found.withColumn(out, F.array_sort(F.filter(out, lambda c: c["base"] | (c["votes"][0] >= 0) & (probability(c) >= ADD_AT))))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by its kind in brackets, as
    <EMAIL>; spans that overlap become one, named after the first. Texts without
    spans stay as they are. An integer column n_chars is set to the new length."""
    spans = hidden(docs, "spans")
    found = personal_data(docs, text, spans)
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS), F.lit(""))
    body = F.col(f"`{text}`")

    def with_reach(sorted_: Column) -> Column:
        """Spans with ``at``, the farthest end before them, and the text's end as the last."""
        ends = F.transform(sorted_, lambda c: c["end"])
        tops = _let(ends, lambda e: F.transform(_run_starts(e), lambda i: F.array_max(F.slice(e, i + 1, _stride(e)))))
        every = F.concat(sorted_, F.array(F.struct(F.length(body).alias("start"), F.length(body).alias("end"), F.lit(len(KINDS)).alias("kind"))))

        def reach(bound: Column, i: Column) -> Column:
            n = _stride(bound["ends"])
            run = F.floor(i / n).cast("int")
            return F.greatest(F.lit(0), F.array_max(F.slice(bound["tops"], F.lit(1), run)), F.array_max(F.slice(bound["ends"], run * n + 1, i - run * n)))

        return _let(F.struct(ends.alias("ends"), tops.alias("tops")), lambda bound: F.transform(
            every, lambda c, i: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), reach(bound, i).alias("at"))))

    def joined(fresh: Column) -> Column:
        """Each span's text before it and its name. Places are counted from the start of
        a run of spans, so that no span counts through the whole text."""
        def run_of(i: Column) -> Column:
            part = F.slice(fresh, i + 1, _stride(fresh))
            return _let(part, lambda p: F.struct(p.alias("part"), p[0]["at"].alias("from"), F.substring(
                body, p[0]["at"] + 1, F.element_at(p, -1)["start"] - p[0]["at"]).alias("text")))

        def put(run: Column) -> Column:
            return F.array_join(F.transform(run["part"], lambda c: F.concat(
                F.substring(run["text"], c["at"] - run["from"] + 1, c["start"] - c["at"]), names[c["kind"]])), "")

        return F.array_join(F.transform(F.transform(_run_starts(fresh), run_of), put), "")

    by_place = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    reached = _let(by_place, with_reach)
    new = _let(F.filter(reached, lambda c: c["start"] >= c["at"]), joined)
    out = found.withColumn(text, F.when(F.size(spans) > 0, new).otherwise(body))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))


def _listed(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", names[c["kind"]], c["start"].cast("string"), c["end"].cast("string"))), ",")


def _number(kind: str, column: str = "pii") -> Column:
    """How many base spans are of this kind."""
    return F.size(F.filter(column, lambda c: c["base"] & (c["kind"] == KINDS.index(kind)))).cast("long")


def op10_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(read_table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("pii", lambda c: c["base"])
    return found.select("doc_id", *(_number(k).alias(f"n_{k}") for k in KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("pii")).alias("spans"))
