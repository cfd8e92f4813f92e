"""Personal data by weak supervision (operator 5); DataFrame functions only.

1. Patterns find candidate spans: the strict base kinds, and looser shapes
   (numbers that fail a checksum, phone numbers without a country code, spelt
   out addresses, values after a secret's name).
2. Regex, gazetteer and context labelers vote on each candidate: 1 personal,
   0 not, -1 abstains.
3. Candidates are counted by kind and vote pattern (a bounded table), and
   expectation-maximisation over the counts estimates each labeler's
   reliability and the posterior of each pattern (agreement model, labelers
   independent given the truth).
4. The posteriors train the final span classifier: weighted naive Bayes over
   the votes and over surface features of the span (length, digits, separators,
   what stands around it), again from a bounded table of counts.
5. Base spans stay; other candidates are added where the classifier gives a
   probability of at least one half and no base span overlaps them.

Positions are code points, end exclusive.  They come from splitting a text at
a pattern's matches and summing the lengths.  Patterns are written so that
they take linear time: a match starts only where a run of its characters
starts, and repetitions are possessive.  The spans' places, overlaps and
replacement take time in proportion to their number, too.

Defined results: null and empty texts have no spans; every row gives a row;
empty input trains nothing (no span is added) and gives empty output.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import free_name, staged

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret")

_LOCAL = r"[A-Za-z0-9._%+-]"
#: kind -> (cheap test for a text, pattern of the base matches).  The local
#: part may start after a former match (\G) or where its run starts.
BASE = {
    "email": ("@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (
        r"[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9][ -]?[0-9]",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?+[0-9]){12,}+",
    ),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
}
#: Candidates beyond the base, by kind: (cheap test, pattern, part kept).
LOOSE = {
    "email": (
        r"[\[(] ?(?:at|AT) ?[\])]",
        rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}+ ?[\[(] ?(?:at|AT) ?[\])] ?[A-Za-z0-9-]{{1,63}}+(?:(?:\.| ?[\[(] ?(?:dot|DOT) ?[\])] ?)[A-Za-z0-9-]{{1,63}}+)++",
    ),
    "phone": (
        r"[0-9]{3}[ .-][0-9]{4}",
        r"(?<![0-9A-Za-z.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    ),
    "secret": (
        r"(?i)token|secret|passw|pwd|api[_-]?key",
        r"(?i)(?<![a-z0-9_])(?:[a-z]{1,20}[_-])?(?:token|secret|password|passwd|pwd|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?[A-Za-z0-9+/_.-]{12,}+",
    ),
}

#: Gazetteers.
TOP_DOMAINS = "com|net|org|edu|gov|mil|int|info|biz|io|co|me|eu|de|fr|es|it|uk|us|nl|ch|at|be|pl|se|no|dk|fi|pt|ie|ca|au|jp|cn|in|br|ru"
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0123469]|4[013456789]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"
CONTEXT = {
    "email": r"(?i)(?:mail|contact|write to|reach|from|to)\W{0,4}$",
    "ip": r"(?i)(?:ip|addr\w*|host|server|from|client)\W{0,4}$",
    "card": r"(?i)(?:card|visa|master\w*|amex|credit|debit|pay\w*)\W{0,8}$",
    "phone": r"(?i)(?:phone|tel|call|mobile|cell|fax|contact)\W{0,6}$",
    "secret": r"\W$|^$",
}
#: Context in which a match is rather something else.
AGAINST = {
    "email": r"[/@:]$",
    "ip": r"(?i)(?:version|ver|v|section|release)\W{0,2}$",
    "card": r"(?i)(?:order|invoice|isbn|serial|id|no|number|ref)\W{0,3}$",
    "phone": r"(?i)(?:order|invoice|serial|ref|isbn)\W{0,3}$",
    "secret": r"(?i)example\W{0,3}$",
}
LABELERS = ("shape", "gazetteer", "context", "edges")
FEATURES = ("shape", "gazetteer", "context", "edges", "length", "digits", "breaks")
BEFORE, AFTER = 24, 4
#: First guess of a labeler's reliability, and rounds of the estimation.
RELIABLE, ROUNDS = 0.8, 50
#: A vote's smoothing, in candidates.
SMOOTH = 1.0
#: Numbers that a running result copies at once; code points of a text's chunk.
BLOCK, CHUNK = 256, 1024
SPAN = "array<struct<kind:string,s:int,e:int,m:string,before:string,after:string>>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


def base_valid(kind: str, m: Column) -> Column:
    """The contract's conditions on a match of the base pattern."""
    size = F.length(_digits(m))
    if kind == "ip":
        return m.rlike("^" + r"\.".join([_OCTET] * 4) + "$")
    if kind == "card":
        return (size >= 13) & (size <= 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return (size >= 9) & (size <= 15)
    return F.lit(True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of an associative ``op`` (0 is neutral) over an array
    of whole numbers.

    An array that grows inside an aggregate is copied with every element.  So
    blocks of ``BLOCK`` numbers are run through first, then the blocks' last
    results, and each block is shifted by what came before: time grows with
    the array's length."""
    grown = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        return let(op(acc["at"], x), lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

    def before(acc: Column, block: Column) -> Column:
        return F.struct(op(acc["at"], block["at"]).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

    def run(v: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(v), F.lit(1)), F.lit(BLOCK))
        blocks = F.transform(starts, lambda start: F.aggregate(F.slice(v, start, F.lit(BLOCK)), grown, step))
        return let(blocks, shift)

    def shift(blocks: Column) -> Column:
        return let(
            F.aggregate(blocks, grown, before, lambda acc: acc["out"]),
            lambda carry: F.flatten(
                F.transform(blocks, lambda b, i: let(F.get(carry, i), lambda c: F.transform(b["out"], lambda x: op(c, x))))
            ),
        )

    return let(values, run)


def find(text: Column, kind: str, test: str, pattern: str) -> Column:
    """Matches of ``pattern`` with their places and surroundings."""

    def spans(matches: Column, gaps: Column) -> Column:
        lengths = F.transform(matches, lambda m, i: F.length(F.get(gaps, i)) + F.length(m))
        return let(
            running(lengths, lambda x, y: x + y),
            lambda ends: F.transform(
                matches,
                lambda m, i: F.struct(
                    F.lit(kind).alias("kind"), (F.get(ends, i) - F.length(m)).alias("s"), F.get(ends, i).alias("e"), m.alias("m"),
                    F.right(F.get(gaps, i), F.lit(BEFORE)).alias("before"), F.left(F.get(gaps, i + 1), F.lit(AFTER)).alias("after"),
                ),
            ),
        )

    found = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda matches: let(F.split(text, pattern, -1), lambda gaps: spans(matches, gaps)),
    )
    likely = F.contains(text, F.lit(test)) if test == "@" else text.rlike(test)
    return F.when(likely, found.cast(SPAN)).otherwise(F.array().cast(SPAN))


def _free(other: Column, base: Column) -> Column:
    """The spans of ``other`` that overlap none of ``base``, by their starts.

    In order of the starts, a span meets a base span before it if the
    furthest end so far is beyond its start, and one after it if the next
    start is before its end."""
    far = F.lit((1 << 31) - 1)

    def event(x: Column, at: Column, of_base: Column) -> Column:
        return F.struct(x["s"].alias("s"), of_base.alias("free"), x["e"].alias("e"), at.alias("at"))

    def keep(events: Column) -> Column:
        # the events again backwards, so that the next start is the last seen
        ends = running(F.transform(events, lambda v: F.when(v["free"] == 0, v["e"]).otherwise(0)), F.greatest)
        starts = F.transform(F.reverse(events), lambda v: F.when(v["free"] == 0, far - v["s"]).otherwise(0))
        return let(
            ends,
            lambda end: let(
                running(starts, F.greatest),
                lambda start: F.transform(
                    F.filter(
                        F.transform(
                            events,
                            lambda v, i: F.struct(
                                v["at"].alias("at"),
                                (
                                    (v["free"] == 1) & (F.get(end, i) <= v["s"]) & (far - F.get(start, F.size(events) - 1 - i) >= v["e"])
                                ).alias("free"),
                            ),
                        ),
                        lambda v: v["free"],
                    ),
                    lambda v: F.get(other, v["at"]),
                ),
            ),
        )

    both = F.concat(
        F.transform(base, lambda b: event(b, F.lit(-1), F.lit(0))), F.transform(other, lambda x, i: event(x, i, F.lit(1)))
    )
    return F.when((F.size(base) == 0) | (F.size(other) == 0), other).otherwise(let(F.array_sort(both), keep))


def _by_kind(kind: Column, values: dict[str, Column]) -> Column:
    out = F.lit(-1)
    for name, value in values.items():
        out = F.when(kind == name, value).otherwise(out)
    return out


def votes(x: Column) -> list[Column]:
    """The labelers' votes on a span: 1, 0, or -1 to abstain."""
    kind, m, before, after = x["kind"], x["m"], x["before"], x["after"]
    digits = _digits(m)
    size = F.length(digits)
    shape = _by_kind(kind, {
        "email": m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}(?:@| ?[\[(])").cast("int"),
        "ip": m.rlike("^" + r"\.".join([_OCTET] * 4) + "$").cast("int"),
        "card": F.call_function("luhn_check", digits).cast("int") * (size.between(13, 19)).cast("int"),
        "phone": size.between(9, 15).cast("int"),
        "secret": (m.rlike("[0-9]") & m.rlike(r"[A-Za-z0-9+/_-]{16,}[\"']?$")).cast("int"),
    })
    gazetteer = _by_kind(kind, {
        "email": F.lower(m).rlike(rf"(?:\.|dot[\])] ?)(?:{TOP_DOMAINS})$").cast("int"),
        "ip": F.lit(-1),
        "card": (digits.rlike(CARD_ISSUERS) & F.call_function("luhn_check", digits)).cast("int"),
        "phone": F.when(m.startswith("+"), m.rlike(COUNTRY_CODES).cast("int")).otherwise(-1),
        "secret": m.rlike("(?i)token|secret|password|api").cast("int"),
    })
    context = F.lit(-1)
    for name in KINDS:
        context = F.when(
            kind == name,
            F.when(before.rlike(AGAINST[name]), 0).when(before.rlike(CONTEXT[name]), 1).otherwise(-1),
        ).otherwise(context)
    glued = before.rlike(r"[A-Za-z0-9_@/=]$") | after.rlike(r"^(?:[A-Za-z0-9_@=]|[./-][A-Za-z0-9])")
    edges = F.when(kind == "secret", F.lit(-1)).otherwise((~glued).cast("int"))
    return [shape, gazetteer, context, edges]


def features(x: Column) -> list[Column]:
    """Small integers that describe a span: the votes and surface features."""
    m = x["m"]
    length = F.least(F.length(m) / F.lit(6), F.lit(8)).cast("int")
    digits = (F.length(_digits(m)) * 4 / F.length(m)).cast("int")
    breaks = F.least(F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")), F.lit(4))
    return [*votes(x), length, digits, breaks]


def _spans_of(rows: DataFrame, text: str, base: str, loose: str) -> DataFrame:
    """``rows`` with the found spans; loose ones that overlap a base span go."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = free_name(rows, "_found")
    # base and failing matches of a kind come from one search
    columns = {f"{found}_{k}": find(whole, k, *BASE[k]) for k in BASE_KINDS}
    out = rows.withColumns(columns | {f"{found}_loose": F.concat(*[find(whole, k, t, p) for k, (t, p) in LOOSE.items()])})

    def checked(kind: str, wanted: bool) -> Column:
        return F.filter(F.col(f"{found}_{kind}"), lambda x: base_valid(kind, x["m"]) == wanted)

    valid = [checked(k, True) for k in BASE_KINDS]
    failing = [checked(k, False) for k in BASE_KINDS[1:]]
    out = out.withColumns({base: F.concat(*valid), f"{found}_other": F.concat(*failing, F.col(f"{found}_loose"))})
    return out.withColumn(loose, _free(F.col(f"{found}_other"), F.col(base))).drop(f"{found}_loose", f"{found}_other", *columns)


# --- estimation ---------------------------------------------------------------


def estimate(patterns: dict[tuple, float], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Posterior that a candidate is personal data, for each (kind, votes...).

    Expectation-maximisation of a two-class model: a prior per kind, and per
    labeler the chance of each vote in either class; shared by all kinds.
    """
    n_votes = max((len(p) for p in patterns), default=1) - 1
    kinds = {p[0] for p in patterns}
    prior = dict.fromkeys(kinds, 0.5)
    right = {(j, v, c): (RELIABLE if v == c else 1 - RELIABLE) for j in range(n_votes) for v in (0, 1) for c in (0, 1)}
    post: dict[tuple, float] = {}
    for _ in range(rounds):
        for p in patterns:
            logs = []
            for c in (0, 1):
                share = prior[p[0]] if c else 1 - prior[p[0]]
                logs.append(math.log(max(share, 1e-9)) + sum(math.log(right[j, v, c]) for j, v in enumerate(p[1:]) if v >= 0))
            post[p] = 1 / (1 + math.exp(min(700.0, logs[0] - logs[1])))
        for k in kinds:
            total = sum(n for p, n in patterns.items() if p[0] == k)
            prior[k] = (sum(n * post[p] for p, n in patterns.items() if p[0] == k) + SMOOTH) / (total + 2 * SMOOTH)
        for j in range(n_votes):
            for c in (0, 1):
                weight = {v: SMOOTH * (RELIABLE if v == c else 1 - RELIABLE) * 10 for v in (0, 1)}
                for p, n in patterns.items():
                    if p[j + 1] >= 0:
                        weight[p[j + 1]] += n * (post[p] if c else 1 - post[p])
                for v in (0, 1):
                    right[j, v, c] = weight[v] / (weight[0] + weight[1])
    return post


def train(counts: dict[tuple, float], post: dict[tuple, float]) -> dict[tuple, float]:
    """Weights of the span classifier: log odds of each (kind, feature, value)
    and of each kind, from candidates weighted by their posteriors."""
    cells: dict[tuple, list[float]] = {}
    for p, n in counts.items():
        y = post[p[: len(LABELERS) + 1]]
        for key in [(p[0], "", 0), *((p[0], f, v) for f, v in zip(FEATURES, p[1:], strict=True))]:
            cell = cells.setdefault(key, [0.0, 0.0])
            cell[0] += n * (1 - y)
            cell[1] += n * y
    weights = {}
    for key, (no, yes) in cells.items():
        if not key[1]:
            weights[key] = math.log((yes + SMOOTH) / (no + SMOOTH))
        else:
            all_no, all_yes = cells[key[0], "", 0]
            weights[key] = math.log((yes + SMOOTH) / (all_yes + 2 * SMOOTH)) - math.log((no + SMOOTH) / (all_no + 2 * SMOOTH))
    return weights


def fit(spans: DataFrame, base: str, loose: str) -> dict[tuple, float]:
    """Classifier weights from all candidates of ``spans``."""
    x = F.col("x")
    rows = spans.select(F.explode(F.concat(base, loose)).alias("x")).select(
        F.col("x.kind").alias("kind"), *[f.alias(name) for name, f in zip(FEATURES, features(x), strict=True)]
    )
    table = rows.groupBy("kind", *FEATURES).agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the value sets
    counts = {tuple(r)[:-1]: float(r.n) for r in table}
    patterns: dict[tuple, float] = {}
    for p, n in counts.items():
        patterns[p[: len(LABELERS) + 1]] = patterns.get(p[: len(LABELERS) + 1], 0.0) + n
    return train(counts, estimate(patterns))


def accept(spans: Column, weights: dict[tuple, float]) -> Column:
    """The spans to which the classifier gives a probability of one half."""
    if not weights:
        return F.filter(spans, lambda _: F.lit(False))

    def score(x: Column) -> Column:
        total = F.lit(0.0)
        values = [F.lit(0), *features(x)]
        for name, value in zip(("", *FEATURES), values, strict=True):
            table = {f"{k}:{v}": w for (k, f, v), w in weights.items() if f == name}
            pairs = F.create_map(*[F.lit(c) for item in table.items() for c in item])
            total = total + F.coalesce(F.element_at(pairs, F.concat_ws(":", x["kind"], value.cast("string"))), F.lit(0.0))
        return total

    return F.filter(spans, lambda x: score(x) >= 0)


def _of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def _ordered(spans: Column) -> Column:
    """Spans by kind as listed, then start."""
    parts = [
        F.array_sort(F.transform(_of_kind(spans, k), lambda x: F.struct(x["s"], x["e"], x["kind"])))
        for k in KINDS
    ]
    return F.transform(F.concat(*parts), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: base counts, digest of the base spans, all spans.

    The texts are read once; the candidates, without the texts, are staged.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    spans = staged(_spans_of(rows, "text", "base", "loose").drop("text"), "pii-candidates")
    weights = fit(spans, "base", "loose")
    every = _ordered(F.concat(F.col("base"), accept(F.col("loose"), weights)))
    counts = [F.size(_of_kind(F.col("base"), k)).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return spans.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans")
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; other
    columns, and texts without spans, unchanged.  Overlapping spans are
    replaced together, by the kind of the first."""
    base, loose, cut = (free_name(docs, f"_pii_{n}") for n in ("base", "loose", "cut"))
    found = _spans_of(docs, text_col, base, loose)
    weights = fit(found.select(base, loose), base, loose)
    ordered = F.array_sort(
        F.transform(
            F.concat(F.col(base), accept(F.col(loose), weights)),
            lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")),
        )
    )
    text = F.col(f"`{text_col}`")
    out = found.withColumn(cut, ordered).withColumn(text_col, F.when(F.size(cut) > 0, _replaced(text, F.col(cut))).otherwise(text))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def _replaced(text: Column, spans: Column) -> Column:
    """``text`` with the spans (in order) replaced by marks, those that
    overlap by the first one's.  Pieces of the text are taken from chunks of it,
    so none is looked for from the text's beginning."""

    def piece(chunks: Column, start: Column, stop: Column) -> Column:
        first, last = F.floor(start / CHUNK).cast("int"), F.floor(stop / CHUNK).cast("int")
        at = (start % CHUNK + 1).cast("int")
        here = F.coalesce(F.get(chunks, first), F.lit(""))
        across = F.concat(
            F.substring(here, at, F.lit(CHUNK)),
            F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""),
            F.left(F.coalesce(F.get(chunks, last), F.lit("")), (stop % CHUNK).cast("int")),
        )
        return F.when(first == last, F.substring(here, at, F.greatest(stop - start, F.lit(0)))).otherwise(across)

    def whole(chunks: Column, reach: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            at = F.coalesce(F.get(reach, i - 1), F.lit(0))
            mark = F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))
            return F.when(x["s"] < at, F.lit("")).otherwise(F.concat(piece(chunks, at, x["s"]), mark))

        end = F.element_at(reach, -1)
        rest = F.concat(
            F.substring(F.coalesce(F.get(chunks, F.floor(end / CHUNK).cast("int")), F.lit("")), (end % CHUNK + 1).cast("int"), F.lit(CHUNK)),
            F.array_join(F.slice(chunks, F.floor(end / CHUNK).cast("int") + 2, F.size(chunks) + 1), ""),
        )
        return F.concat(F.array_join(F.transform(spans, one), ""), rest)

    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{CHUNK}}}"), F.lit(0))
    reaches = running(F.transform(spans, lambda x: x["e"]), F.greatest)
    return let(pieces, lambda chunks: let(reaches, lambda reach: whole(chunks, reach)))
