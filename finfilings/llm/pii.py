"""Personal data by weak supervision.  DataFrame functions only.

Patterns propose spans: strict ones, which are always kept if they pass their checks, and
loose ones.  Labelers vote on each proposal — the strict pattern, its check, gazetteers of
known prefixes and endings, words before it, its shape — or abstain.  From the counts of
vote patterns over the whole corpus, expectation-maximisation estimates how reliable each
labeler is and how likely each pattern is personal data.  With these probabilities as soft
labels a logistic regression over votes and length is trained; it decides on the proposals
that no strict pattern settles.  The counts are a bounded table, whatever the corpus.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finfilings.llm.common import settle, table, whole_text
from finfilings.llm.registry import query

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# Strict patterns.  Possessive repeats and the look-behind match what the plain form
# matches, but in one pass over long runs and without recursion.
STRICT = {
    EMAIL: r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    IP: r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    CARD: r"[0-9](?:[\x20-]?[0-9])++",
    PHONE: r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Loose patterns: addresses with the signs spelled out, numbers without a country code.
LOOSE = {
    EMAIL: r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:[\[(](?:dot|DOT)[\])]|\.)\x20?[A-Za-z0-9-]{1,63}+)++",
    PHONE: r"(?<![0-9A-Za-z+.(-])(?:00[1-9][\x20().0-9-]{7,18}[0-9]|\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-][0-9]{3,4})(?![0-9A-Za-z-])",
}
# What a text must hold for a pattern to be tried at all.
NEEDS = {
    ("s", EMAIL): "[@]", ("s", IP): r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", ("s", CARD): r"[0-9][\x20-]?[0-9]", ("s", PHONE): r"\+[0-9]",
    ("l", EMAIL): r"[\[(](?:at|AT)[\])]", ("l", PHONE): r"[0-9]\)?[\x20.-][0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"

# fixed values: gazetteers
ENDINGS = "com org net edu gov mil int info biz io de fr es uk us ca au ch at it nl eu br mx jp cn in ru se no dk pl be pt".split()
CARD_STARTS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36|38)"
DIALLING = r"^\+?(?:00)?(?:1|7|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
BEFORE = {
    EMAIL: r"(?i)(?:mail|contact|write|reach|kontakt|correo|courriel)[^A-Za-z]{0,12}$",
    IP: r"(?i)(?:\bip|host|server|address|adresse|from)[^A-Za-z]{0,12}$",
    CARD: r"(?i)(?:card|visa|master|amex|credit|payment|karte|carte|tarjeta)[^A-Za-z]{0,12}$",
    PHONE: r"(?i)(?:tel|phone|call|fax|mobile|cell|telefon|tél|móvil)[^A-Za-z]{0,12}$",
}
AGAINST = r"(?i)(?:order|invoice|isbn|version|serial|\bref|\bid|\bno\.?|sku|build|\bv|part|article|page)[^A-Za-z]{0,6}$"
SHAPES = {
    EMAIL: r"^[A-Za-z0-9][A-Za-z0-9._+-]*@.*[.][A-Za-z]{2,24}$", IP: r"^[1-9][0-9]{0,2}(?:\.[0-9]{1,3}){3}$",
    CARD: r"^(?:[0-9]{12,19}|(?:[0-9]{4}([\x20-]))(?:[0-9]{4}\1){2}[0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$",
    PHONE: r"^\+?[0-9]{0,4}[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}$",
}
LABELERS = ("strict", "check", "gazetteer", "before", "against", "shape")
#: Characters before a proposal that the context labelers see.
CONTEXT = 32
#: Probability from which a proposal that no strict pattern settles becomes a span.
ACCEPT = 0.9
EM_STEPS, FIT_STEPS = 60, 400


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def found(text: Column, pattern: str, needs: str) -> Column:
    """Matches as ``struct<start,end,value>``, in code points: what lies between matches and
    the matches themselves, in turn, add up to positions.

    The lengths are added up by blocks of about the square root of their number, then
    within a block, so a text of very many matches takes no time that grows with their square.
    """
    def total(lengths: Column) -> Column:
        return F.aggregate(lengths, F.lit(0), lambda s, x: s + x)

    def with_lengths(s: Column) -> Column:
        n = F.size(s["values"])
        lengths = F.zip_with(F.slice(s["gaps"], F.lit(1), n), s["values"], lambda gap, value: F.length(gap) + F.length(value))
        return F.struct(s["values"].alias("values"), lengths.alias("lengths"), F.ceil(F.sqrt(n)).cast("int").alias("step"))

    def with_sums(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), ((F.size(s["values"]) - 1) / s["step"]).cast("int"))
        return F.struct(s["values"].alias("values"), s["lengths"].alias("lengths"), s["step"].alias("step"), F.transform(
            blocks, lambda k: total(F.slice(s["lengths"], k * s["step"] + 1, s["step"]))).alias("sums"))

    def with_before(s: Column) -> Column:
        return F.struct(s["values"].alias("values"), s["lengths"].alias("lengths"), s["step"].alias("step"), F.transform(
            s["sums"], lambda _, k: total(F.slice(s["sums"], F.lit(1), k))).alias("before"))

    def spans(s: Column) -> Column:
        def of(value: Column, i: Column) -> Column:
            block, place = (i / s["step"]).cast("int"), i % s["step"]
            end = F.get(s["before"], block) + total(F.slice(s["lengths"], i - place + 1, place + 1))
            return F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))

        return F.transform(s["values"], of)

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    matched = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("values"), F.split(text, pattern, -1).alias("gaps"))
    placed = _let(matched, lambda m: F.when(F.size(m["values"]) == 0, none).otherwise(
        _let(with_lengths(m), lambda x: _let(with_sums(x), lambda y: _let(with_before(y), spans)))))
    return F.when(text.rlike(needs), placed).otherwise(none)


def _digits(value: Column) -> Column:
    return F.translate(value, "+ ().-", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _passes(kind: int, value: Column) -> Column:
    """The check of a strict match."""
    if kind == IP:
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == CARD:
        digits = F.translate(value, " -", "")
        return F.length(digits).between(12, 19) & _luhn(digits)
    if kind == PHONE:
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    """1 for, 0 against, -1 abstains."""
    voted = F.when(yes, 1)
    return (voted if no is None else voted.when(no, 0)).otherwise(-1)


def _votes(kind: int, strict: bool, value: Column, before: Column) -> Column:
    ok = _passes(kind, value) if strict else F.lit(False)
    digits = _digits(value)
    if kind == EMAIL:
        ending = F.lower(F.regexp_extract(value, r"([A-Za-z0-9-]+)$", 1))
        check = _vote(ending.rlike("^[a-z]{2,24}$"), ending.rlike("^[0-9]"))
        known = _vote(ending.isin(*ENDINGS))
    elif kind == IP:
        check, known = _vote(ok, ~ok), _vote(value.rlike("^(?:10|127|172|192|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\\."))
    elif kind == CARD:
        check, known = _vote(_luhn(digits), ~_luhn(digits)), _vote(digits.rlike(CARD_STARTS), ~digits.rlike(CARD_STARTS))
    else:
        good = F.length(digits).between(9, 15)
        check, known = _vote(good, ~good), _vote(value.rlike(DIALLING))
    return F.array(
        F.when(ok, 1).otherwise(0 if strict else -1), check, known,
        _vote(before.rlike(BEFORE[kind])), F.when(before.rlike(AGAINST), 0).otherwise(-1),
        _vote(value.rlike(SHAPES[kind]), F.lit(True)),
    )


def _voted(text: Column, kind: int, strict: bool):
    """A match with its votes and without its value."""
    def of(s: Column) -> Column:
        before = text.substr(F.greatest(s.start - CONTEXT + 1, F.lit(1)), F.least(s.start, F.lit(CONTEXT)))
        return F.struct(
            s.start.alias("start"), F.lit(kind).alias("kind"), s.end.alias("end"),
            (_passes(kind, s.value) if strict else F.lit(False)).alias("base"),
            F.least(F.floor((s.end - s.start) / 4), F.lit(9)).cast("int").alias("size"),
            _votes(kind, strict, s.value, before).alias("votes"),
        )

    return of


def _proposals(text: Column) -> Column:
    """All proposals of a text."""
    parts = []
    for strict, patterns in ((True, STRICT), (False, LOOSE)):
        for kind, pattern in patterns.items():
            spans = found(text, pattern, NEEDS["s" if strict else "l", kind])
            if kind == CARD:  # runs of other lengths are no proposals
                spans = F.filter(spans, lambda s: F.length(F.translate(s.value, " -", "")).between(12, 19))
            parts.append(F.transform(spans, _voted(text, kind, strict)))
    return F.concat(*parts)


def _reliabilities(patterns: list) -> list[float]:
    """EM over rows ``kind, votes, n``: the probability of personal data of each row.

    A labeler has, per true class, a probability of voting 1 rather than 0; abstaining says
    nothing.  Each kind has its own share of personal data.  It starts from the strict
    labeler being right nine times in ten and the others seven.
    """
    right = [[0.9, 0.9] if name == "strict" else [0.7, 0.7] for name in LABELERS]
    share = dict.fromkeys(range(len(KINDS)), 0.5)
    chance = [0.5] * len(patterns)
    for _ in range(EM_STEPS):
        for k, row in enumerate(patterns):
            yes, no = math.log(share[row["kind"]]), math.log(1 - share[row["kind"]])
            for (a, b), vote in zip(right, row["votes"]):
                if vote >= 0:
                    yes += math.log(a if vote else 1 - a)
                    no += math.log(1 - b if vote else b)
            chance[k] = 1 / (1 + math.exp(max(-35.0, min(35.0, no - yes))))
        for kind in share:
            mine = [(p, r["n"]) for p, r in zip(chance, patterns) if r["kind"] == kind]
            share[kind] = (1 + sum(p * n for p, n in mine)) / (2 + sum(n for _, n in mine))
        for i in range(len(LABELERS)):
            counts = [[9.0, 3.0], [9.0, 3.0]]  # a weak prior that labelers are right
            for p, row in zip(chance, patterns):
                vote = row["votes"][i]
                if vote >= 0:
                    counts[0][0 if vote else 1] += p * row["n"]
                    counts[1][1 if vote else 0] += (1 - p) * row["n"]
            right[i] = [min(0.999, max(0.001, a / (a + b))) for a, b in counts]
    return chance


def _names(row) -> list[tuple]:
    """The features of a proposal: its kind, each labeler's vote on that kind, its length."""
    kind = row["kind"]
    return [("kind", kind, 0), ("size", kind, row["size"]), *[(name, kind, v) for name, v in zip(LABELERS, row["votes"]) if v >= 0]]


def _train(patterns: list, chance: list[float]) -> dict[tuple, float]:
    """Logistic regression on the pattern table, with the chances as labels and a ridge."""
    total = sum(r["n"] for r in patterns) or 1
    weights: dict[tuple, float] = {name: 0.0 for r in patterns for name in _names(r)}
    squares = dict.fromkeys(weights, 1e-6)
    for _ in range(FIT_STEPS):
        slope = {name: 0.002 * w for name, w in weights.items()}
        for row, p in zip(patterns, chance):
            names = _names(row)
            z = sum(weights[x] for x in names)
            g = (1 / (1 + math.exp(-max(-35.0, min(35.0, z)))) - p) * row["n"] / total
            for x in names:
                slope[x] += g
        for x, g in slope.items():  # a step size for each weight
            squares[x] += g * g
            weights[x] -= 0.3 * g / math.sqrt(squares[x])
    return weights


def find_personal_data(documents: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns but the text, by default) and ``spans``.

    ``spans`` are ``struct<start,kind,end,base,p>`` by start, then kind: code points with
    the end exclusive, the kind as a position in ``KINDS``, whether a strict pattern gives
    it, and the classifier's probability.  Strict spans are leftmost and do not overlap
    within a kind; a matched text that fails its check is dropped without another try.
    A span that the method adds overlaps no strict span.

    Null and empty texts have no spans.  Repeated rows have the same spans each; an empty
    table, or one without any proposal, gives no spans.  A column called ``spans`` is
    replaced; others pass through.
    """
    keep = [c for c in (documents.columns if keep is None else keep) if c not in ("spans", text)]
    body = whole_text(text)
    proposed = settle(documents.select(*[F.col(f"`{c}`") for c in keep], body.alias("__body")).select(
        *[F.col(f"`{c}`") for c in keep], _proposals(F.col("__body")).alias("__spans")))
    # at most kinds x sizes x 3^labelers rows
    patterns = proposed.select(F.explode("__spans").alias("s")).groupBy(
        F.col("s.kind").alias("kind"), F.col("s.size").alias("size"), F.col("s.votes").alias("votes"),
    ).agg(F.count("*").alias("n")).orderBy("kind", "size", "votes").collect()
    weights = _train(patterns, _reliabilities(patterns))

    def score(s: Column) -> Column:
        """The regression as an expression: one table of weights per feature."""
        cells = [F.coalesce(F.element_at(_weights("kind", weights), s.kind * 100), F.lit(0.0)), F.coalesce(F.element_at(_weights("size", weights), s.kind * 100 + s["size"]), F.lit(0.0))]
        for k, name in enumerate(LABELERS):
            cells.append(F.coalesce(F.element_at(_weights(name, weights), s.kind * 100 + s.votes[k]), F.lit(0.0)))
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, cells)))

    scored = F.transform("__spans", lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end"), s.base.alias("base"), score(s).alias("p")))
    with_p = proposed.select(*[F.col(f"`{c}`") for c in keep], scored.alias("__spans")).withColumn("__base", F.filter("__spans", lambda s: s.base))
    kept = F.filter("__spans", lambda s: s.base | ((s.p >= ACCEPT) & ~F.exists("__base", lambda b: (b.start < s.end) & (s.start < b.end))))
    return with_p.select(*[F.col(f"`{c}`") for c in keep], F.array_sort(kept).alias("spans"))


def _weights(name: str, weights: dict[tuple, float]) -> Column:
    cells = {kind * 100 + value: w for (n, kind, value), w in weights.items() if n == name}
    return F.create_map(*[F.lit(x) for kv in (sorted(cells.items()) or [(-1, 0.0)]) for x in kv])


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name[s.kind], s.start.cast("string"), s.end.cast("string"))), ",")


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found_in = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s.base)
    count = lambda kind: F.size(F.filter("spans", lambda s: s.base & (s.kind == kind))).cast("long")
    return found_in.select(
        "doc_id", *[count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"),
    )
