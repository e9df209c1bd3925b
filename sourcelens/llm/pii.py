"""Personal data by weak supervision, in built-in functions only.

Three labelers vote on every candidate span: a shape expression, a gazetteer and the words before it.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is for each
kind; its posteriors train a logistic span classifier on coarse span features. Both fits run over counts
of all documents, whose number of distinct patterns is bounded by the features, not by the data.

Base kinds (``email ip card phone``) keep every span that passes its check, whatever the classifier says;
spans of the added kinds (``ssn iban mailto account``) stay where the classifier gives 0.5 or more. Bare numbers
(``account``) are candidates wherever they stand; for them words before that name an account speak for a span, and
their absence against it, so the classifier drops most.

Nulls and empty texts give no spans; repeated rows are handled row by row; an empty table gives an empty
table and the prior model; columns other than the text pass through untouched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows
from .native_spans import add_spans, joined

BASE = ("email", "ip", "card", "phone")
ADDED = ("ssn", "iban", "mailto", "account")
KINDS = BASE + ADDED

#: Matches are those of the plain patterns; starts inside a run that already failed are not tried again.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "ssn": r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z.-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "mailto": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,63}"
              r"(?:\x20?(?:\.|[\[(](?:dot|DOT)[\])])\x20?[A-Za-z0-9-]{2,63}){1,4}",
    "account": r"(?<![0-9A-Za-z.+/-])[0-9]{8,19}(?![0-9A-Za-z./-])",
}
#: Substrings or short expressions without which a pattern cannot match.
NEEDS_WORD = {"email": ("@",), "phone": ("+",), "mailto": ("at]", "at)", "AT]", "AT)")}
NEEDS_SHAPE = {
    "ip": r"[0-9]\.[0-9]+\.[0-9]",
    "card": r"(?:[0-9][\x20-]?){12}[0-9]",
    "ssn": r"-[0-9][0-9]-[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}[\x20A-Z0-9]",
    "account": r"[0-9]{8}",
}

# Word lists of the gazetteer and context labelers.
TLDS = ("com org net edu gov mil int info biz io co us uk de fr es it nl be ch at se no fi dk pl pt ie cz "
        "eu ca au nz jp cn kr in br mx ar cl za ru").split()
COUNTRY_CODES = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 "
                 "62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()
IBAN_COUNTRIES = ("AD AE AL AT AZ BA BE BG BH BR CH CY CZ DE DK EE ES FI FR GB GI GR HR HU IE IL IS IT KW LI "
                  "LT LU LV MC MD ME MK MT NL NO PL PT RO RS SA SE SI SK SM TR").split()
CONTEXT_FOR = (r"(?i)(mail|contact|write to|tel|phone|call|fax|mobile|address|card|visa|mastercard|amex|"
               r"paid|ssn|social security|iban|account|konto|compte|cuenta|login|from ip|host)[^0-9A-Za-z]{0,12}$")
CONTEXT_ACCOUNT = (r"(?i)(account|acct|konto|kontonummer|compte|cuenta|customer|client|kunde|kundennummer|member|policy|"
                   r"patient|passport|licen[cs]e|insurance)(\x20(no|nr|number|id)\.?)?[:#=\x20]{0,4}$")
CONTEXT_AGAINST = (r"(?i)(version|release|build|isbn|issn|order|part|sku|section|figure|fig|no|nr|doi|"
                   r"chapter|page|v)[.:#\x20]{0,3}$")

VOTES = (-1, 0, 1)
LABELERS = ("shape", "gazetteer", "context")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    """The base check of a kind; matches that fail it are dropped."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda x: F.coalesce(
            F.when(F.length(F.ltrim(x, F.lit("0"))) <= 3, F.ltrim(x, F.lit("0")).try_cast("int")),
            F.when(F.ltrim(x, F.lit("0")) == "", F.lit(0)), F.lit(999)) <= 255)
    if kind == "card":
        n = F.length(_digits(value))
        return n.between(13, 19) & F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0)).cast("int")


def _shape(kind: str, v: Column) -> Column:
    if kind == "email":
        return _vote(v.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@.*\.[A-Za-z]{2,24}$") & ~v.contains(".."),
                     v.contains("..") | v.rlike(r"\.[0-9]+$"))
    if kind == "ip":
        return _vote(~v.rlike(r"(^|\.)0[0-9]"), v.rlike(r"(^|\.)0[0-9]"))
    if kind == "card":
        return _vote(v.rlike(r"^[0-9]{13,19}$|^([0-9]{4}[ -]){3}[0-9]{1,7}$"), v.rlike("^0|--"))
    if kind == "phone":
        return _vote(v.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?([ .-]?[0-9]{2,5}){1,4}$"), v.rlike(r"[.( -]{3}"))
    if kind == "ssn":
        return _vote(~v.rlike(r"^(000|666|9)|-00-|-0000$"), v.rlike(r"^(000|666|9)|-00-|-0000$"))
    if kind == "iban":
        return _vote(F.length(F.replace(v, F.lit(" "), F.lit(""))).between(15, 34), F.lit(False))
    if kind == "account":
        return _vote(F.lit(False), v.rlike(r"^(19|20)[0-9]{6}$|^([0-9])\2+$") | (F.length(v) > 16))
    return _vote(v.rlike(r"(?i)(dot|\.)[\])]?\x20?[a-z]{2,6}$"), F.lit(False))


def _gazetteer(kind: str, v: Column) -> Column:
    if kind in ("email", "mailto"):
        # the end of the value alone: a search for it from every place of a very long one would be quadratic
        known = F.lower(F.regexp_extract(F.right(v, F.lit(64)), r"([A-Za-z0-9-]+)$", 1)).isin(TLDS)
        return _vote(known, ~known)
    if kind == "ip":
        reserved = v.rlike(r"^(0|255)\.|^127\.|\.0\.0\.0$")
        return _vote(~reserved, reserved)
    if kind == "card":
        issuer = _digits(v).rlike(r"^(4|5[1-5]|2[2-7]|3[47]|30[0-5]|3[689]|6011|64[4-9]|65|35|62)")
        return _vote(issuer, ~issuer)
    if kind == "phone":
        code = F.substring(_digits(v), 1, 1).isin(COUNTRY_CODES) | F.substring(_digits(v), 1, 2).isin(COUNTRY_CODES)
        return _vote(code, F.lit(False))
    if kind == "iban":
        known = F.substring(v, 1, 2).isin(IBAN_COUNTRIES)
        return _vote(known, ~known)
    if kind == "account":  # what checks out as a card is one
        return _vote(F.lit(False), F.length(v).between(13, 19) & F.call_function("luhn_check", v))
    return _vote(F.lit(False), F.lit(False))


def _context(kind: str, before: Column) -> Column:
    if kind == "account":
        return _vote(before.rlike(CONTEXT_ACCOUNT), ~before.rlike(CONTEXT_ACCOUNT))
    return _vote(before.rlike(CONTEXT_FOR), before.rlike(CONTEXT_AGAINST))


def _voted(kind: str, spans: Column) -> Column:
    """Valid spans of a kind with the labelers' votes and the classifier's features."""
    return F.transform(F.filter(spans, lambda x: _valid(kind, x["value"])), lambda x: F.struct(
        F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
        _shape(kind, x["value"]).alias("shape"), _gazetteer(kind, x["value"]).alias("gazetteer"),
        _context(kind, x["before"]).alias("context"),
        F.least(F.lit(3), F.floor(F.length(_digits(x["value"])) / 5)).cast("int").alias("digits"),
        F.least(F.lit(3), F.floor((x["end"] - x["start"]) / 8)).cast("int").alias("length"),
        F.when(x["before"].rlike(r"[\s(\"'<,:;]$") | (F.length(x["before"]) == 0), F.lit(1))
        .otherwise(F.lit(0)).alias("bounded")))


def candidates(df: DataFrame, text: str = "text", out: str = "pii_candidates") -> DataFrame:
    """Add ``out``: every candidate span with its kind, votes and features, by kind and start."""
    parts = []
    df = df.withColumn("__pii_text", F.coalesce(F.col(text).cast("string"), F.lit("")))
    body = F.col("__pii_text")
    for kind in KINDS:
        wanted = body.rlike(NEEDS_SHAPE[kind]) if kind in NEEDS_SHAPE else F.lit(False)
        for word in NEEDS_WORD.get(kind, ()):
            wanted = wanted | body.contains(word)
        name = f"__pii_{kind}"
        df = add_spans(df, name, "__pii_text", PATTERNS[kind], wanted)
        parts.append(_voted(kind, F.col(name)))
    return df.withColumn(out, F.concat(*parts)).drop("__pii_text", *(f"__pii_{k}" for k in KINDS))


@dataclass
class Model:
    """``prior`` and ``votes`` of each kind from EM; ``weights`` of the span classifier, by feature name."""

    prior: dict = field(default_factory=dict)
    votes: dict = field(default_factory=dict)
    weights: dict = field(default_factory=dict)


def _posterior(model: Model, kind: str, votes: tuple) -> float:
    p, q = model.prior[kind], 1 - model.prior[kind]
    for name, vote in zip(LABELERS, votes):
        p *= model.votes[kind, name, 1][vote]
        q *= model.votes[kind, name, 0][vote]
    return p / (p + q)


def _em(counts: list[tuple[str, tuple, int]], rounds: int = 40, strength: float = 20.0) -> Model:
    """Reliabilities of the labelers by kind; ``strength`` pseudo-spans hold the prior belief."""
    belief = {1: {-1: 0.1, 0: 0.3, 1: 0.6}, 0: {-1: 0.6, 0: 0.3, 1: 0.1}}
    model = Model()
    for kind in KINDS:
        model.prior[kind] = 0.5
        for name in LABELERS:
            for y in (0, 1):
                model.votes[kind, name, y] = dict(belief[y])
        own = [(v, n) for k, v, n in counts if k == kind]
        for _ in range(rounds):
            soft = [(v, n, _posterior(model, kind, v)) for v, n in own]
            total = sum(n for _, n, _ in soft)
            model.prior[kind] = (sum(n * p for _, n, p in soft) + 0.5 * strength) / (total + strength)
            fresh = {}
            for j, name in enumerate(LABELERS):
                for y in (0, 1):
                    mass = {x: strength * belief[y][x] for x in VOTES}
                    for v, n, p in soft:
                        mass[v[j]] += n * (p if y else 1 - p)
                    whole = sum(mass.values())
                    fresh[kind, name, y] = {x: m / whole for x, m in mass.items()}
            model.votes.update(fresh)
    return model


def _features(kind: str, votes: tuple, digits: int, length: int, bounded: int) -> list[str]:
    return ["bias", f"kind={kind}", f"{kind}:digits={digits}", f"{kind}:length={length}", f"bounded={bounded}",
            *(f"{kind}:{name}={vote}" for name, vote in zip(LABELERS, votes))]


def _train(model: Model, rows: list[tuple], steps: int = 300, rate: float = 0.5, decay: float = 1e-3) -> None:
    """Logistic regression on grouped rows with the EM posteriors as soft labels."""
    total = sum(n for *_, n in rows) or 1
    data = [(_features(k, v, d, le, b), _posterior(model, k, v), n / total) for k, v, d, le, b, n in rows]
    w: dict[str, float] = {}
    for names, _, _ in data:
        for x in names:
            w.setdefault(x, 0.0)
    for _ in range(steps):
        grad = {x: decay * v for x, v in w.items()}
        for names, y, share in data:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w[x] for x in names)))))
            for x in names:
                grad[x] += share * (p - y)
        for x in w:
            w[x] -= rate * grad[x]
    model.weights = w


def pattern_counts(df: DataFrame, spans: str = "pii_candidates") -> DataFrame:
    """How often each combination of kind, votes and features occurs in all documents."""
    one = df.select(F.explode(spans).alias("s"))
    keys = ["kind", *LABELERS, "digits", "length", "bounded"]
    return one.select(*(F.col(f"s.{k}").alias(k) for k in keys)).groupBy(*keys).agg(F.count("*").alias("n"))


def fit(df: DataFrame, spans: str = "pii_candidates") -> Model:
    """Fit on the candidates of all rows. At most 8 kinds x 27 votes x 32 features reach the driver.

    ``df`` should be a written table: exploding candidates that are still to be computed makes the optimizer
    repeat their expressions in a filter.
    """
    rows = bounded_rows(pattern_counts(df, spans), len(KINDS) * 27 * 32, "vote patterns")
    rows = sorted((r["kind"], tuple(r[x] for x in LABELERS), r["digits"], r["length"], r["bounded"], r["n"])
                  for r in rows)
    by_votes: dict = {}
    for k, v, *_, n in rows:
        by_votes[k, v] = by_votes.get((k, v), 0) + n
    model = _em([(k, v, n) for (k, v), n in sorted(by_votes.items())])
    _train(model, rows)
    return model


def classify(spans: Column, model: Model) -> Column:
    """Keep base spans and the added spans that the classifier accepts."""
    w = model.weights

    def score(x: Column) -> Column:
        total = F.lit(w.get("bias", 0.0))
        for kind in ADDED:
            own = F.lit(w.get(f"kind={kind}", 0.0))
            for name, values in (("digits", range(4)), ("length", range(4)), *((n, VOTES) for n in LABELERS)):
                for value in values:
                    weight = w.get(f"{kind}:{name}={value}", 0.0)
                    if weight:
                        own = own + F.when(x[name] == value, F.lit(weight)).otherwise(F.lit(0.0))
            total = total + F.when(x["kind"] == kind, own).otherwise(F.lit(0.0))
        for value in (0, 1):
            total = total + F.when(x["bounded"] == value, F.lit(w.get(f"bounded={value}", 0.0))).otherwise(F.lit(0.0))
        return total

    return F.filter(spans, lambda x: x["kind"].isin(*BASE) | (score(x) >= 0.0))


def mask(df: DataFrame, model: Model, text: str = "text", found: str | None = None) -> DataFrame:
    """Replace every found span by ``<KIND>``; overlapping spans become one mask, of the first's kind.

    ``found`` names a column of candidates, which goes; without one the texts are searched here.
    Null texts stay null; the other columns keep their values.
    """
    df = candidates(df, text, "__pii_found") if found is None else df.withColumnRenamed(found, "__pii_found")
    spans = F.array_sort(F.transform(classify(F.col("__pii_found"), model), lambda x: F.struct(
        x["start"].alias("start"), (-x["end"]).alias("back"), x["kind"].alias("kind"))))
    df = df.withColumn("__pii_found", spans)
    body = F.col(text)
    done = F.aggregate(
        F.col("__pii_found"),
        F.struct(F.lit(0).cast("int").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, x: F.when(
            x["start"] >= acc["at"],
            F.struct((-x["back"]).cast("int").alias("at"),
                     F.concat(acc["out"], F.array(F.substring(body, acc["at"] + 1, x["start"] - acc["at"]),
                                                  F.concat(F.lit("<"), F.upper(x["kind"]), F.lit(">")))).alias("out")),
        ).otherwise(F.struct(F.greatest(acc["at"], -x["back"]).cast("int").alias("at"), acc["out"].alias("out"))))
    masked = F.concat(F.array_join(done["out"], ""), F.substring(body, done["at"] + 1, F.length(body)))
    return (df.withColumn(text, F.when(F.size("__pii_found") > 0, masked).otherwise(body)).drop("__pii_found"))


def digest(df: DataFrame, model: Model, spans: str = "pii_candidates") -> DataFrame:
    """One row per document: counts of the base kinds, digest of base spans, all spans as text."""
    base = F.filter(F.col(spans), lambda x: x["kind"].isin(*BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter(F.col(spans), lambda x: x["kind"] == kind)).cast("long")

    return df.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(classify(F.col(spans), model)).alias("spans"))
