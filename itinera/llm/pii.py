"""Personal data by weak supervision.

Wide patterns propose candidate spans; four labelers vote on each (-1, 0, 1):
the strict pattern, gazetteers, cue words before the span, and the shape of its
digits.  Votes are counted per pattern of votes over the whole corpus (a table
bounded by kinds x 3^labelers).  Expectation-maximisation on that table
estimates each labeler's reliability and each pattern's probability of being
personal data; a logistic span classifier is trained on those probabilities and
scores every candidate.  Base spans (strict patterns) always stay, the
classifier adds to them.  Everything over texts is DataFrame functions; the
driver only iterates over the bounded table.

Offsets are code points.  Java possessive quantifiers and ``\\G`` keep the scans
linear in the text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from itinera.llm.common import table

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "ssn", "iban", "person"]          # the order of spans in results
LABELERS = ["strict", "gazetteer", "context", "shape"]
SPAN = "array<struct<kind:string,start:int,end:int,text:string>>"

LOCAL = r"A-Za-z0-9._%+-"
# kind, cheap test that a text may hold one, pattern.  The first four are the
# base patterns; further ones only feed the classifier.
PATTERNS = [
    ("email", "@", rf"(?:\G|(?<![{LOCAL}]))[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    ("card", r"[0-9](?:[ -]?[0-9]){15}", r"[0-9](?:[ -]?[0-9]){15,}+"),
    ("phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
    ("email", r"[(\[{]at[)\]}]",
     rf"(?<![{LOCAL}])[{LOCAL}]++ ?[(\[{{]at[)\]}}] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[{{]dot[)\]}}]) ?[A-Za-z0-9-]++)++"),
    ("phone", r"[0-9]{3}[ .-][0-9]{4}", r"(?<![0-9+])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    ("ssn", r"[0-9]-[0-9]{2}-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}",
     r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"),
    ("person", r"(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z]",
     r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?+"),
]
N_BASE = len(BASE_KINDS)

# Gazetteers and cue words.
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "eu", "uk", "us", "de", "fr", "es", "it", "nl", "ch"]
CALLING_CODES = ["1", "33", "34", "39", "41", "44", "49", "61", "81", "86", "91"]
IBAN_COUNTRIES = ["AT", "BE", "CH", "DE", "ES", "FR", "GB", "IE", "IT", "LU", "NL", "PT"]
FIRST_NAMES = ["John", "Mary", "James", "Anna", "Peter", "Maria", "Paul", "Laura", "Hans", "Marie", "Carlos", "Julia"]
CUES = {
    "email": ["mail", "contact", "write to", "reach"], "ip": ["ip ", "address", "host", "server"],
    "card": ["card", "visa", "credit", "payment"], "phone": ["phone", "tel", "call", "mobile", "fax"],
    "ssn": ["ssn", "social security"], "iban": ["iban", "account", "bank"],
    "person": ["name", "dear", "by "],
}
AGAINST = ["version", "isbn", "order no", "invoice", "serial", "part no", "section", "build"]
CONTEXT = 40


def found(text: Column, kind: str, test: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches of one pattern with their offsets."""
    whole = rf"(?s)\G(.*?)({pattern})"
    gaps = F.regexp_extract_all(text, F.lit(whole), F.lit(1))
    hits = F.regexp_extract_all(text, F.lit(whole), F.lit(2))
    steps = F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("text")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def add(state, x):
        begin = state["at"] + x["gap"]
        end = begin + F.length(x["text"])
        one = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["text"].alias("text"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(one)).alias("out"))

    spans = F.aggregate(steps, start, add, lambda s: s["out"])
    may = text.contains(test) if test == "@" else text.rlike(test)
    return F.when(may, spans).otherwise(F.array().cast(SPAN))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Digits pass Luhn: every second digit from the right is doubled."""
    n = F.length(number)

    def add(total, i):
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def strict(kind: Column, value: Column) -> Column:
    """The base contract's checks; further kinds have a well-formed text by their pattern."""
    number = digits(value)
    n = F.length(number)
    small = F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
        r"^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    return (F.when(kind == "ip", small)
            .when(kind == "card", F.when(n.between(16, 19), luhn(number)).otherwise(F.lit(False)))
            .when(kind == "phone", n.between(8, 15))
            .otherwise(F.lit(True)))


def votes(text: Column, span: Column) -> list[Column]:
    kind, value = span["kind"], span["text"]
    number = digits(value)
    sign = lambda cond: F.when(cond, 1).otherwise(-1)
    code = F.regexp_extract(value, r"^\+([0-9]+)", 1)
    top = F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1))
    gazetteer = (
        F.when(kind == "email", F.when(top.isin(TOP_DOMAINS), 1).otherwise(0))
        .when(kind == "phone", F.when(F.substring(code, 1, 2).isin(CALLING_CODES) | (code == "1"), 1).otherwise(0))
        .when(kind == "card", sign(value.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)")))
        .when(kind == "ip", sign(value.rlike(r"^(?:[1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.")))
        .when(kind == "iban", sign(F.substring(value, 1, 2).isin(IBAN_COUNTRIES)))
        .when(kind == "person", sign(F.arrays_overlap(F.split(value, " "), F.lit(FIRST_NAMES))))
        .otherwise(sign(~value.rlike("^(?:000|666|9)"))))
    from_ = F.greatest(F.lit(0), span["start"] - CONTEXT)
    before = F.lower(F.substring(text, from_ + 1, span["start"] - from_))
    cue = F.lit(False)
    for k, words in CUES.items():
        cue = cue | ((kind == k) & before.rlike("|".join(words)))
    context = F.when(before.rlike("|".join(AGAINST)), -1).when(cue, 1).otherwise(0)
    shape = F.when((F.length(number) > 3) & (number == F.repeat(F.substring(number, 1, 1), F.length(number))), -1).otherwise(
        F.when(F.length(value) >= 7, 1).otherwise(0))
    named = dict(zip(LABELERS, [sign(strict(kind, value)), gazetteer, context, shape]))
    return [F.coalesce(named[n], F.lit(0)).cast("int").alias(n) for n in LABELERS]


def candidates(text: Column) -> Column:
    """All candidate spans with their votes; ``base`` marks those of the base patterns that pass."""
    def voted(first: bool):
        def one(s):
            base = strict(s["kind"], s["text"]) if first else F.lit(False)
            return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                            base.alias("base"), *votes(text, s))
        return one

    return F.concat(*[F.transform(found(text, k, t, p), voted(i < N_BASE)) for i, (k, t, p) in enumerate(PATTERNS)])


# ---- model: bounded by the number of vote patterns ------------------------------------------

def em(table_: list[tuple[str, tuple[int, ...], int]], rounds: int = 40) -> dict[tuple[str, tuple[int, ...]], float]:
    """Posterior of being personal data for each (kind, votes).  rows: (kind, votes, count).

    One prior per kind, one table P(vote | truth) per labeler, smoothed; starts
    from the share of positive votes.
    """
    post = {(k, v): min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for k, v, _ in table_}
    for _ in range(rounds):
        prior: dict[str, list[float]] = {}
        tell = [[{v: 1.0 for v in (-1, 0, 1)} for _ in LABELERS] for _ in (0, 1)]
        for kind, v, n in table_:
            p = post[kind, v]
            pair = prior.setdefault(kind, [1.0, 1.0])
            for y, w in ((0, (1 - p) * n), (1, p * n)):
                pair[y] += w
                for j, vote in enumerate(v):
                    tell[y][j][vote] += w
        for side in tell:
            for t in side:
                total = sum(t.values())
                for vote in t:
                    t[vote] /= total
        for kind, v, _ in table_:
            logs = [math.log(prior[kind][y]) + sum(math.log(tell[y][j][vote]) for j, vote in enumerate(v)) for y in (0, 1)]
            post[kind, v] = 1 / (1 + math.exp(max(-500.0, min(500.0, logs[0] - logs[1]))))
    return post


def features(kind: str, v: tuple[int, ...]) -> list[float]:
    return [1.0, *[float(x) for x in v], *[float(kind == k) for k in KINDS]]


def span_classifier(rows: list[tuple[str, tuple[int, ...], int]], post: dict, steps: int = 400) -> list[float]:
    """Logistic regression on the posteriors, each pattern weighted by the root of its count."""
    w = [0.0] * (1 + len(LABELERS) + len(KINDS))
    data = [(features(k, v), post[k, v], math.sqrt(n)) for k, v, n in rows]
    total = sum(n for _, _, n in data) or 1.0
    for _ in range(steps):
        g = [0.01 * x for x in w]
        for x, y, n in data:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(w, x))))))
            for j, xj in enumerate(x):
                g[j] += (p - y) * xj * n / total
        w = [a - 1.0 * b for a, b in zip(w, g)]
    return w


def train(docs: DataFrame) -> list[float]:
    """Weights of the span classifier, from the votes over all of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counts = (docs.select(F.explode(candidates(text)).alias("s"))
              .groupBy("s.kind", *[f"s.{n}" for n in LABELERS]).agg(F.count(F.lit(1)).alias("n")))
    rows = sorted((r["kind"], tuple(r[n] for n in LABELERS), r["n"]) for r in counts.collect())
    return span_classifier(rows, em(rows))


def spans(text: Column, weights: list[float]) -> Column:
    """Base spans, and candidates that the classifier accepts and that overlap no base
    span, ordered by kind (KINDS), then start: array of (rank, start, end, kind, base)."""
    weights = [round(w, 9) for w in weights]

    def score(s):
        z = F.lit(weights[0])
        for j, n in enumerate(LABELERS):
            z = z + weights[1 + j] * s[n]
        for j, k in enumerate(KINDS):
            z = z + F.when(s["kind"] == k, weights[1 + len(LABELERS) + j]).otherwise(0.0)
        return z > 0

    def plain(s):
        return F.struct(F.array_position(F.lit(KINDS), s["kind"]).cast("int").alias("rank"), s["start"].alias("start"),
                        s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"))

    every = candidates(text)

    def choose(c):
        base = F.filter(c, lambda s: s["base"])
        more = F.filter(c, lambda s: ~s["base"] & score(s) & ~F.exists(
            base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
        return F.array_sort(F.array_distinct(F.transform(F.concat(base, more), plain)))

    # a one-element transform binds the candidates once
    return F.transform(F.array(every), choose)[0]


def joined(list_: Column) -> Column:
    return F.array_join(F.transform(list_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans for every row.

    Null and empty texts have no spans; repeated rows give a row each; an empty
    table gives no rows (and the classifier keeps its neutral weights, which add
    nothing).  Only doc_id and text are read.
    """
    weights = weights if weights is not None else train(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    got = docs.select("doc_id", spans(text, weights).alias("all"))
    got = got.select("doc_id", "all", F.filter("all", lambda s: s["base"]).alias("base"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return got.select("doc_id", *[count(k) for k in BASE_KINDS],
                      F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def masked(text: Column, list_: Column) -> Column:
    """The text with every span (or run of overlapping spans) replaced by [KIND]."""
    by_start = F.array_sort(F.transform(list_, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state, s):
        piece = F.concat(F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        apart = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(apart, F.concat(state["out"], F.array(piece))).otherwise(state["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(by_start, begin, step, lambda s: F.concat(
        F.array_join(s["out"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(list_) > 0, done).otherwise(text)


def mask_personal_data(docs: DataFrame, weights: list[float] | None = None) -> DataFrame:
    """``docs`` with personal data in text replaced by [KIND] and n_chars, if there,
    set to the new length.  Null texts stay null."""
    weights = weights if weights is not None else train(docs)
    name = next(c for i in range(99) if (c := f"pii_spans_{i}") not in docs.columns)
    out = docs.withColumn(name, spans(F.coalesce(F.col("text"), F.lit("")), weights))
    out = out.withColumn("text", masked(F.col("text"), F.col(name))).drop(name)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))
