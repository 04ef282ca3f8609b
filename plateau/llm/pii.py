"""Personal data by weak supervision: labelers vote on spans, expectation-maximisation weighs them, and a span
classifier trained on the outcome decides. All work on texts is DataFrame functions.

Base spans (email, ip, card, phone) are the leftmost non-overlapping matches of their patterns that pass
their checks; they always stay. Looser candidates (numbers without a plus sign, cards that fail a
check, addresses written with "(at)" and "dot") are added where the classifier is sure.

Five labelers vote yes, no or nothing on each candidate: ``regex`` (the strict form of the kind), ``gazetteer`` (top-level
domains, issuer prefixes, country codes, address ranges), ``context`` (cue words around it),
``check`` (Luhn, digit counts, octets, domain labels) and ``edge`` (glued to other characters or not).
Candidates are counted by kind, votes and shape over all documents; this table is as large as the number of
patterns, whatever the corpus. Expectation-maximisation (Dawid-Skene: per kind, each labeler's vote distribution
for true and false spans) gives every pattern a probability, and a logistic regression on votes and shape
is fitted to them. It is applied as a column expression.

The patterns are the contract's with possessive repeats and an anchor at the start of a run, which
changes no match (what follows a run is never in its class) and keeps them linear in the text. Positions are prefix sums of
the lengths of matches and of the pieces between them, in code points.

Defined results: null and empty texts have no spans; null ids and repeated rows each give a row; a document without
candidates has empty ``spans``; without any candidate in the corpus no classifier is needed; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plateau.llm.common import cut

KINDS = ("email", "ip", "card", "phone")     # in the order of the contract
LABELERS = ("regex", "gazetteer", "context", "check", "edge")
ACCEPT = 0.9
EM_ROUNDS = 50
# Prior counts of no, nothing, yes on a true span (mirrored on a false one), and of false candidates.
PRIOR = {"check": (0.1, 2.0, 12.0), "regex": (0.5, 2.0, 8.0)}
FALSE_PRIOR = 5.0

_LOCAL, _HOST = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_HOST}]++(?:\.[{_HOST}]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:\x20?[(\[]at[)\]]\x20?|\x20at\x20|@)[{_HOST}]++"
             rf"(?:(?:\x20?[(\[]dot[)\]]\x20?|\x20dot\x20|\.)[{_HOST}]++)++",
    "number": r"(?<![0-9.])\(?[0-9](?:[\x20().-]{0,2}+[0-9]){6,18}+(?![0-9])",
}
# Cheap tests that every text with a match passes.
_MAY = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike("[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
    # What the base pattern does not take has one of these; plain addresses are base spans already.
    "loose_email": lambda t: t.rlike(r"(?:at|dot)[)\]]|\x20(?:at|dot)\x20"),
    "loose_number": lambda t: t.rlike("[0-9]"),
}

# Common top-level domains and calling codes; cue words of the labelers.
TLDS = ("com", "org", "net", "edu", "gov", "info", "biz", "io", "co", "uk", "de", "fr", "es", "it", "nl", "eu", "us", "ca", "ch", "at",
        "be", "se", "no", "pl", "pt", "br", "mx", "in", "jp", "cn", "au", "ru")
CALLING = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2})"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35|36|30)"
CUES = {
    "email": r"mail|write|contact|e-?mail|reach|correo|courriel|schreib",
    "ip": r"\bip\b|address|host|server|login|adresse",
    "card": r"card|visa|credit|payment|master|karte|carte|tarjeta",
    "phone": r"phone|tel|call|fax|mobile|cell|dial|telefon|ruf",
}
NOT_CUES = r"version|isbn|issn|order|invoice|serial|page|section|build|release|doi"

_SPAN = "array<struct<s:bigint,k:int,e:bigint,v:string,before:string,after:string,base:boolean>>"
_BLOCK = 256


def _running(a: Column) -> Column:
    """Sums of the elements before each element, block by block so that long arrays stay linear."""
    def sums(x: Column) -> Column:
        zero = F.struct(F.lit(0).cast("bigint").alias("t"), F.array().cast("array<bigint>").alias("a"))
        return F.aggregate(x, zero, lambda z, v: F.struct((z["t"] + v).alias("t"), F.concat(z["a"], F.array(z["t"])).alias("a")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(a) - 1) / _BLOCK).cast("int")),
                         lambda b: sums(F.slice(a, b * _BLOCK + 1, F.lit(_BLOCK))))
    outer = sums(F.transform(blocks, lambda x: x["t"]))["a"]
    joined = F.flatten(F.transform(F.arrays_zip(blocks.alias("x"), outer.alias("o")),
                                   lambda z: F.transform(z["x"]["a"], lambda v: v + z["o"])))
    return F.when(F.size(a) > 0, joined).otherwise(F.array().cast("array<bigint>"))


def _place(name: str, kind: int, base: bool) -> Column:
    p, r = F.col(f"p_{name}"), F.col(f"r_{name}")

    def span(v: Column, i: Column) -> Column:
        piece = F.get(p, i)
        start = F.get(r, i) + F.char_length(piece)
        return F.struct(start.alias("s"), F.lit(kind).alias("k"), (start + F.char_length(v)).alias("e"), v.alias("v"),
                        F.right(piece, F.lit(40)).alias("before"), F.left(F.get(p, i + 1), F.lit(12)).alias("after"),
                        F.lit(base).alias("base"))
    return F.transform(f"m_{name}", span)


def _checked(kind: str) -> Column:
    return F.filter(f"s_{kind}", lambda x: passes(kind, x["v"]))


def _of_kind(spans: str, i: int) -> Column:
    return F.filter(spans, lambda x: x["k"] == i)


def find_spans(df: DataFrame, text: str, jobs: dict[str, tuple[str, str, int, bool]]) -> DataFrame:
    """Add one array column per job (name -> pattern, test, kind number, base) with the matches, their places and
    what stands around them."""
    t = F.col(text)
    for name, (pattern, may, _, _) in jobs.items():
        df = df.withColumn(f"m_{name}", F.when(_MAY[may](t), F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))
                           .otherwise(F.array().cast("array<string>")))
    for name, (pattern, _, _, _) in jobs.items():
        df = df.withColumn(f"p_{name}", F.when(F.size(f"m_{name}") > 0, F.split(t, pattern, -1))
                           .otherwise(F.array().cast("array<string>")))
    for name in jobs:
        m, p = F.col(f"m_{name}"), F.col(f"p_{name}")
        lens = F.zip_with(m, F.slice(p, F.lit(1), F.size(m)),
                          lambda x, y: (F.char_length(x) + F.char_length(y)).cast("bigint"))
        df = df.withColumn(f"r_{name}", _running(lens))
    for name, (_, _, kind, base) in jobs.items():
        df = df.withColumn(f"s_{name}", _place(name, kind, base).cast(_SPAN))
    return df.drop(*[f"{c}_{n}" for n in jobs for c in "mpr"])


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _octets(v: Column) -> Column:
    return F.forall(F.split(v, r"\."), lambda o: F.regexp_replace(o, "^0+(?=[0-9])", "").rlike(
        r"^(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})$"))


def passes(kind: str, v: Column) -> Column:
    """The contract's check of a base match."""
    n = F.char_length(_digits(v))
    if kind == "ip":
        return _octets(v)
    if kind == "card":
        return F.when(n.between(12, 19), F.call_function("luhn_check", _digits(v))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("tinyint")


def _by_kind(k: Column, of: dict[str, Column]) -> Column:
    c = None
    for i, kind in enumerate(KINDS):
        c = F.when(k == i, of[kind]) if c is None else c.when(k == i, of[kind])
    return c


def votes(x: Column) -> Column:
    """Votes of the labelers and shape of a candidate."""
    v, k, base, n = x["v"], x["k"], x["base"], F.char_length(_digits(x["v"]))
    before, after = F.lower(x["before"]), F.lower(x["after"])
    bare = ~v.rlike("[^0-9]")
    regex = _by_kind(k, {
        "email": _vote(base | v.rlike(r"[(\[](?:at|dot)[)\]]"), F.lit(False)),
        "ip": _vote(base, F.lit(False)),
        "card": _vote(base | v.rlike(r"^[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"), bare),
        "phone": _vote(base | v.rlike(r"^\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}$"), bare)})
    tld = F.regexp_extract(F.lower(v), r"([a-z0-9-]+)$", 1)
    first = F.regexp_extract(v, r"^0*([0-9]{1,3})", 1).cast("int")
    gaz = _by_kind(k, {
        "email": _vote(tld.isin(*TLDS), ~tld.isin(*TLDS)),
        "ip": _vote(first.between(1, 223), (first == 0) | (first > 223)),
        "card": _vote(_digits(v).rlike(ISSUERS), ~_digits(v).rlike(ISSUERS)),
        "phone": _vote(v.rlike(CALLING), F.startswith(v, F.lit("+")))})
    cue = _by_kind(k, {kind: before.rlike(CUES[kind]) for kind in KINDS})
    check = _by_kind(k, {
        "email": _vote(~v.rlike(r"@-|-\.|\.\.|^\."), v.rlike(r"@-|-\.|\.\.|^\.")),
        "ip": _vote(_octets(v), ~_octets(v)),
        "card": _vote(passes("card", v), ~passes("card", v)),
        "phone": _vote(n.between(9, 15), (n < 7) | (n > 15))})
    glued = before.rlike(r"[\p{L}0-9_]$") | after.rlike(r"^[\p{L}0-9_]")
    return F.struct(k.alias("k"), base.alias("base"), regex.alias("regex"), gaz.alias("gazetteer"),
                    _vote(cue & ~before.rlike(NOT_CUES), before.rlike(NOT_CUES)).alias("context"), check.alias("check"),
                    _vote(~glued, glued).alias("edge"), v.rlike(r"[\x20().-]").alias("parted"),
                    F.least(F.lit(3), F.floor(n / 5)).cast("int").alias("digits"))


FEATURES = ("k", "base", *LABELERS, "parted", "digits")


def expectation(patterns: np.ndarray, count: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Probability that a pattern (kind, then one vote per labeler) is true, by expectation-maximisation.
    The prior counts hold that a labeler is right more often than wrong, and a failed check hardly ever."""
    n, kinds = len(patterns), patterns[:, 0]
    ballots = patterns[:, 1:] + 1                                # 0 no, 1 nothing, 2 yes
    p = 1 / (1 + np.exp(-1.5 * patterns[:, 1:].sum(1)))
    usual = np.array([1.0, 2.0, 4.0])
    prior = {v: [np.array(PRIOR.get(name, usual)) for name in LABELERS] for v in (0, 1)}
    prior[0] = [c[::-1] for c in prior[0]]
    for _ in range(rounds):
        new = np.empty(n)
        for k in np.unique(kinds):
            at = kinds == k
            w = count[at]
            log = np.zeros((at.sum(), 2))
            for z, share in ((0, 1 - p[at]), (1, p[at])):
                log[:, z] = np.log((w @ share + FALSE_PRIOR * (1 - z) + 1) / (w.sum() + FALSE_PRIOR + 2))
                for j in range(ballots.shape[1]):
                    b = ballots[at, j]
                    c = prior[z][j] + np.bincount(b, weights=w * share, minlength=3)
                    log[:, z] += np.log(c / c.sum())[b]
            new[at] = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -50, 50)))
        if np.abs(new - p).max() < 1e-9:
            break
        p = new
    return p


def design(rows: np.ndarray) -> np.ndarray:
    """Inputs of the classifier: kind, base, yes and no of every labeler, shape, 1."""
    k, base, v, parted, digits = rows[:, 0], rows[:, 1], rows[:, 2:7], rows[:, 7], rows[:, 8]
    return np.column_stack([*(k == i for i in range(len(KINDS))), base, *(v.T == 1), *(v.T == -1), parted,
                            *(digits == i for i in range(4)), np.ones(len(rows))]).astype(float)


def train(x: np.ndarray, p: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression on soft labels, Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    weight = count / max(1.0, count.sum()) * min(count.sum(), 1e4)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (q - p)) + 0.1 * w
        step = np.linalg.solve((x * (weight * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(w)), g)
        w -= step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return w


def probability(f: Column, w: np.ndarray) -> Column:
    """The classifier as a column expression over a struct of FEATURES."""
    def as_num(c: Column) -> Column:
        return c.cast("int")
    inputs = [*(as_num(f["k"] == i) for i in range(len(KINDS))), as_num(f["base"]), *(as_num(f[v] == 1) for v in LABELERS),
              *(as_num(f[v] == -1) for v in LABELERS), as_num(f["parted"]), *(as_num(f["digits"] == i) for i in range(4)), F.lit(1)]
    z = F.lit(0.0)
    for c, weight in zip(inputs, w.tolist()):
        z = z + c * F.lit(weight)
    return 1 / (1 + F.exp(-z))


def _listed(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"),
                                                                 x["e"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base and extra: arrays of spans (s, k, e) sorted by start and kind."""
    df = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    jobs = {kind: (PATTERNS[kind], kind, i, True) for i, kind in enumerate(KINDS)}
    jobs |= {"loose_email": (LOOSE["email"], "loose_email", 0, False), "loose_number": (LOOSE["number"], "loose_number", 3, False)}
    df = find_spans(df, "t", jobs).drop("t")
    for kind in KINDS:
        df = df.withColumn(f"s_{kind}", _checked(kind))
    base = F.concat(*[F.col(f"s_{k}") for k in KINDS])
    # A loose number of 13 digits or more is a card's, a shorter one a phone's.
    number = F.transform("s_loose_number", lambda x: x.withField("k", F.when(F.char_length(_digits(x["v"])) >= 13, 2).otherwise(3)))
    df = df.select("id", base.alias("base"), F.concat("s_loose_email", number).alias("loose"))
    free = F.filter("loose", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"])))
    df = df.select("id", "base", free.alias("loose"))
    place = lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))
    marked = lambda c: F.transform(c, lambda x: F.struct(place(x).alias("at"), votes(x).alias("f")))
    df = cut(df.select("id", marked("base").alias("base"), marked("loose").alias("loose")))
    seen = (df.select(F.explode(F.concat("base", "loose")).alias("x")).select("x.f.*")
            .groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n")).collect())   # one row per pattern
    bare = F.array_sort(F.transform("base", lambda x: x["at"]))
    if not seen:
        return df.select("id", bare.alias("base"), F.filter(bare, lambda x: F.lit(False)).alias("extra"))
    rows = np.array([[int(r[c]) for c in FEATURES] for r in sorted(seen, key=lambda r: tuple(int(r[c]) for c in FEATURES))])
    count = np.array([r["n"] for r in sorted(seen, key=lambda r: tuple(int(r[c]) for c in FEATURES))], float)
    weights = train(design(rows), expectation(rows[:, [0, 2, 3, 4, 5, 6]], count), count)
    sure = F.transform(F.filter("loose", lambda x: probability(x["f"], weights) >= ACCEPT), lambda x: x["at"])
    return df.select("id", bare.alias("base"), F.array_sort(sure).alias("extra"))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from ``find_pii``."""
    counts = [F.size(_of_kind("base", i)).cast("bigint").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(F.col("id").alias("doc_id"), *counts, F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        _listed(F.array_sort(F.concat("base", "extra"))).alias("spans"),
                        F.size("extra").cast("bigint").alias("n_added"))
