"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, and a span classifier decides.

Candidates are the base patterns' matches (mail and network addresses, card and phone numbers) and looser ones: local phone
numbers, social-security-like numbers, spelled-out mail addresses, names behind a title. Three labelers vote yes, no or
not at all on each candidate: one looks at its form, one looks it up in gazetteers (endings of hosts, issuers, calling
codes, given names), one reads the characters before it. Expectation-maximisation finds how often the candidates of a
kind are personal data and how reliable each labeler is, without any labelled span. With the probabilities it gives, a naive
Bayes classifier over the votes, the kind and the form of the span (length, separators, neighbour) is trained. A looser
candidate is reported where that classifier says at least ``least``; base spans are always reported.

DataFrame functions only; EM works on the counts of equal candidates. There are at most 8 kinds x 27 votes x 40 forms of them,
so these counts, taken over all documents, are a table of bounded size.

Defined results. A null text is empty. Equal rows have equal results. Without candidates nothing is reported. Looser
candidates that overlap a base span, or an earlier kind of looser candidate, do not count. Places are code points,
ends exclusive.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm import spans as sp
from caseflow.llm.tables import materialize

#: Base patterns. A match starts where a run does, or where the match before it ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "phone_local": r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9.-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "email_spelled": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]+\x20?[\[(]dot[\])]\x20?[A-Za-z]{2,}",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?",
}
KINDS = [*BASE, *LOOSE]

#: Gazetteers and cue words.
ENDINGS = "com org net edu gov mil int info biz io co me dev app ai de fr es it uk eu ch at nl be se no dk fi pl pt ie us ca mx br ar au nz in jp kr cn"
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 61 64 81 82 86 90 91 351 352 353 358 420"
NAMES = (
    "james mary robert patricia john jennifer michael linda david elizabeth william barbara richard susan joseph jessica thomas sarah "
    "charles karen anna maria peter paul hans marie jean pierre luis carlos juan ana laura sofia lucas emma noah mia"
)
CUES = {
    "email": r"(?i)(mail|contact|write|reach|send)",
    "ip": r"(?i)(\bip\b|address|host|server|client|from)",
    "card": r"(?i)(card|visa|master|amex|credit|debit|pay)",
    "phone": r"(?i)(phone|tel|call|mobile|cell|fax|contact|dial|whatsapp)",
    "phone_local": r"(?i)(phone|tel|call|mobile|cell|fax|contact|dial|whatsapp)",
    "ssn": r"(?i)(ssn|social|security|tax)",
    "email_spelled": r"(?i)(mail|contact|write|reach|send)",
    "name": r"(?i)(name|dear|signed|contact|patient|by)\W*$",
}
COUNTER_CUES = r"(?i)(version|isbn|issn|doi|order|invoice|build|rev|part|serial)\W*$"
CONTEXT = 40

Rows = list[tuple[int, tuple[int, int, int], int, int]]


def _words(text: str) -> Column:
    return F.split(F.lit(text), " ")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


#: What a base match must also be.
VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")).between(0, 3) & (F.coalesce(F.substring(F.regexp_replace(p, "^0+", ""), 1, 3).try_cast("int"), F.lit(0)) <= 255)),
    "card": lambda v: F.when(F.length(_digits(v)).between(12, 19), luhn(_digits(v))).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def _form_vote(kind: str, v: Column) -> Column:
    """1, -1 or 0 by the candidate's own form."""
    if kind == "phone_local":
        good = _digits(v).rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$")
    elif kind == "ssn":
        good = ~v.rlike("^(000|666|9)|-00-|-0000$")
    elif kind == "name":
        return F.lit(0)
    else:
        return F.lit(1)
    return F.when(good, 1).otherwise(-1)


def _list_vote(kind: str, v: Column) -> Column:
    """1, -1 or 0 by gazetteers."""
    if kind in ("email", "email_spelled"):
        return F.when(F.array_contains(_words(ENDINGS), F.lower(F.regexp_extract(v, "([A-Za-z0-9-]+)$", 1))), 1).otherwise(-1)
    if kind == "ip":
        return F.when(v.rlike(r"^(0|10|127|255)\.|^192\.168\.|^169\.254\."), -1).otherwise(0)
    if kind == "card":
        return F.when(_digits(v).rlike("^(4|5[1-5]|2[2-7]|3[47]|35|30|36|38|6)"), 1).otherwise(-1)
    if kind == "phone":
        codes = F.transform(F.array(*[F.lit(n) for n in (1, 2, 3)]), lambda n: F.substring(_digits(v), F.lit(1), n))
        return F.when(F.arrays_overlap(codes, _words(CODES)), 1).otherwise(-1)
    if kind == "name":
        return F.when(F.array_contains(_words(NAMES), F.lower(F.regexp_extract(v, r"\.\x20([A-Za-z]+)", 1))), 1).otherwise(0)
    return F.lit(0)


def _cue_vote(kind: str, before: Column) -> Column:
    return F.when(before.rlike(COUNTER_CUES), -1).when(before.rlike(CUES[kind]), 1).otherwise(0)


def _candidates(kind: str) -> Column:
    """The matches in column ``kind`` with votes and form."""
    place = KINDS.index(kind)

    def describe(m: Column) -> Column:
        v, before = m["value"], m["before"]
        length = F.length(v)
        size = F.when(length <= 11, 0).when(length <= 14, 1).when(length <= 18, 2).when(length <= 24, 3).otherwise(4)
        parts = F.when(v.rlike(r"\x20"), 3).when(v.rlike("-"), 2).when(v.rlike(r"\."), 1).otherwise(0)
        open_ = F.when(before.rlike(r"(^|[\s(\[<\"',;:])$"), 0).otherwise(1)
        return F.struct(
            m["start"].alias("start"), F.lit(place).alias("place"), m["end"].alias("end"), F.lit(kind).alias("kind"),
            F.array(_form_vote(kind, v), _list_vote(kind, v), _cue_vote(kind, before)).alias("votes"), size.alias("size"),
            (parts * 2 + open_).alias("parts"),
        )

    return F.transform(F.col(kind), describe)


def _valid(kind: str) -> Column:
    return F.filter(kind, lambda m: VALID[kind](m["value"]))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")


def candidates(docs: DataFrame) -> DataFrame:
    """``doc_id, base, loose``: what each row holds, with votes and forms."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern in BASE.items():
        rows = sp.with_matches(rows, "text", kind, pattern, CONTEXT)
        if kind != "email":
            rows = rows.withColumn(kind, _valid(kind))
    taken = F.concat(*[sp.tagged(F.col(k), k, n) for n, k in enumerate(BASE)])
    for n, (kind, pattern) in enumerate(LOOSE.items()):
        rows = sp.with_matches(rows, "text", kind, pattern, CONTEXT)
        rows = rows.withColumn(kind, sp.apart(F.col(kind), taken))
        taken = F.concat(taken, sp.tagged(F.col(kind), kind, len(BASE) + n))
    return rows.select("doc_id", F.concat(*map(_candidates, BASE)).alias("base"), F.concat(*map(_candidates, LOOSE)).alias("loose"))


def estimate(rows: Rows, counts: list[int], smoothing: float = 1.0, tolerance: float = 1e-9) -> list[float]:
    """EM: the probability that candidates like each row are personal data.

    Labelers are as reliable on one kind as on another; kinds differ in how often they are personal data.
    """
    p = [min(0.95, max(0.05, 0.5 + 0.2 * sum(votes))) for _, votes, _, _ in rows]
    while True:
        share, total = defaultdict(lambda: smoothing), defaultdict(lambda: 2 * smoothing)
        vote = [[defaultdict(lambda: smoothing), defaultdict(lambda: smoothing)] for _ in range(3)]
        weight = [[3 * smoothing, 3 * smoothing] for _ in range(3)]
        for (kind, votes, _, _), n, yes in zip(rows, counts, p, strict=True):
            share[kind] += n * yes
            total[kind] += n
            for j, v in enumerate(votes):
                for z, w in ((1, n * yes), (0, n * (1 - yes))):
                    vote[j][z][v] += w
                    weight[j][z] += w
        change = 0.0
        for k, (kind, votes, _, _) in enumerate(rows):
            prior = share[kind] / total[kind]
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(vote[j][1][v] / weight[j][1]) - math.log(vote[j][0][v] / weight[j][0]) for j, v in enumerate(votes)
            )
            new = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
            change, p[k] = max(change, abs(new - p[k])), new
        if change < tolerance:
            return p


def fit(found: DataFrame) -> dict[str, dict[int, float]]:
    """The classifier's log-odds by kind, by each vote, and by form."""
    c = F.explode(F.concat("base", "loose")).alias("c")
    table = found.select(c).groupBy("c.place", "c.votes", "c.size", "c.parts").agg(F.count("*").alias("n")).collect()
    table.sort(key=lambda r: (r["place"], r["votes"], r["size"], r["parts"]))
    rows = [(r["place"], tuple(r["votes"]), r["size"], r["parts"]) for r in table]
    counts = [r["n"] for r in table]
    p = estimate(rows, counts)
    yes, no = defaultdict(lambda: defaultdict(lambda: 1.0)), defaultdict(lambda: defaultdict(lambda: 1.0))
    for (kind, votes, size, parts), n, q in zip(rows, counts, p, strict=True):
        for name, value in (("kind", kind), ("size", size), ("parts", parts), *((f"vote{j}", v) for j, v in enumerate(votes))):
            yes[name][value] += n * q
            no[name][value] += n * (1 - q)
    sums = {name: (sum(yes[name].values()), sum(no[name].values())) for name in yes}
    odds = {name: {v: math.log(yes[name][v] / sums[name][0]) - math.log(no[name][v] / sums[name][1]) for v in {*yes[name], *no[name]}} for name in sums}
    if sums:
        prior = math.log(sums["kind"][0] / sums["kind"][1])
        odds["kind"] = {v: x + prior for v, x in odds["kind"].items()}
    return odds


def _log_odds(c: Column, model: dict[str, dict[int, float]]) -> Column:
    parts = {"kind": c["place"], "size": c["size"], "parts": c["parts"], **{f"vote{j}": F.get(c["votes"], F.lit(j)) for j in range(3)}}
    total = F.lit(0.0)
    for name, value in parts.items():
        chosen = F.lit(0.0)
        for v, x in sorted(model.get(name, {}).items()):
            chosen = F.when(value == v, x).otherwise(chosen)
        total = total + chosen
    return total


def scan(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``doc_id, base, more``: base spans and the looser ones that the classifier holds for personal data."""
    found = materialize(candidates(docs), "pii")
    model = fit(found)
    bound = math.log(least / (1 - least))
    return found.select("doc_id", "base", F.filter("loose", lambda c: _log_odds(c, model) >= bound).alias("more"))


def report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` for each document row."""
    found = scan(docs, **options)
    slim = lambda spans: F.transform(spans, lambda c: F.struct(c["start"], c["place"], c["end"], c["kind"]))
    base, more = slim(F.col("base")), slim(F.col("more"))
    return found.select(
        "doc_id", *map(_count, BASE),
        F.sha2(sp.joined(base), 256).alias("base_sha256"), sp.joined(F.concat(base, more)).alias("spans"),
    )
