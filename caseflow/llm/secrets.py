"""Secret scans: fixed patterns, and character Markov models of random strings and ordinary identifiers.

The patterns give base spans. Besides, every run of at least ``run`` characters of identifiers is a candidate. Two
first-order Markov models of its characters are compared: one of random strings, one of ordinary identifiers. A candidate
whose log-likelihood ratio exceeds ``least`` in total and ``mean`` per character is a span of its own, if it overlaps no
base span. DataFrame functions only.

Both models are trained from labelled samples: random are the values that base patterns found in all documents, and
``generated`` strings from a seeded hash in hexadecimal, base-64 and upper-case forms (so that a corpus without secrets
has a model too); ordinary are all candidates of all documents that overlap no base span. Each different string counts once,
so that a secret does not pass for ordinary by being copied. Since every candidate is in the ordinary sample, its own
counts are left out when it is scored. Counts are grouped sums; a model is a table of at most 80 x 80 numbers.

Defined results. A null text is empty. Equal rows have equal results. Without ordinary candidates their model is uniform.
Places are code points, ends exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm import spans as sp
from caseflow.llm.tables import materialize

#: The base patterns. Only matches that are long enough count.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex")
ASSIGN_LEAST = 12

RUN_CHARS = r"A-Za-z0-9+/_=-"
#: Characters of runs lie between these codes.
LOW, HIGH = 43, 122
WIDTH = HIGH - LOW + 1
GENERATED = 3000
SMOOTHING = 0.1


def found_spans(docs: DataFrame, run: int) -> DataFrame:
    """``doc_id, assign, access, hex, more``: matches in each row; ``more`` are the candidates apart from base spans."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX)):
        rows = sp.with_matches(rows, "text", kind, pattern)
    value = lambda m: F.regexp_extract(m["value"], ASSIGN, 2)
    rows = rows.withColumn("assign", F.filter("assign", lambda m: F.length(value(m)) >= ASSIGN_LEAST))
    rows = sp.with_matches(rows, "text", "run", rf"(?<![{RUN_CHARS}])[{RUN_CHARS}]{{{run},}}+")
    return rows.select("doc_id", *KINDS, sp.apart(F.col("run"), base_spans()).alias("more"))


def base_spans() -> Column:
    return F.concat(*[sp.tagged(F.col(k), k, n) for n, k in enumerate(KINDS)])


def _pairs(strings: DataFrame, random: bool) -> DataFrame:
    """``random, a, b, n``: counts of neighbouring characters in the distinct ``s``; the first one follows code LOW - 1."""
    codes = F.filter(F.transform(F.split("s", ""), lambda c: F.ascii(c)), lambda c: c.between(LOW, HIGH))
    chars = strings.distinct().select(codes.alias("c"))
    both = F.arrays_zip(F.concat(F.array(F.lit(LOW - 1)), F.slice("c", F.lit(1), F.size("c") - 1)).alias("a"), F.col("c").alias("b"))
    pairs = chars.where(F.size("c") > 0).select(F.explode(both).alias("p"))
    return pairs.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.count("*").alias("n")).withColumn("random", F.lit(random))


def fit(found: DataFrame, generated: int = GENERATED, smoothing: float = SMOOTHING) -> list[float]:
    """Log ratios (random to ordinary) of each character after each other one, as rows of WIDTH numbers."""
    spark = found.sparkSession
    seeded = spark.range(generated).select(F.sha2(F.concat(F.lit("random:"), F.col("id")).cast("binary"), 256).alias("h"), F.col("id"))
    form = (
        F.when(F.col("id") % 3 == 0, F.substring("h", 1, 40))
        .when(F.col("id") % 3 == 1, F.substring(F.base64(F.unhex("h")), 1, 40))
        .otherwise(F.substring(F.upper(F.regexp_replace(F.base64(F.unhex("h")), "[+/=]", "")), 1, 24))
    )
    values = F.concat(
        F.transform("assign", lambda m: F.regexp_extract(m["value"], ASSIGN, 2)), F.transform("access", lambda m: m["value"]),
        F.transform("hex", lambda m: m["value"]),
    )
    random = found.select(F.explode(values).alias("s")).unionByName(seeded.select(form.alias("s")))
    ordinary = found.select(F.explode(F.transform("more", lambda m: m["value"])).alias("s"))
    rows = _pairs(random, True).unionByName(_pairs(ordinary, False)).collect()  # at most 2 * 80 * 81 rows
    counts = {flag: {(r["a"], r["b"]): r["n"] for r in rows if r["random"] is flag} for flag in (True, False)}
    sums = {flag: {} for flag in counts}
    for flag, pairs in counts.items():
        for (a, _), n in pairs.items():
            sums[flag][a] = sums[flag].get(a, 0) + n

    def log_p(flag: bool, a: int, b: int) -> float:
        own = 0 if flag else 1
        n, total = counts[flag].get((a, b), 0), sums[flag].get(a, 0)
        return math.log((max(0, n - own) + smoothing) / (max(0, total - own) + smoothing * WIDTH))

    return [log_p(True, a, b) - log_p(False, a, b) for a in range(LOW - 1, HIGH + 1) for b in range(LOW, HIGH + 1)]


def ratio(value: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string under the two models."""
    known = F.split(F.lit(" ".join(f"{x:.6g}" for x in table)), " ").cast("array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c))
    state = F.struct(F.lit(LOW - 1).alias("a"), F.lit(0.0).alias("s"))
    step = lambda acc, b: F.struct(b.alias("a"), (acc["s"] + F.get(known, (acc["a"] - (LOW - 1)) * WIDTH + b - LOW)).alias("s"))
    return F.aggregate(codes, state, step, lambda acc: acc["s"])


def scan(docs: DataFrame, run: int = 16, least: float = 12.0, mean: float = 0.6, **options) -> DataFrame:
    """Each document row's matches by kind (``assign``, ``access``, ``hex``, ``markov``), as ``doc_id`` and arrays."""
    found = materialize(found_spans(docs, run), "secrets")
    table = fit(found, **options)

    def likely(m: Column) -> Column:
        score = ratio(m["value"], table)
        return score >= F.greatest(F.lit(least), F.length(m["value"]) * mean)

    return found.select("doc_id", *KINDS, F.filter("more", likely).alias("markov"))


def report(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for each document row."""
    found = scan(docs, **options)
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(sp.joined(base_spans()), 256).alias("base_sha256"),
        sp.joined(F.concat(base_spans(), sp.tagged(F.col("markov"), "markov", len(KINDS)))).alias("spans"),
    )
