from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators import splits

# Published stratum sizes and train counts of the 80/10/10 split.
SIZES = {
    "account_access_security": (677, 542), "address_redirect": (143, 114), "delivery_issue": (17686, 14149),
    "order_cancellation": (513, 410), "prime_billing_cancellation": (531, 425), "refund_request": (1670, 1336),
    "return_wrong_damaged": (3397, 2717), "unauthorized_nonprime_charge": (357, 286), "unmatched_other": (50954, 40763),
}


def test_published_train_quotas(spark):
    strata = spark.createDataFrame([(k, n) for k, (n, _) in SIZES.items()], "stratum string, n long")
    got = {r.stratum: r for r in splits.split_quotas(strata).collect()}
    assert {k: r.train for k, r in got.items()} == {k: t for k, (_, t) in SIZES.items()}
    assert sum(r.validation for r in got.values()) == sum(r.test for r in got.values()) == 7593


def test_split_is_exact_and_stable(spark):
    df = spark.range(1000).select(F.col("id").alias("component_id"), F.when(F.col("id") % 10 < 7, "big").otherwise("small").alias("s"))
    one = {r.component_id: r.split for r in splits.stratified_split(df, "component_id", "s").collect()}
    two = {r.component_id: r.split for r in splits.stratified_split(df.repartition(7), "component_id", "s").collect()}
    assert one == two and len(one) == 1000
    assert [sum(v == n for v in one.values()) for n in ("train_retrieval", "validation", "test")] == [800, 100, 100]


def test_mixed_sample_backfills(spark):
    def pool(tag, multi, single, start):
        return [(start + i, tag, 3) for i in range(multi)] + [(start + multi + i, tag, 1) for i in range(single)]

    rows = pool("short_single", 20, 2, 0) + pool("few_multi", 1, 30, 100) + pool("tiny", 2, 1, 200) + pool("plain", 9, 9, 300)
    rows += pool("even", 40, 40, 400)
    df = spark.createDataFrame(rows, "component_id long, heuristic_intent string, n_pattern_hits int")
    quotas = {"short_single": 10, "few_multi": 10, "tiny": 10, "plain": 6, "even": 15}
    got = splits.mixed_quota_sample(df, quotas, plain="plain").groupBy("heuristic_intent").agg(
        F.count("*").alias("n"), F.count_if(F.col("n_pattern_hits") >= 2).alias("m")).collect()
    counts = {r.heuristic_intent: (r.n, r.m) for r in got}
    # 0.3 * 15 = 4.5 goes to the even number 4
    assert {k: v for k, v in counts.items() if k != "plain"} == {
        "short_single": (10, 8), "few_multi": (10, 1), "tiny": (3, 2), "even": (15, 4)}
    assert counts["plain"][0] == 6


def test_labels_and_violations(spark):
    golden = spark.createDataFrame(
        [(f"g{i:04d}", i, i, "t", "refund_request", "", "", "in", "note" if i else "") for i in range(4)], schemas.GOLDEN)
    labels = spark.createDataFrame(
        [("g0000", "Refund Request", "Easy", "n"), ("g0001", "Refund Request", "Easy", ""), ("g0002", "Nonsense", "Never", None),
         ("g0009", "", None, "")], schemas.LABELS)
    notes = [r.annotator_notes for r in splits.apply_labels(golden, labels).orderBy("golden_id").collect()]
    assert notes == ["n", "note", "note", "note"]
    checks = {r["check"]: r.violations for r in splits.validate_labels(golden, labels).collect()}
    assert checks == {
        "golden id without label": 1, "label without golden id": 1, "size difference": 0, "intent not allowed": 1,
        "difficulty not allowed": 1, "intent empty": 1, "difficulty empty": 1}


def test_leakage(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "component_id long")
    got = {r["check"]: r.overlap for r in splits.leakage_check({"a": (ids(1, 2, 2), ids(2, 3)), "b": (ids(1), ids(2))}).collect()}
    assert got == {"a": 1, "b": 0}
    twice = spark.createDataFrame([(1, "x", False, "test"), (1, "x", False, "validation"), (2, "x", False, "test")], schemas.ASSIGNMENT)
    assert [r.component_id for r in splits.split_violations(twice).collect()] == [1]


def test_null_stratum_keeps_its_rows(spark):
    rows = spark.createDataFrame([(k, None if k % 4 == 0 else "a") for k in range(20)], "id int, s string")
    found = splits.stratified_split(rows, "id", "s").groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in found} == {None: 5, "a": 15}
