from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators import components, ranks
from caseflow.operators import conversations as conv
from caseflow.operators.joins import skewed_join

T0 = "Tue Oct 31 22:10:%02d +0000 2017"


def raw(spark, rows):
    """rows: id, component, author, inbound, second or text date, text"""
    full = [(i, c, a, b, T0 % s if isinstance(s, int) else s, x) for i, c, a, b, s, x in rows]
    return spark.createDataFrame(
        full, "tweet_id long, component_id long, author_id string, inbound boolean, created_at string, text string")


ROWS = [
    (1, 1, "c1", True, 0, "first"), (3, 1, "us", False, 5, "second reply by tie"), (2, 1, "us", False, 5, "tie goes by id"),
    (10, 2, "c2", True, 0, "hi"), (11, 2, "other", False, 1, "not us"),                      # rule 1
    (20, 3, "us", False, 0, "brand only"),                                                  # rule 2
    (30, 4, "c4", True, 0, "q"), (31, 4, "us", False, 1, "a"), (32, 4, "other", False, 2, "b"),  # rule 3
    (40, 5, "c5", True, 0, " \t "), (41, 5, "c5", True, 1, None), (42, 5, "c5", True, "yesterday", "bad date"),
    (43, 5, "us", False, 3, "kept"),
]


def test_rules_and_turns(spark):
    built = conv.build_conversations(raw(spark, ROWS), F.lit("us")).orderBy("component_id", "turn_index").collect()
    want = [(1, 1, 0), (1, 2, 1), (1, 3, 2), (5, 43, 0)]
    assert [(r.component_id, r.tweet_id, r.turn_index) for r in built] == want


def test_drop_accounting(spark):
    want = {"R1": (1, 2, 4, 11), "R2": (1, 1, 3, 10), "R3": (1, 3, 2, 7), "R4": (0, 2, 2, 5), "R5": (0, 1, 2, 4)}
    counted = conv.drop_accounting(raw(spark, ROWS), F.lit("us"))
    observed = conv.build_with_accounting(raw(spark, ROWS), F.lit("us"))[1]
    for table in (counted, observed):
        assert {r.rule[:2]: tuple(r)[1:] for r in table.collect()} == want
    lost = raw(spark, [r for r in ROWS if r[1] != 5] + [(40, 5, "c5", True, 0, None), (41, 5, "us", False, "never", "a")])
    for table in (conv.drop_accounting(lost, F.lit("us")), conv.build_with_accounting(lost, F.lit("us"))[1]):
        assert [tuple(r)[1:] for r in table.collect()][3:] == [(0, 1, 2, 4), (1, 1, 1, 3)]
    for table in (conv.drop_accounting(lost.limit(0), F.lit("us")), conv.build_with_accounting(lost.limit(0), F.lit("us"))[1]):
        assert {tuple(r)[1:] for r in table.collect()} == {(0, 0, 0, 0)}


def scans(df):
    return str(df._jdf.queryExecution().executedPlan()).count("FileScan")


def test_conversations_read_the_messages_twice(spark, tmp_path):
    raw(spark, ROWS).write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    assert scans(conv.drop_accounting(stored, F.lit("us"))) == 1
    assert scans(conv.build_conversations(stored, F.lit("us"))) <= 3


def test_a_burst_is_numbered_in_many_ranges(spark):
    """One component with one timestamp goes to all tasks and gets the same turns as a plain window."""
    rows = [(i, 1 if i % 3 else i, "a", True, 7, f"t{i}") for i in range(600)]
    timed = raw(spark, rows).withColumn("created_at", F.timestamp_seconds(F.lit(1_500_000_000)))
    parts = ranks._ranges(timed, ["component_id", "created_at", "tweet_id"]).where("component_id = 1")
    assert parts.select("_part").distinct().count() >= 3
    found = {r.tweet_id: r.turn_index for r in conv.turn_index(timed).collect()}
    assert found == {i: (k if i % 3 else 0) for i in range(600) for k in [sum(1 for j in range(i) if j % 3)]}


def test_numbered_rows(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") * 7919 % 13).alias("v"), F.lit("x").alias("_n"))
    found = ranks.numbered(df, ["v", "id"], "place").collect()
    assert [r.place for r in sorted(found, key=lambda r: (r.v, r.id))] == list(range(1000))
    assert ranks.numbered(df.limit(0), ["v", "id"], "place").collect() == []


def test_hashed_position_and_top_n(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7 == 0).cast("string").alias("k"))
    ranked = ranks.hashed_position(df, ["k"], "id", 42, "r").collect()
    for key in ("true", "false"):
        own = sorted(r.r for r in ranked if r.k == key)
        assert own == list(range(1, len(own) + 1))
    best = ranks.top_n(df, ["k"], [F.desc("id")], 3, "id").orderBy("k", "rank").collect()
    assert [r.id for r in best] == [499, 498, 496, 497, 490, 483]


def links(spark, rows):
    full = [(i, "a", True, None, "x", resp, parent) for i, parent, resp in rows]
    return spark.createDataFrame(full, schemas.MESSAGES_RAW)


def test_components(spark):
    chain = [(i, i - 1 if i > 100 else None, None) for i in range(100, 137)]
    tree = [(1, None, None), (2, 1, None), (3, 1, None), (4, 2, None)]
    orphan = [(50, 49, None), (51, 50, None)]                       # 49 is not in the table
    named = [(60, None, "61, 62,"), (61, None, None), (62, None, None)]
    cycle = [(70, 72, None), (71, 70, None), (72, 71, None), (69, 70, None), (68, 69, None)]
    got = {r.tweet_id: r.component_id for r in
           components.reply_components(links(spark, chain + tree + orphan + named + cycle)).collect()}
    want = {i: 100 for i in range(100, 137)} | {1: 1, 2: 1, 3: 1, 4: 1} | {50: 50, 51: 50}
    want |= {60: 60, 61: 60, 62: 60} | {i: 70 for i in (68, 69, 70, 71, 72)}
    assert got == want


def test_hot_keys_change_no_join(spark):
    rows = spark.createDataFrame([(i, 0 if i < 50 else i) for i in range(70)], "id long, k long")
    table = spark.createDataFrame([(0, "a"), (0, "b"), (55, "c")], "k long, v string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = sorted(map(str, rows.join(table, "k", how).collect()))
        for salts in (1, 7):
            assert sorted(map(str, skewed_join(rows, table, "k", how, salts).collect())) == plain


def test_resolution_pairs(spark):
    def pair(c, reply, customer="hello there", reply_first=False):
        turns = (1, 0) if reply_first else (0, 1)
        return [(c * 10, c, "c", True, None, customer, turns[0]), (c * 10 + 1, c, "us", False, None, reply, turns[1])]

    rows = pair(1, "x" * 15) + pair(2, "x" * 14) + pair(3, "x" * 20, "1234 ") + pair(4, "x" * 20, " 12345 ")
    rows += pair(5, "x" * 20, reply_first=True) + pair(6, "x" * 20)
    messages = spark.createDataFrame(rows, schemas.MESSAGES.simpleString().removeprefix("struct<").removesuffix(">"))
    assigned = spark.createDataFrame(
        [(c, "refund_request" if c < 4 else "mystery", False, "test" if c == 6 else "train_retrieval") for c in range(1, 7)],
        schemas.ASSIGNMENT)
    got = {r.component_id: (r.case_id, r.intent, r.customer_text) for r in
           conv.resolution_pairs(messages, assigned, F.lit("us")).collect()}
    assert got == {1: ("case_1", "Refund Request", "hello there"), 4: ("case_4", "Other / Out of Scope", "12345")}


def test_all_reply_links_join(spark):
    rows = [
        (1, None, "3"), (3, 98, None),                      # listed, though what it answers is not there
        (10, None, "12"), (11, None, "12"), (12, None, None),  # listed twice
        (20, None, "22"), (21, None, None), (22, 21, None),    # listed by one, answers the other
        (30, None, "31,40"), (31, None, "32"), (32, None, "33, 77"), (33, None, None), (40, None, None), (41, 40, "32"),
    ]
    messages = spark.createDataFrame(rows, "tweet_id long, in_response_to_tweet_id long, response_tweet_id string")
    found = {r["tweet_id"]: r["component_id"] for r in components.reply_components(messages).collect()}
    assert found == {1: 1, 3: 1, 10: 10, 11: 10, 12: 10, 20: 20, 21: 20, 22: 20, **{k: 30 for k in (30, 31, 32, 33, 40, 41)}}
    alone = {r["tweet_id"]: r["component_id"] for r in components.reply_components(messages, use_responses=False).collect()}
    assert alone == {k: {22: 21, 41: 40}.get(k, k) for k, _, _ in rows}


def test_contraction_of_chains_hubs_and_rings(spark):
    chain = [(i, i + 1) for i in range(0, 300)]
    hub = [(1000, 2000 + i) for i in range(300)] + [(2000, 2000)]
    ring = [(5000 + i, 5000 + (i * 7 + 7) % 50) for i in range(50)] + [(5003, 4999)]
    found = components.contract(spark.createDataFrame(chain + hub + ring, "a long, b long"))
    names = {r.node: r.lowest for r in found.collect()}
    want = {i: 0 for i in range(301)} | {1000: 1000} | {2000 + i: 1000 for i in range(300)}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in ring:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    want |= {x: root(x) for a, b in ring if a != b for x in (a, b)}
    assert names == want and found.count() == len(want)


def test_components_of_an_empty_table(spark):
    assert components.reply_components(links(spark, [])).collect() == []
    assert [tuple(r) for r in components.reply_components(links(spark, [(5, 5, "5, x")])).collect()] == [(5, 5)]
