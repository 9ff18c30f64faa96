import datetime

import pytest
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.functions.rules import RulePack
from caseflow.operators import features as fx
from caseflow.operators import retrieval
from caseflow.operators.models import RuleClassifier
from caseflow.plans import triage
from caseflow.plans.queries import models as queries
from caseflow.session import checkpoint_root, materialize, scratch_scope
from caseflow.streaming import triage as streaming

MODEL = RuleClassifier(RulePack((("delivery_issue", r"\b(parcel|late)\b"), ("refund_request", r"\brefund\b"))))
SENT = "q_id string, text string, created_at timestamp"


@pytest.fixture(scope="module")
def index(spark):
    rows = [(f"case_{i}", i, x, x, f"We are sorry about the {x}.", "Delivery Issue") for i, x in enumerate(("late parcel", "lost parcel", "refund due"))]
    words, chars = fx.TermSpec("word", 1, 2, fx.WORD, (), True, 1, 500), fx.TermSpec("char", 3, 5, fx.WORD, (), True, 1, 2000)
    return retrieval.fit_index(spark.createDataFrame(rows, schemas.CORPUS), words, chars)


def test_each_message_once(spark, index, tmp_path):
    start = datetime.datetime(2024, 1, 1)

    def send(name, rows):
        at = [(i, text, start + datetime.timedelta(minutes=m)) for i, text, m in rows]
        spark.createDataFrame(at, SENT).coalesce(1).write.parquet(f"{tmp_path}/in/{name}")

    def drain():
        stream = spark.readStream.schema(SENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        done = streaming.run(stream, MODEL, index, f"{tmp_path}/out", f"{tmp_path}/state", k=2, available_now=True)
        done.awaitTermination()
        return spark.read.parquet(f"{tmp_path}/out")

    send("a", [("1", "my parcel is late", 0), ("2", "refund please", 1), ("2", "refund please", 2), ("3", "hello", 3)])
    send("b", [("3", "hello", 5), ("4", "the parcel is lost", 6)])
    assert sorted(r.q_id for r in drain().collect()) == ["1", "2", "3", "4"]
    # after a restart: one again within the delay, one beyond it, one new
    send("c", [("5", "late late parcel", 600)])
    send("d", [("4", "the parcel is lost", 20), ("1", "my parcel is late", 601), ("6", None, 602), ("5", "late late parcel", 603)])
    found = drain()
    plain = spark.createDataFrame(
        [("1", "my parcel is late"), ("2", "refund please"), ("3", "hello"), ("4", "the parcel is lost"), ("5", "late late parcel"), ("6", None)],
        "q_id string, text string")
    want = triage.output(triage.run(plain, MODEL, index, 2))
    assert sorted(map(str, found.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    # a first batch that runs again with an empty state is told by the sink alone
    stream = spark.readStream.schema(SENT).parquet(f"{tmp_path}/in/*")
    again = streaming.run(stream, MODEL, index, f"{tmp_path}/out", f"{tmp_path}/other", k=2, available_now=True)
    again.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").groupBy("q_id").count().where("count > 1").isEmpty()


def test_scratch_goes_with_its_scope(spark, tmp_path):
    with scratch_scope(spark):
        inside = materialize(spark.range(5), "inside")
        path = inside.inputFiles()[0]
        inside.write.parquet(f"{tmp_path}/kept")
    outside = materialize(spark.range(3), "outside")
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 5 and outside.count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path.rsplit("/", 1)[0]).count()
    assert checkpoint_root(spark) == checkpoint_root(spark)


def test_gates_are_the_same_on_a_stream(spark, tmp_path):
    rows = spark.createDataFrame([("1", "speak to a human"), ("2", None)], "q_id string, text string")
    rows.write.parquet(f"{tmp_path}/in")
    stream = streaming.stateless(spark.readStream.schema("q_id string, text string").parquet(f"{tmp_path}/in"), MODEL.pack)
    done = stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/s").option("path", f"{tmp_path}/o").trigger(availableNow=True).start()
    done.awaitTermination()
    told = spark.read.parquet(f"{tmp_path}/o").orderBy("q_id").collect()
    assert told == streaming.stateless(rows, MODEL.pack).orderBy(F.col("q_id")).collect()


@pytest.mark.parametrize("files", [0, 1, 3])
def test_a_stream_reads_a_file_or_a_folder(spark, tmp_path, files):
    """The table is one file (0), or a folder of files."""
    turns = spark.createDataFrame([(i, 0, "user", f"message {i}") for i in range(6)], "conv_id long, turn long, role string, text string")
    place = f"{tmp_path}/conversations.parquet"
    if files:
        turns.repartition(files).write.parquet(place)
    else:
        turns.toPandas().to_parquet(place)
    assert sorted(r.tweet_id for r in queries.streaming_gates(spark, str(tmp_path)).collect()) == [i * 1000 for i in range(6)]
