import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators import brands, clustering, models, profile
from caseflow.operators import features as fx
from caseflow.operators.models import IntentClassifier, IntentModel, MajorityBaseline, TfidfLogisticBaseline
from caseflow.operators.stages import IntentEstimator
from caseflow.sources import tables

WORDS = {"parcel": "late parcel not here", "refund": "money back refund please", "login": "password reset login fails"}


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, f"{text} {i % 4} {'thanks' if i % 3 else 'hello'}", label)
            for n, (label, text) in enumerate(WORDS.items()) for i in range(n * 100, n * 100 + 12 + 3 * n)]
    return spark.createDataFrame(rows, "id long, text string, label string")


@pytest.fixture(scope="module")
def model(train):
    return IntentClassifier(folds=3).fit(train, "id", "text", "label")


def test_classifier(spark, train, model, tmp_path):
    asked = spark.createDataFrame([(1, "parcel is late"), (2, "forgot my password"), (3, ""), (4, None)], "id long, text string")
    rows = {r.id: r for r in model.transform(asked, "id", "text").collect()}
    assert rows[1].intent == "parcel" and rows[2].intent == "login"
    assert rows[1].is_confident and len(rows) == 4
    for r in rows.values():
        assert abs(sum(r.probabilities.values()) - 1) < 1e-3 and set(r.probabilities) == set(WORDS)
        top = sorted(r.probabilities.values(), reverse=True)
        assert abs(r.confidence - top[0]) < 1e-4 and abs(r.margin - (top[0] - top[1])) < 2e-4
    model.save(str(tmp_path / "model"))
    again = IntentModel.load(spark, str(tmp_path / "model")).transform(asked, "id", "text")
    assert {r.id: (r.intent, r.confidence) for r in again.collect()} == {i: (r.intent, r.confidence) for i, r in rows.items()}


def test_certificate_tells_an_optimum(train, model):
    """The gradient is next to nothing for the fitted model, and not for one fitted to another objective."""
    at = IntentClassifier(folds=3).certificate(model, train, "id", "text", "label").collect()
    assert [r.fold for r in at] == [0, 1, 2] and all(r.largest_gradient < 1e-5 for r in at)
    assert sum(r.rows for r in at) == 2 * train.count()
    off = IntentClassifier(folds=3, c=0.5).certificate(model, train, "id", "text", "label").collect()
    assert all(r.largest_gradient > 1e-3 for r in off)


def test_certificate_without_arrow(spark, train, model):
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        told = IntentClassifier(folds=3).certificate(model, train, "id", "text", "label").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    assert [r.fold for r in told] == [0, 1, 2] and all(r.largest_gradient < 1e-5 for r in told)


def test_fits_side_by_side_share_the_cores(spark, train, monkeypatch):
    """On twelve cores a step of each of five fits has three tasks, and so shuffles three gradients."""
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: 12))
    spread, taken = models._spread, []
    monkeypatch.setattr(models, "_spread", lambda *a: taken.append(spread(*a).rdd.getNumPartitions()) or spread(*a))
    monkeypatch.setattr(models, "ROWS_PER_TASK", 1)
    IntentClassifier().fit(train, "id", "text", "label")
    assert taken == [3]
    assert spread(train, 48_000, 1).rdd.getNumPartitions() == 12 and spread(train, 10**6, 5).rdd.getNumPartitions() <= 20


def test_stages_in_a_pipeline(spark, train, tmp_path):
    stage = IntentEstimator(rowIdCol="id", labelCol="label", folds=2, c=1.5, minConfidence=0.7, minMargin=0.2)
    fitted = Pipeline(stages=[stage]).fit(train)
    fitted.write().overwrite().save(str(tmp_path / "pipeline"))
    loaded = PipelineModel.load(str(tmp_path / "pipeline"))
    asked = spark.createDataFrame([(1, "parcel is late"), (2, "forgot my password"), (3, None)], "id long, text string")
    columns = ["id", "intent", "confidence", "margin", "is_confident"]
    told, again = ([tuple(r) for r in m.transform(asked).select(*columns).orderBy("id").collect()] for m in (fitted, loaded))
    assert told == again and told[0][1] == "parcel"
    assert loaded.stages[0].getOrDefault("minMargin") == 0.2 and loaded.stages[0].uid == fitted.stages[0].uid
    stage.save(str(tmp_path / "stage"))
    assert IntentEstimator.load(str(tmp_path / "stage")).getOrDefault("c") == 1.5


def test_golden_csv_round_trip(spark, tmp_path):
    rows = [("g0001", 5, 2, 'say "hi",\nthen go', "refund_request", "", "Easy", "in_scope", "note, with comma")]
    golden = spark.createDataFrame([tuple(r) for r in rows], schemas.GOLDEN)
    tables.write_csv(golden, str(tmp_path / "golden"))
    assert tables.read_golden_csv(spark, str(tmp_path / "golden")).collect() == golden.collect()


def test_sigmoids_are_at_the_minimum(model):
    slopes = [a for fold in model.sigmoids for a, _ in fold]
    assert len(slopes) == 9 and all(a > 0 for a in slopes)


def test_baselines(train):
    top = MajorityBaseline().fit(train, "label")
    assert top.label == "login"
    assert {r.intent for r in top.transform(train).collect()} == {"login"}
    simple = TfidfLogisticBaseline().fit(train, "id", "text", "label").transform(train, "id", "text")
    assert simple.where("intent <> label").count() == 0


def test_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [(1, "a", True, "x", 'say "hi",\nthen go', None, None), (2, "b", False, "y", "", "3,4", 1)]
    df = spark.createDataFrame(rows, schemas.MESSAGES_RAW)
    tables.write_csv(df, str(tmp_path / "m"))
    back = tables.read_messages_csv(spark, str(tmp_path / "m")).orderBy("tweet_id").collect()
    assert back[0].text == rows[0][4] and back[1].in_response_to_tweet_id == 1 and back[1].response_tweet_id == "3,4"
    (tmp_path / "f.csv").write_text(
        "tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n5,a,True,t,hi,,7.0\n")
    assert tables.read_messages_csv(spark, str(tmp_path / "f.csv")).first().in_response_to_tweet_id == 7


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, " "), (3, "a")], "k int, text string")
    assert profile.duplicate_rows(df).first()[0] == 1 and profile.duplicate_keys(df, "k").first()[0] == 1
    assert {r.column_name: r.nulls for r in profile.null_counts(df).collect()} == {"k": 0, "text": 2}
    assert profile.blank_texts(df).first()[0] == 1


def test_brand_diversity_notes(spark):
    texts = [("few", f"text {i}") for i in range(10)] + [("same", f"word{i} only{i}") for i in range(60)]
    texts += [("rich", f"{a} {b} item{i % 5}") for i, (a, b) in enumerate(
        (x, y) for x in "alpha beta gamma delta omega sigma kappa zeta".split() for y in "red blue green black white pink grey gold".split())]
    df = spark.createDataFrame(texts, "brand string, norm string").withColumn("n", F.lit(1))
    rows = {r.brand: r for r in brands.brand_diversity(df).collect()}
    assert rows["few"].note == "sample too small for reliable clustering" and rows["few"].silhouette is None
    assert rows["same"].note == "too few TF-IDF features after min_df filter"
    assert rows["rich"].note == "" and -1 <= rows["rich"].silhouette <= 1 and 0 < rows["rich"].cluster_balance < 1
    assert rows["rich"].sample_size == 64 and rows["rich"].k == brands.CLUSTERS
    sampled = {r.brand: r for r in brands.brand_diversity(df, sample=45).collect()}
    assert sampled["rich"].sample_size == 45 and sampled["few"] == rows["few"]
    # two groups of texts without a common word: one silhouette near 1, and half of the texts in each cluster
    pairs = spark.createDataFrame([("b", f"{'aa bb' if i % 2 else 'cc dd'} once{i}") for i in range(40)], "brand string, norm string").withColumn("n", F.lit(1))
    two = brands.brand_diversity(pairs, k=2).first()
    assert two.silhouette > 0.99 and two.cluster_balance == 0.5


def test_solver_takes_large_blocks(train, monkeypatch):
    fit, taken = models.LogisticRegression.fit, []
    monkeypatch.setattr(models.LogisticRegression, "fit", lambda self, rows: taken.append(self.getMaxBlockSizeInMB()) or fit(self, rows))
    TfidfLogisticBaseline().fit(train, "id", "text", "label")
    IntentClassifier(folds=2).fit(train, "id", "text", "label")
    assert taken == [models.BLOCK_MB] * 3


def test_clusters_hold_vectors_without_texts(train, monkeypatch):
    fit, held = clustering.KMeans.fit, []
    monkeypatch.setattr(clustering.KMeans, "fit", lambda self, rows: held.append((rows.columns, rows.storageLevel.useMemory)) or fit(self, rows))
    topics = clustering.fit_topics(train, "id", "text", k=3, spec=fx.TermSpec("word", 1, 1, fx.WORD, (), False, 1, 100))
    assert held == [(["features"], True)] and topics.members.columns == ["id", "text", "cluster"]
    assert topics.members.count() == train.count() == sum(r["size"] for r in topics.summary().collect())
