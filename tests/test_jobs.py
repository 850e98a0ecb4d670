import pytest
from pyspark.sql import functions as F

from checks import telemetry as t
from checks.file_queries import specs
from tidemark import __main__ as command
from tidemark.fixed import EVENT_PROPS
from tidemark.operators import search as sr
from tidemark.plans import jobs
from tidemark.sources import writers as wr

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    data = str(tmp_path_factory.mktemp("data"))
    test, labels = t.test_until_assessment(spark, SF), t.labels(spark, SF)
    order = ["game_session", "installation_id", "title", "num_correct", "num_incorrect"]
    columns = t.telemetry(spark, SF).columns
    wr.table(t.train_events(spark, SF), f"{data}/train.csv", "csv")
    wr.table(test.select(*columns), f"{data}/test.csv", "csv")
    wr.table(labels.select(*order, "accuracy_group"), f"{data}/train_labels.csv", "csv")
    wr.table(specs(spark, SF).withColumn("event_id", F.substring("event_id", 1, 40)), f"{data}/specs.csv", "csv")
    return jobs.Files(spark, data, str(tmp_path_factory.mktemp("out")))


def test_sessions_to_submission(files):
    jobs.prepare_sessions(files)
    jobs.features(files)
    assert files.read("train_features").count() == files.labels().count()
    devices = files.test().select("installation_id").distinct().count()
    score = jobs.predict(files, folds=2, rounds=2).first()["mean_score"]
    assert score is None or -1 <= score <= 1
    votes = files.spark.read.option("header", True).csv(files.path("submission"))
    assert votes.count() == devices
    assert {r["accuracy_group"] for r in votes.collect()} <= {"0", "1", "2", "3"}


def test_group_model_and_its_lists(files):
    jobs.event_features(files)
    assert files.read("train_event_features").count() == files.labels().count()
    jobs.prune_list(files)
    dropped = [r["feature"] for r in files.read("correlated_features").collect()]
    assert dropped and set(dropped) < set(files.read("train_event_features").columns)
    train, _, columns = jobs.group_matrices(files)
    assert not set(dropped) & set(columns) and "assessment_title" in columns
    score = jobs.predict_groups(files, folds=2, trees=3).first()["mean_score"]
    assert score is None or -1 <= score <= 1
    votes = files.spark.read.option("header", True).csv(files.path("group_submission"))
    assert votes.count() == files.test().select("installation_id").distinct().count()
    weights = files.read("feature_importances")
    assert {r["feature"] for r in weights.collect()} == set(columns)
    # what was useless is left out from now on
    told = [(c, float(i > 0)) for i, c in enumerate(columns)]
    files.write(files.spark.createDataFrame(told, "feature string, importance double"), "feature_importances")
    assert jobs.group_matrices(files)[2] == columns[1:]


def test_search_goes_on_where_it_ended(files, monkeypatch):
    monkeypatch.setattr(jobs, "PROBES", {"num_correct": sr.PROBES["num_correct"][:1], "num_incorrect": ()})
    quick = {"guided": 0, "folds": 2, "rounds": 2, "trees": 2}
    best = {r["log"]: r["target"] for r in jobs.tune(files, draws=0, **quick).collect()}
    assert set(best) == {"tuning_num_correct"} and 0 <= best["tuning_num_correct"] <= 1
    best = {r["log"]: r["target"] for r in jobs.tune(files, draws=1, **quick).collect()}
    assert set(best) == {"tuning_num_correct", "tuning_num_incorrect"}
    jobs.tune(files, draws=1, **quick)
    from tidemark.sources import readers as rd

    log = rd.tuning_log(files.spark, files.path("tuning_num_correct"))
    assert log.count() == log.select(F.col("params")["learning_rate"]).distinct().count() == 2
    # one more point, which the log alone says; run again, nothing is added
    logged = [(r["params"], r["target"]) for r in log.collect()]
    for _ in range(2):
        jobs.tune(files, draws=1, **{**quick, "guided": 1})
    told = [r["params"] for r in rd.tuning_log(files.spark, files.path("tuning_num_correct")).collect()]
    (new,) = [p for p in told if p not in [q for q, _ in logged]]
    assert new == {k: float(v) for k, v in sr.suggest(sr.BOUNDS, logged).items()}
    best = {r["log"]: r["target"] for r in jobs.best_trials(files).collect()}
    jobs.rank_log(files)
    ranked = [r["target"] for r in files.read("ranked_tuning_num_correct").collect()]
    assert ranked == sorted(ranked, reverse=True) and ranked[0] == best["tuning_num_correct"]


def test_group_search(files):
    best = jobs.tune_groups(files, draws=1, guided=1, trees=2).filter("log = 'tuning_groups'").first()
    assert -1 <= best["target"] <= 1 and best["params"]["n_splits"] in (8.0, 9.0, 10.0, 11.0)


def test_described_specs_are_the_property_map(files):
    assert files.props() == EVENT_PROPS
    jobs.describe_specs(files)
    assert set(files.props()) == {"28520915"} and set(files.props()["28520915"]) == {"duration", "misses"}
    assert files.spark.read.text(files.path("specs_html")).count() == files.specs().count()
    jobs.prepare_events(files)
    sums = [c for c in files.read("train_session_props").columns if "prop" in c]
    assert len(sums) == 2


def test_text_is_read_once(files):
    assert "train_events" in files.train().inputFiles()[0]
    assert files.words()["event_code"] == sorted(t.CODES)


def test_prepared_tables(files):
    jobs.prepare_events(files)
    flagged = files.read("train")
    assert "event_data" not in flagged.columns
    assert flagged.agg(F.sum("is_correct_attempt")).first()[0] > 0
    assert files.read("event_codes").count() == len(t.CODES)
    sessions = files.train().select("game_session").distinct().count()
    assert files.read("train_session_props").count() == sessions
    jobs.prepare_sessions_with_props(files)
    assert files.read("train_prop_sessions").count() == sessions


def test_event_files_are_read_in_parts(files, monkeypatch, tmp_path):
    spark, size = files.spark, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    whole = files.events("test.csv").collect()
    spark.conf.set(size, "4096")
    try:
        split = jobs.Files(spark, files.data, str(tmp_path)).events("test.csv")
        assert sorted(split.collect()) == sorted(whole)
    finally:
        spark.conf.set(size, before)
    seen = []
    monkeypatch.setitem(jobs.JOBS, "prepare-events", lambda f: seen.append(f.data))
    monkeypatch.setattr(command, "build_session", lambda name: spark)
    monkeypatch.setattr("sys.argv", ["tidemark", "prepare-events", files.data, str(tmp_path)])
    command.main()
    assert seen == [files.data]
