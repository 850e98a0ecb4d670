import json

import pytest

from tests.fixtures import STORY, events
from tidemark import schemas
from tidemark.operators import specs as sp
from tidemark.sources import readers as rd
from tidemark.session import scratch_dir, stage
from tidemark.sources import writers as wr


def test_events_survive_a_csv(spark, tmp_path):
    path = str(tmp_path / "events")
    wr.table(events(spark), path, "csv")
    got = sorted(map(tuple, rd.csv_events(spark, path).collect()))
    assert got == sorted(map(tuple, events(spark).collect())) and len(got) == len(STORY)


def test_doubled_quotes_are_read_as_other_tools_write_them(spark, tmp_path):
    path = tmp_path / "specs.csv"
    path.write_text('event_id,info,args\n1,"a, b","[{""name"":""x"",""info"":""y""}]"\n')
    row = rd.csv_table(spark, str(path), schemas.SPECS).first()
    assert row["info"] == "a, b" and json.loads(row["args"]) == [{"name": "x", "info": "y"}]


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "labels.csv"
    path.write_text(
        "accuracy,title,installation_id,game_session,accuracy_group,num_incorrect,num_correct\n"
        '0.5,"a\nb",d,s,2,1,1\n,NA,d2,s2,null,NaN,0\n'
    )
    got = rd.csv_table(spark, str(path), schemas.LABELS).collect()
    assert got == [("s", "d", "a\nb", 1, 1, 2), ("s2", "d2", None, 0, None, None)]
    assert rd.labels(spark, str(path)).first() == ("d", "s", 1, 1, 2)
    text = rd.csv_text(spark, str(path), "title string, num_correct int").collect()
    assert text == [("a\nb", "1"), ("NA", "0")]


def test_a_file_that_does_not_fit_is_an_error(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "1.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="no column c, d"):
        rd.csv_table(spark, str(path), "d int, a int, c int")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rd.csv_table(spark, str(path), "a int", missing=("1",)).collect()
        (path / "1.csv").write_text("a,b\nx,2\n")
        rd.csv_table(spark, str(path), "a int").collect()
    (path / "1.csv").write_text("a,b\n1,2\n")
    (path / "2.csv").write_text("b,a\n3,4\n")
    with pytest.raises(Exception, match="header|Header"):
        rd.csv_table(spark, str(path), "a int, b int").collect()


def test_config_documents(spark, tmp_path):
    path = tmp_path / "props.json"
    path.write_text(json.dumps({"a": ["duration", "misses"], "b": [], "c": ["duration"]}))
    props = rd.event_props(spark, str(path))
    assert rd.props_by_event(props) == {"a": ("duration", "misses"), "c": ("duration",)}
    path = tmp_path / "drop.json"
    path.write_text(json.dumps({"features": ["cnt_Air Show_sum", "x"]}))
    assert [r[0] for r in rd.drop_list(spark, str(path)).collect()] == ["cnt_Air Show_sum", "x"]


def test_tuning_log(spark, tmp_path):
    path = tmp_path / "log.json"
    lines = [{"target": t, "params": {"a": t * 2}} for t in (0.1, 0.7, 0.3)]
    path.write_text("\n".join(map(json.dumps, lines)))
    log = rd.tuning_log(spark, str(path))
    assert sorted((r["target"], r["params"]["a"]) for r in log.collect()) == [
        (0.1, 0.2),
        (0.3, 0.6),
        (0.7, 1.4),
    ]


def test_table_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    wr.table_if_absent(spark.range(3), path)
    wr.table_if_absent(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    wr.table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 9


def test_a_failed_write_does_not_count_as_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(Exception, match="USER_RAISED"):
        wr.table_if_absent(spark.range(3).selectExpr("raise_error('stop') AS id"), path)
    assert not wr.exists(spark, path)
    wr.table_if_absent(spark.range(3), path)
    assert wr.exists(spark, path) and spark.read.parquet(path).count() == 3


def specs(spark, args):
    return spark.createDataFrame([("28520915", "i", args), ("off", "i", args)], schemas.SPECS)


def test_property_map(spark):
    args = '[{"name":"duration","info":"d"},{"name":"game_time","info":"g"},{"name":"duration","info":"e"}]'
    got = {r["event_id"]: r["props"] for r in sp.property_map(specs(spark, args)).collect()}
    assert got == {"28520915": ["duration"], "off": []}


def test_report_rows(spark):
    args = '[{"name":"game_time","info":"g"},{"name":"x","info":"y"}]'
    row = sp.report_rows(specs(spark, args)).first()["html"]
    assert "<ul><li>Name: <strong>x</strong>, y</li></ul>" in row


def test_malformed_spec_is_an_error(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        sp.property_map(specs(spark, "[{")).collect()


def test_staged_tables_go_to_the_named_folder(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_dir(spark) == named
    assert f"{named}/four-" in stage(spark.range(4), "four").inputFiles()[0]


def test_a_cluster_needs_a_shared_scratch_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        def __init__(self, **settings):
            self.settings = settings
            self.conf = self

        def get(self, key, default=None):
            return self.settings.get(key, default)

    def at(**settings):
        return scratch_dir(Session(**{k.replace("_", "."): v for k, v in settings.items()}))

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        at(spark_sql_warehouse_dir="file:/tmp/warehouse")
    assert at(spark_sql_warehouse_dir="s3a://w/") == "s3a://w/_scratch"
    assert at(spark_sql_warehouse_dir="file:/tmp/w", spark_checkpoint_dir="hdfs://c") == "hdfs://c"
    Session.sparkContext.master = "local[2]"
    assert at(spark_sql_warehouse_dir="file:/tmp/w") == "file:/tmp/w/_scratch"
