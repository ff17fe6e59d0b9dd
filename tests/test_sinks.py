from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parley.dialect import FLAT
from parley.schemas import ENTITIES
from parley.sinks import jdbc
from parley.sinks.files import metric_names, write_batch_metadata, write_entity
from parley.sources.tables import read_csv, read_entity, read_reference


def test_csv_round_trip(spark, tmp_path, rows):
    schema = ENTITIES["file_data"]
    data = [
        ("F2", "C1", 'a "quoted", name\nin two lines', datetime(2020, 5, 1, 10, 11, 12), "NA"),
        ("F1", "C1", "None", None, None),
    ]
    path = str(tmp_path / "master" / "file_data.csv")
    for _ in range(2):  # a second run must not double the rows
        write_entity(spark.createDataFrame(data, schema), path, sort=["id"])
    assert rows(read_entity(spark, str(tmp_path), "master", "file_data")) == sorted(data)


def test_all_fields_are_quoted_and_numbered(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    write_entity(spark.createDataFrame([("b",), ("a",)], "id string"), path, sort=["id"], index=True)
    lines = [x for f in sorted((tmp_path / "t.csv").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x for x in lines if x != '"index","id"'] == ['"0","a"', '"1","b"']


def test_absent_table_is_empty(spark, tmp_path):
    empty = read_entity(spark, str(tmp_path), "master", "user_data")
    assert empty.columns == ENTITIES["user_data"].names and empty.count() == 0


def test_namibia_is_not_null(spark, tmp_path, rows):
    (tmp_path / "references").mkdir()
    (tmp_path / "references" / "zone.csv").write_text('ISO,TZ\nNA,Africa/Windhoek\n"",x\n')
    assert rows(read_reference(spark, str(tmp_path), "zone")) == [("NA", "Africa/Windhoek"), (None, "x")]


def test_batch_metadata(spark, tmp_path):
    write_batch_metadata(spark, str(tmp_path), "20200501101112")
    (part,) = (tmp_path / "20200501101112" / "metadata").glob("part-*")
    assert part.read_text() == '"time"\n"2020-05-01T10:11:12"\n'


def test_export_names(spark):
    frame = spark.createDataFrame([("a", "b")], "channel string, user_id string")
    assert metric_names(frame, FLAT).columns == ["CHANNEL", "USER"]


PROPERTIES = """
[postgres]
database.url=jdbc:postgresql:database
database.driver=org.postgresql.Driver
database.user=me
database.password=secret
spark.jars=driver.jar
"""


def test_connection_options():
    assert jdbc.jdbc_options(PROPERTIES, "postgres") == {
        "url": "jdbc:postgresql:database", "driver": "org.postgresql.Driver",
        "user": "me", "password": "secret",
    }


def test_text_columns_fit_bytes_here_and_characters_there(spark):
    here = spark.createDataFrame([("é", "abc", None), (None, "a", None)], "name string, text string, none string")
    assert jdbc.size_varchar(here, ["name", "text", "none"]) == "name VARCHAR(2), text VARCHAR(3), none VARCHAR(1)"
    there = spark.createDataFrame([("ééé", None)], "name string, text string")
    assert jdbc.size_varchar(here, ["name", "text"], there) == "name VARCHAR(3), text VARCHAR(3)"


def test_time_is_typed_and_last(spark):
    frame = spark.createDataFrame([("2020-05-01T10:11:12.000", "x"), ("", "y")], "time string, id string")
    typed = jdbc.typed_time(frame)
    assert typed.dtypes == [("id", "string"), ("time", "timestamp_ntz")]
    assert {r.id: r.time for r in typed.collect()} == {"x": datetime(2020, 5, 1, 10, 11, 12), "y": None}


class _Writer:
    """Records what would be written to a database; none is started for a test."""

    calls = []

    def __init__(self, frame):
        self.frame, self.options = frame, {}

    def mode(self, value):
        self.options["mode"] = value
        return self

    def option(self, key, value):
        self.options[key] = value
        return self

    def jdbc(self, url, table, properties):
        _Writer.calls.append((url, table, properties, self.options, self.frame.columns))


def test_tables_of_a_group_are_loaded(spark, monkeypatch):
    _Writer.calls = []
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(DataFrame, "write", property(_Writer))
    options = jdbc.jdbc_options(PROPERTIES, "postgres")
    tables = {
        "poll_data": spark.range(1).select(
            F.lit("2020-05-01T10:11:12.000").alias("time"), F.lit("t").alias("text"), F.lit("it").alias("vote_item")
        ),
        "tag_data": spark.range(1),
    }
    assert jdbc.load_group(tables, "master", options, sized=True) == ["poll_data"]
    ((url, table, properties, set_options, columns),) = _Writer.calls
    assert (url, table, columns) == ("jdbc:postgresql:database", "poll_data", ["text", "vote_item", "time"])
    assert "url" not in properties and properties["user"] == "me"
    assert set_options == {"mode": "overwrite", "numPartitions": 16, "createTableColumnTypes": "text VARCHAR(1), vote_item VARCHAR(2)"}


def test_load_specs():
    assert [s.table for s in jdbc.LOADS.values() if s.group == "metrics"] == [
        "conversation_data", "tag_data", "node_data", "edge_data",
    ]
    assert len(jdbc.LOADS) == 10


def test_reading_a_csv_needs_no_inference(spark, tmp_path):
    assert read_csv(spark, str(tmp_path / "none.csv"), ENTITIES["poll_data"]).dtypes[-1] == ("vote_count", "int")


@pytest.mark.parametrize("name", sorted(ENTITIES))
def test_entities_have_their_key(name):
    from parley.operators.merge import SPECS

    assert set(SPECS[name].keys) <= set(ENTITIES[name].names)
