import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from frames import creators, rows, taxonomy, videos

from vidmart import schemas, session
from vidmart.sources import readers, sinks, staging

POST = {
    "authorMeta.avatar": "a.jpg", "authorMeta.name": "ann", "text": "#x", "diggCount": 1,
    "shareCount": 2, "playCount": 3, "commentCount": None, "videoMeta.duration": 4,
    "musicMeta.musicName": "s", "musicMeta.musicAuthor": "b", "musicMeta.musicOriginal": True,
    "createTimeISO": "2026-05-01T17:09:00.000Z", "webVideoUrl": "https://v/video/1",
}


def names(ddl):
    return [f.name for f in schemas.struct(ddl).fields]


def test_video_array_with_dotted_names(spark, tmp_path):
    path = tmp_path / "videos.json"
    path.write_text(json.dumps([POST, {**POST, "playCount": 9}], indent=1))
    df = readers.videos_json(spark, str(path))
    assert df.columns == names(schemas.VIDEO)
    assert rows(df.select("authorMeta_name", "playCount", "videoMeta_duration")) == [
        ("ann", 3, 4), ("ann", 9, 4),
    ]


def test_video_lines(spark, tmp_path):
    path = tmp_path / "videos.jsonl"
    path.write_text("\n".join(json.dumps(POST) for _ in range(5)))
    assert readers.videos_json(spark, str(path), multi_line=False).count() == 5


def test_flatten(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert readers.flatten_columns(df).columns == ["a_b", "c"]


def test_creator_file(spark, tmp_path):
    path = tmp_path / "creators.csv"
    path.write_text(
        ",".join(names(schemas.CREATOR))
        + "\nX-1,quill,Quill & Co,777000,12,64,8150,NZ,Gardening,1,Brand,2021-02-28,33,1\n"
    )
    r = readers.creators_csv(spark, str(path)).first()
    assert (r.username, r.follower_count, str(r.joined_date)) == ("quill", 777000, "2021-02-28")
    guessed = readers.read_csv(spark, str(path), None)
    assert dict(guessed.dtypes)["is_verified"] == "int"
    assert dict(guessed.dtypes)["joined_date"] == "date"


def test_fallbacks(spark, tmp_path):
    path = tmp_path / "taxonomy.csv"
    path.write_text(",".join(names(schemas.TAXONOMY)) + "\nHT1,fun,Comedy,,1,PG,low,en,,\n")

    def files():
        return readers.taxonomy_csv(spark, str(path))

    options = readers.jdbc_options("jdbc:postgresql://localhost:1/x", "t")
    df, used = readers.read_with_fallback(lambda: readers.connector(spark, "jdbc", options), files)
    assert used == "fallback" and df.count() == 1
    documents = readers.document_options("mongodb://localhost:1", "d", "c")
    assert documents["spark.mongodb.read.collection"] == "c"
    _, used = readers.read_with_fallback(
        lambda: readers.connector(spark, "mongodb", documents), files
    )
    assert used == "fallback"
    _, used = readers.read_with_fallback(files, lambda: pytest.fail("not needed"))
    assert used == "primary"


def test_only_unavailable_sources_are_replaced(spark, tmp_path):
    """A wrong setting is an error, whatever the fallback could give."""
    bad = tmp_path / "bad.parquet"
    bad.write_text("not parquet")
    csv = tmp_path / "t.csv"
    csv.write_text("a\n1\n")
    wrong = [
        lambda: spark.read.schema("x int").parquet(str(bad)),
        lambda: spark.read.parquet(str(tmp_path / "nowhere")),
        lambda: readers.connector(spark, "jdbc", {"url": "jdbc:postgresql://localhost:1/x"}),
        lambda: readers.connector(spark, "jdbc", readers.jdbc_options("jdbc:x:y", "t", driver="org.nobody.Drivr")),
        lambda: readers.connector(spark, "jdbc", {"url": "jdbc:nothing://localhost:1/x", "dbtable": "t"}),
        lambda: readers.connector(spark, "csv", {"mode": "PERMISSIVE", "header": "maybe", "path": str(csv)}),
    ]
    for source in wrong:
        with pytest.raises((PySparkException, Py4JJavaError)):
            readers.read_with_fallback(source, lambda: pytest.fail("a wrong setting was passed over"))


def test_unreachable_servers(spark):
    """No connection and no such host, as any file system or database client reports them."""
    def at(host):
        return lambda: spark.read.option("ipc.client.connect.max.retries", "0").text(f"hdfs://{host}:1/x")

    for host in ("localhost", "no.such.host.invalid"):
        df, used = readers.read_with_fallback(at(host), lambda: spark.range(2))
        assert used == "fallback" and df.count() == 2


class Cause:
    """A Java exception, as far as its class, message, SQL state and cause are asked for."""

    def __init__(self, name, message="", state=None, cause=None):
        self.name, self.message, self.state, self.cause = name, message, state, cause

    def getClass(self):
        return self

    def getName(self):
        return self.name

    def getMessage(self):
        return self.message

    def getSQLState(self):
        return self.state

    def getCause(self):
        return self.cause


@pytest.mark.parametrize(
    "cause, why",
    [
        (Cause("java.sql.SQLException", "refused", "08001"), "no connection"),
        (Cause("java.sql.SQLException", "password", "28P01"), None),
        (Cause("java.sql.SQLException", "no such table", "42P01"), None),
        (Cause("x", cause=Cause("java.net.SocketTimeoutException")), "timeout"),
        (Cause("com.mongodb.MongoTimeoutException"), "timeout"),
        (Cause("java.lang.ClassNotFoundException", "org.postgresql.Driver"), "no provider"),
        (Cause("java.lang.ClassNotFoundException", "org.nobody.Driver"), None),
        (Cause("org.apache.spark.SparkException", "[DATA_SOURCE_NOT_FOUND] Failed to find"), "no provider"),
    ],
)
def test_error_classes(cause, why):
    error = PySparkException("failed")
    error._origin = cause
    assert readers.unavailable(error) == why


def test_causes_in_a_circle():
    a, error = Cause("a"), PySparkException("failed")
    a.cause = Cause("b", cause=a)
    error._origin = a
    assert readers.unavailable(error) is None


def test_jdbc_options():
    assert "partitionColumn" not in readers.jdbc_options("u", "t", "me", "pw")
    got = readers.jdbc_options("u", "t", partition_column="id", bounds=(0, 100), partitions=8)
    assert (got["lowerBound"], got["upperBound"], got["numPartitions"]) == ("0", "100", "8")
    assert got["driver"] == "org.postgresql.Driver" and "password" not in got
    with pytest.raises(ValueError):
        readers.jdbc_options("u", "t", partition_column="id")


@pytest.mark.parametrize("cuts", [[], ["m"], ["b", "it's", "t"], ["t", "b"], ["b", "b"]])
def test_range_predicates_part_a_table(spark, cuts):
    keys = [None, "", "a", "b", "it's", "iz", "t", "zz"]
    table = spark.createDataFrame([(k,) for k in keys], "k string")
    parts = readers.range_predicates("k", cuts)
    assert len(parts) == len(cuts) + 1
    got = [r["k"] for p in parts for r in table.where(p).collect()]
    assert sorted(got, key=str) == sorted(keys, key=str)


def test_spread(spark, tmp_path):
    path = str(tmp_path / "one")
    spark.range(100).coalesce(1).write.parquet(path)
    scan = spark.read.parquet(path)
    assert readers.spread(scan).rdd.getNumPartitions() == 4
    wide = spark.range(0, 100, 1, 9)
    assert readers.spread(wide) is wide


def test_staging(spark, tmp_path):
    path = str(tmp_path / "s")
    df = staging.stage(videos(spark, {}, {"text": "b"}), path)
    assert df.columns == names(schemas.VIDEO) and df.count() == 2
    assert staging.read_staged(spark, path, schemas.VIDEO).count() == 2
    assert staging.read_optional(spark, str(tmp_path / "none"), schemas.BRIDGE).count() == 0
    assert staging.read_optional(spark, path, schemas.VIDEO).count() == 2


def test_shared_folder_comes_from_the_session(spark):
    assert staging.new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.insert_if_absent(taxonomy(spark, {}, {"hashtag": "same id"}), path, ["hashtag_id"])
    sinks.insert_if_absent(
        taxonomy(spark, {"hashtag": "late"}, {"hashtag_id": "HT2"}), path, ["hashtag_id"]
    )
    got = staging.read_staged(spark, path).select("hashtag_id", "hashtag")
    assert rows(got) == [("HT1", "fun"), ("HT2", "fun")]


def test_load_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.load_once(creators(spark, {}), path)
    assert not sinks.load_once(creators(spark, {}, {}), path)
    assert staging.read_staged(spark, path).count() == 1


def test_partitioned_append(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2026, 1), (2025, 2)], "y int, v int")
    sinks.write_table(df, path, partition_by=("y",))
    sinks.write_table(df, path, mode="append", partition_by=("y",))
    assert rows(staging.read_staged(spark, path).select("y", "v")) == [
        (2025, 2), (2025, 2), (2026, 1), (2026, 1),
    ]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_files(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    sinks.write_report(spark.range(3), path, fmt)
    assert spark.read.option("header", True).format(fmt).load(path).count() == 3


def test_conform(spark):
    df = spark.createDataFrame([(1, "300000", 123.456)], "b int, a string, extra double")
    got = schemas.conform(df, "a smallint, b bigint, c string, extra decimal(4,2)", {"c": "x"})
    assert rows(got) == [(None, 1, "x", None)]


def test_session_zone(spark):
    session.require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    try:
        with pytest.raises(ValueError):
            session.require_utc(spark)
    finally:
        session.pin_utc(spark)
    session.require_utc(spark)
    assert session.create_session(app_name="again") is not None


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("extra,b,a\nx,1200.0,k\ny,1.5,l\nz,no,m\n")
    got = readers.read_csv(spark, str(path), "a string, b bigint").orderBy("a").collect()
    assert [tuple(r) for r in got] == [("k", 1200), ("l", None), ("m", None)]
    with pytest.raises(ValueError, match="lacks"):
        readers.read_csv(spark, str(path), "a string, c bigint")


def test_load_once_on_an_empty_folder(spark, tmp_path):
    (tmp_path / "t").mkdir()
    assert sinks.load_once(spark.range(3), str(tmp_path / "t"))
    assert not sinks.load_once(spark.range(3), str(tmp_path / "t"))


BROKEN = """{"a": 1, "b.c": "x", "d": 0.70}
{"a": "z", "b.c": 5, "d": "0.5"}
not json
{"a": 3

{"a": 1.5, "b.c": {"k": 1}, "d": true}
{"a": null}
"""


def test_checked_json_loses_nothing(spark, tmp_path):
    path = tmp_path / "a.jsonl"
    path.write_text(BROKEN)
    checked = readers.checked_json(spark, str(path), "a bigint, `b.c` string, d double", multi_line=False)
    read = {(r["a"], r["d"]) for r in readers.readable(checked).collect()}
    assert readers.readable(checked).count() == 4 and read == {(1, 0.7), (None, 0.5), (None, None)}
    bad = readers.unreadable(checked)
    assert rows(bad.select("raw_text")) == [("not json",), ('{"a": 3',)]
    assert {r["reject_reason"] for r in bad.collect()} == {"not a JSON object"}
    assert all(r["source_file"].endswith("a.jsonl") for r in bad.collect())
    assert rows(readers.unfit_cells(checked).drop("source_file")) == [
        ("a", "1.5", "bigint"), ("a", "z", "bigint"), ("d", "true", "double"),
    ]
    # whatever columns a query asks for, the same records are broken
    assert checked.where("raw_text is not null").select("raw_text").count() == 2
    assert checked.where("raw_text is null").count() == 4


def test_checked_json_arrays(spark, tmp_path):
    (tmp_path / "1.json").write_text('[{"a": 1}, {"a": "x"}]')
    (tmp_path / "2.json").write_text('[{"a": 1}, {"a":')
    checked = readers.checked_json(spark, str(tmp_path / "*.json"), "a bigint")
    assert rows(readers.readable(checked)) == [(1,), (None,)]
    assert rows(readers.unreadable(checked).select("raw_text")) == [('[{"a": 1}, {"a":',)]


def test_checked_csv_loses_nothing(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text('x,b,a\n1,2,3\n1,2\n1,2,3,4\nq,zz,3\n"a,b",7.0,\n1,,\n')
    checked = readers.checked_csv(spark, str(path), "a string, b bigint")
    assert rows(readers.readable(checked)) == [("3", 2), ("3", None), (None, 7), (None, None)]
    assert rows(readers.unreadable(checked).select("raw_text", "reject_reason")) == [
        ("1,2", "wrong number of cells"), ("1,2,3,4", "wrong number of cells"),
    ]
    assert rows(readers.readable(checked).select("a")) == [("3",), ("3",), (None,), (None,)]
    assert rows(readers.unfit_cells(checked).drop("source_file")) == [("b", "zz", "bigint")]
    with pytest.raises(ValueError, match="lacks"):
        readers.checked_csv(spark, str(path), "c string")


def test_routed_write(spark, tmp_path):
    path = str(tmp_path / "routed")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "x int, y string")
    good, bad = sinks.write_routed(df, path, F.col("x") < 2)
    assert rows(good) == [(1, "a")] and rows(bad) == [(2, "b"), (None, "c")]
    assert good.columns == df.columns
    scan = good._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in scan  # the rejects' files are not read
    good, bad = sinks.write_routed(df.where("false"), path, F.col("x") < 2)
    assert rows(good) == rows(bad) == []


def test_a_run_loaded_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "t")
    ddl = "y int, v int"
    sinks.write_run(spark.createDataFrame([(2025, 1), (2026, 2), (None, 3)], ddl), path, "A", partition_by=("y",))
    sinks.write_run(spark.createDataFrame([(2025, 9)], ddl), path, "B", partition_by=("y",))
    before = staging.files_below(spark, f"{path}/pipeline_run_id=B")
    sinks.write_run(spark.createDataFrame([(2026, 4), (2024, 5)], ddl), path, "A", partition_by=("y",))
    got = staging.read_staged(spark, path).select("pipeline_run_id", "y", "v")
    assert rows(got) == [("A", 2024, 5), ("A", 2026, 4), ("B", 2025, 9)]
    assert staging.files_below(spark, f"{path}/pipeline_run_id=B") == before
    sinks.write_run(spark.createDataFrame([], ddl), path, "A", partition_by=("y",))
    assert rows(staging.read_staged(spark, path).select("pipeline_run_id", "v")) == [("B", 9)]
    plain = str(tmp_path / "p")
    for value in (1, 2):
        sinks.write_run(spark.createDataFrame([(value,)], "v int"), plain, "A")
    assert rows(staging.read_staged(spark, plain).select("v")) == [(2,)]


def test_small_files_are_whole_or_absent(spark, tmp_path):
    path = str(tmp_path / "deep" / "note.json")
    assert staging.read_text(spark, path) is None
    for text in ("one é", "two"):
        staging.write_text(spark, path, text)
        assert staging.read_text(spark, path) == text
    assert [p.name for p in (tmp_path / "deep").iterdir() if not p.name.startswith(".")] == ["note.json"]
