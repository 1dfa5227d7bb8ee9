from __future__ import annotations

import datetime
import threading
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioworks import contracts as C
from folioworks.operators import quality
from folioworks.session import shared_dir
from folioworks.sinks import publish as publishing
from folioworks.sinks.publish import conform, publish, target_path
from folioworks.sinks.versions import current_path, publish_version, read_current, versions
from folioworks.sources.landing import missing_pages, scan_files, scan_paged, with_file_type


def test_one_declaration_two_schemas():
    spark_schema, arrow_schema = C.POSTS.spark_schema(), C.POSTS.arrow_schema()
    assert spark_schema["tool_types"].dataType == T.ArrayType(T.StringType())
    assert spark_schema["tool_types"].metadata["domain"] == list(C.TOOL_TYPES)
    assert not spark_schema["id"].nullable and spark_schema["stage"].nullable
    assert arrow_schema.field("tool_types").type == pa.list_(pa.dictionary(pa.uint32(), pa.string()))
    assert arrow_schema.field("date").type == pa.date32() and not arrow_schema.field("date").nullable


@pytest.mark.parametrize(
    ("declared", "spark_type", "arrow_type"),
    [
        ("uint8", T.ShortType(), pa.uint8()),
        ("uint64", T.DecimalType(20, 0), pa.uint64()),
        ("datetime", T.TimestampNTZType(), pa.timestamp("us")),
        ("binary", T.BinaryType(), pa.binary()),
        (C.ListOf(C.ListOf("int64")), T.ArrayType(T.ArrayType(T.LongType())), pa.list_(pa.list_(pa.int64()))),
    ],
)
def test_types(declared, spark_type, arrow_type):
    assert C.spark_type(declared) == spark_type and C.arrow_type(declared) == arrow_type


@pytest.mark.parametrize("declared", ["time", "duration", "struct", object()])
def test_types_without_a_column_are_refused(declared):
    for convert in (C.spark_type, C.arrow_type):
        with pytest.raises(NotImplementedError):
            convert(declared)


def test_eight_contracts():
    assert list(C.CONTRACTS) == [
        "downloads", "posts", "sections", "glossary_terms", "publications", "legal_resources",
        "student_council_committees", "guide_pages",
    ]
    assert len(C.JURISDICTIONS) == 17 and len(C.GLOSSARY_TERMS.fields) == 19 and len(C.SECTION_TYPES) == 14


SMALL = C.Contract(
    "small",
    (C.Field("id", "uint8"), C.Field("kind", C.Enum(("a", "b")), True), C.Field("marks", C.ListOf(C.Enum(("x",))))),
)


def rows(spark):
    return spark.createDataFrame(
        [(1, "a", ["x", None]), (None, None, []), (-3, "z", ["x", "y"]), (4, "b", None)], "id int, kind string, marks array<string>"
    )


def test_violations_name_every_reason(spark):
    got = {r.id: r.reasons for r in quality.violations(rows(spark), SMALL, {"big": F.col("id") > 3}).collect()}
    assert got == {None: ["null:id"], -3: ["negative:id", "domain:kind", "domain:marks"], 4: ["null:marks", "big"]}
    counts = {r.reason: r.n for r in quality.violation_counts(rows(spark), SMALL).collect()}
    assert counts == {"null:id": 1, "negative:id": 1, "domain:kind": 1, "domain:marks": 1, "null:marks": 1}


def test_cast_strict_and_reporting(spark):
    contract = C.Contract("c", (C.Field("n", "int64", True),))
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    assert [r.n for r in quality.cast(df, contract, strict=False).collect()] == [1, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        quality.cast(df, contract).collect()


def test_missing_column_is_an_error_and_extra_a_warning(spark):
    df = spark.createDataFrame([(1, "u")], "id int, other string")
    assert quality.reconcile(df, SMALL) == (["kind", "marks"], ["other"])
    with pytest.raises(ValueError, match="kind"):
        conform(df, SMALL)
    with pytest.warns(UserWarning, match="other"):
        out = conform(df.withColumn("kind", F.lit("a")).withColumn("marks", F.array(F.lit("x"))), SMALL)
    assert out.columns == ["id", "kind", "marks"]


def test_publish_checks_and_replaces(spark, tmp_path):
    good = spark.createDataFrame([(1, "a", ["x"])], "id int, kind string, marks array<string>")
    path = publish(good, SMALL, str(tmp_path))
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, "a", ["x"])]
    publish(good.withColumn("id", F.lit(2)), SMALL, str(tmp_path))
    trial = publish(good.withColumn("id", F.lit(9)), SMALL, str(tmp_path), smoke=True)
    assert trial.endswith("smoke_test_small.parquet")
    with pytest.raises(ValueError, match="breaks its contract"):
        publish(rows(spark), SMALL, str(tmp_path))
    assert [r.id for r in spark.read.parquet(target_path(str(tmp_path), "small")).collect()] == [2]


def test_publish_broken_off_leaves_the_old_table(spark, tmp_path, monkeypatch):
    good = spark.createDataFrame([(1, "a", ["x"])], "id int, kind string, marks array<string>")
    path = publish(good, SMALL, str(tmp_path))
    move = publishing._Folders.move

    def fails(self, old, new):
        if old.endswith(".staging"):
            raise OSError("no room")
        move(self, old, new)

    monkeypatch.setattr(publishing._Folders, "move", fails)
    with pytest.raises(OSError, match="no room"):
        publish(good.withColumn("id", F.lit(2)), SMALL, str(tmp_path))
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]
    # A driver that dies between the two moves leaves the old table aside.
    monkeypatch.setattr(publishing._Folders, "move", move)
    publishing._Folders(spark, path).move(path, publishing.aside_path(path))
    publishing.recover(spark, path)
    assert [r.id for r in spark.read.parquet(path).collect()] == [1]
    publish(good.withColumn("id", F.lit(3)), SMALL, str(tmp_path))
    assert [r.id for r in spark.read.parquet(path).collect()] == [3]


def test_table_checks(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(1,)], "id int")
    assert [r.key for r in quality.orphans(child, "fk", parent, "id").collect()] == [2]
    assert [tuple(r) for r in quality.multiple(child, ["fk"]).collect()] == [(1, 2)]
    assert quality.multiple(child, ["fk"], F.col("fk") > 1).count() == 0
    assert quality.null_counts(child, ["fk"]).first().fk == 1
    quality.require_rows(child, 4)
    with pytest.raises(ValueError, match="expected 3"):
        quality.require_rows(child, 3)
    with pytest.raises(ValueError, match="orphans"):
        quality.require_none(quality.orphans(child, "fk", parent, "id"), "orphans")


def test_paged_scan_needs_every_page(spark, tmp_path):
    item = "id int"
    page = '{{"page": {}, "total_pages": 3, "items": [{{"id": {}}}]}}'
    for n in (1, 3):
        (tmp_path / f"{n}.json").write_text(page.format(n, n * 10))
    with pytest.raises(ValueError, match="pages are missing"):
        scan_paged(spark, str(tmp_path), item)
    assert scan_paged(spark, str(tmp_path), item, check=False).count() == 2
    (tmp_path / "2.json").write_text(page.format(2, 20))
    assert sorted(tuple(r) for r in scan_paged(spark, str(tmp_path), item).collect()) == [(1, 10), (2, 20), (3, 30)]
    pages = spark.createDataFrame([(1, 1), (1, 1)], "page int, total_pages int")
    assert missing_pages(pages).count() == 0


def test_no_page_at_all_is_a_gap(spark):
    assert missing_pages(spark.createDataFrame([], "page bigint, total_pages bigint")).count() == 1


def test_binary_files_keep_their_bytes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(bytes(range(256)) * 4)
    row = with_file_type(scan_files(spark, str(tmp_path)).withColumn("ct", F.lit("image/png")), "ct").first()
    assert bytes(row.content) == bytes(range(256)) * 4 and row.length == 1024 and row.file_type == "png"


def fake_session(named, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: named),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master=master),
    )


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(fake_session("hdfs:/shared/", "yarn")) == "hdfs:/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake_session(None, "yarn"))
    assert shared_dir(spark) == shared_dir(spark)


def test_dates_are_dates(spark):
    contract = C.Contract("d", (C.Field("day", "date"),))
    df = spark.createDataFrame([("2024-05-06 07:08:09",)], "day string").withColumn("day", F.col("day").cast("timestamp"))
    assert quality.cast(df, contract).first().day == datetime.date(2024, 5, 6)


def test_versions_behind_a_pointer(spark, tmp_path):
    contract = C.Contract("numbers", (C.Field("id", "int64"), C.Field("kind", C.Enum(("a", "b")))))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, kind string")
    folder = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        read_current(spark, folder, "numbers")
    first = publish_version(rows, contract, folder)
    held = read_current(spark, folder, "numbers")
    with pytest.raises(ValueError, match="domain:kind"):
        publish_version(rows.withColumn("kind", F.lit("c")), contract, folder)
    assert current_path(spark, f"{folder}/numbers.parquet") == first  # a broken version is not pointed to
    # Readers in a loop, while versions are published: each sees one whole version.
    stop, seen, wrong = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(sorted({r.id for r in read_current(spark, folder, "numbers").collect()})))
            except Exception as error:  # any miss is what this test is about
                wrong.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(3):
        publish_version(rows.withColumn("id", F.col("id") + 10 * (n + 1)), contract, folder)
    stop.set()
    reader.join()
    assert not wrong and set(seen) <= {(1, 2), (11, 12), (21, 22), (31, 32)} and seen
    assert sorted(r.id for r in held.collect()) == [1, 2]
    assert [r.rows for r in versions(spark, f"{folder}/numbers.parquet").orderBy("version").collect()] == [2, 2, 2, 2]
