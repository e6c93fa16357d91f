from __future__ import annotations

import os
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbside import session
from kerbside.fixed_values import FHVHV_SCHEMA, FHV_SCHEMA, LAKE_FILE_TEMPLATE
from kerbside.plans.build import ingest_in_parts, ingest_months
from kerbside.sinks import files, jdbc as jdbc_sink, manifest, tables
from kerbside.sinks.manifest import (
    CommitConflict, commit_manifest, land, read_landed, read_manifest, remove_unnamed,
)
from kerbside.sources import csv, jdbc, monthly
from kerbside.sources.tables import (
    Sources, load_seed, local_rows, read_month, read_tree, read_year, register_external,
)
from kerbside.streaming import land_new_files

# Quoted text, CRLF line ends, a key in its own spelling, names that look like gaps.
ZONES = (
    '"LocationID","Borough","Zone","service_zone"\r\n'
    '1,"EWR","Newark Airport","EWR"\r\n'
    '56,"Queens","Corona","Boro Zone"\r\n'
    '57,"Queens","Corona","Boro Zone"\r\n'
    '264,"Unknown","NV","N/A"\r\n'
    '265,"Unknown","NA","N/A"\r\n'
)
FHV_HEADER = "dispatching_base_num,pickup_datetime,dropoff_datetime,PULocationID,DOLocationID,SR_Flag"


@pytest.fixture
def zones_csv(tmp_path):
    path = tmp_path / "zones.csv"
    path.write_bytes(ZONES.encode())
    return str(path)


def fhv_file(root: Path, month: str, rows: int, day: int = 1) -> None:
    lines = [f"B{i:05d},{month}-{day:02d} 00:00:{i:02d},{month}-02 00:00:00,1,2," for i in range(rows)]
    root.mkdir(exist_ok=True)
    (root / f"fhv_tripdata_{month}.csv").write_text("\n".join([FHV_HEADER, *lines]) + "\n")


def test_zone_names_that_look_like_gaps_stay_text(spark, zones_csv):
    df = csv.read_csv_strings(spark, zones_csv)
    assert set(df.dtypes) == {(c, "string") for c in df.columns}
    assert df.filter("Zone = 'NA' AND service_zone = 'N/A'").count() == 1
    gaps = csv.read_csv_strings(spark, zones_csv, na_values=["NA", "N/A"])
    assert gaps.filter("Zone IS NULL").count() == 1
    assert gaps.filter("service_zone IS NULL").count() == 2


def test_inferred_sampled_and_overridden_types(spark, zones_csv, tmp_path):
    assert dict(csv.read_csv_inferred(spark, zones_csv).dtypes)["LocationID"] == "int"
    fixed = csv.read_csv_override(spark, zones_csv, {"locationid": "decimal(38,9)"})
    assert dict(fixed.dtypes)["LocationID"] == "decimal(38,9)"
    with pytest.raises(ValueError, match="no such column"):
        csv.read_csv_override(spark, zones_csv, {"nope": "int"})

    late = tmp_path / "late.csv"
    late.write_text("v,w\n" + "1,a\n" * 5 + "x,b\n")
    assert csv.sampled_schema(spark, str(late), rows=5).simpleString() == "struct<v:int,w:string>"
    assert csv.sampled_schema(spark, str(late), rows=6).simpleString() == "struct<v:string,w:string>"
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        csv.read_csv_sampled(spark, str(late), rows=5).collect()
    lenient = csv.read_csv_sampled(spark, str(late), rows=5, strict=False)
    assert [r.v for r in lenient.collect()] == [1] * 5 + [None]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        csv.read_csv_override(spark, str(late), {"v": "int"}).collect()
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        files.csv_to_parquet(spark, str(late), str(tmp_path / "p1"), schema="v int, w string")
    kept = files.csv_to_parquet(
        spark, str(late), str(tmp_path / "p2"), schema="v int, w string", strict=False
    )
    assert kept.filter("v IS NULL").count() == 1


def test_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fare,tip\n10,1\n")
    (tmp_path / "b.csv").write_text("Tip,extra,FARE\n2,x,20\n")
    (tmp_path / "c.csv").write_text("")
    got = csv.read_csv(spark, str(tmp_path), "fare int, tip int", strict=True)
    assert got.columns == ["fare", "tip"]
    assert sorted(tuple(r) for r in got.collect()) == [(10, 1), (20, 2)]
    with pytest.raises(ValueError, match="no column"):
        csv.read_csv(spark, str(tmp_path), "fare int, toll int")


def test_landing_stream_is_strict(spark, tmp_path):
    fhv_file(tmp_path / "raw", "2021-01", 2)
    (tmp_path / "raw" / "fhv_tripdata_2021-02.csv").write_text(f"{FHV_HEADER}\nB1,oops,,seven,2,\n")

    def land(name, **options):
        land_new_files(spark, str(tmp_path / "raw"), FHV_SCHEMA, str(tmp_path / name),
                       str(tmp_path / f"{name}-state"), **options)

    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        land("strict")
    land("lenient", strict=False)
    got = read_landed(spark, str(tmp_path / "lenient"))
    assert got.filter("PULocationID IS NULL").count() == 1 and got.count() == 3


def test_an_emptied_month_is_cleared(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    fhv_file(raw, "2021-01", 2)
    fhv_file(raw, "2021-02", 3)
    months = ["2021-01", "2021-02"]
    assert ingest_months(spark, "fhv", months, str(raw), FHV_SCHEMA, lake) == 5
    fhv_file(raw, "2021-01", 0)
    assert ingest_months(spark, "fhv", ["2021-01"], str(raw), FHV_SCHEMA, lake) == 0
    assert [tuple(r) for r in read_landed(spark, lake).groupBy("month").count().collect()] == [(2, 3)]


def test_month_named_parquet_in_year_folders(spark, tmp_path):
    for month, n in (("2020-01", 2), ("2020-02", 3), ("2021-01", 4)):
        path = monthly.month_path(LAKE_FILE_TEMPLATE, str(tmp_path), "green", month)
        spark.range(n).coalesce(1).write.parquet(path)
    got = monthly.read_month_files(spark, str(tmp_path), "green", ["2020-01", "2020-02"])
    assert sorted(tuple(r) for r in got.groupBy("file_month").count().collect()) == [
        ("2020-01", 2), ("2020-02", 3)
    ]


def test_months_of_services_and_years_are_named_files(spark, tmp_path):
    root = str(tmp_path / "lake")

    def rows(*months):
        return spark.createDataFrame([(m, i) for m, n in months for i in range(n)], "file_month string, id int")

    assert files.write_month_files(rows(("2020-01", 2), ("2020-12", 3), ("2021-01", 4)), root, "green") == [
        "2020-01", "2020-12", "2021-01"
    ]
    files.write_month_files(rows(("2020-01", 9)), root, "yellow")
    names = {str(p.relative_to(root)) for p in Path(root).glob("*/*/*")}
    assert names == {
        "green/2020/green_taxi_2020-01.parquet", "green/2020/green_taxi_2020-12.parquet",
        "green/2021/green_taxi_2021-01.parquet", "yellow/2020/yellow_taxi_2020-01.parquet",
    }
    year = monthly.read_month_files(spark, root, "green", ["2020-01", "2020-12"])
    assert {Path(f).parent.parent.name for f in year.inputFiles()} == {"2020"}
    assert all("/green/" in f for f in year.inputFiles())
    counts = lambda df: {r.file_month: r["count"] for r in df.groupBy("file_month").count().collect()}
    assert counts(year) == {"2020-01": 2, "2020-12": 3}
    # A month again replaces that month; a row without one leaves all as it was.
    files.write_month_files(rows(("2020-12", 1)), root, "green")
    with pytest.raises(Exception, match="no month"):
        files.write_month_files(rows(("2020-01", 5), (None, 1)), root, "green")
    assert counts(monthly.read_month_files(spark, root, "green", ["2020-01", "2020-12"])) == {"2020-01": 2, "2020-12": 1}
    assert not list(Path(root).glob("_*"))


def test_progress_is_told_before_the_end(spark, tmp_path):
    raw, dest = tmp_path / "raw", str(tmp_path / "lake")
    for month, n in (("2019-11", 2), ("2019-12", 3), ("2020-01", 4)):
        fhv_file(raw, month, n)
    parts = [["2019-11", "2019-12"], ["2020-01"]]
    progress = ingest_in_parts(spark, "fhv", parts, str(raw), FHV_SCHEMA, dest)
    first = next(progress)
    assert (first.months, first.rows, first.months_done) == (("2019-11", "2019-12"), 5, 2)
    assert first.seconds > 0 and round(first.percent_done, 2) == 66.67
    assert read_landed(spark, dest).count() == 5  # the next part has not begun
    (last,) = progress
    assert (last.rows, last.percent_done) == (4, 100.0) and read_landed(spark, dest).count() == 9


def test_declared_schema_strict_or_lenient(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text(
        "hvfhs_license_num,dispatching_base_num,pickup_datetime,dropoff_datetime,PULocationID,"
        "DOLocationID,SR_Flag\nHV0003,B1,2021-01-01 00:00:00,oops,7,seven,\n"
    )
    row = csv.read_csv(spark, str(path), FHVHV_SCHEMA, strict=False).first()
    assert (row.dropoff_datetime, row.PULocationID, row.DOLocationID, row.SR_Flag) == (
        None, 7, None, None
    )
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE"):
        csv.read_csv(spark, str(path), FHVHV_SCHEMA).collect()


def test_pieces_of_a_file(spark, tmp_path):
    path = tmp_path / "big.csv"
    path.write_text("v\n" + "".join(f"{i}\n" for i in range(20_000)))
    key = "spark.sql.files.maxPartitionBytes"
    try:
        csv.set_piece_bytes(spark, 10_000)
        df = csv.read_csv(spark, str(path), "v int")
        assert df.select(F.spark_partition_id()).distinct().count() > 5
        assert df.agg(F.sum("v")).first()[0] == 199_990_000
        # Numbered across pieces, in file order.
        numbered = csv.add_row_index(df)
        assert numbered.columns == ["row_index", "v"]
        assert numbered.filter("row_index <> v").count() == 0
        assert numbered.count() == 20_000
    finally:
        spark.conf.unset(key)


def test_row_index_runs_on_across_files(spark, tmp_path):
    for name, values in (("a.csv", [5, 3]), ("b.csv", [9]), ("c.csv", [1, 1])):
        (tmp_path / name).write_text("v\n" + "".join(f"{v}\n" for v in values))
    df = csv.add_row_index(csv.read_csv(spark, str(tmp_path), "v int"), "i")
    assert [tuple(r) for r in df.orderBy("i").collect()] == [(0, 5), (1, 3), (2, 9), (3, 1), (4, 1)]


def test_a_landing_that_dies_changes_nothing(spark, tmp_path, monkeypatch):
    raw, dest = tmp_path / "raw", str(tmp_path / "lake")
    months = ["2019-01", "2019-02"]
    for month in months:
        fhv_file(raw, month, 5)

    def run():
        return ingest_months(spark, "fhv", months, str(raw), FHV_SCHEMA, dest)

    def counts():
        rows = read_landed(spark, dest).groupBy("month").count().collect()
        return {r.month: r["count"] for r in rows}

    assert run() == 10 and counts() == {1: 5, 2: 5}
    # One month shrinks, the other is emptied; the run stops between the write and the switch.
    fhv_file(raw, "2019-01", 2)
    fhv_file(raw, "2019-02", 0)

    def stop(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "commit_manifest", stop)
        with pytest.raises(RuntimeError, match="killed"):
            run()
    assert counts() == {1: 5, 2: 5}
    # And while it writes.
    with pytest.raises(Exception, match="broken"):
        broken = F.when(F.col("PULocationID") > 0, F.raise_error(F.lit("broken"))).cast("string")
        land(read_landed(spark, dest).withColumn("SR_Flag", broken), dest, ["year", "month"])
    assert counts() == {1: 5, 2: 5}
    assert run() == 2 and counts() == {1: 2}
    # Readers of the manifest before still find their files; then only what is named stays.
    folders = lambda: len(list((tmp_path / "lake").glob("year=*/month=*/run=*")))
    assert folders() == 3
    remove_unnamed(spark, dest)
    assert folders() == 1 and counts() == {1: 2}
    fhv_file(raw, "2019-01", 0)
    assert run() == 0
    assert read_landed(spark, dest).columns == [*FHV_HEADER.split(","), "year", "month"]
    assert read_landed(spark, dest).count() == 0


def test_of_two_writers_one_is_refused(spark, tmp_path):
    dest = str(tmp_path / "lake")
    with pytest.raises(ValueError, match="nothing has landed"):
        read_landed(spark, dest)
    rows = spark.range(6).selectExpr("id", "int(id % 2) AS part")
    assert land(rows, dest, ["part"]) == 6
    start = read_manifest(spark, dest)
    commit_manifest(spark, dest, start)
    with pytest.raises(CommitConflict, match="manifest 2"):
        commit_manifest(spark, dest, start)
    assert read_manifest(spark, dest).number == 2
    assert read_manifest(spark, dest).runs == start.runs
    for _ in range(manifest.KEPT_MANIFESTS + 2):
        assert land(rows, dest, ["part"], replaced=["part=0", "part=1"]) == 6
    assert len(list((tmp_path / "lake" / manifest.FOLDER).iterdir())) <= 2 * manifest.KEPT_MANIFESTS
    assert land(rows.where("part = 1"), dest, ["part"]) == 3
    assert sorted(tuple(r) for r in read_landed(spark, dest).groupBy("part").count().collect()) == [
        (0, 3), (1, 6)
    ]


def test_a_stream_takes_headers_in_any_order_and_a_batch_once(spark, tmp_path, monkeypatch):
    raw, dest, state = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "state")
    fhv_file(raw, "2021-01", 3)
    turned = ",".join(reversed(FHV_HEADER.split(",")))
    (raw / "fhv_tripdata_2021-02.csv").write_text(f"{turned}\n,2,1,2021-02-02 00:00:00,2021-02-01 00:00:00,B9\n")

    def run():
        land_new_files(spark, str(raw), FHV_SCHEMA, dest, state)
        return sorted((r.dispatching_base_num, r.month) for r in read_landed(spark, dest).collect())

    # It dies after the commit, before the checkpoint knows: the batch comes again, and adds nothing.
    committed = manifest.commit_manifest

    def commit_and_die(*args):
        committed(*args)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(manifest, "commit_manifest", commit_and_die)
        with pytest.raises(Exception, match="killed"):
            run()
    wanted = [("B00000", 1), ("B00001", 1), ("B00002", 1), ("B9", 2)]
    assert run() == run() == wanted
    assert ingest_months(spark, "fhv", ["2021-01", "2021-02"], str(raw), FHV_SCHEMA, f"{dest}2") == 4
    both = [read_landed(spark, d) for d in (dest, f"{dest}2")]
    assert both[0].exceptAll(both[1]).count() == 0
    # Four tasks read the batch; each month is one file.
    assert [len(list(Path(p).glob("*.parquet"))) for p in read_manifest(spark, dest).paths(dest)] == [1, 1]
    (raw / "fhv_tripdata_2021-03.csv").write_text("dispatching_base_num\nB1\n")
    with pytest.raises(Exception, match="no column"):
        run()


def test_headers_are_read_by_executors(spark, tmp_path):
    (tmp_path / "a.csv").write_text('"fare\nin cents",tip\n10,1\n')
    (tmp_path / "b.csv").write_text('\ufefftip,"fare\nin cents"\n2,20\n' + "3,30\n" * 5_000)
    (tmp_path / "c.csv").write_text("")
    (tmp_path / "d one.csv").write_text('tip,"fare\nin cents"\n')
    got = {tuple(h): [Path(f).name for f in fs] for h, fs in csv.files_by_header(spark, str(tmp_path)).items()}
    assert got == {("fare\nin cents", "tip"): ["a.csv"], ("tip", "fare\nin cents"): ["b.csv", "d one.csv"]}
    headers = csv.file_headers(spark, str(tmp_path))
    assert headers.getNumPartitions() == 3  # a file a task; the empty one has none
    assert csv.files_by_header(spark, str(tmp_path / "a.csv")) == {("fare\nin cents", "tip"): None}
    assert csv.files_by_header(spark, str(tmp_path / "c.csv")) == {}
    assert csv.read_csv(spark, str(tmp_path / "c.csv"), "v int").count() == 0
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "x.csv").write_text("alone\n5\n")
    assert csv.files_by_header(spark, str(tmp_path / "one")) == {("alone",): None}
    assert csv.read_csv(spark, str(tmp_path / "one"), "alone int").first().alone == 5


def test_a_text_fits_the_same_types_in_one_expression_as_tried_one_by_one(spark):
    texts = [
        "5", "-7", "+0012", "2147483648", "9223372036854775808", "1" * 38, "1" * 39, "1.5", ".5", "5.", "1e9",
        "NaN", "-Inf", "Infinity", "1996-03-13", "1996-02-30", "1996-03-13 10:00:00", "1996-03-13T10:00",
        "1996-03-13 25:00:00", "1996-03-13Z", "1996-03-13 10:00:00.5+02:00", "0000-01-01", "true", "FALSE", "yes",
        " 5", "5 ", "5\n", "1996-03-13\n", "1.5\n", "true ", "--5", "+", ".", "-", "N/A", "\u0665",
    ]
    value = F.col("value")
    one_by_one = [F.when(fits(value), 1 << k).otherwise(0) for k, fits in enumerate(csv.LATTICE.values())]
    rows = spark.createDataFrame([(t,) for t in texts], "value string").select(
        "value", csv._fits(value).alias("at_once"), sum(one_by_one).alias("one_by_one")
    ).collect()
    assert [r for r in rows if r.at_once != r.one_by_one] == [] and len({r.at_once for r in rows}) == 8


def test_inference_takes_a_row_a_value_and_no_sort(spark, tmp_path, monkeypatch):
    columns = {f"c{k}": ["1", "x"][k % 2] for k in range(40)}
    spark.createDataFrame([columns]).write.option("header", True).csv(str(tmp_path / "wide"))
    seen = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(
        type(spark.range(1)), "collect",
        lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or collect(df),
    )
    schema = csv.inferred_schema(spark, str(tmp_path / "wide"))
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        f"c{k}": ["int", "string"][k % 2] for k in range(40)
    }
    assert len(seen) == 1 and "HashAggregate" in seen[0] and "SortAggregate" not in seen[0]


def test_inferred_types_and_what_broke_the_narrower_ones(spark, tmp_path):
    columns = {
        "i": ["1", "-2", ""], "l": ["1", "9000000000", "3"], "h": ["1", "9" * 25, "2"], "d": ["1", "2.5", "-1e3"],
        "nan": ["NaN", "1", "-Inf"], "day": ["2021-01-01", "", "2021-02-28"],
        "t": ["2021-01-01", "2021-01-01 10:00:00", "2021-01-01T10:00:00.5Z"], "b": ["true", "FALSE", ""],
        "s": ["1", "x", "2021-01-01"], "none": ["", "", ""], "space": [" 1", "2", "3"], "bad_day": ["2021-02-30", "", ""],
    }
    for k in (0, 1):
        rows = zip(*columns.values()) if k else [["7" if len(n) == 1 and n in "isld" else "" for n in columns]]
        body = "\n".join(",".join(r) for r in rows)
        (tmp_path / f"{k}.csv").write_text(",".join(columns) + f"\n{body}\n")
    strings = csv.read_csv_strings(spark, str(tmp_path))
    found = {t.name: t for t in csv.inferred_types(strings)}
    assert {n: t.kind for n, t in found.items()} == {
        "i": "int", "l": "bigint", "h": "decimal(38,0)", "d": "double", "nan": "double", "day": "date",
        "t": "timestamp", "b": "boolean", "s": "string", "none": "string", "space": "string", "bad_day": "string",
    }
    value, file = found["l"].broken["int"]
    assert value == "9000000000" and file.endswith("1.csv") and list(found["l"].broken) == ["int"]
    assert found["d"].broken["int"][0] == "-1e3" and found["s"].broken["double"][0] == "2021-01-01"
    # One scan, which keeps one row a task.
    inferred = csv.read_csv_inferred(spark, str(tmp_path))
    assert dict(inferred.dtypes)["h"] == "decimal(38,0)" and inferred.count() == 4
    spark_own = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path))
    same = ["i", "l", "d", "nan", "day", "b", "s", "none", "bad_day"]
    assert {n: dict(inferred.dtypes)[n] for n in same} == {n: dict(spark_own.dtypes)[n] for n in same}


def test_a_rebuilt_table_is_switched_at_the_end(spark, tmp_path):
    root = str(tmp_path / "rebuilt")

    def versions():
        return {p.name for p in Path(root).glob("version=*")}

    assert tables.rebuild_table(spark.range(3), "rebuilt", root).count() == 3
    with pytest.raises(Exception, match="broken"):
        broken = F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id"))
        tables.rebuild_table(spark.range(9).select(broken.cast("bigint").alias("id")), "rebuilt", root)
    assert spark.table("rebuilt").count() == 3 and len(versions()) == 2
    # A reader who began before the switch still finds its files; what died is gone.
    reader = spark.table("rebuilt")
    first = versions()
    assert tables.rebuild_table(spark.range(5), "rebuilt", root).count() == 5
    assert reader.count() == 3 and len(versions()) == 2 and len(versions() - first) == 1
    assert tables.as_table(spark.range(2), "rebuilt", mode="append").count() == 7
    # Its own rows are a table's to read while it is rebuilt.
    kept = tables.rebuild_table(spark.table("rebuilt").where("id < 2"), "rebuilt", root)
    assert sorted(r.id for r in kept.collect()) == [0, 0, 1, 1]
    other = tables.rebuild_table(spark.range(1).selectExpr("id", "'x' AS more"), "rebuilt", root)
    assert other.columns == spark.table("rebuilt").columns == ["id", "more"] and other.count() == 1
    inside = tables.as_table(spark.range(4), "rebuilt_inside")
    assert inside.count() == tables.as_table(spark.range(4), "default.rebuilt_inside").count() == 4


def test_a_table_is_never_read_through_a_view(spark, tmp_path):
    tables.rebuild_table(spark.range(3), "shadowed", str(tmp_path / "shadowed"))
    tables.as_view(spark.range(1), "shadowed")
    try:
        for mode in ("overwrite", "append"):
            with pytest.raises(ValueError, match="temporary view"):
                tables.as_table(spark.range(5), "shadowed", str(tmp_path / "shadowed"), mode)
        assert spark.table("spark_catalog.default.shadowed").count() == 3
    finally:
        spark.catalog.dropTempView("shadowed")
    assert spark.table("shadowed").count() == 3


def test_month_names_and_paths():
    assert monthly.month_range("2019-11", "2020-02") == ["2019-11", "2019-12", "2020-01", "2020-02"]
    assert monthly.month_range("2021-03", "2021-02") == []
    assert monthly.month_paths("/raw", "green", ["2019-01"]) == ["/raw/green_tripdata_2019-01.csv"]
    assert monthly.month_path(LAKE_FILE_TEMPLATE, "/lake", "yellow", "2019-01") == (
        "/lake/yellow/2019/yellow_taxi_2019-01.parquet"
    )
    for bad in ("{root}/_taxi_{month}.parquet", "{root}/{service}/", "{root}/{{year}}/{month}"):
        with pytest.raises(ValueError, match="not a usable file path"):
            monthly.month_path(bad, "/lake", "yellow", "2019-01")


def test_months_land_once_whatever_is_rerun(spark, tmp_path):
    raw, dest = tmp_path / "raw", str(tmp_path / "lake")
    for month, rows in (("2019-01", 5), ("2019-02", 2), ("2020-01", 3)):
        fhv_file(raw, month, rows)
    months = ["2019-01", "2019-02", "2020-01"]

    def land(which):
        return ingest_months(spark, "fhv", which, str(raw), FHV_SCHEMA, dest)

    assert land(months) == 10
    assert land(["2019-02"]) == 2
    assert land(months) == 10
    lake = read_landed(spark, dest)
    counts = {(r.year, r.month): r["count"] for r in lake.groupBy("year", "month").count().collect()}
    assert counts == {(2019, 1): 5, (2019, 2): 2, (2020, 1): 3}
    # A corrected file replaces its own month only.
    fhv_file(raw, "2019-02", 4)
    land(["2019-02"])
    assert read_landed(spark, dest).count() == 12


def test_a_stray_date_stays_with_its_file(spark, tmp_path):
    raw, dest = tmp_path / "raw", str(tmp_path / "lake")
    fhv_file(raw, "2019-01", 3)
    path = raw / "fhv_tripdata_2019-02.csv"
    path.write_text(f"{FHV_HEADER}\nB1,2019-01-31 23:59:59,2019-02-01 00:00:00,1,2,\n")
    for months in (["2019-01"], ["2019-02"], ["2019-02"]):
        ingest_months(spark, "fhv", months, str(raw), FHV_SCHEMA, dest)
    lake = read_landed(spark, dest)
    assert lake.filter("month = 1").count() == 3 and lake.filter("month = 2").count() == 1
    assert files.misplaced_rows(lake, "pickup_datetime").count() == 1


def test_stream_takes_each_file_once(spark, tmp_path):
    raw, dest, checkpoint = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "cp")

    def landed():
        land_new_files(spark, str(raw), FHV_SCHEMA, dest, checkpoint)
        return read_landed(spark, dest).count()

    fhv_file(raw, "2019-01", 5)
    assert [landed(), landed()] == [5, 5]
    fhv_file(raw, "2019-02", 2)
    assert [landed(), landed()] == [7, 7]
    lake = read_landed(spark, dest)
    assert lake.filter("year = 2019 AND month = 2").count() == 2


def test_layout_prunes_to_one_year_and_hides_nothing(spark, tmp_path):
    df = spark.sql(
        "SELECT 'green' AS service_type, id, timestamp_ntz'2019-01-01' + make_dt_interval(id) AS t "
        "FROM range(800)"
    )
    path = str(tmp_path / "lake")
    laid = files.with_year_month(df, "t")
    assert files.write_by_month(laid, path, ["service_type", "year", "month"]) == 800
    year = read_year(spark, path, "green", 2020)
    assert year.count() == 366
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_type" in plan
    assert files.misplaced_rows(read_tree(spark, path), "t").count() == 0
    names = [n for _, _, found in os.walk(path) for n in found if n.endswith(".parquet")]
    assert names and not any(n[0] in "_." for n in names)


def test_a_month_of_a_table_is_one_partition(spark, tmp_path):
    path = str(tmp_path / "months")
    df = spark.sql("SELECT id, '2019-0' || (1 + id % 3) AS file_month FROM range(30)")
    files.write_by_month(df, path, ["file_month"])
    month = read_month(spark, path, "2019-02")
    assert month.count() == 10
    assert "PartitionFilters: [isnotnull(file_month" in month._jdf.queryExecution().toString()


def test_parquet_writers(spark, tmp_path):
    df = spark.range(100)
    files.write_repartitioned(df, str(tmp_path / "many"), 24)
    assert len(list((tmp_path / "many").glob("*.parquet"))) == 24
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_repartitioned(df, str(tmp_path / "many"))
    for _ in range(2):
        files.write_single_file(df, str(tmp_path / "one"))
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    large = spark.range(1_100_000)
    files.write_single_file(large, str(tmp_path / "large"))
    assert spark.read.parquet(str(tmp_path / "large")).count() == 1_100_000
    assert len(list((tmp_path / "large").glob("*.parquet"))) == 1
    with pytest.raises(Exception):
        files.write_if_absent(df.select(F.raise_error(F.lit("no"))), str(tmp_path / "absent"))
    files.write_if_absent(df, str(tmp_path / "absent"))
    files.write_if_absent(df.limit(1), str(tmp_path / "absent"))
    assert spark.read.parquet(str(tmp_path / "absent")).count() == 100


def test_csv_to_parquet(spark, zones_csv, tmp_path):
    got = files.csv_to_parquet(
        spark, zones_csv, str(tmp_path / "z.parquet"), overrides={"locationid": "bigint"}
    )
    assert got.count() == 5 and dict(got.dtypes)["LocationID"] == "bigint"
    with pytest.raises(ValueError, match="not a CSV file"):
        files.csv_to_parquet(spark, "zones.txt", str(tmp_path / "x"))
    files.index_csv(spark, zones_csv, str(tmp_path / "indexed"))
    indexed = csv.read_csv_inferred(spark, str(tmp_path / "indexed"))
    assert indexed.columns[0] == "row_index"
    assert {(r.row_index, r.LocationID) for r in indexed.collect()} == {
        (0, 1), (1, 56), (2, 57), (3, 264), (4, 265)
    }


def test_tables(spark, zones_csv, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    assert tables.empty_table(df, "t_empty", path).count() == 0
    assert tables.as_table(df, "t_empty", path, mode="append").count() == 3
    assert tables.replace_then_append([df, df], "t_empty", path).count() == 6
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        tables.as_table(df, "t_empty", path, mode="error")
    with pytest.raises(ValueError):
        tables.replace_then_append([], "t_empty")
    assert tables.as_view(df, "a_view").count() == 3

    seed = load_seed(spark, zones_csv, path=str(tmp_path / "seed"))
    assert dict(seed.dtypes)["LocationID"] == "decimal(38,9)"
    assert spark.table("taxi_zone_lookup").count() == 5

    df.write.parquet(str(tmp_path / "ext"))
    assert register_external(spark, "t_ext", str(tmp_path / "ext")).count() == 3
    sources = Sources(spark, {"files": str(tmp_path / "ext")}, database="default")
    assert sources.table("files").count() == 3 and sources.table("t_ext").count() == 3
    assert local_rows(spark, pd.DataFrame({"a": [1, 2]})).count() == 2


def test_jdbc_options():
    """Only what is handed to Spark; no database is started for the tests."""
    assert jdbc.range_options(None, None, None) == {}
    assert jdbc.range_options("id", (1, 9), 4) == {
        "column": "id", "lowerBound": 1, "upperBound": 9, "numPartitions": 4
    }
    with pytest.raises(ValueError, match="go together"):
        jdbc.range_options("id", None, 4)
    assert jdbc.month_predicates("t", ["2019-12"]) == [
        "t >= TIMESTAMP '2019-12-01 00:00:00' AND t < TIMESTAMP '2020-01-01 00:00:00'"
    ]
    march, january = jdbc.month_predicates("t", ["2021-03", "2021-01"])
    assert "'2021-04-01" in march and "'2021-02-01" in january
    assert jdbc_sink.writer_properties({"user": "u"}, connections=2) == {
        "user": "u", "batchsize": "100000", "numPartitions": "2", "truncate": "false"
    }


def test_session_sizes(spark, monkeypatch):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    scan = "spark.sql.files.maxPartitionBytes"
    spark.conf.unset(scan)

    def sized(total):
        monkeypatch.setattr(session, "input_bytes", lambda *_: total)
        session.prepare(spark, ["/data"])
        return int(spark.conf.get(initial)), int(spark.conf.get(scan).rstrip("B"))

    try:
        assert sized(1000) == (8, 128 * session.MIB)
        tera = 1024**4
        assert sized(tera) == (4096, 128 * session.MIB)
        partitions, piece = sized(100 * tera)
        assert partitions == 20_000 and 100 * tera / piece <= 200_000
    finally:
        spark.conf.unset(initial)
        spark.conf.unset(scan)
    assert session.files_for(0, 24) == 24
    assert session.files_for(100 * session.TARGET_FILE_BYTES, 24) == 100


def test_settings_of_the_user_stay(spark):
    key = "spark.sql.files.maxPartitionBytes"
    try:
        csv.set_piece_bytes(spark, 10_000)
        session.prepare(spark, [])
        session.prepare(spark, [str(Path(__file__).parent)])
        assert spark.conf.get(key) == "10000"
    finally:
        spark.conf.unset(key)


def test_a_replaced_file_shows_its_new_columns(spark, tmp_path):
    from kerbside.sources.star_schema import table

    for columns in (["id"], ["id", "more"]):
        spark.range(2).select("id", F.lit(1).alias("more")).select(*columns).write.mode(
            "overwrite").parquet(str(tmp_path / "t.parquet"))
        spark.catalog.refreshByPath(str(tmp_path / "t.parquet"))
        assert table(spark, str(tmp_path), "t").columns == columns


def test_input_size(spark, tmp_path):
    (tmp_path / "part").mkdir()
    (tmp_path / "a").write_bytes(b"x" * 10)
    (tmp_path / "part" / "b").write_bytes(b"x" * 5)
    assert session.input_bytes(spark, [str(tmp_path), str(tmp_path / "a")]) == 25


def test_scratch_is_in_the_shared_folder(spark):
    path = session.scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != session.scratch_path(spark, "x")


def test_released_scratch_is_this_applications_only(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir")) / "kerbside"
    spark.range(1).write.parquet(session.scratch_path(spark, "gone"))
    (shared / "other-app").mkdir()
    session.release_scratch(spark)
    assert [p.name for p in shared.iterdir()] == ["other-app"]


def test_a_cluster_without_a_shared_folder_is_refused(spark):
    class Context:
        applicationId, master = "app-1", "spark://host:7077"

    class Conf:
        get = staticmethod(lambda key, default: default)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_path(Session, "x")
    Context.master = "local[2]"
    first, second = session.scratch_path(Session, "x"), session.scratch_path(Session, "y")
    assert os.path.dirname(first) == os.path.dirname(second)
