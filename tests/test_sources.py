"""Readers and writers."""

import csv
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockside import fixtures as fx
from dockside import schemas
from dockside.plans import monthly
from dockside.sources import (
    JdbcSource,
    VersionedFolder,
    equal_cuts,
    jdbc_ranges,
    publish_run,
    published_files,
    read_countries,
    read_dim,
    read_fact,
    read_lines,
    read_preferred_vendors,
    resolve,
    run_folder,
    scratch_path,
    split_dim,
    stage,
    tee,
    warehouse_types,
    with_cuts,
    write_book,
    write_lines,
    write_report,
    write_snapshot,
)
from dockside.sources.lines import _table_name


def test_quoted_commas_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "vendors.csv"
    path.write_text(
        "New Category,Category,Vendor ID,Vendor Legacy ID,Vendor Name,Category Status?\n"
        'Knits,Total Knits,12,000307647,"ACME CO., LTD",Preferred\n'
        'Knits,Total Knits,13,000000001,"THE ""BEST"" CO",Preferred\n'
    )
    got = read_dim(spark, str(path), schemas.PREFERRED_VENDOR_FILE).collect()
    assert [r["Vendor Name"] for r in got] == ["ACME CO., LTD", 'THE "BEST" CO']
    assert got[0]["Vendor Legacy ID"] == "000307647"
    listed = read_preferred_vendors(spark, str(path))
    assert listed.schema.names == schemas.PREFERRED_VENDOR.names
    assert listed.dtypes[2] == ("vendor_id", "bigint")
    assert tuple(listed.first()) == ("Knits", "ACME CO., LTD", 12, "Preferred")


def test_caret_file_keeps_na_and_dash(spark, tmp_path):
    path = tmp_path / "country.txt"
    head = "^".join(schemas.COUNTRY_FILE.fieldNames())
    path.write_text(f"{head}\n-^Unassigned^A^B^C^D\nNA^NAMIBIA^A^B^C^D\n")
    got = read_dim(spark, str(path), schemas.COUNTRY_FILE, sep="^").collect()
    assert [(r["CTRY_CD"], r["CTRY_DESC"]) for r in got] == [("-", "Unassigned"), ("NA", "NAMIBIA")]
    assert read_countries(spark, str(path)).count() == 2


def test_a_changed_header_is_noticed(spark, tmp_path):
    path = tmp_path / "country.txt"
    path.write_text("CODE^NAME^c^d^e^f\nA^B^C^D^E^F\n")
    with pytest.raises(Exception, match="header|CSV"):
        read_dim(spark, str(path), schemas.COUNTRY_FILE, sep="^").collect()


def test_rule_table_file(spark, sf_dir, tmp_path):
    rules = fx.ship_choice(spark, sf_dir)
    rules.write.option("header", True).csv(str(tmp_path / "rules"))
    back = read_dim(spark, str(tmp_path / "rules"), schemas.SHIP_CHOICE)
    assert sorted(back.collect()) == sorted(rules.collect())


def test_jdbc_ranges_cover_every_row_once(spark):
    df = spark.createDataFrame([(v,) for v in ("a", "b", "c", "k'", "z", None)], "id string")
    ranges = jdbc_ranges("id", ("b", "k'"))
    # Spark writes a quote inside a literal with a backslash; databases double it.
    hits = [df.where(r.replace("''", "\\'")).count() for r in ranges]
    assert hits == [2, 2, 2]
    assert jdbc_ranges("id", ()) == ["1 = 1"]
    assert jdbc_ranges("n", (10,)) == ["n < 10 OR n IS NULL", "n >= 10"]


def test_snapshot_keeps_types_and_prunes_years(spark, sf_dir, tmp_path):
    sot = fx.sot(spark, sf_dir, ("NUMBER_SEQ", "FISCAL_YEAR", "Units"))
    saved = write_snapshot(sot, str(tmp_path / "sot"))
    assert saved.dtypes == sot.dtypes
    again = read_fact(
        spark, str(tmp_path / "sot"), schemas.SOT, ("NUMBER_SEQ", "FISCAL_YEAR", "Units")
    )
    assert again.count() == sot.count()
    plan = again.where("FISCAL_YEAR = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(FISCAL_YEAR" in plan


def broken(df):
    """The same columns, but the job that reads them fails at one row."""
    return df.withColumn("Units", F.when(F.col("NUMBER_SEQ") == "L7", F.raise_error(F.lit("broken"))).otherwise(F.col("Units")))


@pytest.fixture
def small_lines(spark):
    rows = [(f"L{i}", 2000 + i % 2, float(i)) for i in range(20)]
    return spark.createDataFrame(rows, "NUMBER_SEQ string, FISCAL_YEAR int, Units double")


LINE_COLUMNS = ("NUMBER_SEQ", "FISCAL_YEAR", "Units")


def test_a_failed_save_leaves_the_snapshot(spark, small_lines, tmp_path):
    path = str(tmp_path / "sot")
    write_snapshot(small_lines, path)
    with pytest.raises(Exception, match="broken"):
        write_snapshot(broken(small_lines), path)
    assert read_fact(spark, path, schemas.SOT, LINE_COLUMNS).count() == 20
    assert len(VersionedFolder(spark, path).versions()) == 1
    assert len(list(Path(path).glob("v-*"))) == 1


def test_a_save_may_read_what_it_replaces(spark, small_lines, tmp_path):
    path = str(tmp_path / "sot")
    write_snapshot(small_lines, path)
    for left in (18, 16, 14, 12):
        lines = read_fact(spark, path, schemas.SOT, LINE_COLUMNS)
        write_snapshot(lines.where(F.col("Units") < left), path)
        assert read_fact(spark, path, schemas.SOT, LINE_COLUMNS).count() == left
    # The last two versions stay, for readers that still run.
    assert len(list(Path(path).glob("v-*"))) == 2
    assert [v.number for v in VersionedFolder(spark, path).versions()] == [4, 5]


def test_savers_at_the_same_time_and_broken_entries(spark, tmp_path):
    one, two = (VersionedFolder(spark, str(tmp_path / "t")) for _ in range(2))
    assert one.current() is None and resolve(spark, str(tmp_path / "t")) == str(tmp_path / "t")
    a, b = one.new_folder(), two.new_folder()
    assert one._claim(f"{one.root}/_versions/0000000001.json", "")  # a saver that died in between
    assert one.current() is None
    assert (two.publish(b).number, one.publish(a).number) == (2, 3)
    assert two.current().folder == a
    assert not one._claim(f"{one.root}/_versions/0000000003.json", "x")


def test_left_over_folders_go_after_a_while(spark, small_lines, tmp_path):
    versions = VersionedFolder(spark, str(tmp_path / "t"))
    small_lines.write.parquet(versions.new_folder())
    kept = versions.new_folder()
    small_lines.write.parquet(kept)
    versions.publish(kept)
    assert versions.clean() == []
    assert len(versions.clean(stale_hours=-1)) == 1
    assert spark.read.parquet(resolve(spark, versions.root)).count() == 20


def test_a_run_is_published_whole_or_not_at_all(spark, tmp_path):
    params = replace(fx.PARAMS, out_dir=str(tmp_path))
    assert published_files(spark, params, "run") == {}

    def write(n, fail=False):
        def files(own):
            paths = {"A": write_report(spark.range(n), "A", own)}
            second = spark.range(n).select(F.raise_error(F.lit("broken")).cast("int").alias("x")) if fail else spark.range(n)
            return paths | {"B": write_report(second, "B", own)}

        return files

    count = lambda: [spark.read.option("header", True).csv(p).count() for p in published_files(spark, params, "run").values()]
    assert publish_run(spark, params, "run", write(3)) == published_files(spark, params, "run")
    with pytest.raises(Exception, match="broken"):
        publish_run(spark, params, "run", write(5, fail=True))
    assert count() == [3, 3]
    publish_run(spark, params, "run", write(7))
    assert count() == [7, 7]


def test_lines_in_buckets_meet_without_a_shuffle(spark, tmp_path):
    rows = [(f"L{i % 40}" if i % 3 else "hot", "Late" if i % 2 else "OnTime", 1 + i % 12, float(i)) for i in range(600)]
    facts = spark.createDataFrame(rows, "NUMBER_SEQ string, Lateness string, Month_Number int, Units double").repartition(6)
    keys = ("NUMBER_SEQ", "Lateness", "Month_Number", "Week")
    for name in ("ots", "sot"):
        write_lines(facts, str(tmp_path / name), keys, 4)
    want = monthly.stocked_vs_shipped(facts, facts)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # As a later session finds them: the catalog knows nothing yet.
        for name in ("ots", "sot"):
            spark.sql(f"DROP TABLE {_table_name(VersionedFolder(spark, str(tmp_path / name)).current().folder)}")
        ots, sot = (read_lines(spark, str(tmp_path / name)) for name in ("ots", "sot"))
        got = monthly.stocked_vs_shipped(ots, sot, collapsed=True)
        assert sorted(got.collect()) == sorted(want.collect())
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert "SortMergeJoin" in plan and "Exchange" not in plan[plan.index("SortMergeJoin") :]
    # The hot id takes one row for each status and month, not one for each line.
    assert sot.where("NUMBER_SEQ = 'hot'").count() == 4
    assert sot.agg(F.sum("lines")).first()[0] == 600
    with pytest.raises(ValueError, match="no lines"):
        read_lines(spark, str(tmp_path / "none"))


def test_equal_cuts_of_a_skewed_text_id(spark):
    # Nine in ten ids share a long prefix; lengths differ.
    ids = F.expr("CASE WHEN id % 10 < 9 THEN concat('AAAA-', lpad(hex(id * 7919), 9, '0')) ELSE concat(chr(66 + id % 24), id) END")
    df = spark.range(0, 100_000, 1, 8).select(ids.alias("id"))
    cuts = equal_cuts(df, "id", 8)
    assert len(cuts) == 7 and cuts == sorted(cuts)
    sizes = [df.where(r).count() for r in jdbc_ranges("id", cuts)]
    assert sum(sizes) == 100_000
    assert max(abs(n - 12_500) for n in sizes) <= 1_250


def test_equal_cuts_of_few_hot_and_missing_values(spark):
    hot = spark.createDataFrame([("b",)] * 900 + [("a",)] * 50 + [("c",)] * 50 + [(None,)] * 100, "id string")
    cuts = equal_cuts(hot, "id", 4)
    assert cuts and len(set(cuts)) == len(cuts) and set(cuts) <= {"a", "b", "c"}
    assert sum(hot.where(r).count() for r in jdbc_ranges("id", cuts)) == 1_100
    assert equal_cuts(hot, "id", 1) == [] == equal_cuts(hot.where("id = 'b'"), "id", 4)
    assert equal_cuts(hot.where("false"), "id", 4) == []
    source = JdbcSource("jdbc:x", "t", column="id", single_task=True)
    assert with_cuts(source, hot, 4).cuts == tuple(cuts) and not with_cuts(source, hot, 4).single_task
    assert with_cuts(source, hot.where("false"), 4).single_task


def test_malformed_rows_are_reported(spark, tmp_path):
    path = tmp_path / "rules.csv"
    path.write_text(
        "SHIP_MODE_CD,Trade_Lane_Type,SALES_TERMS_CODE,ShipDateChoice,Ship_Choice_Status\n"
        "A,INTRA,FOB,OC,1\nA,INTRA,FOB,LP,x\nO,INTER,FOB,OC,2,9\nO,INTER\nO,INTER,CIF,OC,\n"
    )
    split = split_dim(spark, str(path), schemas.SHIP_CHOICE)
    assert sorted(map(tuple, split.good.collect())) == [("A", "INTRA", "FOB", "OC", 1), ("O", "INTER", "CIF", "OC", None)]
    bad = split.bad.collect()
    assert {r["record"] for r in bad} == {"A,INTRA,FOB,LP,x", "O,INTER,FOB,OC,2,9", "O,INTER"}
    assert bad[0]["file"].endswith("rules.csv")
    # A report that reads one text column sees the malformed number too.
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        read_dim(spark, str(path), schemas.SHIP_CHOICE).select("SHIP_MODE_CD").collect()
    with pytest.raises(ValueError, match="more than 2 malformed"):
        read_dim(spark, str(path), schemas.SHIP_CHOICE, bad_rows=2)
    assert read_dim(spark, str(path), schemas.SHIP_CHOICE, bad_rows=3).count() == 2


def test_report_name_headings_and_null_token(spark, tmp_path):
    params = replace(fx.PARAMS, out_dir=str(tmp_path))
    df = spark.sql("SELECT 'a' AS entity, CAST(NULL AS DOUBLE) AS ots_pct")
    path = write_report(df, "Report", params, null_token="0", single_file=True)
    assert path == f"{tmp_path}/Report_WE_48.csv"
    (part,) = Path(path).glob("part-*.csv")
    with part.open(newline="") as f:
        assert list(csv.DictReader(f)) == [{"Entity": "a", "OTS%": "0"}]


def test_tee_writes_and_passes_on(spark, tmp_path):
    df = spark.range(3).select("id", (F.col("id") * 2).alias("twice"))
    out = tee(df, str(tmp_path / "check.csv"))
    assert sorted(out.collect()) == sorted(df.collect())
    assert spark.read.option("header", True).csv(str(tmp_path / "check.csv")).count() == 3


def test_book_has_one_folder_per_table(spark, tmp_path):
    paths = write_book({"By A": spark.range(2), "By B": spark.range(3)}, str(tmp_path / "book"))
    assert [spark.read.option("header", True).csv(p).count() for p in paths.values()] == [2, 3]


def test_stage_keeps_schema(spark):
    df = spark.sql("SELECT 1 AS a, DATE '2000-01-01' AS d, CAST(NULL AS STRING) AS s")
    assert stage(df, "t").dtypes == df.dtypes


def test_scratch_lies_in_the_shared_folder_and_is_removed(spark):
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second
    before = spark.sparkContext.getCheckpointDir()
    with run_folder(spark, "run") as folder:
        stage(spark.range(3), "t", f"{folder}/t")
        assert Path(folder, "t").exists()
    assert not Path(folder).exists()
    # The caller's checkpoint folder is left alone.
    assert spark.sparkContext.getCheckpointDir() == before


def test_database_columns_are_cast_to_the_schema(spark):
    raw = spark.sql(
        "SELECT 'L1  ' AS number_seq, CAST(10.25 AS DECIMAL(18,2)) AS UNITS, "
        "CAST(3 AS BIGINT) AS Week, TIMESTAMP '2000-01-02 00:00:00' AS Data_Pulled"
    )
    schema = T.StructType([schemas.OTS[c] for c in ("NUMBER_SEQ", "Data_Pulled", "Week", "Units")])
    got = warehouse_types(raw, schema)
    assert got.schema.simpleString() == schema.simpleString()
    assert tuple(got.first()) == ("L1", date(2000, 1, 2), 3, 10.25)


def test_a_database_read_needs_cuts_or_a_word():
    with pytest.raises(ValueError, match="cuts"):
        JdbcSource("jdbc:x", "t")
    assert JdbcSource("jdbc:x", "t", single_task=True).cuts == ()
    assert JdbcSource("jdbc:x", "t", cuts=("b",)).cuts == ("b",)


def test_a_stocked_extract_may_lack_the_year(spark, sf_dir):
    columns = [c for c in fx.OTS if c != "FISCAL_YEAR"]
    assert schemas.conform(fx.ots(spark, sf_dir, columns), schemas.OTS).columns == columns
    with pytest.raises(ValueError, match="Week"):
        schemas.conform(fx.ots(spark, sf_dir, [c for c in columns if c != "Week"]), schemas.OTS)
