import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import shop
from stallbook import schemas
from stallbook.functions.text import utf8_hex
from stallbook.sources import commits, csv_files, tables


def test_every_table_lands_whole_and_as_text(landed):
    assert {name: df.count() for name, df in landed.items()} == shop.LANDED_ROWS
    for name, df in landed.items():
        assert df.columns == schemas.LANDING_COLUMNS[name].split()
        assert {f.dataType for f in df.schema.fields} == {T.StringType()}


def test_quotes_line_breaks_and_accents_survive(landed):
    reviews = {r["review_id"]: r for r in landed["order_reviews"].collect()}
    assert reviews["r2"]["review_comment_message"] == 'broke on the first day,\n"never again"'
    assert landed["customers"].where("customer_id = 'c1'").first()["customer_city"] == "são paulo"


def test_empty_field_is_null_and_quoted_empty_is_not(landed):
    reviews = {r["review_id"]: r["review_comment_message"] for r in landed["order_reviews"].collect()}
    assert reviews["r5"] is None and reviews["r3"] == ""


def test_byte_order_mark_and_crlf_do_not_reach_a_value(landed):
    rows = landed["product_category_name_translation"].select(
        "*", utf8_hex("product_category_name").alias("hex")).collect()
    assert {tuple(r) for r in rows} == {("beleza", "beauty", "62656c657a61"), ("audio", "audio", "617564696f")}


def test_file_names_are_parameters(spark, raw_folder, tmp_path):
    (tmp_path / "shop_orders_2018.csv").write_text(shop.FILES["orders"], encoding="utf-8")
    (tmp_path / "sellers-a.csv").write_text(shop.FILES["sellers"], encoding="utf-8")
    landed = csv_files.land(spark, str(tmp_path), "shop_{table}_2018.csv", {"sellers": "sellers-*.csv"})
    assert landed["orders"].count() == 11 and landed["sellers"].count() == 3


def test_csv_round_trip(spark, tmp_path):
    rows = [("a", None), ("", "x,y"), ('"q"', "two\nlines"), ("back\\slash", " padded ")]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "ab"])
    csv_files.write_csv(spark.createDataFrame(rows, schema), str(tmp_path / "t"))
    back = csv_files.read_csv(spark, str(tmp_path / "t"), schema, line_breaks=True)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, rows))


@pytest.mark.parametrize("chunk", [1, 40, csv_files.CHUNK])
def test_records_across_lines_and_blocks(spark, tmp_path, chunk):
    """Files cut into many blocks and chunks give the records one sequential reader finds."""
    rng = random.Random(3)
    words = ["a", "b,c", 'say ""x""', "line\nbreak", "two\n\nbreaks", "cr\r\nlf", "", "é"]
    wanted = []
    for n in range(3):
        with open(tmp_path / f"part{n}.csv", "w", encoding="utf-8", newline="") as file:
            file.write('\ufeff"id ""of""\nrow",text\r\n')
            for i in range(400):
                text = " ".join(rng.choices(words, k=rng.randrange(0, 30)))
                if i % 7 == 0:
                    file.write(f"{n}-{i},\r\n")
                    wanted.append((f"{n}-{i}", None))
                else:
                    file.write(f'{n}-{i},"{text}"\r\n')
                    wanted.append((f"{n}-{i}", text.replace('""', '"')))
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = csv_files.read_csv(spark, str(tmp_path / "part*.csv"), schema, line_breaks=True, chunk=chunk)
        assert spark.read.text(str(tmp_path / "part*.csv")).rdd.getNumPartitions() > 30
        rows = sorted(map(tuple, found.collect()), key=lambda r: r[0])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert rows == sorted(wanted, key=lambda r: r[0])


def test_files_are_read_once(spark, tmp_path):
    """What is left to run reads what the one pass over the files wrote down."""
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    schema = T.StructType.fromDDL("a string, b string")
    found = csv_files.read_csv(spark, str(tmp_path / "t.csv"), schema, line_breaks=True)
    (tmp_path / "t.csv").unlink()
    assert sorted(map(tuple, found.collect())) == [("1", "x\ny"), ("2", "z")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and plan.count("text#") > 0


def test_a_record_with_a_missing_field_fails(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2\n')
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    with pytest.raises(Exception, match="MALFORMED"):
        csv_files.read_csv(spark, str(tmp_path / "t.csv"), schema, line_breaks=True).collect()


def _read(spark, path, text, schema):
    path.write_text(text)
    return csv_files.read_csv(spark, str(path), T.StructType.fromDDL(schema), line_breaks=True)


def test_an_empty_line_is_a_row_of_one_column(spark, tmp_path):
    rows = _read(spark, tmp_path / "t.csv", "a\nx\n\n\"y\nz\"\n", "a string").collect()
    assert sorted((r.a for r in rows), key=str) == [None, "x", "y\nz"]


def test_an_empty_line_among_columns_fails(spark, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        _read(spark, tmp_path / "t.csv", "a,b\n1,2\n\n3,4\n", "a string, b string").collect()


def test_an_open_quote_fails_with_the_files_name(spark, tmp_path):
    with pytest.raises(Exception, match="left open in .*odd.csv"):
        _read(spark, tmp_path / "odd.csv", 'a,b\n1,"x\n2,y\n3,z\n', "a string, b string").collect()


def test_json_rows_and_array(spark):
    df = spark.createDataFrame([(1, "a\nb"), (2, None)], "id int, msg string")
    assert {r["json"] for r in tables.json_rows(df).collect()} == {'{"id":1,"msg":"a\\nb"}', '{"id":2}'}
    assert tables.json_array(df.limit(0)).first()["json"] == "[]"


def test_json_array_is_bounded(spark):
    assert tables.json_array(spark.range(3), most=3).first()["json"] == '[{"id":0},{"id":1},{"id":2}]'
    with pytest.raises(Exception, match="3 rows at most"):
        tables.json_array(spark.range(4), most=3).collect()


def test_inline_table_keeps_its_cells_in_place(spark):
    rows = [(str(i), f"v{i}") for i in range(20)]
    assert sorted(map(tuple, tables.inline_table(spark, ["k", "v"], rows).collect())) == sorted(rows)


def test_published_version_changes_whole(spark, tmp_path):
    root = str(tmp_path)
    one = {"t": spark.range(3).toDF("a")}
    tables.reload(spark, root, one, lambda written: None)
    assert tables.read_published(spark, root, ["t"])["t"].count() == 3
    tables.reload(spark, root, one, lambda written: None)
    assert tables.read_published(spark, root, ["t"])["t"].count() == 3

    def refuse(written):
        raise ValueError("no")

    try:
        tables.reload(spark, root, {"t": spark.range(9).toDF("a")}, refuse)
    except ValueError:
        pass
    assert tables.read_published(spark, root, ["t"])["t"].count() == 3


def test_of_two_publishers_one_fails_loudly(spark, tmp_path):
    """Both start from the same commit; the second to publish changes nothing and leaves no version behind."""
    root = str(tmp_path)
    tables.reload(spark, root, {"t": spark.range(1).toDF("a")}, lambda written: None)

    def meanwhile(written):
        tables.reload(spark, root, {"t": spark.range(2).toDF("a")}, lambda written: None)

    with pytest.raises(commits.Conflict):
        tables.reload(spark, root, {"t": spark.range(3).toDF("a")}, meanwhile)
    assert tables.read_published(spark, root, ["t"])["t"].count() == 2
    assert len([p for p in tmp_path.iterdir() if p.name.startswith("v")]) == 2


def test_failed_and_old_versions_go(spark, tmp_path):
    root = str(tmp_path)
    for n in (1, 2, 3):
        tables.reload(spark, root, {"t": spark.range(n).toDF("a")}, lambda written: None)
    abandoned, _ = tables.write_version({"t": spark.range(9).toDF("a")}, root)
    assert tables.vacuum(spark, root) == []                    # all are young
    gone = tables.vacuum(spark, root, keep=2, older_than=timedelta(0))
    assert len(gone) == 2 and abandoned in gone
    assert tables.read_published(spark, root, ["t"])["t"].count() == 3


def test_a_write_counts_what_passes(spark, tmp_path):
    counts = {"t": {"odd": F.count_if(F.col("a") % 2 == 1), "none": F.count_if(F.col("a").isNull())}}
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "a int").repartition(3)
    version, found = tables.write_version({"t": df, "u": df.where("false")}, str(tmp_path), counts)
    assert found == {"t": {"rows": 4, "odd": 2, "none": 1}, "u": {"rows": 0}}
    tables.publish(spark, str(tmp_path), version, metrics=found)
    assert tables.read_published(spark, str(tmp_path), ["t"]).metrics == found
