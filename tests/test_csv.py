"""CSV files come back as they were written."""

import csv
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newspipe import finish, key_list, read_csv, scratch_dir, stream_csv, write_csv, write_raw_csv
from newspipe.plans import flows
from newspipe.schemas import STRICT_ARTICLE, text_fields
from newspipe.sinks.csv import BATCH_RECORDS

AWKWARD = [
    'a"b', '"', '""', "a,b", ",", "a\nb", "\n", "a\r\nb", "a\rb", "\\", '\\"', 'a\\"b"', " a ", "\ta\t", "#x", "'", "é😀", "None",
]


def files(path):
    return sorted(Path(path).glob("part-*.csv"))


def test_awkward_values(spark):
    path = scratch_dir(spark, "awkward.csv")
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(AWKWARD)], "id string, v string")
    write_csv(df, path)
    back = {r.id: r.v for r in read_csv(spark, path, df.schema).collect()}
    assert back == {str(i): v for i, v in enumerate(AWKWARD)}


@settings(max_examples=10, deadline=None)
@given(
    st.lists(
        st.text(st.characters(exclude_categories=["Cs", "Cc"], include_characters="\n\t\""), min_size=1),
        min_size=1,
        max_size=30,
    )
)
def test_any_text(spark, values):
    path = scratch_dir(spark, "any.csv")
    df = spark.createDataFrame([(str(i), v, "end") for i, v in enumerate(values)], "id string, v string, z string")
    write_csv(df.coalesce(1), path)
    back = {r.id: (r.v, r.z) for r in read_csv(spark, path, df.schema).collect()}
    assert back == {str(i): (v, "end") for i, v in enumerate(values)}


def test_other_readers_agree(spark):
    path = scratch_dir(spark, "plain.csv")
    df = spark.createDataFrame([("a\n\"b\"", None, "", " x ")], "a string, b string, c string, d string")
    write_csv(df.coalesce(1), path)
    rows = [row for f in files(path) for row in csv.reader(f.open(newline="", encoding="utf-8"))]
    assert rows == [["a", "b", "c", "d"], ['a\n"b"', "", "", " x "]]
    back = read_csv(spark, path, df.schema).first()
    assert tuple(back) == ('a\n"b"', None, None, " x ")


def test_files_may_start_with_a_byte_order_mark(spark):
    """Every file of batches and streams does; values with line breaks survive."""
    path = scratch_dir(spark, "marked.csv")
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(AWKWARD)], "id string, v string").repartition(3)
    write_csv(df, path, byte_order_mark=True, max_records_per_file=2)
    assert len(files(path)) >= 6
    assert all(f.read_bytes().startswith("\ufeffid,v\n".encode()) for f in files(path))
    assert {r.id: r.v for r in read_csv(spark, path, df.schema).collect()} == {str(i): v for i, v in enumerate(AWKWARD)}
    rows = [row for f in files(path) for row in csv.DictReader(f.open(newline="", encoding="utf-8-sig"))]
    assert {r["id"] for r in rows} == {str(i) for i in range(len(AWKWARD))}
    df.write.parquet(f"{path}.in")
    stream = spark.readStream.schema(df.schema).parquet(f"{path}.in")
    finish(stream_csv(stream, f"{path}.out", f"{path}.steps", byte_order_mark=True))
    assert all(f.read_bytes().startswith("\ufeffid,v\n".encode()) for f in files(f"{path}.out"))
    assert read_csv(spark, f"{path}.out", df.schema).count() == len(AWKWARD)


def test_byte_order_mark_is_skipped_on_read(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("﻿url,headline\nu,é\n".encode())
    row = read_csv(spark, str(tmp_path), text_fields("url", "headline")).first()
    assert tuple(row) == ("u", "é")


def test_columns_names_lists_and_booleans(spark):
    path = scratch_dir(spark, "columns.csv")
    df = spark.createDataFrame(
        [(["a", "b"], {"k": 1}, True, "u")], "c array<string>, m map<string,int>, b boolean, u string"
    )
    write_csv(df.coalesce(1), path, ["u", "c", "m", "b"], rename={"u": "the url"})
    rows = [row for f in files(path) for row in csv.reader(f.open(newline=""))]
    assert rows == [["the url", "c", "m", "b"], ["u", "a, b", '{"k": 1}', "True"]]


def test_overwrite_append_and_no_path(spark, capsys):
    path = scratch_dir(spark, "append.csv")
    df = spark.range(250).selectExpr("string(id) as id").coalesce(1)
    flows.append_news(df, path, max_records_per_file=BATCH_RECORDS)
    assert len(files(path)) == 3
    flows.append_news(df, path)
    assert len(files(path)) == 4
    assert read_csv(spark, path, df.schema).count() == 500
    write_csv(df.limit(1), path)
    assert read_csv(spark, path, df.schema).count() == 1
    flows.append_news(df, None)
    assert "nothing written" in capsys.readouterr().out


def test_stream_in_batches_of_a_hundred(spark):
    base = scratch_dir(spark, "batches")
    spark.range(250).selectExpr("string(id) as id").coalesce(1).write.parquet(f"{base}/in")
    stream = spark.readStream.schema("id string").parquet(f"{base}/in")
    finish(stream_csv(stream, f"{base}/out", f"{base}/c", max_records_per_file=BATCH_RECORDS))
    assert len(files(f"{base}/out")) == 3
    assert read_csv(spark, f"{base}/out", text_fields("id")).distinct().count() == 250


def test_raw_items_under_all_their_keys(spark):
    path = scratch_dir(spark, "raw.csv")
    raw = ['{"b":1,"a":["x","y"]}', '{"c":true,"a":null}', '{"d":{"k":"v"}}']
    df = spark.createDataFrame([(r,) for r in raw], "raw string").coalesce(1)
    assert write_raw_csv(df, "raw", path) == ["a", "b", "c", "d"]
    rows = [row for f in files(path) for row in csv.reader(f.open(newline=""))]
    assert rows == [["a", "b", "c", "d"], ["x, y", "1", "", ""], ["", "", "True", ""], ["", "", "", '{"k": "v"}']]


def test_articles_to_csv(spark):
    path = scratch_dir(spark, "strict.csv")
    html = "<h1>t</h1><time datetime='d'>x</time><div class='entry-content'><p>a<p>b</div>"
    df = spark.createDataFrame([("u", html), ("v", "<h1>t</h1>")], "url string, html string")
    flows.articles_to_csv(df.coalesce(1), path, strict=True)
    rows = [row for f in files(path) for row in csv.reader(f.open(newline=""))]
    assert rows == [["url", "headline", "date of published", "article_content"], ["u", "t", "d", "a b"]]
    assert STRICT_ARTICLE.names[2] == "date_published"
    path = scratch_dir(spark, "lenient.csv")
    flows.articles_to_csv(df.coalesce(1), path)
    rows = [row for f in files(path) for row in csv.reader(f.open(newline=""))]
    assert rows[0] == ["url", "headline", "author", "publish_time", "article_content"]
    assert len(rows) == 3


@pytest.mark.parametrize("name", ["x", "y"])
def test_scratch_is_below_the_shared_folder(spark, name):
    path = scratch_dir(spark, name)
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))
    assert path != scratch_dir(spark, name)


def test_blank_rows_of_a_lone_column_survive(spark, tmp_path):
    df = spark.createDataFrame([("a",), (None,), ("",), ("b",), (" ",)], "x string").coalesce(1)
    write_csv(df, f"{tmp_path}/one")
    back = read_csv(spark, f"{tmp_path}/one", df.schema)
    assert [r.x for r in back.collect()] == ["a", None, None, "b", " "]


def test_files_are_bounded_by_bytes(spark, tmp_path):
    df = spark.range(2000).selectExpr("repeat('x', 1000) as a", "id").coalesce(1)
    write_csv(df, f"{tmp_path}/out", max_bytes_per_file=200_000)
    sizes = [p.stat().st_size for p in (tmp_path / "out").glob("*.csv")]
    assert len(sizes) >= 10 and max(sizes) < 230_000
    assert read_csv(spark, f"{tmp_path}/out", df.selectExpr("a", "string(id) id").schema).count() == 2000


def test_any_number_of_keys(spark, tmp_path):
    raw = [("{" + ",".join(f'"k{i}":{i}' for i in range(j, 10_050, 3)) + "}",) for j in range(3)]
    df = spark.createDataFrame(raw, "raw string")
    assert len(key_list(df, "raw")) == 10_050
    with pytest.raises(ValueError):
        write_raw_csv(df, "raw", f"{tmp_path}/x", max_keys=100)
