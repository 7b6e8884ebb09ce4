from __future__ import annotations

import pytest

from corpuskit.sources import files, sqltable

SCHEMA = "k bigint, code string, text string"
ROWS = [(1, "0111", 'two\nlines, "quoted"'), (2, "0002", "汉字　blank"), (3, None, "")]


def test_csv_keeps_codes_quotes_and_newlines(spark, tmp_path):
    path = str(tmp_path / "csv")
    files.write_csv(spark.createDataFrame(ROWS, SCHEMA), path)
    back = {tuple(r) for r in files.read_csv(spark, path, SCHEMA, multi_line=True).fillna("", ["text"]).collect()}
    assert back == set(ROWS)
    assert files.read_csv(spark, path, SCHEMA, ["code"], multi_line=True).columns == ["code"]


def test_jsonl_is_utf8_and_keeps_bad_lines_apart(spark, tmp_path):
    path = tmp_path / "jsonl"
    files.write_jsonl(spark.createDataFrame(ROWS, SCHEMA).coalesce(1), str(path))
    assert any("汉字" in p.read_text(encoding="utf-8") for p in path.glob("*.json"))
    (path / "extra.json").write_text('{"k": 9, "text": broken\n{"k": 10}\n', encoding="utf-8")
    read = files.read_jsonl(spark, str(path), SCHEMA).cache()
    assert sorted(r["k"] for r in read.where("corrupt IS NULL").collect()) == [1, 2, 3, 10]
    assert read.where("corrupt IS NOT NULL").count() == 1


def test_json_arrays_and_folders(spark, tmp_path):
    for folder, n in (("a", 1), ("a/b", 2)):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"x{n}.json").write_text(f'[{{"k": {n}}}, {{"k": {n * 10}}}]', encoding="utf-8")
        (tmp_path / folder / "skip.txt").write_text("no", encoding="utf-8")
    assert sorted(r["k"] for r in files.read_json_arrays(spark, str(tmp_path / "a" / "*.json"), "k bigint").collect()) == [1, 10]
    listed = files.file_list(spark, str(tmp_path), ".json")
    assert sorted(r["file"].rsplit("/", 1)[1] for r in listed.collect()) == ["x1.json", "x2.json"]


def test_later_cache_file_wins(spark, tmp_path):
    from pyspark.sql import functions as F

    (tmp_path / "1.json").write_text('{"a": {"lon": 1.0}, "b": {"lon": 2.0}}', encoding="utf-8")
    (tmp_path / "2.json").write_text('{"a": {"lon": 9.0}}', encoding="utf-8")
    number = F.regexp_extract("file", r"(\d+)\.json$", 1).cast("int")
    out = files.read_keyed_json(spark, str(tmp_path), "struct<lon: double>", recency=number)
    assert {(r["key"], r["response"]["lon"]) for r in out.collect()} == {("a", 9.0), ("b", 2.0)}


def test_converting_twice_reads_new_files_only(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, ledger = str(tmp_path / "out"), str(tmp_path / "done")
    (source / "one.csv").write_text("k,code,text\n1,0001,x\n", encoding="utf-8")
    assert files.convert_new_csv(spark, str(source), SCHEMA, target, ledger) == 1
    assert files.convert_new_csv(spark, str(source), SCHEMA, target, ledger) == 0
    (source / "two.csv").write_text("k,code,text\n2,0002,y\n", encoding="utf-8")
    assert files.convert_new_csv(spark, str(source), SCHEMA, target, ledger) == 1
    assert sorted((r["k"], r["code"]) for r in spark.read.parquet(target).collect()) == [(1, "0001"), (2, "0002")]


def test_a_crash_before_the_commit_gives_each_row_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    target, checkpoint = str(tmp_path / "out"), tmp_path / "check"
    for i in range(3):
        (source / f"f{i}.csv").write_text(f"k,code,text\n{i},000{i},x\n", encoding="utf-8")
        files.convert_new_csv(spark, str(source), SCHEMA, target, str(checkpoint))
    # As if the last run had died after its data and before its commit.
    commits = sorted(p for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    commits[-1].unlink()
    (checkpoint / "commits" / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    files.convert_new_csv(spark, str(source), SCHEMA, target, str(checkpoint))
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == [0, 1, 2]


def test_parameters_are_values_not_text(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(20)], "k int, name string")
    evil = "n1' OR '1'='1"
    assert sqltable.fetch(spark, "SELECT * FROM {t} WHERE name = :n", "all", {"n": evil}, t=df).count() == 0
    assert sqltable.fetch(spark, "SELECT * FROM {t} ORDER BY k", "many", t=df).count() == 10
    assert sqltable.fetch(spark, "SELECT * FROM {t} ORDER BY k DESC", "one", t=df).first()["k"] == 19


def test_unfinished_tables_are_built_again(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(2).write.parquet(path)  # left behind by a run that died before its marker
    assert files.saved_or_built(spark.range(5), path).count() == 5
    assert files.saved_or_built(spark.range(9), path).count() == 5, "finished: nothing is built"


def test_large_csv_is_split_and_a_quoted_newline_shows(spark, tmp_path):
    path = str(tmp_path / "csv")
    spark.range(200_000).selectExpr("id AS k", "repeat('x', 20) AS text", "'y' AS code").coalesce(1).write.csv(path, header=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        assert files.read_csv(spark, path, "k bigint, text string, code string").rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    (tmp_path / "q.csv").write_text('k,text,code\n1,"a\nb",c\n', encoding="utf-8")
    assert files.read_csv(spark, str(tmp_path / "q.csv"), "k bigint, text string, code string", multi_line=True).count() == 1
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path / "q.csv"), "k bigint, text string, code string").collect()
