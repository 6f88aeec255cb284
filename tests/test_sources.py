import pathlib

import pytest
from pyspark.sql import functions as F

from tapeloom.functions.text import clean_text
from pyspark.errors import AnalysisException
from tapeloom.session import release, scratch_path, scratch_root, staged
from tapeloom.sources import csv, sinks, tables
from tapeloom.streaming.ingest import file_stream, ingest, table_stream


def test_price_files_take_the_symbol_from_the_name(spark, tmp_path):
    head = "Date,Vol,O,H,L,C,A\n"
    (tmp_path / "AAA b.csv").write_text(head + "2020-01-02,5,1,3,0,2,2\n")
    (tmp_path / "x+y.csv").write_text(head + "2020-01-02,6,1,3,0,2,2\n")
    got = csv.read_prices_csv(spark, str(tmp_path)).orderBy("volume").collect()
    assert [(r.stock_symbol, r.volume, r.adj_close) for r in got] == [("aaa b", "5", "2"), ("x+y", "6", "2")]


def test_quotes_and_commas_survive_a_round_trip(spark):
    rows = [("2020-01-01", 'he said "no", twice', "a", None, "p"), ("x", "back\\slash", "b", "u,v", "'")]
    df = spark.createDataFrame(rows, csv.string_schema(csv.NEWS_COLUMNS))
    for quote_all in (True, False):
        path = scratch_path(spark, "trip")
        sinks.write_csv(df, path, quote_all)
        assert sorted(csv.read_news_csv(spark, path).collect(), key=str) == sorted(df.collect(), key=str)


def test_chunks_are_read_back_as_they_were(spark):
    texts = ["abc\\", 'q " q', "a\nb\n", '\\"', "x\\n, y", " lead", "", '"', "\\\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    path = scratch_path(spark, "chunk-trip")
    sinks.write_chunks(df, "k", path, rows=2)
    back = csv.read_strings(spark, path, ["k", "text", "chunk_id"], multi_line=True).collect()
    got = {int(r.k): (r.text or "", int(r.chunk_id)) for r in back}
    assert got == {k: (t, k // 2) for k, t in enumerate(texts)}


def test_stored_copies_are_removed_on_request(spark):
    kept = staged(spark.range(3), "gone")
    (folder,) = {f.rsplit("/", 1)[0] for f in kept.inputFiles()}
    assert release(spark) >= 1
    with pytest.raises(AnalysisException):
        spark.read.parquet(folder)


def test_text_with_line_breaks_is_clean_in_csv(spark):
    df = spark.createDataFrame([(1, 'a\r\n"b"'), (2, "c")], "id long, text string")
    path = scratch_path(spark, "clean")
    sinks.write_csv(df.select(F.col("id").cast("string"), clean_text(F.col("text")).alias("text")), path)
    back = csv.read_strings(spark, path, ["id", "text"]).orderBy("id").collect()
    assert [r.text for r in back] == ["a 'b'", "c"]


def test_chunks_do_not_overlap(spark):
    df = spark.range(160).withColumnRenamed("id", "k")
    part = tables.slice_rows(df, "k", 50).drop("row_idx")
    sizes = sinks.with_chunks(df, "k", 100).groupBy("chunk_id", "part").count().orderBy("chunk_id")
    assert [tuple(r) for r in sizes.collect()] == [(0, "part-00000", 100), (1, "part-00001", 60)]
    assert part.count() == 110


def test_slices(spark):
    df = spark.range(10, 40).withColumnRenamed("id", "k")
    assert [r.k for r in tables.slice_rows(df, "k", 28, -1).orderBy("k").collect()] == [38, 39]
    assert tables.head_percent(df, "k", 10.9).count() == 3
    assert tables.head_percent(df, "k", 100).count() == 30
    for bad in (0, -1, 101):
        with pytest.raises(ValueError):
            tables.head_percent(df, "k", bad)
    assert [r.k for r in tables.take_head(df, ["k"], 2).collect()] == [10, 11]


def test_fake_pairs(spark):
    first = tables.synthetic_pairs(tables.number_sequence(spark, 100), "n", "2025-01-01").first()
    assert list(first) == ["Text1+101", "Text201+301", "1", "2024-12-31", "2024-12-30"]


def test_materialize_builds_once(spark):
    path, calls = scratch_path(spark, "once"), []

    def build():
        calls.append(1)
        return spark.range(3)

    assert sinks.materialize(spark, path, build).count() == 3
    assert sinks.materialize(spark, path, build).count() == 3
    assert len(calls) == 1


def test_texts_with_line_breaks_lie_in_small_files(spark):
    path = scratch_path(spark, "wide")
    rows = [(str(k), "\n" * (k % 3) + 'a "b"\r' + "x") for k in range(23)]
    df = spark.createDataFrame(rows, "k string, text string").coalesce(1)
    sinks.write_csv(df, path, rows=5)
    read = csv.read_strings(spark, path, ["k", "text"], multi_line=True)
    assert len(read.inputFiles()) == 5
    assert sorted(map(tuple, read.collect())) == sorted(rows)


def test_deliveries_and_wide_news_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Neither a delivery of documents nor a file of texts with line breaks grows with the table."""
    from tapeloom.plans import ingest as plans

    rows = [(k, f"text\n{k}", "en", "s") for k in range(300)]
    schema = "doc_id long, text string, lang string, source string"
    spark.createDataFrame(rows, schema).repartition(48).write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(sinks, "WHOLE_FILE_ROWS", 40)
    made = []
    monkeypatch.setattr(plans, "scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    spark.conf.set("spark.sql.files.openCostInBytes", "64m")  # a task for each file or two
    try:
        numbered = plans.stream_chunks(spark, str(tmp_path)).collect()
        assert plans.wide_news_scan(spark, str(tmp_path)).count() == 300
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    order = sorted(range(300), key=lambda k: (k % 3, k))
    assert [(r.doc_id, r.batch) for r in sorted(numbered, key=lambda r: r.row_no)] == [(k, k % 3) for k in order]
    parts = {name: list(pathlib.Path(path).glob("part-*")) for path in made for name in ("deliveries", "wide-news") if f"/{name}-" in path}
    assert len(parts["deliveries"]) > 16 * 3 and len(parts["wide-news"]) >= 300 / 40


def test_existing_tables(spark):
    path = scratch_path(spark, "ctas")
    sinks.create_parquet(spark.range(2), path)
    assert sinks.create_parquet(spark.range(5), path, if_not_exists=True).count() == 2
    with pytest.raises(Exception):
        sinks.create_parquet(spark.range(5), path)


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    schema = csv.string_schema(["id", "text"])
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def pass_once():
        stream = file_stream(spark, str(tmp_path), schema, header="true")
        query = ingest(stream, lambda df: df.withColumn("text", clean_text(F.col("text"))), out, state)
        query.awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    (tmp_path / "a.csv").write_text("id,text\n1, x \n2,y\n")
    assert pass_once() == ["1", "2"]
    (tmp_path / "b.csv").write_text("id,text\n3,z\n")
    assert pass_once() == ["1", "2", "3"]
    assert pass_once() == ["1", "2", "3"]


def test_stream_of_a_table_in_one_file_or_many(spark, tmp_path):
    """A table may be a folder of part files, or a file beside other tables."""
    many, one = str(tmp_path / "many.parquet"), tmp_path / "one.parquet"
    spark.range(40).repartition(20).write.parquet(many)
    spark.range(7).coalesce(1).write.parquet(str(tmp_path / "made"))
    one.write_bytes(next((tmp_path / "made").glob("part-*.parquet")).read_bytes())
    for path, n in ((many, 40), (str(one), 7)):
        out = scratch_path(spark, "table-out")
        ingest(table_stream(spark, path, spark.range(1).schema), lambda df: df, out, scratch_path(spark, "table-state")).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(n))


def test_scratch_uses_the_named_folder(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_chunks_of_a_stream_go_on_after_any_crash(spark, tmp_path):
    """A batch that is run again, before or after its record was written, gives the same chunks."""
    from tapeloom.streaming import chunks

    out, records = str(tmp_path / "out"), str(tmp_path / "records")
    batches = [spark.createDataFrame([(k, f"t{k}") for k in range(a, b)], "id long, text string") for a, b in ((0, 5), (5, 6), (6, 17))]

    def write(number, times=1):
        for _ in range(times):
            chunks.write_batch(batches[number], number, lambda df: df, "id", out, records, rows=4)

    write(0, times=2)
    write(1)
    (tmp_path / "records" / "batch-1").rename(tmp_path / "lost")  # ended before the record was written
    write(1)
    write(2, times=2)
    write(1)  # a late repeat counts only what came before it
    rows = chunks.read_chunks(spark, out).orderBy("row_no").collect()
    assert [(r.id, r.row_no, r.chunk_id, r.part) for r in rows] == [(k, k, k // 4, f"part-{k // 4:05d}") for k in range(17)]
    assert [r.batch for r in rows] == [0] * 5 + [1] + [2] * 11


def test_stream_restarts_number_on(spark, tmp_path):
    from tapeloom.streaming import chunks
    from tapeloom.streaming.ingest import file_stream

    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for start in (0, 30, 60):
        spark.range(start, start + 30).coalesce(1).write.mode("append").parquet(folder)
        stream = file_stream(spark, folder, spark.range(1).schema, "parquet")
        chunks.ingest_chunks(stream, lambda df: df.where("id % 2 = 0"), "id", out, state, rows=7).awaitTermination()
    rows = chunks.read_chunks(spark, out).orderBy("row_no").collect()
    assert [(r.id, r.row_no, r.chunk_id, r.batch) for r in rows] == [(2 * k, k, k // 7, k // 15) for k in range(45)]


def test_symbol_files_keep_odd_names_and_split_large_symbols(spark, tmp_path):
    rows = [(s, f"2020-01-{d:02d}", 1.0 + d) for s in ("a b", "x=y/z", "50%", "brk.b") for d in range(1, 20)]
    columns = csv.PRICE_FILE_COLUMNS
    df = spark.createDataFrame(rows, "stock_symbol string, date string, v double")
    df = df.select("stock_symbol", "date", *[df.v.alias(c) for c in columns[1:]])
    sinks.write_symbol_files(df, str(tmp_path / "files"), rows=6)
    back = csv.read_prices_csv(spark, str(tmp_path / "files")).collect()
    assert sorted((r.stock_symbol, r.date, float(r.close)) for r in back) == sorted(rows)
    assert len(list((tmp_path / "files").rglob("*.csv"))) >= 4 * 4
