"""Files, pages, footers and database options."""

import glob
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.plans.sources import parquet_footer_bytes, write_pages
from millrace.session import fresh_path, shared_folder
from millrace.sources import files, footers, html, incremental, jdbc, paged
from millrace.tables import load


class FakeSession:
    """Just the settings the folder is looked up in."""

    def __init__(self, named, master):
        self.named, self.made = named, None
        self.conf = self.sparkContext = self
        self.master = master

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


def test_shared_folder_comes_from_the_session():
    assert shared_folder(FakeSession("/shared/x/", "yarn")) == "/shared/x"
    assert fresh_path(FakeSession("s3a://b/x", "yarn"), "t").startswith("s3a://b/x/millrace/t-")
    local = FakeSession(None, "local[2]")
    assert shared_folder(local) == shared_folder(local) == local.made
    with pytest.raises(RuntimeError):
        shared_folder(FakeSession(None, "spark://host:7077"))


def test_text_survives_csv(spark):
    notes = ['comma, here', 'line\nbreak', 'say "hi"', "  spaced ", 'all, "of"\nit', "back\\slash"]
    df = spark.createDataFrame(list(enumerate(notes)), "id int, note string")
    path = files.write(df, "csv", fresh_path(spark, "csv"), **files.QUOTED)
    back = files.read(spark, "csv", path, df.schema, **files.QUOTED)
    assert [r["note"] for r in back.orderBy("id").collect()] == notes


def test_ragged_and_jsonl(spark):
    path = fresh_path(spark, "ragged")
    spark.createDataFrame([("1,a",), ("2",), ("3,c,x,y",)], "value string").coalesce(1).write.text(path)
    rows = files.read_ragged_csv(spark, path, "id int, v string", header="false")
    got = {r["id"]: (r["v"], r[files.CORRUPT]) for r in rows.collect()}
    assert got == {1: ("a", None), 2: (None, "2"), 3: ("c", "3,c,x,y")}
    path = fresh_path(spark, "jsonl")
    spark.createDataFrame([('{"a": 1}',), ("",), ("{bad",), ('{"a": 2}',)], "value string").write.text(path)
    good, bad = files.read_jsonl(spark, path, "a int")
    assert sorted(r["a"] for r in good.collect()) == [1, 2] and [r["value"] for r in bad.collect()] == ["{bad"]


@pytest.mark.parametrize("kind", ["csv", "json", "parquet", "orc"])
def test_formats(spark, kind):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "i int, s string, d double")
    path = files.multi_sink(df, [kind], fresh_path(spark, "multi"))[kind]
    assert sorted(map(tuple, files.read(spark, kind, path, df.schema).collect())) == [(1, "a", 1.5), (2, None, None)]


def test_footers_equal_pyarrow(spark):
    path = fresh_path(spark, "footers")
    spark.range(1000).selectExpr("id", "cast(id % 7 as string) as s").repartition(3).write.parquet(path)
    profile = {r["column"]: r for r in footers.footer_profile(spark.read.parquet(path)).collect()}
    sizes = {"id": 0, "s": 0}
    for name in glob.glob(path + "/*.parquet"):
        meta = pq.read_metadata(name)
        for g in range(meta.num_row_groups):
            for i in range(2):
                chunk = meta.row_group(g).column(i)
                sizes[chunk.path_in_schema] += chunk.total_compressed_size
    assert {c: r["compressed"] for c, r in profile.items()} == sizes
    assert profile["id"]["n_rows"] == 1000
    assert abs(sum(r["share"] for r in profile.values()) - 1) < 1e-9
    share = footers.subset_share(footers.footer_profile(spark.read.parquet(path)), ["id"]).first()["share"]
    assert share == pytest.approx(sizes["id"] / sum(sizes.values()))


CARD = '<li class="item" data-no="{0}"><b class="title">{1}</b><i class="cost">{2}</i>{3}</li>'


def test_cards(spark):
    page = "<html><body>" + CARD.format("S1", "Lamp &amp; Co", "$1,019.99", '<br><a href="/s1">more</a>') + CARD.format("S2", "Chair", "", "") + "</body>"
    df = spark.createDataFrame([(1, page), (2, page.replace("item", "tile")), (3, None)], "id int, html string")
    cards = html.product_cards(df, "id", "html", "item", {"name": "title", "price": "cost"}, "data-no")
    got = sorted((r["id"], r["sku"], r["name"], r["price"], r["url"]) for r in cards.collect())
    assert got == [(1, "S1", "Lamp & Co", 1019.99, "/s1"), (1, "S2", "Chair", None, None)]
    assert sorted(r["id"] for r in html.drifted(df, cards, "id").collect()) == [2, 3]


def test_titles_and_links(spark):
    text = '<HTML><title lang="en"> Hi\nthere </title><a class="x" href="/a">a</a><A href="/b?c=1">b</A><a name="n">c</a>'
    df = spark.createDataFrame([(1, text), (2, "<p>none</p>")], "id int, html string")
    assert [r[0] for r in df.select(html.title(F.col("html"))).collect()] == ["Hi\nthere", None]
    assert sorted((r["id"], r["pos"], r["href"]) for r in html.links(df, "id", "html").collect()) == [(1, 0, "/a"), (1, 1, "/b?c=1")]


def test_page_retry():
    calls, waits = [], []

    def fetch():
        calls.append(1)
        if len(calls) < 3:
            raise paged.PageError("busy")
        return ["{}"]

    assert paged.fetch_with_retry(fetch, 3, 1.0, waits.append) == ["{}"]
    assert len(waits) == 2 and waits[0] <= 1.0 and waits[1] <= 2.0
    with pytest.raises(paged.PageError):
        paged.fetch_with_retry(lambda: (_ for _ in ()).throw(paged.PageError("down")), 2, 0.0, waits.append)


@pytest.mark.parametrize("pages,tasks", [(0, 5), (3, 5), (5, 5), (11, 5), (100, 7)])
def test_page_runs_cover_every_page_once(pages, tasks):
    runs = paged.page_runs(pages, tasks)
    assert [n for r in runs for n in range(r.first, r.last)] == list(range(pages)) and len(runs) <= tasks


def test_marks_keep_their_ties(spark):
    path = fresh_path(spark, "marks")
    rows = [(1, "2024-01-03"), (2, "2024-01-05"), (3, "2024-01-05"), (4, "2024-01-01")]
    df = spark.createDataFrame(rows, "id int, t string").select("id", F.to_timestamp("t").alias("ts"))
    incremental.save_mark(df.filter("id in (1, 4)"), path, "a", "ts", "id")
    incremental.save_mark(df.filter("id < 3"), path, "a", "ts", "id")
    incremental.save_mark(df.limit(0), path, "a", "ts", "id")
    mark = incremental.read_mark(spark, path, "a")
    assert mark == ("2024-01-05 00:00:00", ["2"]) and incremental.read_mark(spark, path, "c") is None
    assert [r["id"] for r in incremental.since(df, "ts", "id", mark).collect()] == [3]
    assert incremental.since(df, "ts", "id", None).count() == 4


def test_keys_at_a_hot_mark_stay_in_tables(spark):
    path = fresh_path(spark, "marks")
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, F.lit("2024-01-05")).otherwise("2024-01-03").cast("timestamp").alias("ts"))
    incremental.save_mark(df.filter("id < 2000"), path, "a", "ts", "id")
    assert spark.read.parquet(path).count() == 667 and incremental.last_mark(spark, path, "c") is None
    at, keys = incremental.last_mark(spark, path, "a")
    assert at == "2024-01-05 00:00:00" and keys.count() == 667
    found = incremental.since(df, "ts", "id", (at, keys))
    assert "LocalTableScan" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in found.collect()) == list(range(2001, 3000, 3))


def write_page(folder, name, text):
    (folder / f"page={name}").mkdir()
    (folder / f"page={name}" / "part-0").write_text(text + "\n")


@pytest.mark.parametrize("n", [0, 1, 15, 16, 17, 50])
def test_pages_end_with_the_first_empty_one(spark, tmp_path, n):
    """A gap is an end, whatever comes behind it; pages without records and pages that aren't there are both empty."""
    for k in range(n + 9):
        if k != n or n % 2:
            write_page(tmp_path, k, '{"items": []}' if k == n else f'{{"items": [{{"k": {k}}}]}}')
    got = paged.read_pages(spark, str(tmp_path), None, "k int", attempts=1).collect()
    assert sorted((r["page"], r["k"]) for r in got) == [(k, k) for k in range(n)]


def test_a_long_extract_has_tasks_by_cores(spark, tmp_path):
    """One task a page would make more tasks, and more small files, with every page."""
    for k in range(100):
        write_page(tmp_path, k, f'{{"items": [{{"k": {k}}}]}}')
    most = paged.TASKS_A_CORE * spark.sparkContext.defaultParallelism
    got = paged.fetch(spark, str(tmp_path), pages=100, attempts=1)
    assert got.rdd.getNumPartitions() <= most and got.count() == 100
    waves = paged.fetch(spark, str(tmp_path), attempts=1)
    assert len(waves.inputFiles()) <= 3 * most and sorted(r["page"] for r in waves.collect()) == list(range(100))


def test_pages_are_written_by_many_tasks(spark):
    """However few bytes they are: a page is a file, and one task would write all of them."""
    path = write_pages(spark, "/root/testdata/sf0.01")
    tasks = {f.name.split("-")[1] for f in Path(path.removeprefix("file:")).glob("page=*/part-*")}
    assert len(tasks) > 1


def test_a_stream_goes_on_from_its_cursor(spark, tmp_path):
    pages, out, checkpoint = tmp_path / "pages", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    pages.mkdir()
    link = lambda k, last: "" if k == last else f', "next": "c{k + 1}"'
    for k in range(5):
        write_page(pages, f"c{k}", f'{{"items": [{{"k": {k}}}, {{"k": {10 * k}}}]{link(k, 99)}}}')

    def run(most):
        rows = paged.stream_cursor(spark, str(pages), "c0", "k int", most)
        writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(out).awaitTermination()
        return sorted((r["page"], r["status"], r["k"]) for r in spark.read.schema(rows.schema).parquet(out).collect())

    want = [(f"c{k}", "ok", x) for k in range(9) for x in sorted((k, 10 * k))]
    assert run(2) == want[:4]
    assert run(2) == want[:8]
    assert run(100) == want[:10]  # the page that c4 names isn't there yet
    for k in range(5, 9):
        write_page(pages, f"c{k}", f'{{"items": [{{"k": {k}}}, {{"k": {10 * k}}}]{link(k, 8)}}}')
    assert run(100) == sorted(want)
    assert run(100) == sorted(want)


def test_a_failed_page_of_a_stream_is_a_row(spark, tmp_path):
    write_page(tmp_path, "a", '{"error": "busy", "next": "b"}')
    write_page(tmp_path, "b", '{"items": [{"k": 1}]}')
    reader = paged.CursorReader({"location": str(tmp_path), "start": "a", "attempts": "1"})
    start, end = reader.initialOffset(), reader.latestOffset()
    rows = [r for p in reader.partitions(start, end) for r in reader.read(p)]
    assert rows == [("a", "failed", "busy"), ("b", "ok", '{"k": 1}')]
    again = paged.CursorReader({"location": str(tmp_path), "start": "a"})  # after a restart the last batch is planned first
    assert [p.name for p in again.partitions(start, end)] == ["a", "b"] and again.latestOffset() == end


def test_a_long_chain_has_few_tasks(tmp_path):
    for k in range(30):
        write_page(tmp_path, f"c{k}", '{"error": "busy", "next": "c5"}' if k == 4 else f'{{"items": [{{"k": {k}}}], "next": "c{k + 1}"}}')
    reader = paged.CursorReader({"location": str(tmp_path), "start": "c0", "attempts": "1", "max_tasks": "7"})
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert len(parts) <= 7
    want = [(f"c{k}", "failed", "busy") if k == 4 else (f"c{k}", "ok", f'{{"k": {k}}}') for k in range(30)]
    assert [r for p in parts for r in reader.read(p)] == want


def test_zone_maps_leave_files_unopened(spark):
    path = fresh_path(spark, "zones")
    rows = spark.range(1000).selectExpr("id", "id * 0.5 as x", "timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) as t", "if(id < 100, null, cast(id as string)) as s")
    rows.repartitionByRange(10, "id").write.parquet(path)
    df = spark.read.schema(rows.schema).parquet(path)
    zones = footers.zone_map(df, ["id", "x", "t"])
    assert zones.count() == 10 and zones.agg(F.sum("n_rows")).first()[0] == 1000
    assert all(r["low_id"] * 0.5 == r["low_x"] and r["bytes"] > 0 for r in zones.collect())
    found = footers.read_within(spark, rows.schema, zones, {"id": (300, 310), "x": (0.0, 152.5)})
    assert sorted(r["id"] for r in found.collect()) == list(range(300, 306)) and 1 <= len(found.inputFiles()) <= 2
    assert footers.read_within(spark, rows.schema, zones, {"id": (5000, 6000)}).collect() == []
    # a file without known bounds is opened
    unknown = footers.zone_map(df, ["s"])
    assert footers.matching(unknown, {"s": ("zzz", "zzzz")}).count() >= 1


def test_footer_bytes_of_many_files(spark, tmp_path, monkeypatch):
    """The table is written by as many tasks as read it."""
    lines = load(spark, "/root/testdata/sf0.01", "lineitem")
    lines.repartition(4).write.parquet(str(tmp_path / "lineitem.parquet"))
    seen, profile = [], footers.footer_profile
    monkeypatch.setattr(footers, "footer_profile", lambda df: seen.extend(df.inputFiles()) or profile(df))
    got = parquet_footer_bytes(spark, str(tmp_path)).collect()
    assert len(seen) > 1 and {(r["n_rows"], r["bytes_a_row"], r["share"], r["keys_share"]) for r in got} == {(lines.count(), 8, 0.25, 0.5)}


def test_one_hour_is_one_prefix(spark):
    path = fresh_path(spark, "hours")
    rows = spark.range(100).selectExpr("id", "timestamp'2024-01-05 00:00:00' + make_interval(0, 0, 0, 0, cast(id as int)) as ts")
    incremental.write_hours(rows, path, "ts")
    hour = incremental.read_hour(spark, path, "id bigint", "2024-01-06", 7)
    assert [r["id"] for r in hour.collect()] == [31]
    assert all("/day=2024-01-06/hour=07/" in f for f in hour.inputFiles())
    assert incremental.read_hour(spark, path, "id bigint", "2024-02-06", 7).collect() == []


def test_pages_in_several_files_and_chains(spark, tmp_path):
    for name, texts in {
        "0": ['{"items": [{"k": 1}]}', '{"items": [{"k": 2}, {"k": 3}]}'],
        "1": ['{"error": "busy"}'],
        "2": ['{"items": []}'],
        "a": ['{"items": [{"k": 10}], "next": "b"}'],
        "b": ['{"items": [{"k": 11}, {"k": 12}]}'],
        "c": ['{"items": [{"k": 13}], "next": "gone"}'],
    }.items():
        (tmp_path / f"page={name}").mkdir()
        for i, text in enumerate(texts):
            (tmp_path / f"page={name}" / f"part-{i}").write_text(text + "\n")
    got = paged.read_pages(spark, str(tmp_path), None, "k int", attempts=1).collect()
    assert sorted((r["page"], r["status"], r["error"] or "", r["k"] or 0) for r in got) == [
        (0, "ok", "", 1), (0, "ok", "", 2), (0, "ok", "", 3), (1, "failed", "busy", 0),
    ]
    chains = paged.read_cursors(spark, str(tmp_path), ["a", "c"], "k int").collect()
    assert sorted((r["page"], r["status"], r["k"] or 0) for r in chains) == [
        (0, "ok", 10), (0, "ok", 11), (0, "ok", 12), (1, "failed", 0), (1, "ok", 13),
    ]
    lost = fresh_path(spark, "lost")
    paged.dead_letters(paged.fetch(spark, str(tmp_path), attempts=1), lost)
    assert [tuple(r) for r in spark.read.parquet(lost).collect()] == [(1, "busy")]



def test_database_options():
    options = jdbc.read_options("jdbc:x", "t", "id", 0, 100, 8)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", "id", 5, 5, 8)
