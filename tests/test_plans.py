"""What plans look like: no shuffle that is not needed, no file read that is not wanted."""

import pytest
from pyspark.sql import functions as F

from silverline.functions.nodes import cls, first_text, tag, text_of, select, with_nodes
from silverline.operators import joins, pages as pg
from silverline.plans.discovery import discover_ingredients, discover_products
from silverline.queries import QUERIES
from silverline.sources import readers as rd, writers as wr
from silverline.sources.shared import fresh_path, shared_dir

from given import DATA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pages_are_not_shuffled(spark, table):
    pages = with_nodes(table("pages"))
    assert "Exchange" not in plan(pages)
    assert "Exchange" not in plan(pg.extract_links(pages, "page_id", "https://a.example.com"))
    assert "Exchange RoundRobinPartitioning(3)" in plan(with_nodes(table("pages"), partitions=3))


def test_list_pages_are_parsed_once_for_all_tables(spark):
    card = '<div class="card f-column"><p class="product-card__title"><a class="reversed-link" href="/p/{0}">I {0}</a></p></div>'
    row = '<tr><td><a href="/ingredient-dictionary/ingredient-{0}.html"><h3>I {0}</h3></a></td></tr>'
    for discover, item in ((discover_products, card), (lambda p, b: discover_ingredients(p, b, "x"), row)):
        pages = spark.createDataFrame([(1, item.format(1) + item.format(2)), (2, item.format(2)), (3, None)],
                                      "page long, html string")
        found = discover(pages, "https://a.example.com")
        assert sorted(found) == ["links", "log", "progress"]
        assert not any("Python" in plan(found[name]) for name in found)
        assert [tuple(r) for r in found["progress"].orderBy("page").collect()] == [(1, 2, 2, 2), (2, 1, 0, 2)]
        assert [r.records_found for r in found["log"].orderBy("page").collect()] == [2, 1, 0]
        assert sorted(r.page for r in found["links"].collect()) == [1, 1]


def test_lists_are_cleaned_once_and_equal_words_once(spark):
    found = plan(QUERIES["clean_list"](spark, DATA))
    assert found.count("array_distinct(") == found.count("split(") == found.count("regexp_replace(") == 1


def test_null_keys_skip_the_join(spark):
    fact = spark.range(200).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"), "id")
    dim = spark.range(0, 200, 4).withColumnRenamed("id", "k")
    for found in (joins.fk_orphans(fact, [(dim, "k")]), joins.skip_done(fact, dim, "k")):
        assert {r.id for r in found.collect()} == {i for i in range(200) if i % 4}
        assert "Union" in plan(found)


def test_newest_batch_reads_its_own_directory_only(spark):
    base = fresh_path(spark, "zone")
    rows = spark.createDataFrame(
        [(i, "web", "p", day, f"{day}_{run}") for i, (day, run) in enumerate(
            [("2026-01-09", "1"), ("2026-01-10", "1"), ("2026-01-10", "2"), ("2025-12-31", "9")])],
        "v long, source string, entity string, ingestion_date string, batch_id string")
    wr.write_partitioned(rows, base)
    got = rd.read_raw_zone(spark, base, rows.select("v").schema, "web", "p")
    assert [r.v for r in got.collect()] == [2]
    assert all("batch_id=2026-01-10_2" in f for f in got.inputFiles())
    assert rd.read_raw_zone(spark, base, rows.select("v").schema, "web", "other").collect() == []
    old = rd.read_raw_zone(spark, base, rows.select("v").schema, "web", "p", "2025-12-31_9")
    assert [r.v for r in old.collect()] == [3]


def test_plain_csv_is_split(spark):
    path = fresh_path(spark, "csv")
    spark.range(60_000).select("id", F.md5(F.col("id").cast("string")).alias("m")).coalesce(1).write.option(
        "header", True).csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        df = rd.read_csv_strings(spark, path)
        assert df.rdd.getNumPartitions() > 1 and df.count() == 60_000
        assert rd.read_csv_strings(spark, path, multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_large_bronze_file_is_read_by_several_tasks(spark, monkeypatch):
    from silverline.plans import bronze_to_silver as job
    bronze, silver = fresh_path(spark, "bronze"), fresh_path(spark, "silver")
    ids = spark.range(40_000).select(F.col("id").cast("string").alias("id"), F.md5(F.col("id").cast("string")).alias("m"))
    for name, columns in (
            ("ProductTable", "id product_id, '1' price, '2' rating, 'USD' currency, 'x' source, m brand_name"),
            ("IngredientsTable", "id ingredient_id, m ingredient_name, 'a' evidence_level, 'x' source"),
            ("BridgeTable", "id product_id, id ingredient_id, m ingredient_name")):
        ids.selectExpr(*[" AS ".join(c.rsplit(" ", 1)) for c in columns.split(", ")]).coalesce(1).write.option(
            "header", True).csv(f"{bronze}/{name}.csv")
    tasks, write = {}, job.write_parquet

    def counted(df, path):
        tasks[path.rsplit("/", 1)[1]] = df.rdd.getNumPartitions()
        write(df, path)

    monkeypatch.setattr(job, "write_parquet", counted)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        assert set(job.bronze_to_silver(spark, bronze, silver).values()) == {40_000}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks["products"] > 4 and tasks["ingredients"] > 4


def test_files_follow_the_data_not_the_tasks(spark):
    base = fresh_path(spark, "parts")
    wr.write_partitioned(spark.range(0, 1000, 1, 16).withColumn("d", F.col("id") % 3), base, ["d"])
    assert len(spark.read.parquet(base).inputFiles()) == 3


def test_a_session_without_a_folder_fails():
    class Empty:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})

        class sparkContext:
            class _jsc:
                @staticmethod
                def sc():
                    option = type("Option", (), {"isEmpty": staticmethod(lambda: True)})
                    return type("Context", (), {"getCheckpointDir": staticmethod(lambda: option)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Empty)


TREE = '<div><p class="a">Water, Zinc<p>Other note<ul><li>one<li>two<b>2</b></ul></div><table><tr><td>x<td>y<tr><td>z</table>'


@pytest.mark.parametrize("tree, first, items, cells", [
    (True, "Water, Zinc", ["one", "two 2"], ["x", "y", "z"]),
    (False, "Water, Zinc Other note one two 2", ["one two 2", "two 2"], ["x y z", "y z", "z"])])
def test_implied_end_tags(spark, tree, first, items, cells):
    df = with_nodes(spark.createDataFrame([(TREE,)], "html string"), tree=tree)
    n = F.col("nodes")
    texts = lambda t: F.transform(select(n, tag(t)), lambda e: text_of(n, e))
    row = df.select(first_text(n, cls("a")).alias("first"), texts("li").alias("li"), texts("td").alias("td")).first()
    assert (row.first, row.li, row.td) == (first, items, cells)


def test_nested_containers_give_each_match_once(spark):
    html = "<div><i>1</i><div><i>2</i></div></div><i>3</i><div><i>4</i></div>"
    n = F.col("nodes")
    df = with_nodes(spark.createDataFrame([(html,)], "html string"))
    got = df.select(F.transform(select(n, tag("div"), tag("i")), lambda e: text_of(n, e)).alias("t")).first().t
    assert got == ["1", "2", "4"]
