"""Golden rows of the fine-grained rules, and properties of the keyed operators."""

import pytest
from pyspark.sql import functions as F

from silverline.functions import fixed, lists as ls, text as t
from silverline.operators import aggregates as ag, columns as cl, joins as jn, keyed as ky, quality as q
from silverline.plans import bronze_to_silver as b2s
from silverline.plans.features import recommendation_features
from silverline.sources import readers as rd, writers as wr
from silverline.sources.shared import fresh_path

BASE = "https://shop.example.com"
CASES = [
    (lambda c: t.allow_list(c, fixed.VALID_CURRENCIES, "USD"), ["USD", "GBP", "usd", "", None],
     ["USD", "GBP", "USD", "USD", "USD"]),
    (lambda c: t.null_sentinel(c, 0.01), ["0.0", "0.01", "0.02", "-1", "$12", None],
     [None, None, "0.02", None, "$12", None]),
    (t.int_like, ["5.0", "5.7", "-5.7", " 7 ", "5.", ".5", "1,234", "1e2", "true", "99999999999"],
     [5, 5, -5, 7, 5, 0, None, None, None, None]),
    (lambda c: t.clean_text(c, True), ["  a\xa0<b>b</b> &amp; c ", "&#233;&#x41; &eacute;", " ", None],
     ["a b & c", "éA é", None, None]),
    (lambda c: t.absolute_url(c, BASE), ["//x.com/a", "/p/1", "p/1", " "],
     ["https://x.com/a", BASE + "/p/1", "p/1", None]),
    (lambda c: t.absolute_url(c, BASE, resolve=True), ["p/1", "mailto:x", "?a=1", "../p"],
     [BASE + "/p/1", "mailto:x", BASE + "?a=1", BASE + "/p"]),
    (t.drop_fragment, ["https://a/b?x=1#top"], ["https://a/b?x=1"]),
    (t.md5_id, [" Aqua "], ["65cb59645b852c2394ba3ff8b295e83c"]),
    (lambda c: t.record_id(c, "p"), ["u"], ["p_0bfe935e70c321c7"]),
    (t.slug, ["https://A.com/B c.html", None, "a" * 130], ["a_com_b_c_html", "unknown", "a" * 120]),
    (t.parse_price, ["From $1,234.50 now", "free"], ["1234.50", None]),
    (t.first_int, ["1,234 reviews", "none"], [1, None]), (t.comma_int, ["1,234"], [1234]),
    (t.ratio_of_5, ["2/5", "1.5 / 5", "3"], [2.0, 1.5, None]),
    (t.yes_no, ["yes", "no", "unknown", "n/a", None], [1, 0, 0, None, None]),
    (t.score_label, ["Excellent", "Very Good", "fair", "avoid", "great"], [5, 4, 2, 0, None]),
    (lambda c: t.strip_label(c, "Made in"), ["Made in France"], ["France"]),
    (lambda c: F.array_join(ls.split_list(c, ",", fixed.INGREDIENT_DISCLAIMER), "|"),
     ["Water, Glycerin,, Zinc. For the latest information see", None], ["Water|Glycerin|Zinc.", None]),
    (lambda c: F.array_join(ls.clean_list(F.split(c, ",")), "|"), ["A ,b,a,,B", " ,"], ["A|b", None]),
    (lambda c: F.concat_ws("/", t.ingredient_name(c)["name"], t.ingredient_name(c)["concentration"]),
     ["Niacinamide 5 % –", "~1 - 2% Retinol.", "Free From: parabens", "x" * 121],
     ["Niacinamide/5%", "Retinol/~1-2%", "", ""]),
    (lambda c: t.canonical_name(t.normalize_name(c)), [" Vitamin  B3 ", "Aqua", "Zinc"],
     ["niacinamide", "water", "zinc"]),
    (lambda c: t.keyword_tags(c, fixed.BENEFIT_RULES), ["Hydrating serum with Vitamin C", "x"],
     ["brightening|hydrating", None]),
    (lambda c: t.keyword_tags(c, fixed.CONCERN_RULES), ["Hydrating serum with Vitamin C"], [None]),
    (t.after_colon, ["Rating:  best: yes", "plain"], ["best: yes", "plain"]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_golden(spark, case):
    rule, values, want = CASES[case]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    assert [r.x for r in df.select("i", rule(F.col("v")).alias("x")).orderBy("i").collect()] == want


def test_scalar_rules_stay_in_the_jvm(spark):
    df = spark.range(1).select(F.lit("x").alias("v"))
    plan = df.select(t.clean_text("v", True), t.ingredient_name("v"), ls.clean_list(F.split("v", ",")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()


def test_fetch_outcomes(spark):
    rows = [(200, 0), (200, 700), (403, 0), (404, 0), (503, 0), (418, 0)]
    df = spark.createDataFrame(rows, "s int, n int")
    got = [r.e for r in df.select(q.fetch_error(F.col("s"), F.col("n")).alias("e")).collect()]
    assert got == ["EmptyResponse", None, "AccessDenied", "NotFound", "RetryableHTTPError", "HTTPError"]


def test_final_attempt(spark):
    rows = [("a", 1, 503), ("a", 2, 200), ("b", 1, 503), ("b", 2, 503), ("b", 3, 503)]
    df = spark.createDataFrame(rows, "k string, attempt int, status int")
    out = ky.final_attempt(df, "k", "attempt", F.col("status") != 503, ["status"]).orderBy("k").collect()
    assert [tuple(r) for r in out] == [("a", 2, 200), ("b", 3, 503)]


def test_require_columns_names_what_is_there(spark):
    with pytest.raises(ValueError, match="available: \\['id'\\]"):
        cl.require_columns(spark.range(1), ["product_url"])


def test_upsert_is_idempotent(spark, table):
    events = table("events").select("user_id", "event_type", "event_id", "value")
    once = ky.upsert_keep_last(events, events, ["user_id", "event_type"], ["event_id"])
    twice = ky.upsert_keep_last(once, events, ["user_id", "event_type"], ["event_id"])
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_keep_first_twice_changes_nothing(spark, table):
    first = ky.keep_first(table("orders"), ["o_custkey"], ["o_orderkey"])
    assert first.exceptAll(ky.keep_first(first, ["o_custkey"], ["o_orderkey"])).count() == 0


def test_keyed_rows_shrink_before_the_shuffle(spark, table):
    plan = ky.keep_last(table("events"), ["user_id"], ["event_id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_hot_key_keeps_one_row_per_task(spark):
    rows = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    out = ky.keep_last(rows, ["k"], ["id"])
    assert out.filter("k = 7").first()["id"] == 29997
    assert out.count() == rows.select("k").distinct().count()


def test_fk_filter_and_orphans_partition_the_fact(spark):
    fact = spark.createDataFrame([("p1", "i1"), (None, "i1"), ("p2", "i1"), ("p1", "i9")], "product_id string, ingredient_id string")
    dims = [(spark.createDataFrame([("p1",)], "product_id string"), "product_id"),
            (spark.createDataFrame([("i1",)], "ingredient_id string"), "ingredient_id")]
    twice = [(d.unionAll(d), k) for d, k in dims]
    assert jn.fk_filter(fact, dims).count() == 1 and jn.fk_filter(fact, twice).count() == 4
    assert jn.fk_filter(fact, twice, "semi").count() == 1 and jn.fk_orphans(fact, twice).count() == 3


def test_running_total_matches_a_plain_window(spark, table):
    daily = table("events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    got = [r["total"] for r in ky.running_total(daily, "day", "n", "total").orderBy("day").collect()]
    want, total = [], 0
    for r in daily.orderBy("day").collect():
        total += r["n"]
        want.append(total)
    assert got == want


def test_merge_fragments_takes_first_filled(spark):
    df = spark.createDataFrame([(1, 1, 1, "Niacinamide", None), (1, 2, 3, "niacinamide", "5%"), (1, 3, 9, "NIACINAMIDE", "9%")],
                               "page int, source int, position int, name string, amount string")
    row = ag.merge_fragments(df, ["page"], "name", ["source", "position"], ["position", "amount"]).first()
    assert (row["name"], row["position"], row["amount"]) == ("Niacinamide", 1, "5%")


def test_irritation_flag(spark):
    df = spark.createDataFrame([("a", "irritating"), ("a", "non-irritating"), ("b", "irritating"), ("c", "x")], "k string, v string")
    flag = ag.any_flag(F.col("v") == "irritating", negative=F.col("v") == "non-irritating")
    assert [r.f for r in df.groupBy("k").agg(flag.alias("f")).orderBy("k").collect()] == [0, 1, None]


def test_features(spark):
    df = spark.createDataFrame([("1", "Soothing Oil-Free Gel", "fragrance and fragrance-free")], "product_id string, product_name string, description string")
    row = recommendation_features(df).first()
    assert len(row) == 24
    assert (row["skin_type_oily"], row["concern_redness"], row["avoid_for_sensitive"], row["avoid_for_fungal_acne"]) == (1, 1, 0, None)


def test_bronze_to_silver_twice_gives_equal_tables(spark):
    source, target = fresh_path(spark, "bronze"), fresh_path(spark, "silver")
    products = spark.createDataFrame([("1", "n", "usd", "x", "0.01", "0", None, "5.0"), ("2", "n", "GBP", "dermstore", "$9", "4.5", "A", "x")],
                                     "product_id string, _norm string, currency string, source string, price string, rating string, brand_name string, vegan string")
    ingredients = spark.createDataFrame([("i1", " Aqua ", None, "skincarisma"), ("i2", " **†", None, "x")],
                                        "ingredient_id string, ingredient_name string, evidence_level string, source string")
    bridge = spark.createDataFrame([("1", "i1", "Aqua", "5%", None), ("1", "i2", " **†", None, None), ("9", "i1", "Aqua", None, None), ("2", "i1", "**†", None, None)],
                                   "product_id string, ingredient_id string, ingredient_name string, ingredient_concentration string, evidence_level string")
    for name, df in (("ProductTable", products), ("IngredientsTable", ingredients), ("BridgeTable", bridge)):
        wr.write_csv(df, f"{source}/{name}.csv")
    for _ in range(2):
        assert b2s.bronze_to_silver(spark, source, target) == {"products": 2, "ingredients": 1, "product_ingredients": 1}
    rows = {r["product_id"]: r for r in spark.read.parquet(f"{target}/products").collect()}
    assert (rows["1"]["currency"], rows["1"]["source"], rows["1"]["price"], rows["1"]["rating"], rows["1"]["brand_name"], rows["1"]["vegan"]) == (
        "USD", "unknown", None, None, "Unknown", 5)
    assert (rows["2"]["price"], rows["2"]["rating"], rows["2"]["vegan"]) == ("$9", "4.5", None) and "_norm" not in rows["1"]


def test_csv_keeps_quotes_lines_and_nulls(spark):
    path = fresh_path(spark, "csv")
    rows = [(1, 'a "b", c\n\nd', ["x", 'y"']), (2, None, None)]
    wr.write_csv(spark.createDataFrame(rows, "i int, v string, a array<string>"), path, ["v", "a", "i", "gone"])
    back = rd.read_csv_strings(spark, path, multi_line=True).orderBy("i").collect()
    assert back[0].asDict() == {"v": 'a "b", c\n\nd', "a": '["x","y\\""]', "i": "1", "gone": None}
    assert back[1]["v"] is None and back[1]["a"] is None


def test_validate_record_lists_required_first(spark):
    df = spark.createDataFrame([("u", " ", "d", [])], "ingredient_url string, raw_ingredient_name string, full_description string, synonyms array<string>")
    row = q.validate_record(df, fixed.REQUIRED_INGREDIENT_FIELDS, fixed.OPTIONAL_INGREDIENT_FIELDS).first()
    assert row["extraction_status"] == "partial"
    assert row["missing_fields"] == ["raw_ingredient_name"] + fixed.OPTIONAL_INGREDIENT_FIELDS


# ---- Columns of the caller that are called like an operator's own ----

OWN = "k long, v long, _rank long, _at long, _side long, _range long, _start long, _sum long, _canonical string, __rank long"


def _own(spark, *rows):
    return spark.createDataFrame([(k, v, 10 + v, 20, 30, 40, 50, 60, "c", 70) for k, v in rows], OWN)


def test_no_column_of_the_caller_is_lost(spark):
    df = _own(spark, (1, 1), (1, 2), (2, 3))
    for kept, want in ((ky.keep_last(df, ["k"], ["v"]), {2, 3}), (ky.keep_first(df, ["k"], ["v"]), {1, 3})):
        assert kept.columns == df.columns and {(r.v, r._rank, r["__rank"]) for r in kept.collect()} == {
            (v, 10 + v, 70) for v in want}
    both = ky.upsert_keep_last(df, _own(spark, (2, 9)), ["k"], ["v"])
    assert both.columns == df.columns and {(r.k, r.v, r._side) for r in both.collect()} == {(1, 2, 30), (2, 9, 30)}
    assert ky.upsert_keep_last(df, df, ["none"], ["v"]).count() == 3
    total = ky.running_total(df, "v", "v", "sum")
    assert total.columns == [*df.columns, "sum"]
    assert sorted((r.v, r["sum"], r._range, r._start, r._sum) for r in total.collect()) == [
        (1, 1, 40, 50, 60), (2, 3, 40, 50, 60), (3, 6, 40, 50, 60)]
    items = df.withColumn("items", F.array(F.lit("a"), F.lit("b")))
    listed = ky.enumerate_items(items, "items", "item")
    assert sorted({(r.item, r.position, r._at) for r in listed.collect()}) == [("a", 1, 20), ("b", 2, 20)]


def test_lookups_keep_columns_called_like_their_own(spark):
    df = _own(spark, (1, 1)).withColumn("name", F.lit("aqua"))
    lookup = spark.createDataFrame([("aqua", "water")], "name string, canonical string")
    got = jn.canonical_lookup(df, "name", lookup, "norm").first()
    assert (got.norm, got._canonical) == ("water", "c")
    first = spark.createDataFrame([(1, None, "mine")], "k long, a string, _a string")
    second = spark.createDataFrame([(1, "theirs")], "k long, a string")
    assert tuple(jn.prefer(first, second, "k", ["a"]).first()) == (1, "theirs", "mine")


def test_nested_rules_repeat_nothing(spark):
    """Each expression is in the plan once, however rules are nested, and also inside lambdas."""
    def repeats(rule):
        texts = F.transform(F.split("id", ","), lambda x: rule(F.concat(x, F.lit("seen once"))))
        plan = spark.range(1).select(F.col("id").cast("string").alias("id")).select(texts.alias("x"))
        return plan._jdf.queryExecution().optimizedPlan().toString().count("seen once")

    rules = [lambda x: t.blank_to_null(t.clean_text(t.clean_text(x))), lambda x: t.score_label(t.clean_text(x)),
             lambda x: t.absolute_url(x, "https://a.example.com"), t.first_int, t.first_number, t.parse_price, t.yes_no]
    assert [repeats(r) for r in rules] == [1] * len(rules)


def test_whitespace_runs_become_one_space(spark):
    texts = ["a b", " a  b ", "a\tb", "a 　b\n", "\xa0", "a  b \x85", "x​x", "a \tb\t c"]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    assert [r[0] for r in df.select(t.clean_text("x")).collect()] == [
        "a b", "a b", "a b", "a b", None, "a b", "x​x", "a b c"]
