"""Bronze tables (all text) to clean, typed, key-consistent silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from silverline.functions import fixed, text as t
from silverline.operators.aggregates import observed
from silverline.operators.columns import cast_ids, drop_columns, drop_values, trim_columns
from silverline.operators.joins import fk_filter
from silverline.sources.readers import read_csv_strings
from silverline.sources.writers import write_parquet


def clean_products(products: DataFrame) -> DataFrame:
    """Ids, allow-lists, sentinels, brand default and integer columns in one projection."""
    integers = [c for c in fixed.INTEGER_COLUMNS if c in products.columns]
    return drop_columns(products, "_norm").withColumns({
        "product_id": F.col("product_id").cast("string"),
        "currency": t.allow_list("currency", fixed.VALID_CURRENCIES, fixed.DEFAULT_CURRENCY),
        "source": t.allow_list("source", fixed.PRODUCT_SOURCES, fixed.UNKNOWN_SOURCE),
        "price": t.null_sentinel("price", fixed.MAX_BAD_PRICE),
        "rating": t.null_sentinel("rating", fixed.MAX_BAD_RATING),
        "brand_name": F.coalesce(F.col("brand_name"), F.lit(fixed.UNKNOWN_BRAND)),
        **{c: t.int_like(c) for c in integers}})


def clean_ingredients(ingredients: DataFrame,
                      sources: list[str] = fixed.INGREDIENT_SOURCES) -> DataFrame:
    """Trimming comes before the garbage test here, so padded garbage goes too."""
    cleaned = ingredients.withColumns({
        "ingredient_id": F.col("ingredient_id").cast("string"),
        "ingredient_name": F.trim("ingredient_name"),
        "evidence_level": F.col("evidence_level").cast("string"),
        "source": t.allow_list("source", sources, fixed.UNKNOWN_SOURCE)})
    return drop_values(cleaned, "ingredient_name", fixed.GARBAGE_INGREDIENT)


def clean_bridge_rows(bridge: DataFrame) -> DataFrame:
    """Everything but the key check. The garbage test precedes trimming: padded garbage stays."""
    kept = drop_values(bridge, "ingredient_name", fixed.GARBAGE_INGREDIENT)
    kept = drop_columns(kept, "ingredient_concentration", "evidence_level")
    return cast_ids(trim_columns(kept, ["ingredient_name"]), ["product_id", "ingredient_id"])


def clean_bridge(bridge: DataFrame, products: DataFrame, ingredients: DataFrame,
                 mode: str = "inner") -> DataFrame:
    return fk_filter(clean_bridge_rows(bridge),
                     [(products, "product_id"), (ingredients, "ingredient_id")], mode)


def silver_tables(products: DataFrame, ingredients: DataFrame, bridge: DataFrame) -> dict[str, DataFrame]:
    products, ingredients = clean_products(products), clean_ingredients(ingredients)
    return {"products": products, "ingredients": ingredients,
            "product_ingredients": clean_bridge(bridge, products, ingredients)}


def bronze_to_silver(spark: SparkSession, bronze: str, silver: str,
                     multi_line: bool = False) -> dict[str, int]:
    """Run the job on CSV folders; returns rows written per table.

    A row is a line, so one large file is read by many tasks. With `multi_line` cells may hold line
    breaks, and a file is one task.

    Each input is scanned once. The bridge is checked against the key columns of the silver
    tables just written, so the dimensions are neither parsed nor cleaned a second time.
    """
    watches = {}

    def read(table: str) -> DataFrame:
        return read_csv_strings(spark, f"{bronze}/{table}.csv", multi_line=multi_line)

    def write(df: DataFrame, name: str) -> None:
        counted, watches[name] = observed(df, name)
        write_parquet(counted, f"{silver}/{name}")

    write(clean_products(read("ProductTable")), "products")
    write(clean_ingredients(read("IngredientsTable")), "ingredients")
    keys = [(spark.read.parquet(f"{silver}/{t}").select(k), k)
            for t, k in (("products", "product_id"), ("ingredients", "ingredient_id"))]
    bridge = clean_bridge_rows(read("BridgeTable"))
    write(fk_filter(bridge, keys), "product_ingredients")
    return {name: watch.get["n_rows"] for name, watch in watches.items()}
