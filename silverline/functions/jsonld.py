"""Linked-data JSON inside pages, read with the VARIANT type; everything stays in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from silverline.functions.nodes import HIDDEN
from silverline.functions.text import _col, clean_text, let, safe_lower

def _get(v: Column, path: str, as_type: str) -> Column:
    return F.try_variant_get(v, path, as_type)


def _scripts(nodes: Column) -> Column:
    """Texts of the linked-data scripts of a page; comments hold none."""
    linked = lambda n: (n["tag"] == "script") & F.coalesce(
        safe_lower(n["attrs"]["type"]) == "application/ld+json", F.lit(False))
    return F.transform(F.filter(nodes, linked), lambda n: F.array_join(F.transform(
        F.filter(F.slice(nodes, n["at"] + 1, n["last"] - n["at"]), lambda x: x["tag"] == HIDDEN),
        lambda x: x["text"]), ""))


def jsonld_objects(nodes) -> Column:
    """array<variant> of all linked-data objects; bad JSON is skipped, lists are flattened."""
    none = F.array().cast("array<variant>")
    parsed = F.transform(_scripts(_col(nodes)), lambda b: F.try_parse_json(b))
    kept = F.filter(parsed, lambda v: v.isNotNull())
    return F.flatten(F.transform(kept, lambda v: F.when(
        _get(v, '$["@graph"]', "variant").isNotNull(),
        F.coalesce(_get(v, '$["@graph"]', "array<variant>"), none)
    ).otherwise(F.coalesce(_get(v, "$", "array<variant>"), F.array(v)))))


def has_type(obj: Column, name: str, allow_list: bool = True) -> Column:
    single = F.coalesce(_get(obj, '$["@type"]', "string") == F.lit(name), F.lit(False))
    if not allow_list:
        return single
    many = F.array_contains(_get(obj, '$["@type"]', "array<string>"), name)
    return single | F.coalesce(many, F.lit(False))


def jsonld_pick(objects: Column, name: str) -> Column:
    """First object whose `@type` is, or lists, the given type."""
    return F.get(F.filter(objects, lambda o: has_type(o, name)), F.lit(0))


def jsonld_item_list(objects: Column) -> Column:
    """array<struct(position, name)> of every ItemList named after ingredients."""
    def wanted(o):
        title = safe_lower(_get(o, "$.name", "string"))
        return has_type(o, "ItemList", allow_list=False) & (
            title.contains("ingredient") | title.contains("inci"))

    items = F.flatten(F.transform(
        F.filter(objects, wanted),
        lambda o: F.coalesce(_get(o, "$.itemListElement", "array<variant>"),
                             F.array().cast("array<variant>"))))
    rows = F.transform(items, lambda i: F.struct(
        _get(i, "$.position", "int").alias("position"),
        clean_text(_get(i, "$.name", "string"), strip_tags=True).alias("name")))
    return F.filter(rows, lambda r: r["name"].isNotNull())


def jsonld_breadcrumb(objects: Column) -> Column:
    """Names of the first BreadcrumbList by position; a missing position sorts as 99."""
    first = F.get(F.filter(objects, lambda o: has_type(o, "BreadcrumbList", allow_list=False)), F.lit(0))
    items = F.transform(
        _get(first, "$.itemListElement", "array<variant>"),
        lambda i, at: F.struct(
            F.coalesce(_get(i, "$.position", "double"), F.lit(99.0)).alias("position"),
            at.alias("at"),
            _get(i, "$.name", "string").alias("name")))
    named = F.filter(F.sort_array(items), lambda r: r["name"].isNotNull() & (r["name"] != ""))
    return F.coalesce(
        F.transform(named, lambda r: clean_text(r["name"], strip_tags=True)),
        F.array().cast("array<string>"))


def scalar_text(v: Column, path: str) -> Column:
    """Text of a scalar at `path`; null when an object or a list sits there."""
    text = _get(v, path, "string")
    return F.when(F.schema_of_variant(_get(v, path, "variant")).rlike("^(OBJECT|ARRAY)"), F.lit(None)).otherwise(text)


def brand_of(product: Column) -> Column:
    """Brand given as text or as an object with a name."""
    return clean_text(F.coalesce(_get(product, "$.brand.name", "string"),
                                 scalar_text(product, "$.brand")), strip_tags=True)


def image_text(product: Column) -> Column:
    """The whole `image` value as text: a list keeps all its members."""
    return _get(product, "$.image", "string")


def image_of(product: Column) -> Column:
    """Image given as text or as a list, whose head counts."""
    return F.coalesce(_get(product, "$.image[0]", "string"), scalar_text(product, "$.image"))


def offer_field(product: Column, field: str) -> Column:
    """Field of `offers` when that is an object."""
    return _get(product, f"$.offers.{field}", "string")


def embedded_json_array(html, variable: str, field: str) -> Column:
    """First element's `field` of `const <variable> = [...]`; bad JSON is null."""
    body = F.regexp_extract(_col(html), rf"(?s)const {variable} = (\[.*?\]);", 1)
    return let(F.try_parse_json(F.nullif(body, F.lit(""))), lambda v: _get(v, f"$[0].{field}", "string"))


def json_cells(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps become JSON text; scalars are left alone."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
        for f in df.schema.fields])
