"""Rules over array columns: splitting, cleaning, sets and ordered lists in one row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from silverline.functions import fixed
from silverline.functions.text import _col, blank_to_null, collapse, contains_any, let, strip


def split_list(c, pattern: str = ",", cut_at: str | None = None) -> Column:
    """Split by regex, strip the pieces, drop the empty ones; null text stays null."""
    c = _col(c)
    if cut_at:
        c = F.substring_index(c, cut_at, 1)
    return F.filter(F.transform(F.split(c, pattern), strip), lambda x: x != "")


def distinct_fold(values: Column) -> Column:
    """Case-insensitive distinct in first-seen order and spelling.

    Sorting by (folded, position) and keeping the head of each run costs n log n,
    so a very long list in one cell stays cheap.
    """
    keyed = F.transform(values, lambda v, i: F.struct(F.lower(v).alias("k"), i.alias("i"), v.alias("v")))
    heads = let(
        F.sort_array(keyed),
        lambda s: F.filter(s, lambda e, i: (i == 0) | (F.get(s, i - 1)["k"] != e["k"])))
    in_order = F.sort_array(F.transform(heads, lambda e: F.struct(e["i"].alias("i"), e["v"].alias("v"))))
    return F.transform(in_order, lambda e: e["v"])


def empty_to_null(values: Column) -> Column:
    return let(values, lambda a: F.when(F.size(a) > 0, a))


def clean_list(values) -> Column:
    """Clean each text, drop the empty ones, distinct ignoring case; an empty list is null.

    Only the first of equal texts can stay, so no text is cleaned or sorted twice.
    """
    cleaned = F.filter(F.transform(F.array_distinct(_col(values)), collapse), lambda x: x != "")
    return empty_to_null(distinct_fold(cleaned))


def sorted_set(values) -> Column:
    """Distinct values, ascending, `|`-joined; nothing is null."""
    kept = F.filter(_col(values), lambda x: x.isNotNull())
    return blank_to_null(F.array_join(F.sort_array(F.array_distinct(kept)), "|"))


def ordered_list(values, sep: str = "|") -> Column:
    """Values in the order of the list, joined; nulls are skipped and nothing is null."""
    return blank_to_null(F.array_join(F.filter(_col(values), lambda x: x.isNotNull()), sep))


def rule_of(label: Column, rules: dict[str, list[str]]) -> Column:
    """Name of the first rule with a word in the label."""
    out = None
    for name, words in rules.items():
        hit = contains_any(label, words)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return out


def label_value(pairs: Column, name: str, mode: str = "last") -> Column:
    """Value of a rule among the (rule, value) structs of one row.

    `last` takes the last pair even when its value is null; `first` and `last_value` take
    the first and the last non-null one.
    """
    if mode == "last":
        mine = F.filter(pairs, lambda p: F.coalesce(p["rule"] == name, F.lit(False)))
    else:
        mine = F.filter(pairs, lambda p: F.coalesce(p["rule"] == name, F.lit(False)) & p["value"].isNotNull())
    return F.try_element_at(mine, F.lit(1 if mode == "first" else -1))["value"]


def synonyms(points, description, name) -> Column:
    """Other names: `aka` points first, then each description pattern in turn."""
    aka = F.filter(_col(points), lambda p: F.lower(p).startswith(fixed.SYNONYM_PREFIX))
    from_points = F.flatten(F.transform(aka, lambda p: F.split(
        strip(F.substring(p, len(fixed.SYNONYM_PREFIX) + 1, 2_147_483_647)), fixed.SYNONYM_SPLIT)))
    found = [F.coalesce(F.regexp_extract_all(_col(description), F.lit(p), F.lit(1)),
                        F.array().cast("array<string>"))
             for p in fixed.SYNONYM_PATTERNS]
    every = F.concat(F.coalesce(from_points, F.array().cast("array<string>")), *found)
    own = F.lower(F.coalesce(_col(name), F.lit("")))
    return empty_to_null(F.filter(clean_list(every), lambda s: F.lower(s) != own))
