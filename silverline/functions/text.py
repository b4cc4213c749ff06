"""Text, number, id and time rules as native Column expressions (no Python per row)."""

from __future__ import annotations

import json
from functools import reduce
from html.entities import html5
from urllib.parse import urlsplit

from pyspark.sql import Column, functions as F

from silverline.functions import fixed

# Characters with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The same as ranges, without the space, for a class that Java tests quickly.
_OTHER = "\t-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Runs of them other than one space: most texts hold none, and then nothing is replaced.
UNEVEN = f"[{_OTHER}][ {_OTHER}]*| [ {_OTHER}]+"

# What Windows-1252 has at the codes of the C1 controls, where it has something.
WINDOWS = {str(i): bytes([i]).decode("cp1252") for i in range(0x80, 0xA0)
           if bytes([i]).decode("cp1252", "ignore")}

# One character reference: decimal, hexadecimal, or a name.
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)"
# Markup whose content goes too, up to the end of the text where it is left open, and any other
# tag. A tag starts at `<` followed by a letter, `/`, `!` or `?`; any other `<` is text.
HIDDEN_MARKUP = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\z)"
TAG = r"""(?s)<[A-Za-z/!?](?:"[^"]*"|'[^']*'|[^'">])*>"""


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """Bind `value` once and use it many times inside `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(c) -> Column:
    """Null for the empty text. Spark repeats the argument of `nullif` inside a lambda, and such
    repeats multiply where rules are nested, so an expression is bound first."""
    return F.nullif(_col(c), F.lit("")) if isinstance(c, str) else let(c, lambda v: F.nullif(v, F.lit("")))


def strip(c) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def contains_any(c, words) -> Column:
    c = _col(c)
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def _lookup(table: dict[str, str]) -> Column:
    """A constant map, parsed once when the plan is optimised."""
    return F.from_json(F.lit(json.dumps(table)), "map<string,string>")


def _numeric(ref: Column) -> Column:
    """The character of a numeric reference, by the rules of HTML.

    Leading zeros do not count; codes that are no character become U+FFFD, and those of the
    C1 controls what Windows-1252 has in their place.
    """
    hexadecimal = F.lower(F.substring(ref, 3, 1)) == "x"
    digits = F.regexp_replace(F.regexp_replace(ref, "^&#[xX]?|;$", ""), "^0+", "")
    code = F.when(F.length(digits).between(1, 7), F.when(hexadecimal, F.conv(digits, 16, 10))
                  .otherwise(F.conv(digits, 10, 10)).cast("int"))
    bad = code.isNull() | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    old = F.when(code.between(0x80, 0x9F), F.element_at(_lookup(WINDOWS), code.cast("string")))
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.when(bad, "\ufffd").otherwise(F.coalesce(old, plain))


def _resolved(ref: Column) -> Column:
    named = F.element_at(_lookup(html5), F.substring(ref, 2, 64))
    return F.when(ref.startswith("&#"), _numeric(ref)).otherwise(F.coalesce(named, ref))


def _unescape(text: Column) -> Column:
    """Each reference is resolved once; what it resolves to is text."""
    refs = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    between = F.split(text, REFERENCE, -1)
    return F.array_join(F.zip_with(between, refs, lambda part, ref: F.concat(
        part, F.when(ref.isNull(), "").otherwise(_resolved(ref)))), "")


def unescape_entities(c) -> Column:
    """Resolve character references: all names of HTML, and numbers of any length."""
    return let(_col(c), lambda t: F.when(t.contains("&"), _unescape(t)).otherwise(t))


def _strip_markup(text: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(text, HIDDEN_MARKUP, " "), TAG, " ")
    return F.when(text.contains("<") | text.contains("&"), unescape_entities(bare)).otherwise(text)


def collapse(c) -> Column:
    """Runs of whitespace (nbsp included) as one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), UNEVEN, " "))


def clean_text(c, strip_tags: bool = False) -> Column:
    """Collapse whitespace (nbsp included), strip, blank to null.

    With `strip_tags`, markup is dropped first and character references resolved.
    """
    c = let(_col(c), _strip_markup) if strip_tags else _col(c)
    return blank_to_null(collapse(c))


def safe_lower(c) -> Column:
    return F.lower(strip(F.coalesce(_col(c), F.lit(""))))


def drop_fragment(c) -> Column:
    """Cut `#...`; the query string stays."""
    return F.substring_index(_col(c), "#", 1)


def _without_dots(path: Column) -> Column:
    """Fold `.` and `..` segments of an absolute path."""
    none = F.array().cast("array<string>")
    parts = F.slice(F.split(path, "/"), 2, 1 << 20)
    last = F.element_at(parts, -1)
    folded = F.aggregate(parts, none, lambda done, x: F.when(
        x == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))).when(
        x == ".", done).otherwise(F.concat(done, F.array(x))))
    return F.concat(F.lit("/"), F.array_join(folded, "/"),
                    F.when(last.isin(".", "..") & (F.size(folded) > 0), "/").otherwise(""))


def _resolve(url: Column) -> Column:
    """Fold the dot segments of an absolute URL's path; query and fragment stay."""
    head = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(url, r"([?#].*)$", 1)
    return F.when(url.contains("/.") & (head != "") & path.rlike(r"/\.{1,2}(/|$)"),
                  F.concat(head, let(path, _without_dots), rest)).otherwise(url)


def absolute_url(c, base: str, resolve: bool = False) -> Column:
    """`//x` gets a scheme, `/x` the base. `resolve` joins as a browser does, from a `base` with or
    without a path: `/x` goes below the host, plain relative paths below the base's last folder,
    and dot segments are folded."""
    return let(blank_to_null(strip(c)), lambda url: _absolute(url, base, resolve))


def _absolute(c: Column, base: str, resolve: bool) -> Column:
    scheme = F.when(c.startswith("//"), F.concat(F.lit("https:"), c))
    if not resolve:
        return scheme.when(c.startswith("/"), F.concat(F.lit(base.rstrip("/")), c)).otherwise(c)
    parts = urlsplit(base)
    host = f"{parts.scheme}://{parts.netloc}"
    folder = parts.path[:parts.path.rfind("/") + 1] or "/"
    out = (scheme.when(c.startswith("/"), F.concat(F.lit(host), c))
           .when(c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), c)
           .when(c.startswith("?"), F.concat(F.lit(host + parts.path.rstrip("/")), c))
           .when(c.startswith("#"), F.concat(F.lit(base.partition("#")[0].rstrip("/")), c))
           .otherwise(F.concat(F.lit(host + folder), c)))
    return let(out, _resolve)


def md5_id(c, fold: bool = True) -> Column:
    """Folded ids ignore case and outer space; unfolded ids hash the text as it is."""
    return F.md5(safe_lower(c)) if fold else F.md5(_col(c))


def record_id(c, prefix: str, fallback: Column | None = None) -> Column:
    """`prefix_` + first 16 hex digits of sha256; missing input hashes `fallback`."""
    value = blank_to_null(c)
    if fallback is not None:
        value = F.coalesce(value, fallback)
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(value, 256), 1, 16))


def slug(c, max_length: int = 120) -> Column:
    s = F.regexp_replace(safe_lower(c), "https?://", "")
    s = F.btrim(F.regexp_replace(s, "[^a-z0-9]+", "_"), F.lit("_"))
    s = F.rtrim(F.substring(s, 1, max_length), F.lit("_"))
    return F.coalesce(blank_to_null(s), F.lit("unknown"))


def parse_price(c) -> Column:
    """First run of digits and dots once thousands commas are gone."""
    return blank_to_null(F.regexp_extract(F.replace(_col(c), F.lit(","), F.lit("")), "[0-9.]+", 0))


def first_int(c) -> Column:
    return blank_to_null(F.regexp_extract(_col(c), "[0-9]+", 0)).try_cast("int")


def comma_int(c) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit("")).try_cast("int")


def ratio_of_5(c) -> Column:
    """Number written before `/5`."""
    found = F.regexp_extract(_col(c), r"([0-9]+(?:\.[0-9]+)?)\s*/\s*5", 1)
    return blank_to_null(found).try_cast("double")


def first_number(c) -> Column:
    return blank_to_null(F.regexp_extract(_col(c), r"[0-9]+(?:\.[0-9]+)?", 0)).try_cast("double")


def yes_no(c) -> Column:
    """1 when the text holds `yes`, else 0 when it holds `no` (so `unknown` is 0)."""
    return let(safe_lower(c), lambda low: F.when(low.contains("yes"), 1).when(low.contains("no"), 0))


def score_label(c, labels: dict[str, int] | None = None) -> Column:
    """Score of the first label, in rule order, that the text contains."""
    def scored(low: Column) -> Column:
        pairs = list((labels or fixed.SCORE_LABELS).items())
        out = F.when(low.contains(pairs[0][0]), pairs[0][1])
        for word, score in pairs[1:]:
            out = out.when(low.contains(word), score)
        return out

    return let(safe_lower(c), scored)


def strip_label(c, label: str, prefix_only: bool = False) -> Column:
    """Remove a literal label everywhere, or (any case) only at the start."""
    if prefix_only:
        quoted = "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in label)
        return strip(F.regexp_replace(_col(c), rf"(?i)^{quoted}\s*", ""))
    return strip(F.replace(_col(c), F.lit(label), F.lit("")))


def after_colon(c) -> Column:
    """Text after the first colon, or the whole text when there is none."""
    return clean_text(F.regexp_replace(_col(c), "^[^:]*:", ""))


def ingredient_name(c, strip_tags: bool = False) -> Column:
    """struct(name, concentration); both null when the text is no ingredient name."""
    text = F.btrim(clean_text(c, strip_tags), F.lit(fixed.NAME_EDGE_CHARS))
    return let(text, _name_and_concentration)


def _name_and_concentration(text: Column) -> Column:
    found = F.regexp_extract(text, f"({fixed.CONCENTRATION_PATTERN})", 1)  # '' when there is none
    return let(F.struct(text.alias("text"), found.alias("amount")), _without_amount)


def _without_amount(e: Column) -> Column:
    bare = F.btrim(F.replace(e["text"], e["amount"], F.lit("")), F.lit(fixed.NAME_EDGE_CHARS))
    amount = blank_to_null(F.replace(e["amount"], F.lit(" "), F.lit("")))
    return let(F.struct(clean_text(bare).alias("name"), amount.alias("concentration")), lambda r: F.when(
        (F.length(r["name"]) <= fixed.MAX_NAME_LENGTH)
        & ~F.lower(r["name"]).rlike("|".join(fixed.BAD_NAME_WORDS)), r).otherwise(
        F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("concentration"))))


def normalize_name(c) -> Column:
    return F.lower(clean_text(c))


def normalize_rating(c) -> Column:
    return F.upper(clean_text(c))


def canonical_name(c, names: dict[str, str] | None = None) -> Column:
    """Map through a small literal dictionary; unmapped names stay themselves."""
    c = _col(c)
    pairs = [F.lit(x) for kv in (names or fixed.CANONICAL_NAMES).items() for x in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), c), c)


def keyword_tags(c, rules: dict[str, list[str]]) -> Column:
    """`|`-joined names of the rules with a word in the text, in name order; none is null."""
    return let(safe_lower(c), lambda low: blank_to_null(F.concat_ws(
        "|", *[F.when(contains_any(low, rules[tag]), F.lit(tag)) for tag in sorted(rules)])))


def claim_flags(c, rules: dict[str, list[str]] | None = None) -> dict[str, Column]:
    """One always-0/1 column per claim."""
    low = F.lower(F.coalesce(_col(c), F.lit("")))
    return {name: contains_any(low, words).cast("int").alias(name)
            for name, words in (rules or fixed.CLAIM_RULES).items()}


def safe_concat(cols) -> Column:
    """Join with one space; a null field still takes its place as an empty string."""
    return F.concat_ws(" ", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def truncate(c, n: int) -> Column:
    return F.substring(_col(c), 1, n)


def batch_id(ts) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd_HHmmss")


def ingestion_date(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd")


def iso_ts(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def is_missing(c, data_type: str = "string") -> Column:
    """Null, a blank string, or an empty array."""
    c = _col(c)
    if data_type.startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    if data_type == "string":
        return c.isNull() | (strip(c) == "")
    return c.isNull()


def int_like(c) -> Column:
    """Integer part of plain decimal text; anything else (`1e2`, `1,234`, `true`) is null.

    Only text known to be digits reaches `try_cast`: a cast that fails raises and catches an
    exception per row, and this runs on 20 columns a row.
    """
    text = F.btrim(_col(c).cast("string"), F.lit(" \t\n\r\x0b\x0c"))
    whole = F.substring_index(text, ".", 1)
    rest = F.substring(text, F.length(whole) + 2, F.length(text))
    digits = F.when(whole.startswith("+") | whole.startswith("-"),
                    F.substring(whole, 2, 2_147_483_647)).otherwise(whole)
    plain = F.translate(F.concat(digits, rest), "0123456789", "") == ""
    return F.when(plain & (digits != ""), whole.try_cast("int")).when(
        plain & text.contains("."), F.lit(0))


def null_sentinel(c, max_bad: float) -> Column:
    """Null when the text is a number not above `max_bad`; other text and null pass."""
    c = _col(c)
    return F.when(c.try_cast("double") <= max_bad, F.lit(None)).otherwise(c)


def allow_list(c, allowed, default: str) -> Column:
    """Keep listed values; everything else, null included, becomes `default`."""
    c = _col(c)
    return F.when(c.isin(list(allowed)), c).otherwise(F.lit(default))
