"""Pages as flat node lists.

`html_nodes` is the library's only Python step: Arrow batches of HTML in, one array of
nodes per page out, in document order. A node knows where its subtree ends, so "inside this
element" is a slice and every rule on top is a native array expression. All of it stays in
the page's own row: extraction never shuffles.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T

from silverline.functions.text import blank_to_null, clean_text, let

# Ship the parser inside the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NODE_TYPE = T.ArrayType(T.StructType([
    T.StructField("at", T.IntegerType()), T.StructField("last", T.IntegerType()),
    T.StructField("parent", T.IntegerType()), T.StructField("depth", T.IntegerType()),
    T.StructField("tag", T.StringType()), T.StructField("cls", T.StringType()),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
    T.StructField("text", T.StringType())]))
TEXT = "#text"      # visible text
HIDDEN = "#hidden"  # text of script, style and template elements

# --- Fixed values: elements without content, and elements whose text is not shown. ---
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "keygen", "link",
        "menuitem", "meta", "param", "source", "track", "wbr"}
UNSHOWN = {"script", "style", "template"}
# Elements whose end tag a following start tag implies, and where the search for them stops.
BLOCKS = ("address article aside blockquote center details dialog dir div dl fieldset figcaption "
          "figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul")
IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
           "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
           "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "tbody"},
           **{t: {"p"} for t in BLOCKS.split()}}
SCOPE = {"ul", "ol", "dl", "table", "select", "button", "html", "body", "template"}
# Elements whose content is raw text, or text without elements; of others like them parsers differ.
RAW, TEXT_ONLY = {"script", "style"}, {"title", "textarea"}
UNSURE = {"iframe", "noembed", "noframes", "noscript", "plaintext", "xmp"}
# --- End of fixed values. ---

# Plain markup, read without the tokenizer: text, and tags whose attributes are double-quoted or bare.
TOKEN = re.compile(r"[^<]+|<[^<>]*>|<")
PLAIN_TAG = re.compile(r"""<(/?)([a-z][a-z0-9]*)((?:[ \n]+[a-z][a-z0-9_:-]*(?:="[^"<>&]*")?)*)[ \n]*(/?)>""")
DOCTYPE = re.compile(r"<!doctype[^<>\"']*>", re.IGNORECASE)
# What some parsers take for the end of a script, or for a part of it that hides the end.
LIKE_END = re.compile(r"</\s*(?:script|style)|<!--", re.IGNORECASE)
COMMENT = re.compile(r"<!--[^<>-]+-->")
ATTRIBUTE = re.compile(r"""([a-z][a-z0-9_:-]*)(?:="([^"]*)")?""")
#: Tags that are remembered with what they say; most pages of a site share theirs.
KNOWN_TAGS = 4096
OPENS, CLOSES, EMPTY = range(3)
#: Pages and bytes of markup whose nodes are held at once; a longer page is held alone. Nodes take many
#: times the room of their markup, so those of a whole Arrow batch (64 MB of pages) are never together.
PART_PAGES, PART_BYTES = 64, 1 << 18


def _classes(attrs: dict[str, str]) -> str:
    cls = attrs.get("class")
    return f" {' '.join(cls.split())} " if cls else ""


class _Flattener(HTMLParser):
    """Collects (last, parent, depth, tag, cls, attrs, text) per node.

    An end tag closes up to its match. With `tree`, start tags also close the elements whose end
    they imply, as tree-building parsers do: a list item ends at the next one.
    """

    def __init__(self, tree: bool = False):
        super().__init__(convert_charrefs=True)
        self.tree = tree
        self.nodes: list[list] = []
        self.stack: list[tuple[str, int]] = []
        self.open: dict[str, int] = {}
        self.pending: list[str] = []

    def _flush(self):
        if self.pending:
            shown = not self.stack or self.stack[-1][0] not in UNSHOWN
            self.nodes.append([len(self.nodes) + 1, *self._place(), TEXT if shown else HIDDEN, "",
                               {}, "".join(self.pending)])
            self.pending.clear()

    def _place(self) -> tuple[int, int]:
        return (self.stack[-1][1] + 1 if self.stack else 0), len(self.stack)

    def handle_data(self, data):
        self.pending.append(data)

    def handle_comment(self, data):
        self._flush()

    def _element(self, tag, attrs):
        self._flush()
        attrs = {k: v or "" for k, v in attrs}
        self._node(tag, _classes(attrs), attrs)

    def _node(self, tag, cls, attrs):
        self.nodes.append([len(self.nodes) + 1, *self._place(), tag, cls, attrs, None])

    def _imply_ends(self, tag):
        ends = IMPLIED.get(tag, ())
        for at in range(len(self.stack) - 1, -1, -1):
            name = self.stack[at][0]
            if name in ends:
                self._flush()
                while len(self.stack) > at:
                    self._pop()
            elif name in SCOPE:
                return

    def _pop(self) -> str:
        name, at = self.stack.pop()
        self.open[name] -= 1
        self.nodes[at][0] = len(self.nodes)
        return name

    def handle_starttag(self, tag, attrs):
        if self.tree:
            self._imply_ends(tag)
        self._element(tag, attrs)
        self._open(tag)

    def _open(self, tag):
        if tag not in VOID:
            self.stack.append((tag, len(self.nodes) - 1))
            self.open[tag] = self.open.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self._element(tag, attrs)

    def handle_endtag(self, tag):
        self._flush()
        if not self.open.get(tag):
            return
        while self._pop() != tag:
            pass

    def finish(self) -> list[list]:
        self.close()
        self._flush()
        for _, at in self.stack:
            self.nodes[at][0] = len(self.nodes)
        return self.nodes


def _plain_tag(token: str) -> tuple | None:
    """(kind, tag, cls, attrs) of a tag that every parser reads alike; None for all other markup."""
    found = PLAIN_TAG.fullmatch(token)
    if not found:  # a comment parts two texts, as an end tag of nothing does
        return (CLOSES, "", "", {}) if COMMENT.fullmatch(token) else None
    end, tag, listed, empty = found.groups()
    if tag in UNSURE or (end and (listed or empty)) or (empty and (tag in RAW or tag in TEXT_ONLY)):
        return None
    attrs = dict(ATTRIBUTE.findall(listed)) if listed else {}
    return CLOSES if end else EMPTY if empty else OPENS, tag, _classes(attrs), attrs


def _flatten_plain(html: str, known: dict[str, tuple | None]) -> list[list] | None:
    """The nodes of `_Flattener` for a page of plain markup alone; None where the tokenizer has to decide.

    A page is text and tags in turn, so neither tokens nor their places are looked for twice. Adjacent
    text tokens do not exist, hence each is a node of its own.
    """
    tokens = TOKEN.findall(html)
    if tokens and DOCTYPE.fullmatch(tokens[0]):
        del tokens[0]
    nodes: list[list] = []
    stack: list[tuple[str, int]] = []
    opened: dict[str, int] = {}
    inside, depth, only = 0, 0, ""
    script: list[str] = []
    for token in tokens:
        if only in RAW and token != f"</{only}>":
            script.append(token)
            continue
        if script:
            body = "".join(script)
            if LIKE_END.search(body):
                return None
            nodes.append([len(nodes) + 1, inside, depth, HIDDEN, "", {}, body])
            script = []
        if token[0] != "<":
            kind = HIDDEN if inside and stack[-1][0] in UNSHOWN else TEXT
            nodes.append([len(nodes) + 1, inside, depth, kind, "", {}, unescape(token) if "&" in token else token])
            continue
        if token in known:
            said = known[token]
        else:
            said = _plain_tag(token)
            if len(known) >= KNOWN_TAGS:
                known.clear()
            known[token] = said
        if said is None:
            return None
        kind, tag, cls, attrs = said
        if only:
            if kind != CLOSES or tag != only:
                return None
            only = ""
        if kind == CLOSES:
            if opened.get(tag):
                last = len(nodes)
                while True:
                    name, at = stack.pop()
                    opened[name] -= 1
                    nodes[at][0] = last
                    if name == tag:
                        break
                depth = len(stack)
                inside = stack[-1][1] + 1 if stack else 0
            continue
        nodes.append([len(nodes) + 1, inside, depth, tag, cls, attrs, None])
        if kind == OPENS and tag not in VOID:
            stack.append((tag, len(nodes) - 1))
            opened[tag] = opened.get(tag, 0) + 1
            inside, depth = len(nodes), depth + 1
            if tag in RAW or tag in TEXT_ONLY:
                only = tag
    if only:
        return None
    for _, at in stack:
        nodes[at][0] = len(nodes)
    return nodes


def _flatten(html: str, tree: bool = False, known: dict | None = None) -> list[list] | None:
    if not tree:
        nodes = _flatten_plain(html, {} if known is None else known)
        if nodes is not None:
            return nodes
    parser = _Flattener(tree)
    try:
        parser.feed(html)
        return parser.finish()
    except AssertionError:  # markup the tokenizer rejects; the page is reported, not lost
        return None


def _node_array(html: pa.Array, tree: bool, known: dict) -> pa.Array:
    sizes, lasts, ats, tags, classes, texts = [0], [], [], [], [], []
    parents, depths = [], []
    attr_sizes, keys, values, missing = [0], [], [], []
    for cell in html.to_pylist():
        nodes = None if cell is None else _flatten(cell, tree, known)
        missing.append(nodes is None)
        if nodes:
            ats.extend(range(1, len(nodes) + 1))
            of_page = zip(*nodes)
            for column in (lasts, parents, depths, tags, classes):
                column.extend(next(of_page))
            for attrs in next(of_page):
                if attrs:
                    keys.extend(attrs)
                    values.extend(attrs.values())
                attr_sizes.append(len(keys))
            texts.extend(next(of_page))
        sizes.append(len(ats))
    attrs = pa.MapArray.from_arrays(
        pa.array(attr_sizes, pa.int32()), pa.array(keys, pa.string()), pa.array(values, pa.string()))
    structs = pa.StructArray.from_arrays(
        [pa.array(ats, pa.int32()), pa.array(lasts, pa.int32()), pa.array(parents, pa.int32()),
         pa.array(depths, pa.int32()), pa.array(tags, pa.string()),
         pa.array(classes, pa.string()), attrs, pa.array(texts, pa.string())],
        names=["at", "last", "parent", "depth", "tag", "cls", "attrs", "text"])
    return pa.ListArray.from_arrays(
        pa.array(sizes, pa.int32()), structs, mask=pa.array(missing, pa.bool_()))


def _parts(html: pa.Array) -> Iterator[pa.Array]:
    """A batch cut into runs of few pages and little markup."""
    start = held = 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(html), 0).to_pylist()):
        if at > start and (at - start == PART_PAGES or held + size > PART_BYTES):
            yield html.slice(start, at - start)
            start, held = at, 0
        held += size
    if start < len(html):
        yield html.slice(start)


def _node_arrays(batches: Iterator[pa.Array], tree: bool) -> Iterator[pa.Array]:
    """Every part's nodes leave before the next part is read."""
    for html in batches:
        known: dict = {}
        for part in _parts(html):
            yield _node_array(part, tree, known)


@F.arrow_udf(NODE_TYPE)
def html_nodes(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Node list of each page; elements end where their end tags are."""
    return _node_arrays(html, False)


@F.arrow_udf(NODE_TYPE)
def html_tree_nodes(html: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Node list of each page, with the ends that start tags imply."""
    return _node_arrays(html, True)


# ---- Native selectors: a predicate is a function of a node. ----

def tag(*names: str):
    return lambda n: n["tag"].isin(*names) if len(names) > 1 else n["tag"] == names[0]


def cls(name: str, of: str | None = None):
    """`.name`, or `of.name`."""
    has = lambda n: n["cls"].contains(f" {name} ")
    return has if of is None else lambda n: has(n) & (n["tag"] == of)


def cls_like(part: str):
    """`[class*=part]`."""
    return lambda n: n["cls"].contains(part)


def attr_is(name: str, value: str):
    return lambda n: F.coalesce(n["attrs"][name] == value, F.lit(False))


def attr_has(name: str, part: str | None = None):
    if part is None:
        return lambda n: n["attrs"][name].isNotNull()
    return lambda n: F.coalesce(n["attrs"][name].contains(part), F.lit(False))


def both(*preds):
    def test(n):
        out = preds[0](n)
        for p in preds[1:]:
            out = out & p(n)
        return out
    return test


def either(*preds):
    """Comma list: the first match is the first in document order."""
    def test(n):
        out = preds[0](n)
        for p in preds[1:]:
            out = out | p(n)
        return out
    return test


def _under(nodes: Column, outers: Column, pred) -> Column:
    """Matches below the outer nodes, in document order, each once.

    Each outer node's subtree is cut out and searched, so the work follows the subtrees and
    not the number of pairs; nested outer nodes find a match twice, hence the distinct places.
    """
    def found(page: Column, outs: Column) -> Column:
        before = F.get(page, F.lit(0))["at"] - 1
        hits = F.flatten(F.transform(outs, lambda o: F.transform(
            F.filter(F.slice(page, o["at"] + 1 - before, o["last"] - o["at"]), pred),
            lambda n: n["at"])))
        return F.transform(F.array_sort(F.array_distinct(hits)),
                           lambda at: F.get(page, at - before - 1))

    return let(F.struct(nodes.alias("page"), outers.alias("outs")), lambda x: found(x["page"], x["outs"]))


def nearest_above(nodes: Column, n: Column, pred) -> Column:
    """The innermost element around `n` that matches; `nodes` must be the whole page."""
    at = F.aggregate(F.sequence(F.lit(1), n["depth"]), n["parent"], lambda p, _: F.when(
        (p > 0) & ~pred(F.get(nodes, p - 1)), F.get(nodes, p - 1)["parent"]).otherwise(p))
    return F.when((n["depth"] > 0) & (at > 0), F.get(nodes, at - 1))


def select(nodes: Column, *path) -> Column:
    """Nodes matching a descendant path of predicates, in document order, each once."""
    found = F.filter(nodes, path[0])
    for pred in path[1:]:
        found = _under(nodes, found, pred)
    return found


def select_one(nodes: Column, *path) -> Column:
    return F.get(select(nodes, *path), F.lit(0))


def first_of(nodes: Column, *paths) -> Column:
    """Priority list: the first path that finds an element decides."""
    paths = [p if isinstance(p, tuple) else (p,) for p in paths]
    return F.coalesce(*[select_one(nodes, *p) for p in paths])


def _subtree(nodes: Column, n: Column) -> Column:
    return F.slice(nodes, n["at"] + 1, n["last"] - n["at"])


def inside(nodes: Column, n: Column) -> Column:
    """Subtree of `n` without itself. `nodes` must be the whole page."""
    return let(n, lambda e: _subtree(nodes, e))


def _pieces(subtree: Column) -> Column:
    return F.transform(F.filter(subtree, lambda n: n["tag"] == TEXT), lambda n: n["text"])


def raw_text(subtree: Column) -> Column:
    """Plain concatenation: `Oil<b>y</b>` is `Oily`."""
    return F.array_join(_pieces(subtree), "")


def joined_text(subtree: Column) -> Column:
    """Stripped pieces joined by one space, cleaned: `Oil<b>y</b>` is `Oil y`.

    Cleaning collapses runs of whitespace, so joining the unstripped pieces is enough.
    """
    return clean_text(F.array_join(_pieces(subtree), " "))


def text_of(nodes: Column, n: Column, raw: bool = False) -> Column:
    """Text of an element; null when there is no element."""
    body = inside(nodes, n)
    return raw_text(body) if raw else joined_text(body)


def first_text(nodes: Column, *paths, raw: bool = False) -> Column:
    """Fallback chain for one field."""
    return text_of(nodes, first_of(nodes, *paths), raw)


def attr(n: Column, name: str) -> Column:
    return n["attrs"][name]


def other_classes(n: Column, own: str) -> Column:
    """`|`-joined classes except `own`."""
    return blank_to_null(F.array_join(
        F.filter(F.split(F.trim(n["cls"]), " "), lambda c: (c != own) & (c != "")), "|"))


def with_nodes(df: DataFrame, html: str = "html", into: str = "nodes",
               partitions: int | None = None, tree: bool = False) -> DataFrame:
    """Add the node list of every page.

    Pages keep the partitions they come in. Parsing costs far more than moving the bytes, so a
    small table that comes as one split gains from `partitions`. `tree` reads markup as
    tree-building parsers do.
    """
    if partitions:
        df = df.repartition(partitions)
    return df.withColumn(into, (html_tree_nodes if tree else html_nodes)(F.col(html)))
