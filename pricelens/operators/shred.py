"""HTML shredding: one page's markup -> an array of element nodes.

This is the only step that runs Python.  It is a per-partition Arrow batch
transform (``mapInArrow``): pages stay where they are, no shuffle, and
everything downstream (selection, text functions, records) is native Column
expressions over the ``nodes`` array.

Nodes are numbered in document order (``ord``) and carry the number of their
last descendant (``last``): a node is inside another if its number lies in that
interval, so a CSS selector is a chain of interval tests and steps to the
parent (see ``pricelens.functions.select``), and a page's nodes take space in
proportion to the page however deep it nests.  The steps (id and class set) of
a batch's nodes are shared by a dictionary over their markup.

Tree-building rules (close to what a lenient HTML parser does):
  * void elements never open a scope;
  * an end tag closes up to its nearest open match, an unmatched one is
    ignored;
  * some start tags imply the end of an open element (a new ``p`` or a block
    element closes an open ``p``; ``li``, ``dt``/``dd``, ``option``, ``tr``,
    ``td``/``th``, ``a`` and headings close their open sibling);
  * entities are decoded in text and attribute values;
  * each run of direct text between child elements/comments is one text node;
    ``script`` / ``style`` text belongs to those elements only.
"""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from pricelens.operators.partitioning import spread
from pricelens.schema import NODES_TYPE

VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr "
    "keygen basefont frame isindex".split())

P_CLOSERS = frozenset(
    "p div ul ol dl h1 h2 h3 h4 h5 h6 table section article header footer "
    "nav aside blockquote pre form hr address figure figcaption main "
    "fieldset details menu".split())

# start tag -> (tags it closes, tags that bound the search)
SIBLING_CLOSERS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    # links do not nest: a new <a> closes an open one
    "a": ({"a"}, {"td", "th", "table", "html"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_P_ONLY = frozenset(["p"])
P_SCOPE_BOUNDS = frozenset("table td th button object html".split())

ORD, PARENT, TAG, ATTRS, LAST, SIB_POS, TEXTS, STEP = range(8)


def _esc(name: str) -> str:
    return (name.replace("%", "%25").replace("/", "%2F")
            .replace(".", "%2E").replace("#", "%23"))


def _step(attrs: dict) -> tuple[str | None, list[str]]:
    """An element's id (null if blank) and its classes, sorted and distinct."""
    return attrs.get("id", "").strip() or None, sorted(set(attrs.get("class", "").split()))


class _TreeBuilder(HTMLParser):
    def __init__(self, steps: dict):
        super().__init__(convert_charrefs=True)
        self.nodes = []      # lists of ORD .. STEP
        self.stack = []      # indexes of open nodes
        self.child_tags = {-1: {}}
        self.text_open = {}  # node -> last child was text
        self.open_tags = {}  # tag -> places in the stack of the open elements with that tag
        self.steps = steps   # (id, class) markup -> (id, classes)

    def _close_to(self, idx_in_stack: int) -> None:
        places, nodes, last = self.open_tags, self.nodes, len(self.nodes) - 1
        for node in reversed(self.stack[idx_in_stack:]):
            places[nodes[node][TAG]].pop()
            nodes[node][LAST] = last
        del self.stack[idx_in_stack:]

    def _innermost(self, tags) -> int:
        return max((self.open_tags[t][-1] for t in tags if self.open_tags.get(t)), default=-1)

    def _find_open(self, tags, bounds=frozenset()) -> int:
        """Place of the innermost open one of ``tags``, -1 if one of ``bounds`` is nearer."""
        k = self._innermost(tags)
        return k if k >= 0 and k >= self._innermost(bounds) else -1

    def close(self):
        super().close()
        self._close_to(0)

    def _implied_ends(self, tag: str) -> None:
        counts = self.open_tags
        if tag in P_CLOSERS and counts.get("p"):
            k = self._find_open(_P_ONLY, P_SCOPE_BOUNDS)
            if k >= 0:
                self._close_to(k)
        if tag in HEADINGS and self.stack and self.nodes[self.stack[-1]][TAG] in HEADINGS:
            self._close_to(len(self.stack) - 1)  # an open heading ends at the next one
        rule = SIBLING_CLOSERS.get(tag)
        if rule and any(counts.get(t) for t in rule[0]):
            k = self._find_open(rule[0], rule[1])
            if k >= 0:
                self._close_to(k)

    def _open(self, tag, attrs, push: bool) -> None:
        self._implied_ends(tag)
        parent = self.stack[-1] if self.stack else -1
        amap = {}
        for k, v in attrs:
            if k not in amap:
                amap[k] = "" if v is None else v
        markup = (amap.get("id"), amap.get("class"))
        step = self.steps.get(markup)
        if step is None:
            step = self.steps[markup] = _step(amap)
        counts = self.child_tags.setdefault(parent, {})
        counts[tag] = counts.get(tag, 0) + 1
        idx = len(self.nodes)
        self.nodes.append([idx, parent, tag, amap, idx, counts[tag], [], step])
        self.text_open[parent] = False
        if push and tag not in VOID_TAGS:
            self.open_tags.setdefault(tag, []).append(len(self.stack))
            self.stack.append(idx)

    def handle_starttag(self, tag, attrs):
        self._open(tag, attrs, push=True)

    def handle_startendtag(self, tag, attrs):
        # HTML ignores the self-closing slash on non-void elements
        self._open(tag, attrs, push=True)

    def handle_endtag(self, tag):
        if tag in VOID_TAGS or not self.open_tags.get(tag):
            return
        k = self._find_open({tag})
        if k >= 0:
            self._close_to(k)

    def handle_data(self, data):
        if not self.stack:
            return
        node = self.stack[-1]
        texts = self.nodes[node][TEXTS]
        if self.text_open.get(node):
            texts[-1] += data
        else:
            texts.append(data)
            self.text_open[node] = True

    def parse_marked_section(self, i, report=1):
        """Unknown ``<![...`` sections are bogus comments; what follows is kept."""
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:
            return self.parse_bogus_comment(i)

    def handle_comment(self, data):
        if self.stack:
            self.text_open[self.stack[-1]] = False


# Distinct steps a dictionary holds before it starts anew.
STEPS_KEPT = 50000


def _build(html: str | None, steps: dict | None = None) -> list | None:
    if html is None:
        return None
    steps = {} if steps is None else steps
    if len(steps) > STEPS_KEPT:
        steps.clear()
    b = _TreeBuilder(steps)
    try:
        b.feed(html)
        b.close()
    except (AssertionError, ValueError, RecursionError):
        # beyond repair: no nodes at all, which becomes a reject (one page
        # must neither fail the task nor count as read with a part missing)
        return None
    return b.nodes


def parse_nodes(html: str | None) -> list[dict] | None:
    """Parse one page into node dicts (unit tests and debugging).

    ``css_path`` (ids and classes of all ancestors, names escaped) is a debugging
    aid that only exists here: see ``select.selector_regex``."""
    nodes = _build(html)
    if nodes is None:
        return None
    out: list[dict] = []
    for n in nodes:
        ident, classes = n[STEP]
        path = (out[n[PARENT]]["css_path"] if n[PARENT] >= 0 else "") + "/" + n[TAG] + (f"#{_esc(ident)}" if ident else "") + "".join(f".{_esc(c)}" for c in classes)
        out.append({"ord": n[ORD], "parent": n[PARENT], "last": n[LAST], "tag": n[TAG], "id": ident, "classes": classes,
                    "attrs": list(n[ATTRS].items()), "css_path": path, "sib_tag_pos": n[SIB_POS], "texts": n[TEXTS]})
    return out


def _nodes_array(htmls: list):
    """Parse a batch of pages straight into one Arrow list<struct> array."""
    return _to_array([_build(h) for h in htmls])


def _to_array(pages: list):
    """Built nodes of some pages as one Arrow list<struct> array.

    Built column by column from flat lists and offsets (much cheaper than
    converting nested Python objects)."""
    import pyarrow as pa

    ords, parents, lasts, tags, ids, sibs = [], [], [], [], [], []
    cvals, coffs = [], [0]
    akeys, avals, aoffs = [], [], [0]
    tvals, toffs = [], [0]
    noffs, valid = [0], []
    for nodes in pages:
        valid.append(nodes is not None)
        for n in nodes or ():
            ords.append(n[ORD])
            parents.append(n[PARENT])
            lasts.append(n[LAST])
            tags.append(n[TAG])
            ids.append(n[STEP][0])
            cvals.extend(n[STEP][1])
            coffs.append(len(cvals))
            for k, v in n[ATTRS].items():
                akeys.append(k)
                avals.append(v)
            aoffs.append(len(akeys))
            sibs.append(n[SIB_POS])
            tvals.extend(n[TEXTS])
            toffs.append(len(tvals))
        noffs.append(len(ords))
    attrs = pa.MapArray.from_arrays(pa.array(aoffs, pa.int32()), pa.array(akeys, pa.string()),
                                    pa.array(avals, pa.string()))
    classes = pa.ListArray.from_arrays(pa.array(coffs, pa.int32()), pa.array(cvals, pa.string()))
    texts = pa.ListArray.from_arrays(pa.array(toffs, pa.int32()), pa.array(tvals, pa.string()))
    struct = pa.StructArray.from_arrays(
        [pa.array(ords, pa.int32()), pa.array(parents, pa.int32()), pa.array(lasts, pa.int32()), pa.array(tags, pa.string()),
         pa.array(ids, pa.string()), classes, attrs, pa.array(sibs, pa.int32()), texts],
        names=["ord", "parent", "last", "tag", "id", "classes", "attrs", "sib_tag_pos", "texts"])
    mask = pa.array([not v for v in valid], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(noffs, pa.int32()), struct, mask=mask)


def _node_bytes(nodes: list | None) -> int:
    """About what a page's nodes take: steps, texts and attributes."""
    return sum(96 + sum(map(len, n[STEP][1])) + sum(map(len, n[TEXTS])) + sum(len(k) + len(v) for k, v in n[ATTRS].items()) for n in nodes or ())


def _runs(pages, max_rows: int, max_bytes: int):
    """(start, nodes of each page) runs of at most max_rows pages and, unless
    a single page is larger, at most max_bytes of nodes."""
    start, run, size = 0, [], 0
    for nodes in pages:
        n = _node_bytes(nodes)
        if run and (len(run) >= max_rows or size + n > max_bytes):
            yield start, run
            start, run, size = start + len(run), [], 0
        run.append(nodes)
        size += n
    if run:
        yield start, run


def shred(pages: DataFrame, html_col: str = "html", keep=None,
          out_col: str = "nodes", rows_per_batch: int = 256, bytes_per_batch: int = 32 << 20) -> DataFrame:
    """Replace ``html_col`` by ``out_col: array<NODE>``, null for a page
    without markup or one that cannot be parsed.

    ``keep`` lists the pass-through columns (default: all but html).  Filter
    and project the pages *before* calling this: Catalyst cannot push
    predicates through a Python step.
    """
    keep = [c for c in (keep or pages.columns) if c != html_col]
    src = spread(pages.select(*keep, html_col))
    out_fields = [f for f in src.schema.fields if f.name in keep]
    out_schema = T.StructType(out_fields + [T.StructField(out_col, NODES_TYPE)])

    def run(batches):
        import pyarrow as pa
        for whole in batches:
            steps: dict = {}
            # Nodes can be many times larger than the markup: output batches
            # are bounded in pages and in node bytes.
            htmls = whole.column(whole.schema.get_field_index(html_col))
            for start, run_ in _runs((_build(h.as_py(), steps) for h in htmls), rows_per_batch, bytes_per_batch):
                rb = whole.slice(start, len(run_))
                cols = [rb.column(rb.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays(cols + [_to_array(run_)], names=keep + [out_col])

    return src.mapInArrow(run, out_schema)
