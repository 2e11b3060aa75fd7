"""HTML fragments: outline of a root answer and removal of ``<p>`` attributes.

A fragment is read with the standard library's tokenizer into a plain tag tree
(no repair of missing end tags: an open tag runs to the end of its parent) and
written back in a canonical form: attributes in name order, ``class`` and the
other token lists with single spaces, void tags as ``<img/>``, text with only
``& < >`` escaped.
"""

import re
import sys
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags without content, tags keeping their spaces, raw-text tags,
# and attributes holding a list of tokens.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split()
)
SPACED_TAGS = frozenset(["pre", "textarea"])
RAW_TAGS = frozenset(["script", "style"])
TOKEN_LISTS = {
    "*": {"class", "accesskey", "dropzone"},
    "a": {"rel", "rev"},
    "link": {"rel", "rev"},
    "td": {"headers"},
    "th": {"headers"},
    "form": {"accept-charset"},
    "object": {"archive"},
    "area": {"rel"},
    "icon": {"sizes"},
    "iframe": {"sandbox"},
    "output": {"for"},
}
ASCII_SPACE = " \n\t\f\r"
# A fragment of bare tags and plain text, its tokens, and tags whose content the tokenizer reads in another way.
PLAIN = re.compile(r"(?:</?[a-zA-Z][a-zA-Z0-9]*+>|[^<&]++)*+")
PLAIN_TOKEN = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9]*)>|([^<&]+)")
TEXT_TAGS = frozenset(
    "script style textarea title iframe noembed noframes noscript xmp plaintext listing".split())

OUTLINE = "struct<n_top:int,first_tag:string,child_divs:array<string>,error:string,broken:boolean>"


class Tag:
    __slots__ = ("name", "attrs", "children")

    def __init__(self, name, attrs=()):
        self.name = name
        self.attrs = dict(attrs)
        self.children = []

    def tags(self):
        return [c for c in self.children if isinstance(c, Tag)]


class Markup(str):
    """Comments, declarations and the like, written back unescaped."""


def _escape(text):
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _attribute(name, value):
    value = _escape(value)
    if '"' not in value:
        return f' {name}="{value}"'
    if "'" not in value:
        return f" {name}='{value}'"
    return ' {}="{}"'.format(name, value.replace('"', "&quot;"))


class FragmentReader(HTMLParser):
    """Builds the tag tree of one fragment."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.root = Tag("")
        self.open = [self.root]
        self.open_names = Counter()
        self.text = []

    def read(self, fragment):
        if not self._read_plain(fragment):
            self.feed(fragment)
            self.close()
        self._end_text()
        return self.root

    def _read_plain(self, fragment):
        """Reads a fragment in which nothing but bare tags and text stands, many times faster; false for any other."""
        if not PLAIN.fullmatch(fragment):
            return False
        tokens = PLAIN_TOKEN.findall(fragment)
        if any(name and name.lower() in TEXT_TAGS for _, name, _ in tokens):
            return False
        for end, name, text in tokens:
            if text:
                self.text.append(text)
            elif end:
                self.handle_endtag(name.lower())
            else:
                self.handle_starttag(name.lower(), ())
        return True

    def _end_text(self):
        if not self.text:
            return
        text, self.text = "".join(self.text), []
        if not text.strip(ASCII_SPACE) and not any(self.open_names[t] for t in SPACED_TAGS):
            text = "\n" if "\n" in text else " "
        self.open[-1].children.append(text)

    def _markup(self, text):
        self._end_text()
        self.open[-1].children.append(Markup(text))

    def handle_starttag(self, tag, attrs):
        self._end_text()
        values = {}
        if attrs:
            listed = TOKEN_LISTS["*"] | TOKEN_LISTS.get(tag, set())
            values = {k: " ".join((v or "").split()) if k in listed else v or "" for k, v in attrs}
        node = Tag(tag, values)
        self.open[-1].children.append(node)
        if tag not in VOID_TAGS:
            self.open.append(node)
            self.open_names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        while self.open_names[tag]:
            name = self.open.pop().name
            self.open_names[name] -= 1
            if name == tag:
                break

    def handle_data(self, data):
        self.text.append(data)

    def handle_charref(self, name):
        try:
            code = int(name[1:], 16) if name[:1] in "xX" else int(name)
            if 128 <= code < 160:
                self.text.append(bytes([code]).decode("windows-1252", "replace"))
            else:
                self.text.append(chr(code))
        except (ValueError, OverflowError):
            self.text.append("\N{REPLACEMENT CHARACTER}")

    def handle_entityref(self, name):
        self.text.append(html5.get(name + ";", f"&{name}"))

    def handle_comment(self, data):
        self._markup(f"<!--{data}-->")

    def handle_decl(self, decl):
        self._markup(f"<!{decl}>\n")

    def unknown_decl(self, data):
        self._markup(f"<![{data}]>" if not data.startswith("CDATA[") else f"<![{data}]]>")

    def handle_pi(self, data):
        self._markup(f"<?{data}>")


def read_fragment(fragment):
    return FragmentReader().read(fragment)


def write_fragment(root):
    """Canonical text of a tree, without recursion so depth does not matter."""
    out, todo = [], [root]
    while todo:
        node, raw = todo.pop(), False
        if isinstance(node, tuple):
            node, raw = node
        if not isinstance(node, Tag):
            out.append(node if raw or isinstance(node, Markup) else _escape(node))
            continue
        if node.name:
            attrs = "".join(_attribute(k, node.attrs[k]) for k in sorted(node.attrs))
            if node.name in VOID_TAGS:
                out.append(f"<{node.name}{attrs}/>")
                continue
            out.append(f"<{node.name}{attrs}>")
            todo.append(Markup(f"</{node.name}>"))
        in_raw = node.name in RAW_TAGS
        for child in reversed(node.children):
            todo.append((child, True) if in_raw and not isinstance(child, Tag) else child)
    return "".join(out)


def outline_of(fragment):
    """Shape of one fragment; the child ``<div>`` texts only under a sole ``<div>``."""
    if fragment is None:
        return None
    try:
        top = read_fragment(fragment).tags()
        divs = []
        if len(top) == 1 and top[0].name == "div":
            divs = [write_fragment(t) for t in top[0].tags() if t.name == "div"]
        first = top[0].name if top else None
        return (len(top), first, divs, None)
    except Exception as e:
        return (None, None, [], str(e))


def without_p_attributes(fragment):
    """The fragment itself when no ``<p>`` has attributes, else its canonical text without them.

    The text may hold a lone surrogate, which only its reader can judge.
    """
    if "<p" not in fragment:
        return fragment
    try:
        root = read_fragment(fragment)
        changed, todo = False, [root]
        while todo:
            node = todo.pop()
            if node.name == "p" and node.attrs:
                node.attrs, changed = {}, True
            todo.extend(node.tags())
        return write_fragment(root) if changed else fragment
    except Exception:
        return fragment


def stripped(fragment):
    """``without_p_attributes``, or the fragment where the result holds a lone surrogate."""
    cleaned = without_p_attributes(fragment)
    try:
        cleaned.encode()
        return cleaned
    except UnicodeEncodeError:
        return fragment


def _written(text):
    return text and text.encode("utf-8", "replace").decode()


def _outline_row(fragment):
    """The outline as text; ``broken`` tells that a lone surrogate, which cannot be written, stood in it."""
    outline = outline_of(fragment)
    if outline is None:
        return (None, None, None, None, None)
    n_top, first_tag, divs, error = outline
    texts = [_written(d) for d in divs]
    return (n_top, _written(first_tag), texts, _written(error), texts != divs)


def _outlines(fragments: pd.Series) -> pd.DataFrame:
    rows = [_outline_row(f) for f in fragments]
    return pd.DataFrame(rows, columns=["n_top", "first_tag", "child_divs", "error", "broken"]).astype(
        {"n_top": "Int32", "broken": "boolean"})


def _stripped(fragments: pd.Series) -> pd.Series:
    return fragments.map(stripped, na_action="ignore")


def _cleaned(fragment):
    """The cleaned fragment, whether it differs, and whether a lone surrogate keeps it from being written."""
    if fragment is None:
        return None
    cleaned = without_p_attributes(fragment)
    written = _written(cleaned)
    return {"text": written, "changed": cleaned != fragment, "broken": written != cleaned}


def _cleaned_lists(lists: pd.Series) -> pd.Series:
    return lists.map(lambda fragments: [_cleaned(f) for f in fragments], na_action="ignore")


# The helpers travel to the executors with the function, so no package has to be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def html_outline(text: Column) -> Column:
    """Outline struct of an HTML column; NULL input costs no parsing."""
    return F.pandas_udf(_outlines, OUTLINE)(text)


# Something other than the end behind <p, in text and in JSON text, where a space or the letters may be escaped.
P_WITH_MORE = r"(?i)<p[\s/]+[^\s/>]"
P_WITH_MORE_IN_JSON = r"(?i)<p([\s/]|\\[nrtbfu/])|\\u003c|\\u0070|\\u0050"


def strip_p_attributes(text: Column) -> Column:
    """``<p>`` attributes removed; text without any reaches Python only as NULL."""
    needed = text.rlike(P_WITH_MORE)
    return F.coalesce(F.pandas_udf(_stripped, "string")(F.when(needed, text)), text)


def clean_fragments(fragments: Column) -> Column:
    """An array of fragments, some of them NULL, cleaned one by one; NULL arrays cost no parsing."""
    return F.pandas_udf(_cleaned_lists, "array<struct<text:string,changed:boolean,broken:boolean>>")(fragments)
