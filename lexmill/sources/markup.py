"""Markup to text where no expression can: HTML, XML, RTF and old word files, as Arrow UDFs.

Markup is read as a flat series of events by one pattern, so what is not well formed gives
some text and never an error; functions that need a whole tree give null for what is none.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Event(NamedTuple):
    """A piece of markup: text (tag empty), or a tag that opens, closes or does both."""

    tag: str = ""
    opens: bool = False
    closes: bool = False
    attributes: str = ""
    text: str = ""


_PIECE = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attributes>(?:"[^"]*"|'[^']*'|[^'">])*)>|(?P<text>[^<]+|<)""", re.S)
#: Elements whose content is no markup.
_RAW = {"script": re.compile(r"(?i)(?=</script)"), "style": re.compile(r"(?i)(?=</style)")}


def events(markup: str, raw: dict[str, re.Pattern] = _RAW) -> Iterator[Event]:
    at = 0
    while m := _PIECE.match(markup, at):
        at = m.end()
        if m["text"] is not None:
            yield Event(text=entities.unescape(m["text"]))
        elif m["tag"] is not None:
            tag, rest = m["tag"], m["attributes"] or ""
            both = rest.endswith("/")
            yield Event(tag, not m["end"], bool(m["end"]) or both, rest)
            if not m["end"] and not both and tag.lower() in raw:
                stop = raw[tag.lower()].search(markup, at)
                at, inside = (stop.start() if stop else len(markup)), markup[at : stop.start() if stop else len(markup)]
                if inside:
                    yield Event(text=inside)
    if at < len(markup):
        yield Event(text=markup[at:])


def squeezed(text: str, blanks: str = r"[ \t]+", blank: str = " ") -> str:
    return re.sub(r"\n{3,}", "\n\n", re.sub(blanks, blank, text)).strip()


#: Fixed names: tags that start a line, tags whose end starts a line, and tags from which, up to an end of any of them, text is left out.
STARTS, ENDS, HIDDEN = frozenset("p div br li tr h1 h2 h3 h4".split()), frozenset("p div li tr".split()), frozenset("script style head".split())


def html_text(html: str) -> str:
    """X-04: text with line ends at blocks; one flag, not a depth, leaves out script, style and head."""
    hidden, out = False, []
    for e in events(html):
        name = e.tag.lower()
        if name in HIDDEN:
            hidden = e.opens and not e.closes
        lines = (e.opens and name in STARTS) + (e.closes and name in ENDS)
        out.append("\n" * lines or ("" if hidden else e.text))
    return squeezed("".join(out))


def block_text(html: str) -> str:
    """X-05: the text of every p, div, li and tr; nested blocks repeat their text."""
    pieces: list[str] = []
    blocks: list[list] = []  # [tag, first piece, piece after the last]
    for e in events(html):
        name = e.tag.lower()
        if not name and e.text.strip():
            pieces.append(e.text.strip())
        if name not in ENDS:
            continue
        still = [b for b in blocks if b[2] is None]
        if e.opens:
            if name == "p" and still and still[-1][0] == "p":
                still[-1][2] = len(pieces)
            blocks.append([name, len(pieces), None])
        if e.closes and (same := [i for i, b in enumerate(still) if b[0] == name and b[2] is None]):
            for b in still[same[-1] :]:
                b[2] = len(pieces) if b[2] is None else b[2]
    texts = [" ".join(pieces[a:b]) for _, a, b in blocks] if blocks else [" ".join(pieces)]
    return squeezed("\n".join(t for t in texts if t))


#: Fixed rules of code markup: what stands around an element's text, by name; names below give their text as it is.
AROUND = {"td": ("", " "), "th": ("", " "), "tr": ("\n", "")} | {name: ("\n\n", "\n\n") for name in ("p", "table", "ul", "ol", "li", "div")}
TRIMMED = frozenset(("td", "th", "tr"))
PLAIN = frozenset("html body thead tbody tfoot colgroup col i b u em strong sup sub span br fraction numerator denominator content heading".split())


def caml_text(xml: str) -> tuple[str, list[str]]:
    """X-08: (text, unknown elements): paragraphs apart by a blank line, rows by a line, cells by a blank, mixed numbers by a blank.

    Each open element has a buffer; when it ends, the rules say what its buffer adds to the one below.
    """
    unknown: set[str] = set()
    open_: list[dict] = [{"name": "", "attributes": "", "text": "", "bare": "", "parts": {}}]

    def ended() -> None:
        el, into = open_.pop(), open_[-1]
        name, text = el["name"], el["text"]
        into["bare"] += el["bare"]
        into["parts"].setdefault(name, el["bare"].strip())
        if name == "br":
            text = "\n"
        elif name == "span" and ("enspace" in el["attributes"].lower() or not el["bare"].strip()):
            text = " "
        elif name == "fraction" and {"numerator", "denominator"} <= el["parts"].keys():
            text = f"{el['parts']['numerator']}/{el['parts']['denominator']}"
            if into["text"].rstrip()[-1:].isdigit():
                text = " " + text
        elif name in AROUND:
            before, after = AROUND[name]
            text = before + (text.strip() if name in TRIMMED else text) + after
        elif name not in PLAIN:
            unknown.add(name)
        into["text"] += text

    for e in events(xml, {}):
        name = e.tag.rpartition(":")[2].lower()
        if not name:
            open_[-1]["text"] += re.sub(r"\s+", " ", e.text)
            open_[-1]["bare"] += e.text
        elif e.opens:
            open_.append({"name": name, "attributes": e.attributes, "text": "", "bare": "", "parts": {}})
            if e.closes:
                ended()
        elif any(el["name"] == name for el in open_[1:]):  # an end without a start is passed over
            while open_[-1]["name"] != name:
                ended()
            ended()
    while len(open_) > 1:
        ended()
    return squeezed(open_[0]["text"], r"[ \t]+\n", "\n"), sorted(unknown)


#: Fixed names of a register rule's blocks.
REGISTER_BLOCKS = frozenset("P HD FP SECTION DIV".split())


def register_text(xml: str) -> str:
    """X-09: text of a register rule, lines at blocks, page marks out with what follows them."""
    out, lost, depth, within = [], False, 0, 0
    for e in events(xml, {}):
        if not e.tag:
            if not lost and not within:
                out.append(e.text)
            continue
        top = depth == 0 and e.opens
        depth += e.opens - e.closes
        lost = False
        if e.tag == "PRTPAGE":
            within = within + e.opens - e.closes
            lost = within <= 0
            within = max(within, 0)
        elif not within and e.tag in REGISTER_BLOCKS and not top and depth >= e.closes:
            out.append("\n" * (e.opens + e.closes))
    return squeezed("".join(out))


#: Control words that stand for a blank.
RTF_BREAKS = frozenset(("par", "line", "tab", "cell", "row"))
_RTF = re.compile(r"\\(?P<word>[A-Za-z]+)(?P<n>-?\d+)? ?|\\'(?P<hex>.{0,2})|\\(?P<symbol>.?)|(?P<brace>[{}])|(?P<text>[^\\{}]+)", re.S)


def rtf_text(chunk: str) -> str:
    """X-13: control words out, breaks as blanks, \\u and \\' decoded, groups that start with \\* out; what cannot be decoded is passed over."""
    tokens = list(_RTF.finditer(chunk))
    hidden: list[bool] = [False]  # by open group
    out: list[str] = []
    for before, m in zip([None, *tokens], tokens):
        text = ""
        if m["brace"] == "{":
            hidden.append(hidden[-1])
        elif m["brace"] == "}":
            if len(hidden) > 1:
                hidden.pop()
        elif m["word"] is not None:
            if m["word"] in RTF_BREAKS:
                text = " "
            elif m["word"] == "u" and m["n"]:
                code = int(m["n"]) % 65536
                text = chr(code) if not 0xD800 <= code < 0xE000 else "\ufffd"
        elif m["hex"] is not None:
            if re.fullmatch("[0-9A-Fa-f]{2}", m["hex"]):
                text = bytes.fromhex(m["hex"]).decode("cp1252", "replace")
        elif m["symbol"] is not None:
            if m["symbol"] == "*" and before is not None and before["brace"] == "{":
                hidden[-1] = True
            text = m["symbol"] if m["symbol"] in ("{", "}", "\\") else ""
        else:
            stands = before is not None and before["word"] == "u" and before["n"]  # one character that stands for the one before, for old readers
            text = re.sub("[\r\n]", "", m["text"][1 if stands else 0 :])
        out.append("" if hidden[-1] else text)
    return re.sub(r"[ \t]+", " ", "".join(out)).strip()


def doc_text(blob: bytes, window: int = 200, step: int = 100, least: int = 30) -> str:
    """S-28: what can be read of an old word file, from its citation head to where letters grow rare."""
    text = "".join(" " if c == "\0" or (ord(c) < 32 and c not in "\n\r\t") else c for c in blob.decode("cp1252", "ignore"))
    if m := re.search(r"\d{2}-\d{2,3}\s+[A-Z][A-Z ,&'\-/()]+", text):
        text = text[m.start() :]
    cut = next((i for i in range(0, max(0, len(text) - window + 1), step) if sum(map(str.isalpha, text[i : i + window])) < least), len(text))
    text = re.sub(r" *\n *", "\n", re.sub(r"[ \t]{2,}", "  ", text[:cut].rstrip()))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


def tree(xml: str) -> ElementTree.Element | None:
    """The root of a document, null if it is not well formed."""
    try:
        return ElementTree.fromstring(xml)
    except ElementTree.ParseError:
        return None


def rendered(xml: str) -> str | None:
    """T-12: paragraphs of nested divs, each with the identifiers of its containers before it; history last; null without a tree."""
    if (root := tree(xml)) is None:
        return None
    paragraphs: list[str] = []
    history: list[str] = []
    text = lambda el: re.sub(r"\s+", " ", "".join(el.itertext())).strip()

    def walk(el, stack: list[str]) -> None:  # noqa: ANN001
        kind = el.get("class", "")
        if el.tag == "div" and kind == "history":
            history.extend([text(el)] if text(el) else [])
        elif el.tag == "div" and kind == "heading":
            return
        elif el.tag == "p":
            if text(el):
                paragraphs.append("".join(f"({i}) " for i in stack) + text(el))
        else:
            heading = el.find("div[@class='heading']")
            own = [re.sub(r"[().]", "", text(heading).split(" ")[0])] if heading is not None and text(heading) else []
            for child in el:
                walk(child, stack + own)

    walk(root, [])
    return "\n".join(paragraphs + history)


def udf_of(function, kind: str = "string"):  # noqa: ANN001, ANN201
    """A function of one string or binary as an Arrow UDF; null stays null."""

    @F.pandas_udf(kind)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: None if v is None else function(v))

    return run


@F.pandas_udf(T.StructType([T.StructField("text", T.StringType()), T.StructField("unknown", T.ArrayType(T.StringType()))]))
def caml(values: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([caml_text(v) if v is not None else (None, None) for v in values], columns=["text", "unknown"])


def rtf_sections(docs: DataFrame, doc: str, rtf: str, styles: dict[int, str]) -> DataFrame:
    """S-21: (doc, title, section, text) of a style-driven document: chunks between \\pard, titles carried forward."""
    from lexmill.operators.rows import forward_fill, islands

    kind = F.create_map(*[F.lit(x) for pair in styles.items() for x in pair])
    rows = docs.select(doc, F.posexplode(F.split(F.col(rtf), r"\\pard")).alias("pos", "chunk"))
    rows = rows.withColumn("kind", kind[F.regexp_extract("chunk", r"^\s*(?:\\plain)?\s*\\s(\d+)\b", 1).try_cast("int")]).withColumn("plain", udf_of(rtf_text)(F.col("chunk")))
    rows = forward_fill(rows.withColumn("t", F.when(F.col("kind") == "title", F.col("plain"))), [doc], "pos", "t", "title")
    rows = islands(rows, [doc], "pos", F.coalesce(F.col("kind") == "section", F.lit(False))).where("island > 0 and coalesce(kind, '') <> 'title' and plain <> ''")
    parts = F.sort_array(F.collect_list(F.struct("pos", "plain", "title")))
    rows = rows.groupBy(doc, "island").agg(parts.alias("p"))
    return rows.select(doc, F.get("p", F.lit(0))["title"].alias("title"), F.get("p", F.lit(0))["plain"].alias("section"), F.array_join(F.transform(F.slice("p", F.lit(2), F.size("p")), lambda x: x["plain"]), "\n").alias("text"))
