"""Main text of web pages: a chain model over the leaf blocks of a page, with features of their ancestors and their text."""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acreage.llm.common import slices, whole_text
from acreage.llm.crf import Chain, train

HTML_BYTES = 8 << 20
#: Labelled pages that the model is trained on; they are made from layouts, so the number bounds the training.
TRAINING_PAGES = 240

# Elements that start a block, that have no end, and whose content is no text.
BLOCK = frozenset(
    "address article aside blockquote body button caption dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section select summary table tbody "
    "td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template textarea svg math iframe object canvas audio video".split())
#: What an opening element ends if it is still open, so far as no element of the second set lies between.
ENDS = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt", ("dl",)), "dd": ("dd", ("dl",)), "tr": ("tr", ("table",)), "td": ("td", ("tr",)), "th": ("th", ("tr",)), "option": ("option", ("select",))}
_TOKEN = re.compile(r"[a-z]+")


@dataclass(slots=True)
class Block:
    text: str
    tag: str  # of the element around it
    within: frozenset[str]  # features of all elements around it: their tags and the words of their class, id and role
    linked: int  # characters inside links


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, frozenset[str]]] = []
        self.count: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.linked = self.links = 0
        self.silent = 0

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.blocks.append(Block(text, *(self.open[-1] if self.open else ("", frozenset())), self.linked))
            self.parts, self.linked = [], 0

    def _pop(self, at: int) -> None:
        for tag, _ in self.open[at:]:
            self.count[tag] -= 1
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[at:]

    def _end_open(self, tag: str, fence: tuple[str, ...] = ()) -> None:
        for i in range(len(self.open) - 1, -1, -1) if self.count[tag] else ():
            if self.open[i][0] == tag:
                return self._pop(i)
            if self.open[i][0] in fence:
                return

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
            self._end_open("p", ("table", "td", "th", "button"))
            if tag in ENDS:
                self._end_open(*ENDS[tag])
        elif tag == "br":
            self.parts.append(" ")
        if tag not in VOID:
            own = {f"in:{tag}", *(f"is:{w}" for k, v in attrs if k in ("class", "id", "role") and v for w in _TOKEN.findall(v.lower()))}
            around = self.open[-1][1] if self.open else frozenset()
            self.open.append((tag, around if own <= around else around | own))
            self.count[tag] += 1
            self.silent += tag in SILENT
            self.links += tag == "a"

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in SILENT and self.open and self.open[-1][0] == tag:
            self._pop(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        self._end_open(tag)

    def handle_data(self, data):
        if not self.silent:
            self.parts.append(data)
            if self.links:
                self.linked += len(data.strip())


def blocks(html: str) -> list[Block]:
    """Leaf blocks in page order, character references decoded and white space made single. Broken markup is read on."""
    reader = _Reader()
    reader.feed(html)
    reader.close()
    reader.flush()
    return reader.blocks


def _bin(n: float, *edges: float) -> int:
    return sum(n >= e for e in edges)


def features(page: list[Block]) -> list[list[str]]:
    """Names of what holds for each block; neighbours are left to the chain."""
    out = []
    for i, b in enumerate(page):
        words = b.text.count(" ") + 1
        share = b.linked / len(b.text)
        seen = b.within | {
            "all",
            f"words:{_bin(words, 2, 5, 10, 20, 40)}",
            f"links:{_bin(share, 0.01, 0.3, 0.7)}",
            f"commas:{_bin(b.text.count(','), 1, 3)}",
            f"tag:{b.tag}",
            f"place:{0 if i == 0 else 2 if i == len(page) - 1 else 1}",
        }
        more = {"stops"} if b.text[-1] in ".!?…:" else set()
        if "©" in b.text or "(c)" in b.text:
            more.add("rights")
        out.append(sorted(seen | more))
    return out


# --- labelled pages --------------------------------------------------------------------------------------------------

# Names that layouts give to parts that are not the article, and to the article itself.
SIDE = {
    "nav": "nav menu navbar navigation breadcrumb topnav".split(),
    "header": "header masthead banner branding".split(),
    "footer": "footer copyright colophon legal".split(),
    "aside": "sidebar aside related widget recommended".split(),
    "div": "ad ads advert sponsor promo cookie notice alert consent popup newsletter share social comments comment replies subscribe pagination".split(),
    "section": "comments comment related newsletter".split(),
    "form": "search login subscribe signup".split(),
}
BODY = "content article post entry story main text body".split()


def labelled_pages(n: int = TRAINING_PAGES, seed: int = 0) -> list[tuple[str, list[str]]]:
    """Pages made from random layouts, each with the blocks of its article in order."""
    r = random.Random(seed)
    letters = "abcdefghilmnoprstuv"
    number = iter(range(1, 10**9))

    def words(k: int) -> str:
        # A number in each stretch keeps the blocks of all pages apart.
        return " ".join(["".join(r.choices(letters, k=r.randint(2, 8))) for _ in range(max(0, k - 1))] + [f"x{next(number)}"])

    def prose() -> str:
        return ". ".join((", " if r.random() < 0.5 else " ").join([words(r.randint(1, 9)), words(r.randint(1, 9))]).capitalize() for _ in range(r.randint(1, 6))) + r.choice(["...", ".", ".", "!", "?", ""])[-1:]

    def side(kind: str) -> str:
        name = r.choice(SIDE[kind])
        tag = kind if r.random() < 0.6 else "div"
        mark = r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {name}-box"', ""] if tag == kind and kind != "div" and kind != "section" else [f' class="{name}"', f' id="{name}"'])
        if kind == "nav" or r.random() < 0.3:
            inner = "<ul>" + "".join(f'<li><a href="#">{words(r.randint(1, 3))}</a></li>' for _ in range(r.randint(2, 6))) + "</ul>"
        elif kind == "form":
            inner = f"<label>{words(2)}</label><input><button>{words(1)}</button>"
        elif kind == "footer":
            inner = r.choice([f"&copy; {words(3)} &middot; {prose()}", f"<p>&copy; {words(4)}</p><p>{prose()}</p>", f"{words(3)}"])
        else:
            inner = r.choice([prose(), f"<p>{prose()}</p>", f"<h3>{words(2)}</h3><p>{prose()}</p>", f"<p>{prose()}</p><p>{prose()}</p>", f"<div><p>{prose()}</p></div>"])
        return f"<{tag}{mark}>{inner}</{tag}>"

    pages = []
    for _ in range(n):
        kept: list[str] = []

        def keep(text: str) -> str:
            kept.append(text)
            return text

        parts = [f"<h1>{keep(words(r.randint(2, 9)))}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.randint(1, 9)):
            t = r.random()
            if t < 0.7:
                parts.append(r.choice(["<p>{}</p>", "<p><b>{}<br>", "<p>{}", "<div>{}</div>", "<blockquote>{}</blockquote>"]).format(keep(prose())))
            elif t < 0.8:
                parts.append(f"<h2>{keep(words(r.randint(1, 5)))}</h2>")
            elif t < 0.9:
                parts.append("<ul>" + "".join(f"<li>{keep(words(r.randint(2, 12)))}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            elif r.random() < 0.4:
                parts.append(side(r.choice(["aside", "div"])))
            else:
                parts.append(f"<p>{keep(words(r.randint(1, 4)) + '.')}</p>")
        tag = r.choice(["article", "article", "article", "main", "div", "section"])
        mark = f' class="{r.choice(BODY)}"' if tag in ("div", "section") or r.random() < 0.3 else ""
        article = f"<{tag}{mark}>{''.join(parts)}</{tag}>"
        before = [side(r.choice(["nav", "header", "div", "form", "aside"])) for _ in range(r.randint(0, 3))]
        after = [side(r.choice(["aside", "div", "section", "form", "nav", "div"])) for _ in range(r.randint(0, 3))]
        footer = [side("footer")] if r.random() < 0.8 else []
        title = f"<title>{words(r.randint(1, 6))}</title>"
        pages.append((f"<!DOCTYPE html><html><head>{title}<style>p{{}}</style><script>var t='</p>';</script></head><body>{''.join([*before, article, *after, *footer])}" + r.choice(["</body></html>", ""]), kept))
    return pages


def labels(page: list[Block], kept: list[str]) -> list[int]:
    """1 for blocks whose text is the next of the kept ones."""
    rest, out = list(kept), []
    for b in page:
        hit = bool(rest) and b.text == rest[0]
        out.append(int(hit))
        if hit:
            rest.pop(0)
    return out


@cache
def default_model() -> Chain:
    made = [(blocks(h), kept) for h, kept in labelled_pages()]
    return train([(features(p), labels(p, kept)) for p, kept in made])


# --- the operator -----------------------------------------------------------------------------------------------------


def main_text(html: str, model: Chain) -> str:
    page = blocks(html)
    return "\n\n".join(b.text for b, keep in zip(page, model.decode(features(page))) if keep)


def extract(pages: DataFrame, html: str = "html", model: Chain | None = None) -> DataFrame:
    """``pages`` without ``html``, with ``text`` (the main text, empty if there is none) and ``n_chars``.

    A null page is empty. Pages stay where they are read; repeated rows are treated alike; an empty table gives none; input
    columns named text or n_chars are replaced. The model is trained on the driver from ``TRAINING_PAGES`` labelled pages and
    travels with the tasks.
    """
    model = model or default_model()
    own = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in (html, "text", "n_chars")], whole_text(html).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in slices(b, "_html", HTML_BYTES):
                part = b.slice(i, j - i)
                texts = [main_text(h, model) for h in part.column("_html").to_pylist()]
                made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=[*b.schema.names[:-1], "text", "n_chars"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1]]
    return own.mapInArrow(run, ", ".join([*fields, "text string", "n_chars bigint"]))
