"""Clean text and structure out of HTML, wikitext, Markdown and LaTeX, in any mixture within one body.

One pass per distinct body: regions a reader never sees as prose (comments, scripts, tables, captions, templates,
references) are removed, code and formulas are set aside, then HTML lists and headings are read from the tag stream and
the remaining lines by their wiki, Markdown or LaTeX markers. Each text node is counted under its root-to-leaf tag
path. Over the whole corpus the text length and punctuation of each path are aggregated, smoothed along the tree and
fused into one score; elements of every kind survive if their path scores as content.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexforge.operators.delivery import distinct_by, has_positions
from lexforge.session import broadcast_if_small, materialize

_OPEN, _SHUT, _LITERAL, _AT = "\ue000", "\ue001", "\ue002", "\ue003"

_PROTECT = re.compile(
    r"""
    (?P<drop><!--.*?(?:-->|\Z)|<(?P<h>script|style|table|figure|figcaption|template|noscript|iframe|svg|gallery|caption)\b[^<>]*>.*?</(?P=h)\s*>
        |<ref\b[^<>]*/>|<ref\b[^<>]*>.*?</ref\s*>|<sup\b[^<>]*\breference\b[^<>]*>.*?</sup\s*>
        |<span\b[^<>]*(?:mw-editsection|display:\s*none)[^<>]*>.*?</span\s*>
        |\\footnote\{[^{}]*\}|\[\^[^\]\s]+\](?::[^\n]*)?
        |\\begin\{(?P<e>table|tabular|figure)\*?\}.*?\\end\{(?P=e)\*?\}|\\caption\{[^{}]*\}
        |^\{\|.*?^\|\}
        |\[\[\s*(?:File|Image|Category|ファイル|画像|カテゴリ|Datei|Bild|Kategorie|Fichier|Catégorie|Archivo|Categoría)\s*:(?:[^\[\]]|\[\[[^\[\]]*\]\]|\[[^\[\]]*\])*\]\])
    |<pre\b[^<>]*>(?P<pre>.*?)</pre\s*>
    |<(?P<s>syntaxhighlight|source)\b[^<>]*>(?P<raw>.*?)</(?P=s)\s*>
    |^(?P<fence>```+|~~~+)[^\n`]*\n(?P<fenced>.*?)(?:^(?P=fence)[ \t]*$|\Z)
    |\\begin\{(?P<v>verbatim|lstlisting|minted|Verbatim)\*?\}(?:\[[^\]\n]*\])?(?P<verb>.*?)\\end\{(?P=v)\*?\}
    |<nowiki>(?P<nowiki>.*?)</nowiki\s*>
    |<math\b(?P<matt>[^<>]*)>(?P<math>.*?)</math\s*>
    |<img\b(?=[^<>]*\bmath)[^<>]*?\balt=(?P<quote>["'])(?P<alt>.*?)(?P=quote)[^<>]*>
    |\$\$(?P<dd>[^$]+?)\$\$
    |\\\[(?P<br>.+?)\\\]
    |\\\((?P<pa>.+?)\\\)
    |\\begin\{(?P<q>equation|align|gather|displaymath|math|multline|eqnarray)\*?\}(?P<eq>.*?)\\end\{(?P=q)\*?\}
    |(?<![\\$])\$(?=[^\s$])(?P<d>[^$\n]*?[^\s$\\])\$(?![\d$])
    |(?<!`)`(?P<tick>[^`\n]+)`(?!`)
    |(?P<indent>(?:(?<=\n\n)|\A)(?:[ \t]+[^\s][^\n]*(?:\n|\Z))+)
    """,
    re.S | re.M | re.X | re.I,
)

_BRACES = re.compile(r"\{\{|\}\}")
_HTML_HEADING = re.compile(r"<h([1-6])\b[^<>]*>(.*?)</h\1\s*>", re.S | re.I)
_LIST_TAG = re.compile(r"<(/?)(ul|ol|li|dl|dt|dd)\b[^<>]*>", re.I)
_CONTAINER = re.compile(r"<(/?)(div|section|article|main|nav|header|footer|aside|form)\b([^<>]*)>", re.I)
_CLASS = re.compile(r"""\bclass=["']?\s*([\w-]+)""", re.I)
# Containers that only wrap what stands in them.
_WRAPPERS = ("mw-highlight", "mw-parser-output", "mw-heading", "mw-body-content")
_BLOCK_TAG = re.compile(r"</?(?:p|body|html|head|blockquote|center|hr)\b[^<>]*>|<!DOCTYPE[^<>]*>", re.I)
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_BR = re.compile(r"<br\b[^<>]*>", re.I)
_CODE_TAG = re.compile(r"</?(?:code|span|b|i|em|strong|a|tt|kbd|samp|div|font|u|s|sub|sup|mark|br)\b(?:\s[^<>]*)?/?>", re.I)
_ANNOTATION = re.compile(r"<annotation\b[^<>]*x-tex[^<>]*>(.*?)</annotation\s*>", re.S | re.I)
_ALTTEXT = re.compile(r"""\balttext=(["'])(.*?)\1""", re.I | re.S)
_HELD = re.compile(f"{_OPEN}(\\d+){_SHUT}")
_MOVED = re.compile(f"{_AT}(\\d+){_SHUT}")
_ESCAPED = re.compile(r"\s*&lt;[!/A-Za-z]")
_ESCAPED_TAG = re.compile(r"&lt;[!/A-Za-z]")
_REAL_TAG = re.compile(r"<[!/A-Za-z]")

_WIKI_HEADING = re.compile(r"^(={1,6})[ \t]*(\S.*?)[ \t]*\1[ \t]*$")
_MD_HEADING = re.compile(r"^ {0,3}(#{1,6})[ \t]+(\S.*?)(?:[ \t]+#+)?[ \t]*$")
_TEX_HEADING = re.compile(r"^[ \t]*\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?\{(.*)\}[ \t]*(?:\\label\{[^{}]*\})?[ \t]*$")
_UNDERLINE = re.compile(r"^ {0,3}(?:={3,}|-{3,})[ \t]*$")
_WIKI_ITEM = re.compile(r"^([*#:;]+)[ \t]*(.*)$")
_MD_ITEM = re.compile(r"^[ \t]*(?:[-*+]|\d{1,3}[.)])[ \t]+(\S.*)$")
_TEX_ITEM = re.compile(r"^[ \t]*\\item(?:\[[^\]]*\])?[ \t]*(.*)$")
_TEX_ENV = re.compile(r"^[ \t]*\\(begin|end)\{(itemize|enumerate|description)\*?\}(?:\[[^\]\n]*\])?[ \t]*$")
_STARRED_START = re.compile(r"^(\*{1,2})(?!\s|\*)[^*]*[^\s*]\1")

_CLEAN = (
    (re.compile(r"!\[[^\]\n]*\]\([^()\s]*\)"), ""),
    (re.compile(r"\[\[(?:[^\[\]|]*\|)?([^\[\]|]*)\]\]"), r"\1"),
    (re.compile(r"\[(?:https?:|mailto:)?//\S+[ \t]+([^\[\]]*)\]"), r"\1"),
    (re.compile(r"\[(?:https?:)?//\S+?\]"), ""),
    (re.compile(r"\[([^\[\]\n]+)\]\((?:[^()\s]|\([^()\s]*\))*(?:\s+\"[^\"]*\")?\)"), r"\1"),
    (re.compile(r"'{2,5}"), ""),
)
_TEX_LINK = re.compile(r"\\href\{[^{}]*\}\{([^{}]*)\}")
_TEX_STYLE = re.compile(r"\\(?:text(?:bf|it|tt|sc|rm|sf|sl|up)|emph|underline|mbox|uline)\{([^{}]*)\}")
_TEX_NOTE = re.compile(r"\\(?:label|cite|ref|footnote)\{[^{}]*\}")
_TEX_SIGN = re.compile(r"\\([&%_#${}])")
_MD_STYLE = (
    (re.compile(r"\*\*(?=\S)((?:[^*]|\*(?!\*))+?)(?<=\S)\*\*"), r"\1"),
    (re.compile(r"(?<![A-Za-z0-9])__(?=\S)((?:[^_]|_(?!_))+?)(?<=\S)__(?![A-Za-z0-9])"), r"\1"),
    (re.compile(r"\*(?=[^\s*])([^*\n]*?)(?<=[^\s*])\*"), r"\1"),
    (re.compile(r"(?<!\w)_(?=[^\s_])([^_\n]*?)(?<=[^\s_])_(?!\w)"), r"\1"),
    (re.compile(r"~~(?=\S)((?:[^~]|~(?!~))+?)(?<=\S)~~"), r"\1"),
)
_MD_ESCAPE = re.compile(r"\\([\\`*_{}\[\]()#+\-.!|<>~])")


# Where a pattern may begin, and the closers it would look for. A pattern is tried only where a closer of its kind follows,
# so an opener that nothing closes is not searched to the end of the text, and the time stays in proportion to the length.
_TAGS = "script|style|table|figure|figcaption|template|noscript|iframe|svg|gallery|caption|ref|sup|span|pre|syntaxhighlight|source|nowiki|math|h[1-6]"
_ENVS = "table|tabular|figure|verbatim|lstlisting|minted|equation|align|gather|displaymath|math|multline|eqnarray"
_START = re.compile(
    rf"<(?P<tag>(?!h[1-6]){_TAGS})\b|\\begin\{{(?P<env>{_ENVS})\*?\}}|\\(?P<sign>[\[(])|^(?P<bar>\{{\|)|<!--|<img\b|\\footnote|\\caption|\[\^|\[\[|^(?:```|~~~)|[$`]|(?:(?<=\n\n)|\A)[ \t]",
    re.M | re.I,
)
_HEADING_START = re.compile(r"<(?P<tag>h[1-6])\b", re.I)
_CLOSER = re.compile(rf"</(?P<tag>{_TAGS})\s*>|\\end\{{(?P<env>{_ENVS})\*?\}}|\\(?P<sign>[\])])|^(?P<bar>\|\}})", re.M | re.I)
_CLOSES = {"]": "[", ")": "(", "|}": "{|"}
_REF = re.compile(r"<ref\b[^<>]*/>", re.I)


def _kind(m: re.Match) -> tuple[str, str] | None:
    """Which opener or closer matched; an opener and its closers have the same kind."""
    what = m.lastgroup
    return what and (what, _CLOSES.get(m[what], m[what].casefold()))


def _sub_closed(pattern: re.Pattern, start: re.Pattern, to: Callable[[re.Match], str], text: str) -> str:
    """``pattern.sub(to, text)`` for a pattern that matches only where ``start`` does, in time proportional to the text."""
    out: list[str] = []
    last: dict | None = None
    done = at = 0
    while s := start.search(text, at):
        here = s.start()
        kind = _kind(s)
        if kind and last is None:
            last = {_kind(m): m.start() for m in _CLOSER.finditer(text)}
        if kind is None or last.get(kind, -1) > here:
            m = pattern.match(text, here)
        else:
            # a reference may close itself
            m = pattern.match(text, here) if kind == ("tag", "ref") and _REF.match(text, here) else None
        if m:
            out += text[done:here], to(m)
            done = at = m.end()
        else:
            at = here + 1
    return "".join(out) + text[done:] if out else text


def _without_templates(text: str) -> str:
    """Text without closed templates, however deep they are nested, in one pass; braces that nothing closes stay."""
    opened: list[int] = []
    spans: list[tuple[int, int]] = []
    for m in _BRACES.finditer(text):
        if m[0] == "{{":
            opened.append(m.start())
        elif opened:
            start = opened.pop()
            while spans and spans[-1][0] > start:
                spans.pop()
            spans.append((start, m.end()))
    if not spans:
        return text
    edges = [0, *(x for span in spans for x in span), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


class _Body:
    """Parser state of one body."""

    def __init__(self, text: str):
        self.held: list[tuple[str, str]] = []
        self.elements: list[tuple[str, str, str]] = []  # kind, content, path of the container
        self.emitted: set[int] = set()
        self.containers = ["/body"]
        self.paths: Counter[str] = Counter()
        self.marks: Counter[str] = Counter()
        self.nodes: Counter[str] = Counter()
        self.lines: list[str] = []
        if _ESCAPED.match(text) and len(_ESCAPED_TAG.findall(text)) > len(_REAL_TAG.findall(text)):
            text = html.unescape(text)  # the whole page was escaped once more than it should be
        text = text.replace("\r\n", "\n").replace("\r", "\n")
        for mark in (_OPEN, _SHUT, _LITERAL, _AT):
            text = text.replace(mark, "")
        self.container = "/body"
        text = _sub_closed(_PROTECT, _START, self.protect, text)
        text = _without_templates(text)
        self.open: list[tuple[str, str]] = []
        text = _CONTAINER.sub(self.enter, text)
        text = _sub_closed(_HTML_HEADING, _HEADING_START, self.html_heading, text)
        text = self.html_lists(text)
        text = _BLOCK_TAG.sub(lambda m: "\n\n" + (_LITERAL + "P " if m[0][1:2] in "pP" and m[0][2:3] in "> \n\t" else ""), text)
        self.scan(text.split("\n"))

    def count(self, path: str, text: str) -> None:
        if text:
            self.paths[path] += len(text)
            self.marks[path] += sum(text.count(c) for c in ".,;:!?、。，；：！？")
            self.nodes[path] += 1

    def hold(self, kind: str, text: str) -> str:
        self.held.append((kind, text))
        return f"{_OPEN}{len(self.held) - 1}{_SHUT}"

    def emit(self, kind: str, text: str) -> None:
        """``text`` is free of markup already."""
        content = " ".join(text.split())
        if content:
            self.elements.append((kind, content, self.container))
            self.count(f"{self.container}/{kind}", content)

    def enter(self, m: re.Match) -> str:
        """Mark where a container begins or ends; its path is its ancestors' names with their first class."""
        tag = m[2].lower()
        if not m[1]:
            found = _CLASS.search(m[3])
            name = f"/{tag}.{found[1]}" if found else f"/{tag}"
            self.open.append((tag, "" if found and found[1] in _WRAPPERS else name))
        elif any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass
        path = "/body" + "".join(name for _, name in self.open)
        if path != self.containers[-1]:
            self.containers.append(path)
        return f"\n\n{_AT}{len(self.containers) - 1}{_SHUT}\n\n"

    def formula(self, tex: str) -> str:
        return self.hold("formula", tex.strip())

    def code(self, text: str) -> str:
        return f"\n\n{self.hold('code', text)}\n\n"

    def found_in(self, line: str) -> None:
        """Emit the formulas and code blocks set aside in a line, each once, under the container the line is in."""
        for m in _HELD.finditer(line):
            kind, text = self.held[int(m[1])]
            if kind != "text" and int(m[1]) not in self.emitted:
                self.emitted.add(int(m[1]))
                self.emit(kind, text)

    def protect(self, m: re.Match) -> str:
        g = m.groupdict()
        if g["drop"] is not None:
            what = m[0]
            return "" if what[:2] == "<!" or what[:4].lower() in ("<ref", "<sup", "<spa") or what[0] in "\\[" else "\n\n"
        if g["pre"] is not None:
            return self.code(html.unescape(_CODE_TAG.sub("", g["pre"])))
        if g["raw"] is not None:
            return self.code(html.unescape(g["raw"]))
        if g["fenced"] is not None:
            return self.code(g["fenced"])
        if g["verb"] is not None:
            return self.code(g["verb"])
        if g["nowiki"] is not None:
            return self.hold("text", html.unescape(g["nowiki"]))
        if g["math"] is not None:
            inner = g["math"]
            if a := _ANNOTATION.search(inner):
                return self.formula(html.unescape(a[1]))
            if a := _ALTTEXT.search(g["matt"]):
                return self.formula(html.unescape(a[2]))
            return self.formula(html.unescape(inner)) if not re.search(r"</?m[a-z]+\b", inner) else ""
        if g["alt"] is not None:
            return self.formula(html.unescape(g["alt"]))
        for name in ("dd", "br", "pa", "eq", "d"):
            if g[name] is not None:
                return self.formula(html.unescape(g[name]))
        if g["tick"] is not None:
            return self.hold("text", g["tick"])
        lines = [x.strip() for x in m[0].split("\n") if x.strip()]
        # an indented run of markup or held parts is no preformatted text
        if lines[0][0] in f"<{_OPEN}|":
            return m[0]
        return self.code("\n".join(lines))

    def clean(self, text: str) -> str:
        """What a reader sees of inline markup."""
        text = _TAG.sub("", _BR.sub(" ", text))
        if "\\" in text:
            text = _TEX_NOTE.sub("", text)
            for _ in range(4):
                grown = _TEX_STYLE.sub(r"\1", _TEX_LINK.sub(r"\1", text))
                if grown == text:
                    break
                text = grown
            text = _TEX_SIGN.sub(lambda m: self.hold("text", m[1]), text)
            text = _MD_ESCAPE.sub(lambda m: self.hold("text", m[1]), text)
        if "[" in text or "''" in text:
            for pattern, to in _CLEAN:
                text = pattern.sub(to, text)
        if "*" in text or "_" in text or "~~" in text:
            for pattern, to in _MD_STYLE:
                text = pattern.sub(to, text)
        return html.unescape(_MOVED.sub(" ", text)).replace(_LITERAL, "")

    def restore(self, text: str) -> str:
        """Literal texts and formulas back in their places; a code block inside a line is a blank there."""
        return _HELD.sub(lambda m: self.held[int(m[1])][1] if self.held[int(m[1])][0] != "code" else " ", text)

    def shown(self, text: str) -> str:
        return self.restore(self.clean(text))

    def html_heading(self, m: re.Match) -> str:
        return f"\n\n{_LITERAL}H{m[1]} {' '.join(self.clean(m[2]).split())}\n\n"

    def html_lists(self, text: str) -> str:
        """Emit the items of HTML lists; what stands outside of them is returned."""
        out: list[str] = []
        stack: list[dict] = []
        at = 0
        for m in _LIST_TAG.finditer(text):
            piece, at = text[at : m.start()], m.end()
            self._text(stack, piece, out)
            shut, tag = m[1] == "/", m[2].lower()
            if not shut:
                if tag in ("ul", "ol", "dl"):
                    stack.append({"tag": tag, "item": None})
                else:
                    if not stack:
                        stack.append({"tag": "ul" if tag == "li" else "dl", "item": None})
                    self._close(stack[-1], out)
                    stack[-1]["item"] = [tag, []]
            elif stack:
                if tag in ("ul", "ol", "dl"):
                    self._close(stack.pop(), out)
                else:
                    self._close(stack[-1], out)
        self._text(stack, text[at:], out)
        while stack:
            self._close(stack.pop(), out)
        return "".join(out)

    def _text(self, stack: list[dict], piece: str, out: list[str]) -> None:
        if not stack:
            out.append(piece)
        elif stack[-1]["item"] is not None:
            stack[-1]["item"][1].append(piece)

    def _close(self, level: dict, out: list[str]) -> None:
        if level["item"] is not None:
            tag, pieces = level["item"]
            text = self.clean(" ".join(pieces) if len(pieces) > 1 else pieces[0] if pieces else "")
            out.append(f"\n\n{_LITERAL}{'L ' if tag == 'li' else 'P '}{' '.join(text.split())}\n\n")
            level["item"] = None

    def scan(self, lines: list[str]) -> None:
        """Headings and items of line-oriented notations; every other line is prose."""
        envs: list[str] = []
        n = len(lines)
        k = 0
        before = ""  # kind of the line before, '' after a blank one
        while k < n:
            line = lines[k]
            k += 1
            bare = line.strip()
            if not bare:
                before = ""
                continue
            if bare[0] == _AT:
                if m := _MOVED.fullmatch(bare):
                    self.container = self.containers[int(m[1])]
                    before = ""
                    continue
            self.found_in(bare)
            if bare[0] == _LITERAL:
                # a heading, item or paragraph that HTML tags marked; its inline markup is resolved for the first two
                kind, _, rest = bare[1:].partition(" ")
                if kind[:1] == "H":
                    text = self.restore(rest)
                    self.emit("heading", text)
                    self.lines.append("#" * int(kind[1]) + " " + " ".join(text.split()))
                elif kind == "L":
                    text = self.restore(rest)
                    self.emit("list_item", text)
                    self.lines.append("- " + " ".join(text.split()))
                else:
                    text = self.shown(rest)
                    self.lines.append(text)
                    self.count(f"{self.container}/p", text)
                before = "p"
                continue
            if (c := bare[0]) == "|" and bare.count("|") > 1:
                before = "table"
                continue
            heading = item = None
            if c == "=" and (m := _WIKI_HEADING.match(bare)):
                heading = m[2]
            elif c == "\\":
                if m := _TEX_ENV.match(line):
                    envs.append(m[2]) if m[1] == "begin" else envs and envs.pop()
                    continue
                if m := _TEX_HEADING.match(line):
                    heading = m[1]
                elif m := _TEX_ITEM.match(line):
                    item = m[1] if not envs or envs[-1] != "description" else None
                    if item is None:
                        continue
            elif c in "*#:;-+0123456789":
                nxt = lines[k].strip() if k < n else ""
                if c == "#" and (m := _MD_HEADING.match(line)) and before != "item" and not nxt.startswith(("#", "*")) and (len(m[1]) > 1 or not nxt):
                    heading = m[2]
                elif (m := _MD_ITEM.match(line)) and not (c == "*" and line.startswith("**")):
                    item = m[1]
                elif c in "*#:;" and line[0] == c and (m := _WIKI_ITEM.match(line)) and not (c == "*" and before != "item" and _STARRED_START.match(line)):
                    if m[1][-1] in "*#":
                        item = m[2]
                    else:
                        text = self.shown(m[2])
                        self.lines.append(text)
                        self.count(f"{self.container}/dl", text)
                        before = "dl"
                        continue
            if heading is None and item is None and before == "" and k < n and c not in "<" and _UNDERLINE.match(lines[k]) and (k + 1 >= n or not lines[k + 1].strip()):
                heading = bare
                k += 1
            if heading is not None:
                text = self.shown(heading)
                self.emit("heading", text)
                self.lines.append("## " + " ".join(text.split()))
                before = ""
            elif item is not None:
                text = self.shown(item)
                self.emit("list_item", text)
                self.lines.append("- " + " ".join(text.split()))
                before = "item"
            else:
                text = self.shown(bare)
                held = _HELD.fullmatch(bare)
                if held and self.held[int(held[1])][0] == "code":
                    self.lines.append("```\n" + self.held[int(held[1])][1].strip("\n") + "\n```")
                else:
                    self.lines.append(text)
                    self.count(f"{self.container}/p", text)
                before = "p"


def parse(body: str) -> _Body:
    """Structure, clean lines and tag-path counts of one body."""
    return _Body(body)


def clean_text(body: str | None) -> str | None:
    """Clean text with headings as ``#`` lines, items as ``- `` lines, code in fences and formulas as TeX; null for null."""
    return None if body is None else "\n".join(x for x in (line.strip() for line in parse(body).lines) if x)


#: Share of the score of the corpus's median prose node below which a path holds no content.
THRESHOLD = 0.1
#: Weight of a path's container in smoothing, and nodes that a container's parent counts for beside its own.
CONTAINER_WEIGHT = 0.5
PARENT_NODES = 10

_PARSED = "elements array<struct<kind:string,content:string,container:string>>, paths array<struct<path:string,chars:bigint,marks:bigint,nodes:bigint>>, text string"


def parse_bodies(bodies: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """(keys, elements, paths, text) of each row; a null body gives empty lists and a null text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            elements, paths, texts = [], [], []
            for b in pdf[body]:
                if b is None:
                    elements.append([])
                    paths.append([])
                    texts.append(None)
                    continue
                p = parse(b)
                elements.append([{"kind": k, "content": c, "container": at} for k, c, at in dict.fromkeys(p.elements)])
                paths.append([{"path": k, "chars": v, "marks": p.marks[k], "nodes": p.nodes[k]} for k, v in p.paths.items()])
                texts.append("\n".join(x for x in (line.strip() for line in p.lines) if x))
            out = {k: pdf[k] for k in keys}
            yield pd.DataFrame(out | {"elements": elements, "paths": paths, "text": texts})

    types = dict(bodies.dtypes)
    return bodies.select(*keys, body).mapInPandas(run, ", ".join([*(f"`{k}` {types[k]}" for k in keys), _PARSED]))


def leaf_scores(parsed: DataFrame) -> DataFrame:
    """(path, container, chars, marks, nodes, score, is_content): tag-path ratios of the whole corpus.

    Text ratio (characters per node) and punctuation ratio (marks per node) are aggregated for each root-to-leaf path.
    Both are smoothed along the tree: a leaf path with its container, which stands for its richest leaf, and a container
    with its parent's prose, the more the fewer nodes it has itself. Text and punctuation are fused by their product. A
    path holds content if its score is not far below that of prose: the median over all prose nodes of the corpus, so
    that no path counts for more than the nodes it has. Regions that are not shown have no paths.
    """
    leaf = parsed.select(F.explode("paths").alias("p")).groupBy("p.path").agg(F.sum("p.chars").alias("chars"), F.sum("p.marks").alias("marks"), F.sum("p.nodes").alias("nodes"))
    leaf = leaf.select("path", F.regexp_replace("path", "/[^/]*$", "").alias("container"), "chars", "marks", "nodes", (F.col("chars") / F.col("nodes")).alias("tpr"), (F.col("marks") / F.col("nodes")).alias("ppr"), F.col("path").rlike("/(p|dl)$").alias("prose"))
    # every leaf counts for all containers above it
    steps = F.filter(F.split("container", "/"), lambda x: x != "")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.concat(F.lit("/"), F.array_join(F.slice(steps, F.lit(1), n), "/")))
    of = lambda c, only: F.sum(F.when(F.lit(True) if only is None else F.col("prose"), F.col(c)))
    tree = leaf.select(F.explode(above).alias("_above"), "chars", "marks", "nodes", "prose").groupBy("_above").agg(
        F.coalesce(of("chars", 1) / of("nodes", 1), of("chars", None) / of("nodes", None)).alias("atpr"), F.coalesce(of("marks", 1) / of("nodes", 1), of("marks", None) / of("nodes", None)).alias("appr")
    )
    parent = F.coalesce(F.nullif(F.regexp_replace("container", "/[^/]*$", ""), F.lit("")), F.col("container"))
    best = leaf.groupBy("container").agg(F.max_by(F.struct("tpr", "ppr"), F.struct(F.col("tpr") * F.col("ppr"), "tpr", "ppr")).alias("b"), F.sum("nodes").alias("n"))
    lean = lambda own, up: (F.col(own) * F.col("n") + F.col(up) * PARENT_NODES) / (F.col("n") + PARENT_NODES)
    held = best.select("container", parent.alias("_above"), "b", "n").join(tree, "_above").select("container", lean("b.tpr", "atpr").alias("ctpr"), lean("b.ppr", "appr").alias("cppr"))
    blend = lambda own, up: F.col(own) * (1 - CONTAINER_WEIGHT) + F.col(up) * CONTAINER_WEIGHT
    scored = leaf.join(held, "container").select("path", "container", "chars", "marks", "nodes", "prose", (blend("tpr", "ctpr") * blend("ppr", "cppr")).alias("score"))
    # one row per score and kind of path, sorted in one task; a corpus without prose is compared with all of its paths
    weights = scored.groupBy("prose", "score").agg(F.sum("nodes").alias("n"))
    ranked = weights.select("prose", "score", F.sum("n").over(Window.partitionBy("prose").orderBy("score")).alias("upto"), F.sum("n").over(Window.partitionBy("prose")).alias("all"))
    medians = {r["prose"]: r["median"] for r in ranked.filter("upto * 2 >= all").groupBy("prose").agg(F.min("score").alias("median")).collect()}
    usual = medians.get(True, medians.get(False, 0.0))
    return scored.select("path", "container", "chars", "marks", "nodes", "score", (F.col("score") >= usual * THRESHOLD).alias("is_content"))


def path_scores(parsed: DataFrame) -> DataFrame:
    """(container, score, is_content): of each container its best path, and whether any of its paths holds content."""
    return leaf_scores(parsed).groupBy("container").agg(F.max("score").alias("score"), F.max("is_content").alias("is_content"))


def distinct_bodies(bodies: DataFrame, body: str, keys: list[str]) -> DataFrame:
    """(keys, body): the distinct rows with a body, so that a page repeated in every snapshot is parsed once.

    Of a Parquet scan only the keys and 128 bits of hash of the body are shuffled; the bodies are read again where they
    lie. Other tables are reduced by a plain ``distinct``.
    """
    slim = bodies.select(*keys, body).filter(F.col(body).isNotNull())
    if not has_positions(slim):
        return slim.distinct()
    return distinct_by(slim, [*map(F.col, keys), F.xxhash64(body), F.xxhash64(F.lit(1), F.col(body))])


def parsed_bodies(bodies: list[DataFrame], body: str, keys: list[str]) -> DataFrame:
    """``parse_bodies`` of the distinct bodies of all tables, written to the shared folder as it is read twice."""
    parts = [parse_bodies(distinct_bodies(b, body, keys), body, keys).select(*keys, "elements", "paths") for b in bodies]
    return materialize(reduce(DataFrame.unionByName, parts), "parsed")


def structural_elements(bodies: DataFrame | list[DataFrame], body: str, keys: list[str]) -> DataFrame:
    """(keys, kind, content): distinct headings, list items, code blocks and formulas of the paths that hold content.

    ``bodies`` is one table or several with the same columns; rows without a body have no elements.
    """
    parsed = parsed_bodies(bodies if isinstance(bodies, list) else [bodies], body, keys)
    content = leaf_scores(parsed).filter("is_content").select(F.col("path").alias("_p"))
    elements = parsed.select(*keys, F.explode("elements").alias("e")).select(*keys, "e.kind", "e.content", F.concat_ws("/", "e.container", "e.kind").alias("_path"))
    # paths are few; if a corpus has very many, the join shuffles on them, spread by AQE
    placed = elements.join(broadcast_if_small(content), F.col("_path") == F.col("_p"), "left_semi")
    return placed.select(*keys, "kind", "content").distinct()


def article_bodies(articles: DataFrame, edges: DataFrame) -> list[DataFrame]:
    """(source_table, identifier, version_identifier, body) of the rows of each table that have all of them."""

    def part(df: DataFrame, name: str, body: Column) -> DataFrame:
        return df.select(F.lit(name).alias("source_table"), "identifier", F.col("version.identifier").alias("version_identifier"), body.alias("body"))

    both = part(articles, "normal_articles", F.col("article_body.html")), part(edges, "edge_case_articles", F.col("article_body.wikitext"))
    return [df.filter("identifier is not null and version_identifier is not null and body is not null") for df in both]
