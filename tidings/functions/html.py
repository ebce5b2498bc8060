"""HTML to plain text by one pass over the tokens of each text.

Links become ``[text](url)``, images are dropped, headings become ``#`` lines, bold ``**``, italics
``_``, list items ``* `` (two more spaces per level), table cells are parted by `` | ``; text is not wrapped; three or
more newlines collapse to two; the result is stripped. Comments, declarations, ``head``, ``script`` and ``style`` go with what they
hold; other tags go and their text stays. Attribute values may be quoted in either way or not at all; named and numeric
entities are decoded. A ``<`` that begins no tag, and an ``&`` that begins no entity, are text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_VALUES = r"""(?:[^<>"']|"[^"<]*"|'[^'<]*')*"""
_TOKEN = re.compile(rf"<!--|</?[a-z]{_VALUES}>|</?[a-z][^<>]*>|<[!?][^<>]*>|&(?:#[0-9]+|#x[0-9a-f]+|[a-z][a-z0-9]*);", re.I)
# what goes with its content: how it ends
_ENDS = {"!--": re.compile("-->"), **{name: re.compile(rf"</{name}\s*>", re.I) for name in ("head", "script", "style")}}
_NAME = re.compile(r"</?([a-z][a-z0-9]*)", re.I)
_HREF = re.compile(r"""\shref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
# What a tag becomes (opened, closed).
_MARKS = {
    "br": ("\n", "\n"), "b": ("**", "**"), "strong": ("**", "**"), "i": ("_", "_"), "em": ("_", "_"),
    "h1": ("\n\n# ", "\n\n"), "h2": ("\n\n## ", "\n\n"), "h3": ("\n\n### ", "\n\n"),
    **{f"h{n}": ("\n\n#### ", "\n\n") for n in (4, 5, 6)},
    **{name: ("\n\n", "\n\n") for name in ("p", "div", "article", "section", "nav", "header", "footer", "main", "aside", "table", "blockquote", "pre")},
}


def html_to_text(source: str) -> str:
    out: list[str] = []
    links: list[tuple[int, str | None]] = []  # of open links: place in ``out``, target
    at, depth, cells = 0, 0, 0
    endless: set[str] = set()  # what has no end from here on, so that it is looked for once
    while m := _TOKEN.search(source, at):
        out.append(source[at: m.start()])
        at = m.end()
        token = m.group()
        if token[0] == "&":
            out.append(html.unescape(token).replace("\xa0", " "))
            continue
        closes = token[1] == "/"
        name = "!--" if token == "<!--" else "" if token[1] in "!?" else _NAME.match(token).group(1).lower()
        if name in _ENDS and not closes and name not in endless:
            end = _ENDS[name].search(source, at)
            if end:
                at = end.end()
            else:
                endless.add(name)
            continue
        if name in _MARKS:
            out.append(_MARKS[name][closes])
        elif name == "a":
            if not closes:
                href = _HREF.search(token)
                links.append((len(out), html.unescape(next(g for g in href.groups() if g is not None)) if href else None))
                out.append("")
            elif links:
                place, target = links.pop()
                if target is not None:
                    out[place] = "["
                    out.append(f"]({target})")
        elif name in ("ul", "ol"):
            depth = max(depth + (-1 if closes else 1), 0)
            out.append("\n\n" if depth == (0 if closes else 1) else "")
        elif name == "li" and not closes:
            out.append("\n" + "  " * max(depth, 1) + "* ")
        elif name == "tr":
            cells = 0
            out.append("\n")
        elif name in ("td", "th") and not closes:
            out.append(" | " if cells else "")
            cells += 1
    out.append(source[at:])
    text = re.sub(r"[ \t]+\n", "\n", "".join(out))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


@F.arrow_udf(StringType())
def _to_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array([html_to_text(x) if x else "" for x in texts.to_pylist()], pa.string())


def clean_html(col) -> Column:
    """Plain text of an HTML column; null is empty."""
    return _to_text(F.col(col) if isinstance(col, str) else col)
