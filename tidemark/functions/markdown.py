"""HTML fragments to Markdown: headings, paragraphs, lists, tables, links, emphasis, code, breaks."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WRAP = {"b": "**", "strong": "**", "em": "*", "i": "*", "code": "`", "del": "~~", "s": "~~"}
_BLANK = re.compile(r"\n{3,}")
_SPACE = re.compile(r"[\t \r\n]+")


class _Writer(HTMLParser):
    """Collects output per open element; an element's text is finished when it ends."""

    def to_markdown(self, html: str) -> str:
        self.reset()
        self.open = [("", {}, [])]
        self.feed(html)
        self.close()
        while len(self.open) > 1:
            self._end()
        return _BLANK.sub("\n\n", "".join(self.open[0][2])).strip("\n")

    def _lists(self):
        return [tag for tag, _, _ in self.open if tag in ("ul", "ol")]

    def _around(self, tag):
        """Attributes and counts of the nearest open element of this tag."""
        return next((given for t, given, _ in reversed(self.open) if t == tag), None)

    def _row(self, given, cells):
        """A table row; the first one brings the rule below the head, or an empty head."""
        if not given["#"]:
            return ""
        table = self._around("table") or {"#": 0}
        table["#"] += 1
        rule = "| " + " | ".join(["---"] * given["#"]) + " |\n"
        line = f"|{cells}\n"
        if table["#"] > 1:
            return line
        if given.get("heads") == given["#"] or self._around("thead") is not None:
            return line + rule
        return "| " + " | ".join([""] * given["#"]) + " |\n" + rule + line

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.open[-1][2].append("  \n")
        elif tag == "hr":
            self.open[-1][2].append("\n\n---\n\n")
        elif tag == "img":
            given = dict(attrs)
            self.open[-1][2].append(f"![{given.get('alt') or ''}]({given.get('src') or ''})")
        else:
            opened = [t for t, _, _ in self.open]
            ending = {"th": ("td", "th"), "td": ("td", "th")}.get(tag, (tag,))
            last = max((i for i, t in enumerate(opened) if t in ending), default=None)
            if tag in ("p", "li", "td", "th", "tr") and last is not None:
                # An unclosed paragraph, item, cell or row ends where the next one starts.
                at = last
                if not {"ul", "ol", "table"} & set(opened[at:]):
                    while len(self.open) > at:
                        self._end()
            self.open.append((tag, {**dict(attrs), "#": 0}, []))

    def handle_endtag(self, tag):
        if tag in [t for t, _, _ in self.open]:
            while self._end() != tag:
                pass

    def handle_data(self, data):
        tags = [t for t, _, _ in self.open]
        if "pre" not in tags:
            data = _SPACE.sub(" ", data)
            if "code" not in tags:
                data = re.sub(r"([*_])", r"\\\1", data)
        parts = self.open[-1][2]
        if data.strip() or parts and not parts[-1].endswith(("\n", " ")):
            parts.append(data)

    def _end(self) -> str:
        tag, given, parts = self.open.pop()
        body = "".join(parts)
        text = body.strip(" \n")
        lead = " " if body[:1] == " " else ""
        trail = " " if body[-1:] == " " else ""
        if tag in ("script", "style"):
            body = ""
        elif tag in ("h1", "h2"):
            line = _SPACE.sub(" ", text)
            body = f"\n\n{line}\n{('=' if tag == 'h1' else '-') * len(line)}\n\n" if line else ""
        elif re.fullmatch("h[3-6]", tag):
            body = f"\n\n{'#' * int(tag[1])} {_SPACE.sub(' ', text)}\n\n" if text else ""
        elif tag == "p":
            body = f"\n\n{text}\n\n" if text else ""
        elif tag == "pre":
            body = "\n\n```\n" + body.strip("\n") + "\n```\n\n" if body.strip() else ""
        elif tag == "code" and self._around("pre"):
            pass  # the fence around it is enough
        elif tag in ("td", "th"):
            row = self._around("tr")
            if row:
                row["#"] += 1
                row["heads"] = row.get("heads", 0) + (tag == "th")
            body = f" {_SPACE.sub(' ', text)} |"
        elif tag == "tr":
            body = self._row(given, "".join(p for p in parts if p.strip()))
        elif tag in ("thead", "tbody", "tfoot"):
            body = "".join(p for p in parts if p.strip())
        elif tag == "table":
            rows = "".join(p for p in parts if p.strip()).strip("\n")
            body = f"\n\n{rows}\n\n" if rows else ""
        elif tag in _WRAP:
            body = f"{lead}{_WRAP[tag]}{text}{_WRAP[tag]}{trail}" if text else body[:1]
        elif tag == "a":
            href, title = given.get("href"), given.get("title")
            title = ' "' + title.replace('"', '\\"') + '"' if title else ""
            if href and text:
                body = (f"{lead}<{href}>{trail}" if text == href and not title
                        else f"{lead}[{text}]({href}{title}){trail}")
        elif tag == "li":
            holder = next((e for e in reversed(self.open) if e[0] in ("ul", "ol")), None)
            mark = "*+-"[(self._lists().count("ul") - 1) % 3] if holder else "*"
            if holder and holder[0] == "ol":
                holder[1]["#"] += 1
                mark = f"{int(holder[1].get('start') or 1) + holder[1]['#'] - 1}."
            body = mark + " " + text.replace("\n", "\n" + " " * (len(mark) + 1)) + "\n"
        elif tag in ("ul", "ol"):
            inner = "".join(p for p in parts if p.strip()).rstrip("\n")
            body = f"\n{inner}\n" if "li" in [t for t, _, _ in self.open] else f"\n\n{inner}\n\n"
        elif tag == "blockquote" and text:
            body = "\n\n> " + text.replace("\n", "\n> ") + "\n\n"
        elif tag in ("div", "article", "section") and text:
            body = f"\n\n{text}\n\n"
        self.open[-1][2].append(body)
        return tag


@F.pandas_udf(T.StringType())
def html_to_markdown(fragments: pd.Series) -> pd.Series:
    writer = _Writer(convert_charrefs=True)
    return pd.Series(
        [None if x is None else writer.to_markdown(x) for x in fragments], dtype=object
    )
