"""Repeated items of pages: one row for each block of a list, with several fields."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Tags whose end is left out as a rule: the next start ends them.
ENDED_BY_NEXT = ("p", "option")
_INSIDE = r"""(?:[^>"']++|"[^">]*+"|'[^'>]*+'|["'])*+"""
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
_BEFORE = rf"""(?:\s+[^\s=>"']++(?:\s*+=\s*+{_VALUE})?+)*?"""
_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""


def _one_of(item: Column, pattern: str, groups: int) -> Column:
    """The first group that matched, NULL where the pattern is not found."""
    found = [F.get(F.regexp_extract_all(item, F.lit(pattern), F.lit(g)), F.lit(0)) for g in range(1, groups + 1)]
    return F.when(F.regexp_like(item, F.lit(pattern)), F.concat(*[F.coalesce(f, F.lit("")) for f in found]))


def attribute(tag: str, name: str) -> Callable[[Column], Column]:
    """Value of an attribute in the first ``tag`` that has it, in quotes of either kind or in none; NULL if there is none."""
    pattern = rf"""(?is)<{tag}{_BEFORE}\s+{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return lambda item: _one_of(item, pattern, 3)


def element(tag: str, css_class: str | None = None) -> Callable[[Column], Column]:
    """Text of the first ``tag`` (with the class), without inner tags, runs of spaces as one; NULL if there is none."""
    named = rf"""{_BEFORE}\s+class\s*=\s*(?:"(?:[^"]*\s)?{css_class}(?:\s[^"]*)?"|'(?:[^']*\s)?{css_class}(?:\s[^']*)?'|{css_class}(?=[\s>]))"""
    pattern = rf"""(?is)<{tag}{named if css_class else r"(?=[\s/>])"}{_REST}(.*?)</{tag}\s*>"""

    def text(item: Column) -> Column:
        inner = F.regexp_replace(_one_of(item, pattern, 1), r"(?s)<[^>]*>", " ")
        return F.trim(F.regexp_replace(inner, r"\s+", " "))

    return text


def _blocks(tag: str, css_class: str | None) -> Callable[[str], Iterator[str]]:
    """Whole blocks of ``tag`` with the class, in order, found in one scan by counting starts and ends of the tag."""
    marks = re.compile(rf"(?is)<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?){tag}(?=[\s/>])({_INSIDE})>")
    classes = re.compile(r"""(?is)\sclass\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
    by_next = tag.lower() in ENDED_BY_NEXT

    def wanted(attributes: str) -> bool:
        found = classes.search(attributes)
        return css_class is None or (found is not None and css_class in (found[1] or found[2] or found[3] or "").split())

    def run(html: str) -> Iterator[str]:
        begin, depth = None, 0
        for mark in marks.finditer(html):
            if mark[3] is None:
                continue
            if not mark[2]:
                if begin is not None and by_next:
                    yield html[begin : mark.start()]
                    begin = None
                if begin is not None:
                    depth += 1
                elif wanted(mark[3]):
                    begin, depth = mark.start(), 1
            elif begin is not None:
                depth -= 1
                if not depth:
                    yield html[begin : mark.end()]
                    begin = None
        if begin is not None:
            yield html[begin:]

    return run


def extract_page_items(pages: DataFrame, tag: str, fields: Mapping[str, Callable[[Column], Column]], css_class: str | None = None,
                       html: str = "html") -> DataFrame:
    """The page's other columns, ``item_no`` (from 1) and ``fields`` for each block of ``tag`` (with the class) of each page.

    Blocks are found in one scan of the whole page, with starts and ends counted, so blocks may hold tags of their own kind;
    a block inside another belongs to the outer one. Comments, scripts and styles hold no blocks. ``p`` and ``option`` also
    end where the next begins; any other block without an end reaches to the end of the page. The start of a block ends
    at its first ``>``, also in quotes, which keeps the scan linear on broken pages. A field that an item does not
    have is NULL. NULL, empty and itemless pages give no rows; repeated pages give their items each.
    """
    others = [c for c in pages.columns if c != html]
    split = _blocks(tag, css_class)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, page in enumerate(batch.column("_html")):  # a page at a time: memory is that of one page's items
                found = list(split(page.as_py() or ""))
                if found:
                    own = batch.select(["_page"]).take(pa.array([i] * len(found)))
                    yield pa.RecordBatch.from_arrays([own.column(0), pa.array(range(1, len(found) + 1), pa.int64()), pa.array(found, pa.string())],
                                                     ["_page", "item_no", "_item"])

    # the page's columns travel as one, so that their names never meet ours
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_")).alias("_page"), F.col(f"`{html}`").alias("_html"))
    items = rows.mapInArrow(run, T.StructType([rows.schema["_page"], T.StructField("item_no", T.LongType()), T.StructField("_item", T.StringType())]))
    return items.select(*[F.col(f"_page.`{c}`") for c in others], "item_no", *[of(F.col("_item")).alias(name) for name, of in fields.items()])
