"""Text helpers: words, page fields, word checks. Column expressions over whole texts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def words(text: Column | str) -> Column:
    """Lower-case words of a text: runs of letters and digits."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def keyword_counts(rows: DataFrame, text: str, time: str, source: str, window: str) -> DataFrame:
    """Occurrences of each word per time window and source."""
    spread = rows.select(time, source, F.explode(words(text)).alias("keyword"))
    counted = spread.groupBy(F.window(time, window).alias("w"), source, "keyword").agg(F.count(F.lit(1)).alias("ct"))
    pattern = "yyyy-MM-dd HH:mm:ss"
    return counted.select(
        F.date_format("w.start", pattern).alias("stt"), F.date_format("w.end", pattern).alias("edt"), source, "keyword", "ct"
    )


PAGE_FIELDS = {
    "title": r"(?is)<title[^>]*>(.*?)</title>",
    "heading": r"(?is)<h1[^>]*>(.*?)</h1>",
    "lang": r'(?is)<html[^>]*\slang="([^"]*)"',
}
PAGE_LISTS = {
    "links": r'(?is)<a\s[^>]*href="([^"]*)"',
    "paragraphs": r"(?is)<p[^>]*>(.*?)</p>",
}


def extract_page_fields(
    pages: DataFrame, html: str = "html", fields: Mapping[str, str] = PAGE_FIELDS, lists: Mapping[str, str] = PAGE_LISTS
) -> DataFrame:
    """First match of each field pattern (empty where there is none) and all matches of each list pattern."""
    return pages.withColumns({
        **{name: F.trim(F.regexp_extract(html, pattern, 1)) for name, pattern in fields.items()},
        **{name: F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)) for name, pattern in lists.items()},
    }).drop(html)


def last_part(text: Column | str, separator: str = ",") -> Column:
    """What follows the last separator; separators at the end of the text do not count."""
    c = F.col(text) if isinstance(text, str) else text
    return F.substring_index(F.regexp_replace(c, f"{separator}+\\z", ""), separator, -1)


def flag_sensitive_messages(messages: DataFrame, word_table: DataFrame, text: str = "msg", grade: str = "P0") -> DataFrame:
    """Messages whose last part is a listed word: flag, grade and the word."""
    listed = word_table.select(F.col("word").alias("_word")).distinct()
    joined = messages.withColumn("_last", last_part(text)).join(listed, F.col("_last") == F.col("_word"), "left")
    hit = F.col("_word").isNotNull()
    return joined.select(
        *messages.columns, hit.cast("int").alias("is_violation"),
        F.when(hit, F.lit(grade)).otherwise("").alias("violation_grade"),
        F.when(hit, F.col("_word")).otherwise("").alias("violation_msg"),
    )
