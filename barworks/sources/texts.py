"""Texts out of landed payloads: search JSON (S17) and HTML pages."""

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F

MIN_LENGTH = 50
POSTS = "struct<data:struct<children:array<struct<data:struct<title:string,selftext:string>>>>,_corrupt_record:string>"

# Elements that hold text, by news source.
SOURCE_ELEMENTS = {"cointelegraph.com": ("h1", "h2", "article")}
OTHER_ELEMENTS = ("h1", "h2", "h3", "p")
# HTML elements whose start ends an open paragraph.
CLOSES_PARAGRAPH = ("address", "article", "aside", "blockquote", "div", "dl", "footer", "form", "h1", "h2", "h3", "h4",
                    "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul")
# HTML elements without content.
EMPTY_ELEMENTS = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def reddit_texts(payloads, payload="payload", limit=None, min_length=MIN_LENGTH):
    """Title, then body, of each post, if longer than `min_length`. A given `limit` stops after the post that reaches it.

    All of it happens inside the row of one payload, so no text is shuffled.
    """
    posts = F.coalesce(F.from_json(payload, POSTS)["data"]["children"], F.array())
    rows = payloads.withColumn("_posts", F.transform(posts, lambda p: F.filter(
        F.array(F.coalesce(p["data"]["title"], F.lit("")), F.coalesce(p["data"]["selftext"], F.lit(""))),
        lambda t: F.length(t) > min_length))).drop(payload)
    if limit is not None:
        # posts to read: count on until the kept texts reach the limit
        start = F.struct(F.lit(0).alias("texts"), F.lit(0).alias("posts"))
        progress = F.aggregate("_posts", start, lambda acc, p: F.when(acc["texts"] >= limit, acc).otherwise(
            F.struct((acc["texts"] + F.size(p)).alias("texts"), (acc["posts"] + 1).alias("posts"))))
        rows = rows.withColumn("_posts", F.slice("_posts", 1, progress["posts"]))
    rows = rows.withColumn("_texts", F.flatten("_posts")).drop("_posts")
    return rows.select(*rows.drop("_texts").columns, F.posexplode("_texts").alias("text_no", "text"))


def refused_payloads(payloads, payload="payload"):
    """Payloads without a readable list of posts, and why."""
    posts = F.from_json(payload, POSTS)
    reason = (F.when(F.col(payload).isNull(), F.lit("missing")).when(posts.isNull() | posts["_corrupt_record"].isNotNull(), F.lit("not readable"))
              .when(posts["data"]["children"].isNull(), F.lit("no posts")))
    return payloads.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop(payload)


class _Elements(HTMLParser):
    """Text of the wanted elements of one page, in the order in which they start."""

    def __init__(self, wanted):
        super().__init__(convert_charrefs=True)
        self.wanted, self.found, self.open = set(wanted), [], []

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_PARAGRAPH:
            self._close("p")
        if tag in EMPTY_ELEMENTS:
            return
        text = [] if tag in self.wanted else None
        if text is not None:
            self.found.append(text)
        self.open.append((tag, text))

    def handle_endtag(self, tag):
        self._close(tag)

    def handle_data(self, data):
        if self.open and self.open[-1][0] in ("script", "style"):
            return
        for _, text in self.open:
            if text is not None:
                text.append(data)

    def _close(self, tag):
        """Close the innermost open element of this name and all inside it; a stray end tag closes nothing."""
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return


def page_texts(html, source, limit=None, min_length=MIN_LENGTH):
    """Texts of one page: stripped, longer than `min_length`, in document order; the first `limit`, if given."""
    parser = _Elements(SOURCE_ELEMENTS.get(source, OTHER_ELEMENTS))
    parser.feed(html or "")
    parser.close()
    texts = ("".join(parts).strip() for parts in parser.found)
    return [t for t in texts if len(t) > min_length][:limit]


def news_texts(pages, html="html", source="source", limit=None, min_length=MIN_LENGTH):
    """One row per text of each page; pages are parsed in Arrow batches, in place."""

    @F.pandas_udf("array<string>")
    def parse(html: pd.Series, source: pd.Series) -> pd.Series:
        return pd.Series([page_texts(h, s, limit, min_length) for h, s in zip(html, source)])

    rows = pages.withColumn("_t", parse(F.col(html), F.col(source))).drop(html)
    return rows.select(*rows.drop("_t").columns, F.posexplode("_t").alias("text_no", "text"))
