"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space as the act texts know it, the no-break space included.
BLANKS = r"[\t\n\f\r\p{Z}]+"
TAG = r"<[^>]+>"
LIST_PREFIX = "string;#"


def _each(df: DataFrame, names, fn) -> DataFrame:
    """Apply ``fn`` to those of ``names`` the table has."""
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: fn(F.col(f"`{n}`")) for n in present}) if present else df


def strip_tags(c: Column) -> Column:
    """Remove everything that looks like a tag."""
    return F.regexp_replace(c, TAG, "")


def scrub_prefix(c: Column) -> Column:
    """Remove every list marker from a search field."""
    return F.replace(c, F.lit(LIST_PREFIX), F.lit(""))


def cut_decimal(c: Column) -> Column:
    """Keep what stands before the first point of a printed number."""
    return F.substring_index(c, ".", 1)


def newline_space(c: Column) -> Column:
    return F.translate(c, "\n", " ")


def squish(c: Column) -> Column:
    """One blank between words, none at the ends."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def strip_tags_in(df: DataFrame, names) -> DataFrame:
    return _each(df, names, strip_tags)


def scrub_prefix_in(df: DataFrame, names) -> DataFrame:
    return _each(df, names, scrub_prefix)


def cut_decimal_in(df: DataFrame, names) -> DataFrame:
    return _each(df, names, cut_decimal)


def _html_udf(block_sep: str):
    """Arrow-batched HTML reader.  The class lives inside the function so that it
    travels with it and executors need no installed package."""
    import pandas as pd

    def read(batch: pd.Series) -> pd.Series:
        from html.parser import HTMLParser

        blocks = {
            "p", "div", "br", "li", "ul", "ol", "tr", "td", "th", "table", "h1", "h2", "h3",
            "h4", "h5", "h6", "section", "article", "header", "footer", "nav", "blockquote",
        }

        class TextNodes(HTMLParser):
            def __init__(self):
                super().__init__(convert_charrefs=True)
                self.nodes = []

            def handle_data(self, data):
                self.nodes.append(data)

            def handle_starttag(self, tag, attrs):
                if block_sep and tag in blocks:
                    self.nodes.append(block_sep)

            def handle_endtag(self, tag):
                if block_sep and tag in blocks:
                    self.nodes.append(block_sep)

        def text_of(html):
            if html is None:
                return None
            parser = TextNodes()
            parser.feed(html)
            parser.close()
            return "".join(parser.nodes)

        return batch.map(text_of, na_action="ignore")

    read.__annotations__ = {"batch": pd.Series, "return": pd.Series}
    return F.pandas_udf(read, "string")


def html_text(c: Column, block_sep: str = "") -> Column:
    """Text nodes of an HTML fragment, joined without a separator by default.

    Comments are dropped, entities decoded, script and style text kept; NULL
    stays NULL.  Values without markup never leave the JVM.
    """
    markup = c.contains("<") | c.contains("&")
    parsed = _html_udf(block_sep)(F.when(markup, c))
    return F.when(markup, parsed).otherwise(c)


def html_to_line(c: Column, block_sep: str = "") -> Column:
    """HTML to one line of plain text: text nodes, line breaks, squish."""
    return squish(newline_space(html_text(c, block_sep)))
