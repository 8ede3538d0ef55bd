"""Labels, lines, captions and page text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning in a caption.
STOPWORDS = ("and", "of", "the", "in", "for", "to", "from", "on", "at", "by", "a", "an", "as", "or")


def squeeze(text: Column) -> Column:
    # words of plain letters parted by single spaces, the usual case, are as they should be
    return F.when(text.rlike(r"^[!-~]+(?: [!-~]+)*+\z"), text).otherwise(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def label(text: Column) -> Column:
    """Normalised row label: lower case, quotes and dashes unified, no marks at words' ends or before the first letter or
    bracket; a hyphen inside a word stays tight, one with a space at a side gets one on both."""
    t = F.translate(F.lower(text), "‘’`´“”–—", "''''\"\"--")
    t = F.regexp_replace(t, r"(?<=\w)[.:](?=[\s\u00A0]|$)", "")
    t = F.regexp_replace(t, r"^[^a-z(]+", "")
    t = F.regexp_replace(t, r"(\w)\s+-\s*(?=\w)|(\w)-\s+(?=\w)", "$1$2 - ")
    return squeeze(t)


def heading_segments(page: Column, lines: int = 14) -> Column:
    """Segments, parted by three spaces or more, of a page's first non-blank lines."""
    first = F.slice(F.filter(F.split(page, "\n"), lambda x: F.trim(x) != ""), 1, lines)
    return F.filter(F.transform(F.flatten(F.transform(first, lambda x: F.split(F.trim(x), r" {3,}"))), lambda x: F.trim(x)), lambda x: x != "")


def figure_lines(page: Column) -> Column:
    """Number of lines that hold two figures or more."""
    return F.size(F.filter(F.split(page, "\n"), lambda x: F.regexp_count(x, F.lit(r"[0-9][0-9,]*\.?[0-9]*")) >= 2))


def html_to_text(html: Column) -> Column:
    """Script and style dropped, block ends to line breaks, cell ends to spaces, tags stripped, white space squeezed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>|</(p|div|tr|li|h[1-6]|table|ul|ol)>", "\n")
    t = F.regexp_replace(t, r"(?i)</t[dh]>", " ")
    t = F.regexp_replace(t, r"<[^>]*>", "")
    t = F.replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&"))
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[ \t]+", " "), r" ?\n[ \n]*", "\n"))


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), F.lit(1))


def words(text: Column) -> Column:
    """Lower-case words without stop words."""
    return F.filter(F.split(F.lower(text), r"[^a-z]+"), lambda w: (w != "") & ~w.isin(*STOPWORDS))


def words_alike(a: Column, b: Column, scanned: bool = False) -> Column:
    """Equal, or one begins the other (four letters or more), or one edit apart (two for long words of scanned text)."""
    near = F.levenshtein(a, b)
    short = F.least(F.length(a), F.length(b))
    edits = F.when(F.lit(scanned) & (short >= 8), 2).otherwise(F.when(short >= 4, 1).otherwise(0))
    return (a == b) | ((short >= 4) & (a.startswith(b) | b.startswith(a))) | (near <= edits)


def skeleton(text: Column) -> Column:
    """The digits of a text."""
    return F.regexp_replace(text, "[^0-9]", "")


def common_subsequence(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two strings: a fold over rows of the usual table."""
    chars = lambda s: F.filter(F.split(s, ""), lambda x: x != "")
    zero = F.array_repeat(F.lit(0), F.length(b) + 1)

    def row(above: Column, c: Column) -> Column:
        # each cell: max(left, above, diagonal + match)
        cells = F.transform(chars(b), lambda x, j: F.greatest(F.get(above, j + 1), F.get(above, j) + F.when(x == c, 1).otherwise(0)))
        return F.aggregate(cells, F.array(F.lit(0)), lambda acc, v: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), v))))

    return F.element_at(F.aggregate(chars(a), zero, row), -1)


def split_category(text: Column) -> tuple[Column, Column]:
    """'X (basis)' into X and basis, both without outer spaces; no basis is null."""
    m = r"^(.*?)\s*\(([^()]*)\)\s*$"
    found = text.rlike(m)
    return F.trim(F.when(found, F.regexp_extract(text, m, 1)).otherwise(text)), F.when(found, F.nullif(squeeze(F.regexp_extract(text, m, 2)), F.lit("")))


def absent(text: Column) -> Column:
    """Null for the marks that stand for nothing."""
    t = F.trim(text)
    return F.when(~F.lower(t).isin("", "-", "n/a", "na", "nil", "null", "none"), t)


def basis(text: Column) -> Column:
    t = F.lower(text)
    return F.when(t.rlike("unconsolidated|standalone|separate"), "unconsolidated").when(t.rlike("consolidated|group"), "consolidated")


def token_on_line(line: Column, token: Column) -> Column:
    """Whether a printed number stands on a line and not inside a longer number."""
    quoted = F.concat(F.lit(r"\Q"), token, F.lit(r"\E"))
    return F.regexp_like(line, F.concat(F.lit(r"(?<![0-9,.])"), quoted, F.lit(r"(?![0-9]|[,.][0-9])")))


def record_key(url: Column) -> Column:
    """First 32 hex digits of the URL's SHA-256."""
    return F.substring(F.sha2(url, 256), 1, 32)


def letters_to_zero(text: Column) -> Column:
    """The letter O between digits is a zero."""
    return F.regexp_replace(text, r"(?<=[0-9,.])[Oo](?=[0-9,.]|$)", "0")
