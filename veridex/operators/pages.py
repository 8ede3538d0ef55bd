"""Page text: statement titles, statements printed side by side, notes, printed lines as rows, choice of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import basis, heading_segments, squeeze

# Statement titles, what may stand before and after them, and what is a title of no statement read here.
TITLES = (
    ("income", r"(?i)^(statement\s+of\s+profit\s+(?:or|and)\s+loss|profit\s+(?:or|and)\s+loss\s+account|income\s+statement|statement\s+of\s+income)\b"),
    ("balance", r"(?i)^(statement\s+of\s+financial\s+position|balance\s+sheet)\b"),
    ("cash_flow", r"(?i)^(statement\s+of\s+cash\s+flows?|cash\s+flow\s+statement)\b"),
)
PREFIX = r"(?i)^(?:(?:un-?consolidated|consolidated|separate|standalone|condensed|interim)\s+)*"
TAIL = r"(?i)^(?:\s*$|\s*and\s*$|\s*(?:and\s+other\s+comprehensive\s+income|account|[(\[]|for\s+the\b|as\s+(?:at|on)\b|[-–—:]|[0-9]))"
COMPANY = r"\b(?:limited|ltd)\b\.?\)?\s*"
RUNNING = r"\b(?:annual|half[-\s]?yearly|quarterly|interim)\s+report(?:\s+(?:19|20)[0-9]{2}(?:\s*[-–/]\s*[0-9]{2,4})?)?\s*"
OTHER_TITLE = r"(?i)^(statement\s+of\s+(?:other\s+)?comprehensive\s+income|statement\s+of\s+changes\s+in\s+equity|notes\s+to\s+the)\b"
# Note topics with their wording, and a figure or nil of a printed line.
NOTE_TOPICS = (
    ("share_capital", r"(?i)(?:issued,?\s+subscribed\s+and\s+paid[-\s]?up\s+(?:share\s+)?capital|share\s+capital)\b"),
    ("stock_in_trade", r"(?i)(?:stock[-\s]in[-\s]trade|inventor(?:y|ies))\b"),
    ("fixed_assets", r"(?i)(?:property,?\s+plant\s+and\s+equipment|operating\s+(?:fixed\s+)?assets|fixed\s+assets)\b"),
    ("dividends", r"(?i)(?:events?\s+(?:after|subsequent\s+to)\s+(?:the\s+)?(?:reporting\s+(?:period|date)|balance\s+sheet\s+date|statement\s+of\s+financial\s+position\s+date|year[-\s]end)|non[-\s]adjusting\s+events?|subsequent\s+events?|dividends?(?:\s+and\s+appropriations)?)\b"),
)
FIGURE = r"^\(?-?[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?\)?$|^\(?-?[0-9]+(?:\.[0-9]+)?\)?%?$|^[-–—]+$"


def title_of(segment: Column) -> Column:
    """Statement that a heading's text, without company or running header, is the title of; null for none."""
    rest = F.regexp_replace(segment, PREFIX, "")
    out = F.lit(None).cast("string")
    for name, pattern in reversed(TITLES):
        alone = F.regexp_replace(rest, pattern, "").rlike(TAIL)
        if name == "income":  # comprehensive income alone restates the year's profit
            alone = alone & ~(rest.rlike("(?i)comprehensive") & ~rest.rlike("(?i)profit"))
        out = F.when(rest.rlike(pattern), F.when(alone, F.lit(name))).otherwise(out)
    return out


def _candidates(segment: Column) -> Column:
    """The heading, and what follows a company's name or a running header in it."""
    after = [F.regexp_extract(segment, rf"(?i)^.*{lazy}{p}(.+)$", 1) for p in (COMPANY, RUNNING) for lazy in ("?", "")]
    return F.array(segment, *[F.nullif(a, F.lit("")) for a in after])


def undoubled(segments: Column) -> Column:
    """The heading with each word at its first place only: a title printed twice over itself is read once."""
    words = F.filter(F.split(F.array_join(segments, " "), r"\s+"), lambda w: w != "")
    return F.array_join(F.filter(words, lambda w, i: ~F.array_contains(F.transform(F.slice(words, F.lit(1), i), F.lower), F.lower(w))), " ")


def titles(pages: DataFrame) -> DataFrame:
    """(filing, page_number, kind, basis): the statements whose titles a page's heading lines carry, each kind once.

    Where no line carries one, the heading with doubled words read once is tried.
    """
    d = pages.withColumn("_s", heading_segments(F.col("text")))
    hit = lambda s: F.try_element_at(F.filter(F.transform(_candidates(s), lambda c: F.struct(title_of(c).alias("kind"), F.nullif(F.regexp_extract(c, r"(?i)^(?:(?:condensed|interim)\s+)*(un-?consolidated|separate|standalone|consolidated)\b", 1), F.lit("")).alias("word"))), lambda x: x["kind"].isNotNull()), F.lit(1))
    found = F.filter(F.transform("_s", hit), lambda x: x.isNotNull())
    d = d.withColumn("_t", found).withColumn("_t", F.when(F.size("_t") > 0, F.col("_t")).otherwise(F.filter(F.array(hit(undoubled(F.col("_s")))), lambda x: x.isNotNull())))
    # of an inner explode a filter would be inferred, pushed below a repartition, and every page read twice
    first = d.select("filing", "page_number", F.posexplode_outer("_t").alias("at", "x")).where("x is not null").groupBy("filing", "page_number", F.col("x.kind").alias("kind")).agg(F.min_by("x.word", "at").alias("word"))
    return first.select("filing", "page_number", "kind", basis(F.regexp_replace("word", "-", "")).alias("basis"))


def title_offsets(pages: DataFrame) -> DataFrame:
    """(filing, page_number, kind, start): where titles start on heading lines that carry two or more side by side."""
    lines = F.slice(F.filter(F.split("text", "\n"), lambda x: F.trim(x) != ""), 1, 14)
    d = pages.select("filing", "page_number", F.posexplode(lines).alias("line_no", "line"))
    # the pieces cover the line from its start, so their lengths add up to where each begins
    d = d.withColumn("_p", F.regexp_extract_all("line", F.lit(r"\s*\S+(?:\s\S+)*"), F.lit(0)))
    start = lambda i: F.aggregate(F.slice(F.col("_p"), F.lit(1), i), F.lit(0), lambda a, x: a + F.length(x))
    cells = d.select("filing", "page_number", "line_no", F.explode(F.transform("_p", lambda x, i: F.struct((start(i) + F.length(x) - F.length(F.ltrim(x))).alias("start"), squeeze(x).alias("t")))).alias("c"))
    cells = cells.select("filing", "page_number", "line_no", "c.start", F.explode(F.split("c.t", r"\s{3,}|\|")).alias("t"))
    rest = F.regexp_replace("t", PREFIX, "")
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(TITLES):
        kind = F.when(rest.rlike(pattern), F.lit(name)).otherwise(kind)
    cells = cells.withColumn("kind", F.coalesce(kind, F.when(rest.rlike(OTHER_TITLE), "other"))).where("kind is not null")
    return cells.withColumn("n", F.count("*").over(Window.partitionBy("filing", "page_number", "line_no"))).where("n >= 2").select("filing", "page_number", "kind", "start")


def side_columns(offsets: DataFrame) -> DataFrame:
    """(filing, page_number, kind, lo, hi): the character columns of each statement printed beside another."""
    starts = offsets.groupBy("filing", "page_number").agg(F.array_sort(F.collect_set("start")).alias("starts"))
    own = offsets.where("kind <> 'other'").groupBy("filing", "page_number", "kind").agg(F.min("start").alias("start")).join(starts, ["filing", "page_number"])
    at = F.array_position("starts", F.col("start")).cast("int")
    following = F.get("starts", at)
    return own.select("filing", "page_number", "kind", F.when(at == 1, 0).otherwise(F.greatest(F.lit(0), F.col("start") - 2)).alias("lo"), F.coalesce(following - 2, F.lit(10_000)).alias("hi"))


def cropped(text: Column, lo: Column, hi: Column) -> Column:
    """The text's lines cut to character columns [lo, hi)."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x: F.substr(x, lo + 1, hi - lo)), "\n")


def compact(text: Column) -> Column:
    """Page text for a reader: runs of spaces become " | ", blank lines go."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"[ \t]{2,}", " | "), r"^\s*\|\s*", "")))
    return F.array_join(F.filter(lines, lambda x: (x != "") & (x != "|")), "\n")


def note_references(pages: DataFrame) -> DataFrame:
    """(filing, basis, topic, number): the note numbers that a balance sheet prints beside its captions, the first of each topic."""
    lines = pages.select("filing", "basis", "page_number", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    topic = F.explode(F.array(*[F.struct(F.lit(n).alias("topic"), F.regexp_extract("line", rf"{p}([^\n]*)$", 1).alias("rest")) for n, p in NOTE_TOPICS if n != "dividends"])).alias("x")
    number = F.regexp_extract("x.rest", r"^[^0-9\n]{0,80}?\s([0-9]{1,2}(?:\.[0-9]{1,2})?)\s+(?:\(?[0-9]{1,3}(?:[,.][0-9]{3})+|-\s)", 1)
    found = lines.select("filing", "basis", "page_number", "line_no", topic).withColumn("number", F.nullif(number, F.lit(""))).where("number is not null")
    return found.groupBy("filing", "basis", F.col("x.topic").alias("topic")).agg(F.min_by("number", F.struct("page_number", "line_no")).alias("number"))


def note_headings(pages: DataFrame, references: DataFrame) -> DataFrame:
    """(filing, basis, topic, page_number, number): the first page whose line, or layout column, starts a note on each topic.

    A cited note is found by its number with the topic's words or a heading in capitals; an uncited one by its words.
    """
    lines = pages.select("filing", "basis", "page_number", "text", F.explode(F.split("text", "\n")).alias("line"))
    start = r"(?:^\s*|\s{3,})([0-9]{1,2}(?:\.[0-9]{1,2})?)\.?\s{1,12}(?=\S)"
    heads = lines.select("filing", "basis", "page_number", "text", "line", F.explode(F.regexp_extract_all("line", F.lit(rf"{start}(.{{0,80}})"), F.lit(0))).alias("head"))
    heads = heads.withColumn("number", F.regexp_extract("head", start, 1)).withColumn("rest", F.regexp_replace("head", rf"^{start}", ""))
    topics = F.explode(F.array(*[F.struct(F.lit(n).alias("topic"), F.col("rest").rlike(rf"(?i)^.{{0,4}}?{p[4:]}").alias("topical")) for n, p in NOTE_TOPICS])).alias("x")
    found = heads.select("filing", "basis", "page_number", "text", "number", "rest", topics).select("filing", "basis", "page_number", "text", "number", "rest", "x.*").join(references.withColumnRenamed("number", "cited"), ["filing", "basis", "topic"], "left")
    fits = F.when(F.col("cited").isNull(), F.col("topical") & F.col("number").rlike(r"^[0-9]{1,2}$")).otherwise((F.col("number") == F.col("cited")) & (F.col("topical") | F.col("rest").rlike(r"^[A-Z][A-Z ,&'’()-]{6,}")))
    found = found.where(fits & ((F.col("topic") != "dividends") | F.col("text").rlike(r"(?i)\bdividend")))
    return found.groupBy("filing", "basis", "topic").agg(F.min(F.struct("page_number", "number")).alias("x")).select("filing", "basis", "topic", "x.*")


def _tokens(line: Column) -> Column:
    """Tokens of a line in order: (text, figure).  Two spaces part cells; figures at a cell's end are tokens of their own."""

    def bound(value: Column, then) -> Column:  # inside a lambda an expression is evaluated at each of its uses
        return F.transform(F.array(value), then)[0]

    def built(parts: Column, figures: Column) -> Column:
        # words before the figures at the end
        words = F.when(F.forall(figures, lambda x: x), 0).otherwise(F.size(parts) - F.array_position(F.reverse(figures), F.lit(False)).cast("int") + 1)
        head = lambda n: F.when(n > 0, F.array(F.struct(F.array_join(F.slice(parts, F.lit(1), n), " ").alias("text"), F.lit(False).alias("figure")))).otherwise(F.array().cast("array<struct<text:string,figure:boolean>>"))
        return bound(words, lambda n: F.concat(head(n), F.transform(F.slice(parts, n + 1, F.size(parts)), lambda x: F.struct(x.alias("text"), F.lit(True).alias("figure")))))

    def of(cell: Column) -> Column:
        return bound(F.split(F.trim(cell), r"\s+"), lambda parts: bound(F.transform(parts, lambda x: x.rlike(FIGURE)), lambda figures: built(parts, figures)))

    cells = F.filter(F.split(F.trim(line), r"\s{2,}|\t+"), lambda x: ~F.trim(x).isin("", "|"))
    return F.flatten(F.transform(cells, of))


def line_rows(pages: DataFrame) -> DataFrame:
    """(filing, page_number, line_no, segment, caption, leading, numbers, headings): captions of printed lines with their figures.

    Text after a segment's figures starts the next one, so two statements side by side give two rows.  A line of text
    alone is a heading of the next row; directly above a line of figures alone it is also that line's caption.
    """
    raw = pages.select("filing", "page_number", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.trim("line") != "")
    t = raw.withColumn("_t", _tokens(F.col("line")))
    # a token starts a segment if it is text and the token before it is a figure that follows a caption
    caption_before = lambda i: F.exists(F.slice(F.col("_t"), F.lit(1), i), lambda x: ~x["figure"])
    starts = F.transform("_t", lambda x, i: F.when(~x["figure"] & (i > 0) & F.get("_t", i - 1)["figure"] & caption_before(i), 1).otherwise(0))
    t = t.withColumn("_s", starts).withColumn("_n", F.transform("_s", lambda _, i: F.aggregate(F.slice("_s", F.lit(1), i + 1), F.lit(0), lambda a, x: a + x))).drop("_s")
    t = t.withColumn("_has", F.exists("_t", lambda x: x["figure"]))
    w = Window.partitionBy("filing").orderBy("page_number", "line_no")
    t = t.withColumn("_above", F.lag(F.when(~F.col("_has"), F.regexp_replace(F.trim("line"), r"\s{2,}", " "))).over(w))
    t = t.withColumn("_g", F.coalesce(F.sum(F.col("_has").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # headings meet their row in a window over the filing's lines
    heads = F.collect_list(F.when(~F.col("_has"), F.struct("page_number", "line_no", F.regexp_replace(F.trim("line"), r"\s{2,}", " | ").alias("h")))).over(Window.partitionBy("filing", "_g"))
    rows = t.withColumn("headings", heads).where("_has").withColumn("headings", F.transform(F.sort_array("headings"), lambda x: x["h"]))
    segment = F.explode(F.sequence(F.lit(0), F.element_at("_n", -1))).alias("segment")
    rows = rows.select("filing", "page_number", "line_no", "_t", "_n", "_above", "headings", segment)
    own = F.filter("_t", lambda x, i: F.get("_n", i) == F.col("segment"))
    rows = rows.withColumn("_o", own)
    first_text = F.coalesce(F.nullif(F.array_position(F.transform("_o", lambda x: x["figure"]), F.lit(False)), F.lit(0)), (F.size("_o") + 1).cast("long")).cast("int")
    figures = lambda a: F.transform(F.filter(a, lambda x: x["figure"]), lambda x: x["text"])
    caption = squeeze(F.array_join(F.transform(F.filter("_o", lambda x: ~x["figure"]), lambda x: x["text"]), " "))
    rows = rows.withColumns({"caption": caption, "leading": figures(F.slice("_o", F.lit(1), first_text - 1)), "numbers": figures(F.slice("_o", first_text, F.size("_o")))})
    rows = rows.where((F.size("numbers") > 0) | (F.size("leading") > 0))
    alone = (F.col("caption") == "") & (F.element_at("_n", -1) == 0) & F.col("_above").isNotNull()
    no_headings = F.array().cast("array<string>")
    return rows.select("filing", "page_number", "line_no", "segment", F.when(alone, F.col("_above")).otherwise(F.col("caption")).alias("caption"), "leading", "numbers", F.when(F.col("segment") == 0, F.coalesce("headings", no_headings)).otherwise(no_headings).alias("headings"))


def pages_to_scan(pages: DataFrame, policy: str = "if_needed", leading: int = 3, needed: DataFrame | None = None, least: int = 80) -> DataFrame:
    """The pages that a policy sends to character recognition: ``always`` all, ``leading`` the first few, ``if_needed`` the
    sparse pages (under ``least`` characters) of the filings in ``needed``."""
    if policy == "always":
        return pages
    if policy == "leading":
        return pages.where(F.col("page_number") <= leading)
    sparse = pages.where(F.length(F.trim("text")) < least)
    return sparse if needed is None else sparse.join(needed.select("filing").distinct(), "filing", "left_semi")


def subset(selected: DataFrame) -> DataFrame:
    """(filing, page_number, subset_number): the selected pages in order, numbered from 1 for a reader that gets only them."""
    own = selected.select("filing", "page_number").distinct()
    return own.withColumn("subset_number", F.row_number().over(Window.partitionBy("filing").orderBy("page_number")))


def restored(results: DataFrame, numbering: DataFrame) -> DataFrame:
    """A reader's results with the filing's own page numbers in place of the subset's; results of no page go."""
    return results.join(numbering, ["filing", "subset_number"]).drop("subset_number")


def notice_text(pages: DataFrame) -> DataFrame:
    """(id, text): the pages of each notice in order, parted by a blank line; pages without text are left out."""
    kept = pages.where(F.trim("text") != "")
    return kept.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_number", "text"))), lambda x: x["text"]), "\n\n").alias("text"))
