"""Readers: format dispatch, page text, word boxes, records, artifacts, answer keys, prices."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from ..functions.text import html_to_text, record_key

MAX_BYTES = 50 << 20

# First bytes of formats, in hex.
MAGIC = (("pdf", "25504446"), ("image", "89504E47"), ("image", "FFD8FF"), ("image", "47494638"), ("image", "49492A00"), ("image", "4D4D002A"), ("image", "424D"), ("zip", "504B0304"), ("xls", "D0CF11E0"))

WORD_BOXES = StructType([StructField(n, IntegerType()) for n in ("level", "page_num", "block_num", "par_num", "line_num", "word_num", "left", "top", "width", "height")] + [StructField("conf", DoubleType()), StructField("text", StringType())])
RECORD = "key STRING, corpus_version INT, text_version INT, source_url STRING, symbol STRING, extracted_at TIMESTAMP, source STRUCT<byteLength: BIGINT, sha256: STRING>, document STRUCT<kind: STRING, method: STRING, contentType: STRING, confidence: DOUBLE, text: STRING, ocr: BOOLEAN, pages: ARRAY<STRUCT<pageNumber: INT, method: STRING, confidence: DOUBLE, text: STRING>>>"


def format_of(content: Column, content_type: Column, path: Column) -> Column:
    """pdf, image, sheet, csv, html, text or unsupported: first bytes, then content type, then extension."""
    head = F.hex(F.substring(content, 1, 8))
    kind = F.lit(None).cast("string")
    for name, magic in reversed(MAGIC):
        kind = F.when(head.startswith(magic), name).otherwise(kind)
    ext = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)(?:\?.*)?$", 1))
    t = F.lower(F.coalesce(content_type, F.lit("")))
    zipped = F.when((kind == "zip") & (ext.isin("xlsx", "xlsm") | t.contains("spreadsheet")), "sheet").when(kind == "xls", "sheet")
    webp = F.when(head.startswith("52494646") & (F.hex(F.substring(content, 9, 4)) == "57454250"), "image")
    return F.coalesce(
        F.when(kind.isin("pdf", "image"), kind), webp, zipped,
        F.when(t.contains("html") | ext.isin("html", "htm"), "html").when(t.contains("csv") | (ext == "csv"), "csv").when(t.startswith("text/") | ext.isin("txt", "md"), "text"),
        F.lit("unsupported"),
    )


def binary_documents(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Files of a folder up to the size cap, with their format."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("length") <= max_bytes)
    return files.select("path", "modificationTime", "length", "content", format_of(F.col("content"), F.lit(None).cast("string"), F.col("path")).alias("format"))


def text_pages(documents: DataFrame, sparse: int = 80) -> DataFrame:
    """(doc_id, page_number, text, chars, confidence) at form feeds; a page of few characters is trusted less."""
    p = documents.select("doc_id", F.posexplode(F.split("text", "\f")).alias("i", "text"))
    chars = F.length(F.trim("text"))
    return p.select("doc_id", (F.col("i") + 1).alias("page_number"), "text", chars.alias("chars"), F.when(chars < sparse, 0.35).otherwise(0.85).alias("confidence"))


def html_documents(pages: DataFrame) -> DataFrame:
    return pages.withColumn("text", html_to_text(F.col("html")))


def sheet_pages(spark: SparkSession, path: str) -> DataFrame:
    """Each sheet of each workbook as a page of CSV text, where a workbook reader is installed."""
    schema = "path string, page_number int, text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import io

        import pandas as pd

        for b in batches:
            rows = [(p, i + 1, f.to_csv(index=False, header=False)) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for i, f in enumerate(pd.read_excel(io.BytesIO(c), sheet_name=None, header=None).values())]
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.string())], names=["path", "page_number", "text"])

    return binary_documents(spark, path).where("format = 'sheet'").select("path", "content").mapInArrow(run, schema)


def word_boxes(spark: SparkSession, path: str) -> DataFrame:
    """Words of a tab-separated box file (level 5), with the file's name."""
    return spark.read.csv(path, sep="\t", header=True, schema=WORD_BOXES, quote="").where("level = 5 and trim(text) <> ''").withColumn("file", F.input_file_name())


def box_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """Words joined to the lines that the box file itself names."""
    by = [*keys, "page_num", "block_num", "par_num", "line_num"]
    return words.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_num", "text"))), lambda x: x["text"]), " ").alias("line"), F.avg("conf").alias("confidence"), F.min("top").alias("top"))


def layout_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """Words set into lines by place: a word joins the line whose running middle is within half the median height.

    Columns are left edges over the median character width.  A page is one group; its size is that of a page.
    """
    import statistics

    out = ", ".join(f"{k} {dict(words.dtypes)[k]}" for k in keys) + ", page_num int, line_no int, line string, confidence double"

    def lay(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: (r["top"] + r["height"] / 2, r["left"]))
        height = statistics.median(r["height"] for r in rows)
        wide = max(statistics.median(r["width"] / max(len(r["text"]), 1) for r in rows), 1)
        lines: list[list] = []
        middle = 0.0
        for r in rows:
            m = r["top"] + r["height"] / 2
            if lines and abs(m - middle) <= height / 2:
                lines[-1].append(r)
                middle += (m - middle) / len(lines[-1])
            else:
                lines.append([r])
                middle = m
        text, conf = [], []
        for line in lines:
            s = ""
            for r in sorted(line, key=lambda r: r["left"]):
                s = s.ljust(max(round(r["left"] / wide), len(s) + bool(s))) + r["text"]
            text.append(s)
            conf.append(sum(r["conf"] for r in line) / len(line))
        n = len(lines)
        head = {k: pa.array([rows[0][k]] * n, t.schema.field(k).type) for k in keys}
        return pa.table({**head, "page_num": pa.array([rows[0]["page_num"]] * n, pa.int32()), "line_no": pa.array(range(n), pa.int32()), "line": text, "confidence": conf})

    return words.groupBy(*keys, "page_num").applyInArrow(lay, out)


def records(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Valid and invalid corpus records of gzip JSON lines; an unreadable line is invalid."""
    raw = spark.read.schema(RECORD + ", _corrupt_record STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    good = F.col("_corrupt_record").isNull() & F.col("source_url").isNotNull() & (F.col("key") == record_key(F.col("source_url"))) & F.col("document").isNotNull() & F.col("extracted_at").isNotNull()
    good = F.coalesce(good, F.lit(False))
    marked = raw.withColumn("_good", good)
    return marked.where("_good").drop("_good", "_corrupt_record"), marked.where("not _good").drop("_good")


def newest_artifacts(spark: SparkSession, path: str, pattern: str = r"/run-?([0-9]+)/.*?([0-9]+)\.json$") -> DataFrame:
    """Path of the newest run's artifact of each filing under a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")
    named = files.select("path", F.regexp_extract("path", pattern, 1).try_cast("long").alias("run"), F.nullif(F.regexp_extract("path", pattern, 2), F.lit("")).alias("filing"))
    return named.where("filing is not null").groupBy("filing").agg(F.max_by("path", "run").alias("path"), F.max("run").alias("run"))


def payloads(spark: SparkSession, path: str, version: int = 2) -> DataFrame:
    """Payloads of one schema version under a folder."""
    return spark.read.option("recursiveFileLookup", "true").option("multiLine", "true").json(path).where(F.col("schemaVersion") == version)


def answer_keys(rows: DataFrame) -> DataFrame:
    """Answers merged from several files: the later file wins for an item.  ``rows``: file_ord, url, label, item, expected."""
    parts = F.split("label", r"\|")
    merged = rows.groupBy("url", "label", "item").agg(F.max_by("expected", "file_ord").alias("expected"))
    return merged.select("url", parts[0].alias("statement"), F.try_to_date(parts[1]).alias("period_end"), parts[2].try_cast("int").alias("months"), F.try_element_at(parts, F.lit(4)).alias("basis"), "item", "expected")


def price_series(raw: DataFrame) -> DataFrame:
    """(symbol, ts, close) of (epoch seconds, close) pairs; only positive closes count."""
    return raw.where("close > 0").select("symbol", F.timestamp_seconds("epoch").alias("ts"), F.col("close").cast("double").alias("close"))


def hints(entries: DataFrame, known: DataFrame) -> DataFrame:
    """A filing's reviewer hints count only if every one of them is valid."""
    checked = entries.join(known.select("filing", "page").withColumn("_ok", F.lit(True)), ["filing", "page"], "left")
    whole = checked.groupBy("filing").agg(F.every(F.coalesce("_ok", F.lit(False)) & F.col("kind").isin("income", "balance", "cash_flow")).alias("valid"))
    return entries.join(whole.where("valid"), "filing", "left_semi")


def page_selection(pages: DataFrame, cited: str, most: int = 150) -> DataFrame:
    """Evidence pages: cited first, at most ``most`` of each filing, in page order."""
    w = Window.partitionBy("filing").orderBy(F.col(cited).desc(), "page_number")
    return pages.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most).drop("_n")
