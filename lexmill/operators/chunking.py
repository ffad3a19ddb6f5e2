"""Splitting texts, documents and page lists, and putting results back together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARAGRAPH, LINE = "\n\n", "\n"


def _pieces(text: Column, sep: str) -> Column:
    """Parts between separators; empty ones at the end are dropped, but never the first."""
    parts = F.split(text, sep, -1)
    filled = F.transform(parts, lambda p, i: F.when(p != "", i + 1))
    return F.slice(parts, F.lit(1), F.greatest(F.coalesce(F.array_max(filled), F.lit(1)), F.lit(1)))


def _cut(text: Column, size: int, overlap: int) -> Column:
    """Fixed windows over a text that has at least one character."""
    starts = F.sequence(F.lit(0), F.length(text) - 1, F.lit(size - overlap))
    return F.transform(starts, lambda i: F.substring(text, i + 1, F.lit(size)))


def _pack(pieces: Column, sep: str, extra: int, size: int, overlap: int, split_large) -> Column:
    """Fill chunks up to `size` with whole pieces; larger pieces go to `split_large`."""
    none = F.array().cast("array<string>")

    def state(chunks: Column, current: Column) -> Column:
        return F.struct(chunks.alias("chunks"), current.alias("current"))

    def closed(acc: Column) -> Column:
        return F.when(acc["current"] == "", acc["chunks"]).otherwise(F.concat(acc["chunks"], F.array(acc["current"])))

    def step(acc: Column, piece: Column) -> Column:
        current = acc["current"]
        tail = F.when((F.length(current) > overlap) & (F.lit(overlap) > 0), F.concat(F.right(current, F.lit(overlap)), F.lit(2 * sep)))
        longer = F.when(current == "", piece).otherwise(F.concat(current, F.lit(sep), piece))
        full = (current != "") & (F.length(current) + F.length(piece) + extra > size)
        return (
            F.when(F.length(piece) > size, state(F.concat(closed(acc), split_large(piece)), F.lit("")))
            .when(full, state(closed(acc), F.concat(F.coalesce(tail, F.lit("")), piece)))
            .otherwise(state(acc["chunks"], longer))
        )

    return F.aggregate(pieces, state(none, F.lit("")), step, closed)


def split_paragraphs(text: Column, size: int, overlap: int) -> Column:
    """Chunks of one text: paragraphs first, then lines, then fixed cuts."""

    def by_lines(paragraph: Column) -> Column:
        rows = _pieces(paragraph, LINE)
        packed = _pack(rows, LINE, 1, size, overlap, lambda line: _cut(line, size, overlap))
        return F.when(F.size(rows) > 1, packed).otherwise(_cut(paragraph, size, overlap))

    packed = _pack(_pieces(text, PARAGRAPH), PARAGRAPH, len(PARAGRAPH), size, overlap, by_lines)
    return F.when(F.length(text) <= size, F.array(text)).otherwise(packed)


def paragraph_chunks(texts: DataFrame, id_col: str, size: int, overlap: int, text_col: str = "text") -> DataFrame:
    """(id, chunk_index, total_chunks, chunk) of every text; the packing is a fold over its pieces."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    return (
        texts.where(F.col(text_col).isNotNull())
        .select(id_col, split_paragraphs(F.col(text_col), size, overlap).alias("chunks"))
        .select(id_col, F.size("chunks").alias("total_chunks"), F.posexplode("chunks").alias("chunk_index", "chunk"))
        .select(id_col, "chunk_index", "total_chunks", "chunk")
    )


def window_chunks(texts: DataFrame, id_col: str, size: int, overlap: int, text_col: str = "text") -> DataFrame:
    """Fixed windows with overlap: (id, chunk_index, total_chunks, start, end, chunk).

    An empty text is one empty chunk, a null text one null chunk. The windows of a text become an
    array before they become rows, so no row carries the whole text.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    text, n = F.col(text_col), F.length(text_col)
    count = F.greatest(F.lit(1), F.coalesce(F.ceil((n - overlap) / F.lit(step)), F.lit(1))).cast("int")

    def window(i: Column) -> Column:
        start = (i - 1) * step
        return F.struct(
            i.alias("chunk_index"), count.alias("total_chunks"), start.alias("start"),
            F.least(start + size, F.coalesce(n, start + size)).alias("end"), F.substring(text, start + 1, F.lit(size)).alias("chunk"),
        )

    return texts.select(id_col, F.inline(F.transform(F.sequence(F.lit(1), count), window)))


def whole_text(texts: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """The strategy that never splits."""
    return texts.select(
        id_col,
        F.lit(0).alias("chunk_index"),
        F.lit(1).alias("total_chunks"),
        F.col(text_col).alias("chunk"),
    )


def join_parts(
    parts: DataFrame,
    keys: Sequence[str],
    position: str,
    text_col: str,
    separator: str = PARAGRAPH,
    per_row: int = 1024,
) -> DataFrame:
    """Join the parts of each document in order: (keys, row_no, text).

    A row takes at most `per_row` consecutive positions, so a document of any length is spread
    over several rows whose texts, joined by the separator, are the whole.
    """
    row_no = F.floor(F.col(position) / per_row).cast("int").alias("row_no")
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(text_col).alias("t"))))
    return (
        parts.groupBy(*keys, row_no)
        .agg(ordered.alias("__parts"))
        .select(*keys, "row_no", F.array_join(F.transform("__parts", lambda x: x["t"]), separator).alias("text"))
    )


def chunk_numbers(sizes: Column, head: Column, limit: int) -> Column:
    """Chunk number of each item when items are packed until head + sizes exceed `limit`."""
    start = F.struct(
        F.lit(0).alias("chunk"), F.lit(0).cast("long").alias("used"), F.array().cast("array<int>").alias("out")
    )

    def step(acc: Column, item: Column) -> Column:
        full = (acc["used"] > 0) & (head + acc["used"] + item > limit)
        chunk = acc["chunk"] + full.cast("int")
        return F.struct(
            chunk.alias("chunk"),
            F.when(full, item).otherwise(acc["used"] + item).cast("long").alias("used"),
            F.concat(acc["out"], F.array(chunk)).alias("out"),
        )

    return F.aggregate(sizes, start, step, lambda acc: acc["out"])


def article_chunks(
    docs: DataFrame, id_col: str, articles: str, head: Column, limit: int, sizes: Column | None = None
) -> DataFrame:
    """Pack the articles of a document into chunks; every chunk repeats the document's metadata.

    One row per chunk: (id, chunk_index, articles). Documents below the limit stay whole. An
    article counts with the length of its JSON text unless `sizes` says otherwise.
    """
    if sizes is None:
        sizes = F.transform(articles, lambda a: F.length(F.to_json(a)).cast("long"))
    whole = head + F.aggregate(sizes, F.lit(0).cast("long"), lambda acc, x: acc + x) <= limit
    numbers = F.when(whole, F.transform(articles, lambda a: F.lit(0))).otherwise(chunk_numbers(sizes, head, limit))
    # Chunk numbers never fall, so a chunk is one slice; no row carries the other chunks' articles.
    def chunk(k: Column) -> Column:
        size = F.size(F.filter(F.col("__no"), lambda n: n == k))
        return F.struct(k.alias("chunk_index"), F.slice("__all", F.array_position("__no", k).cast("int"), size).alias("articles"))

    numbered = docs.select(id_col, F.col(articles).alias("__all"), numbers.alias("__no"))
    return numbered.select(id_col, F.inline(F.transform(F.array_distinct("__no"), chunk)))


def merge_chunk_articles(articles: DataFrame, id_col: str, index: str, order: Sequence[Column]) -> DataFrame:
    """First article per (document, index) over all chunks.

    `min_by` combines repeats before the shuffle, where a ranking window could not.
    """
    rest = F.struct(*[F.col(c) for c in articles.columns if c not in (id_col, index)])
    return (
        articles.groupBy(id_col, index)
        .agg(F.min_by(rest, F.struct(*order)).alias("__r"))
        .select(id_col, index, "__r.*")
        .select(*articles.columns)
    )


def concat_chunk_articles(chunks: DataFrame, id_col: str, chunk: str, articles: str) -> DataFrame:
    """All articles of a document's chunks in order, one row per article (position is 0-based
    within its chunk), so that a document of any number of chunks stays distributed."""
    return chunks.select(id_col, chunk, F.posexplode(articles).alias("position", "article")).select(
        id_col, chunk, "position", "article.*"
    )


def page_batches(pages: DataFrame, id_col: str, page: str, max_pages: int) -> DataFrame:
    """Batches of consecutive pages: (id, batch_index, first_page, last_page, n_pages, total_batches)."""
    batches = pages.groupBy(id_col, F.floor(F.col(page) / max_pages).cast("int").alias("batch_index")).agg(
        F.min(page).alias("first_page"), F.max(page).alias("last_page"), F.count(F.lit(1)).alias("n_pages")
    )
    totals = batches.groupBy(id_col).agg(F.count(F.lit(1)).alias("total_batches"))
    return batches.join(totals, id_col)


def kept_pages(pages: DataFrame, id_col: str, page: str, text_col: str, stop_word: str = "AMPLIATIONS") -> DataFrame:
    """Pages up to and including the first with the stop word, blank ones left out, with banners.

    The stop page and the page count are plain aggregates joined back, so the pages of one
    document never have to meet in one task.
    """
    hit = F.upper(text_col).contains(stop_word)
    stops = pages.groupBy(id_col).agg(
        F.min(F.when(hit, F.col(page))).alias("__stop"),
        F.max(page).alias("__last"),
        F.min(page).alias("__first"),
    )
    total = F.col("__last") - F.col("__first") + 1
    banner = F.format_string(
        "\n\n=== Page %d/%d ===\n\n", F.col(page) - F.col("__first") + 1, total
    )
    return (
        pages.join(stops, id_col)
        .where((F.col("__stop").isNull() | (F.col(page) <= F.col("__stop"))) & (F.length(F.btrim(F.col(text_col), F.lit(" \t\n\r"))) > 0))
        .withColumn("page_text", F.when(total > 1, F.concat(banner, F.col(text_col))).otherwise(F.col(text_col)))
        .drop("__stop", "__last", "__first")
    )
