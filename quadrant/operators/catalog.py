"""Catalogue queries over the quad table: graph-pattern joins (J1-J4, J6),
group-concat (A1), filters (F1-F5), union / keep-first (U1), ordering (O1-O4)
and latest-by-title (A6).

Each triple pattern is a filtered scan of the quad table (p = ..., pushed to
Parquet); patterns sharing a variable become equi-joins that Catalyst orders
and AQE re-plans. Fixed-object patterns (`a core:Text`, `lastUser harvester`)
are existence checks, hence semi-joins. The ids of the graph (layer, media,
segment, url) are joined first; the properties of a segment share its subject, so
over a store bucketed by subject they join without a shuffle, and so does the
aggregation by segment: only ids
move (and, in J2, its distinct rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.session import written


def pattern(quads: DataFrame, p: str, s_as: str, o_as: str | None = None,
            o_value: str | None = None, lang: str | None = None) -> DataFrame:
    """Bindings of one triple pattern `?s_as <p> ?o_as` (or a fixed object)."""
    q = quads.where(F.col("p") == p)
    if o_value is not None:
        q = q.where(F.col("o") == o_value)
    if lang is not None:
        q = q.where(F.col("o_lang") == lang)
    cols = [F.col("s").alias(s_as)]
    if o_as:
        cols.append(F.col("o").alias(o_as))
    return q.select(cols)


def typed(quads: DataFrame, cls: str, as_: str = "media") -> DataFrame:
    return pattern(quads, K.RDF_TYPE, as_, o_value=cls).distinct()


def media_segments(quads: DataFrame) -> DataFrame:
    """?layer core:document ?media . ?layer core:segment ?media_seg ."""
    doc = pattern(quads, K.CORE_DOCUMENT, "layer", "media")
    segl = pattern(quads, K.CORE_SEGMENT, "layer", "media_seg")
    return doc.join(segl, "layer")


def media_urls(quads: DataFrame) -> DataFrame:
    """?media core:instance ?i . ?i core:http_url ?url ."""
    inst = pattern(quads, K.CORE_INSTANCE, "media", "instance")
    url = pattern(quads, K.CORE_HTTP_URL, "instance", "url")
    return inst.join(url, "instance").drop("instance")


def segment_ids(quads: DataFrame, media_class: str) -> DataFrame:
    """(media, media_seg, url) of the media typed `media_class`: ids only, no texts."""
    return (media_segments(quads).drop("layer").join(typed(quads, media_class), "media", "left_semi")
            .join(media_urls(quads), "media"))


def group_concat(rows: DataFrame, keys: list[str], label_col: str = "lab1",
                 keyword_col: str = "keyword") -> DataFrame:
    """A1: distinct labels joined by ' | ', keywords (not distinct) by ', '.

    The keyword list keeps the label x keyword fan-out of the solution multiset;
    both lists are sorted so the result is deterministic.
    """
    return rows.groupBy(keys).agg(
        F.expr(f"listagg(DISTINCT {label_col}, ' | ') WITHIN GROUP (ORDER BY {label_col})").alias("lab"),
        F.expr(f"listagg({keyword_col}, ', ') WITHIN GROUP (ORDER BY {keyword_col})").alias("keywords"),
    )


def text_documents(quads: DataFrame, media_class: str = K.CORE_TEXT) -> DataFrame:
    """Harvested text documents with labels, description, keywords, date, url."""
    seg_props = (pattern(quads, K.RDFS_LABEL, "media_seg", "lab1")
                 .join(pattern(quads, K.CORE_CREATION_DATE, "media_seg", "creation_date"), "media_seg")
                 .join(pattern(quads, K.DC_DESCRIPTION, "media_seg", "presentation"), "media_seg")
                 .join(pattern(quads, K.DC_SUBJECT, "media_seg", "keyword"), "media_seg")
                 .join(pattern(quads, K.CORE_LAST_USER, "media_seg", o_value=K.HARVESTER), "media_seg", "left_semi"))
    rows = seg_props.join(segment_ids(quads, media_class), "media_seg")
    return group_concat(rows, ["media", "url", "presentation", "media_seg", "creation_date"])


def temporal_documents(quads: DataFrame) -> DataFrame:
    """J3 (connected form): temporal documents, title as label, keywords concatenated."""
    seg_props = (pattern(quads, K.DC_TITLE, "media_seg", "lab1")
                 .join(pattern(quads, K.DC_DESCRIPTION, "media_seg", "presentation"), "media_seg")
                 .join(pattern(quads, K.CORE_CREATION_DATE, "media_seg", "creation_date"), "media_seg")
                 .join(pattern(quads, K.DC_SUBJECT, "media_seg", "keyword"), "media_seg"))
    rows = seg_props.join(segment_ids(quads, K.CORE_TEMPORAL_DOCUMENT), "media_seg")
    return (rows.groupBy("lab1", "media", "url", "presentation", "media_seg", "creation_date")
                .agg(F.expr("listagg(keyword, ', ') WITHIN GROUP (ORDER BY keyword)").alias("keywords"))
                .withColumnRenamed("lab1", "lab"))


def interviews(quads: DataFrame) -> DataFrame:
    """Distinct (media, title, title2, url, creation_date) of temporal documents."""
    seg_props = (pattern(quads, K.DC_TITLE, "media_seg", "title")
                 .join(pattern(quads, K.DC_TITLE2, "media_seg", "title2"), "media_seg")
                 .join(pattern(quads, K.CORE_CREATION_DATE, "media_seg", "creation_date"), "media_seg"))
    rows = seg_props.join(segment_ids(quads, K.CORE_TEMPORAL_DOCUMENT), "media_seg")
    return rows.select("media", "title", "title2", "url", "creation_date").distinct()


def filter_collection(rows: DataFrame, needle: str, col: str = "title2") -> DataFrame:
    """case-insensitive substring filter."""
    return rows.where(F.lower(F.col(col)).contains(needle.lower()))


def filter_by_type(quads: DataFrame, cls: str) -> DataFrame:
    """subjects typed `cls`."""
    return typed(quads, cls)


def titles_in_lang(quads: DataFrame, titles: DataFrame, lang: str = "fr") -> DataFrame:
    """segments whose title equals one of `titles` with language tag `lang`."""
    t = pattern(quads, K.DC_TITLE, "media_seg", "title", lang=lang)
    return t.join(titles.select("title").distinct(), "title", "left_semi")


#: rows of one title on either side of a cell of `lookup_titles`: a cell makes at most about the square of it
CELL_ROWS = 512


def lookup_titles(quads: DataFrame, titles: DataFrame, lang: str = "fr", cell: int = CELL_ROWS) -> DataFrame:
    """Each asked title -> its catalogue media; unmatched titles give no row,
    repeated titles give repeated rows (no distinct).

    A title asked n times that m segments bear has n x m rows. The catalogue's side is
    joined to (title, media, url) first, so these rows are made by the last join and never
    shuffled. The rows of a title with more than `cell` of them on a side are dealt to
    cells of about `cell` by `cell` rows, and each cell is a key of its own: the rows of a
    frequent title are made by many tasks."""
    t = pattern(quads, K.DC_TITLE, "media_seg", "title", lang=lang)
    asked = written(titles.where(F.col("title").isNotNull()).select("line_no", "title"), "asked-titles")
    found = written(t.join(asked.select("title"), "title", "left_semi")
                     .join(media_segments(quads).drop("layer"), "media_seg")
                     .join(media_urls(quads), "media")
                     .select("title", "media", "url", F.xxhash64("media_seg", "media", "url").alias("_hash")), "titled-media")
    cells = lambda n: F.ceil(F.col(n) / cell).cast("int")
    many = written(asked.groupBy("title").agg(F.count(F.lit(1)).alias("n"))
                        .join(found.groupBy("title").agg(F.count(F.lit(1)).alias("m")), "title")
                        .where((F.col("n") > cell) | (F.col("m") > cell))
                        .select("title", cells("n").alias("_rows"), cells("m").alias("_cols")), "many-titles")

    def dealt(side: DataFrame, own: str, other: str, by: Column) -> DataFrame:
        """Rows with the cells that they belong to: one of their own side, all of the other."""
        return (side.join(many, "title", "left")
                    .withColumn(own, F.coalesce(F.pmod(by, F.col(own)), F.lit(0)).cast("int"))
                    .withColumn(other, F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))))
    n = int(quads.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["title", "_rows", "_cols"]
    lines = dealt(asked, "_rows", "_cols", F.xxhash64("line_no")).repartition(n, *key)
    media = dealt(found, "_cols", "_rows", F.col("_hash")).repartition(n, *key)
    return lines.join(media, key).select("line_no", "title", "media", "url")


def recent(rows: DataFrame, as_of: str, days: int, date_col: str = "created") -> DataFrame:
    """datediff(as_of, date) < days; future dates pass."""
    return rows.where(F.datediff(F.lit(as_of).cast("date"), F.to_date(F.col(date_col))) < days)


def keep_first(rows: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """A3: first row per key by `order` (ascending, nulls first).

    An aggregate, not a window: `min_by(row, order)` is combined map-side, so a
    key holding a large share of the rows is reduced before the shuffle instead
    of being sorted in one task. `order` must make rows unique within a key.
    """
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(
        F.min_by(F.struct(*rest), F.struct(*[F.col(c) for c in order])).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(rows.columns)


def catalog_union(text_docs: DataFrame, temporal_docs: DataFrame) -> DataFrame:
    """Text documents (by url) then temporal documents (by date), first per media."""
    cols = ["lab", "media", "url", "presentation", "keywords", "media_seg", "creation_date"]
    a = text_docs.select(cols).withColumn("src_rank", F.lit(1)).withColumn("sort_key", F.col("url"))
    b = temporal_docs.select(cols).withColumn("src_rank", F.lit(2)).withColumn("sort_key", F.col("creation_date"))
    u = a.unionByName(b).withColumn("src_rank", F.col("src_rank").cast("bigint"))
    return keep_first(u, "media", ["src_rank", "sort_key", "media_seg", "lab", "presentation", "keywords"]) \
        .drop("sort_key")


def latest_media_by_title(rows: DataFrame, title_col: str = "title", date_col: str = "created") -> DataFrame:
    """Per title, the media of the latest date (ties: larger media)."""
    return rows.groupBy(title_col).agg(
        F.max_by("media", F.struct(F.col(date_col), F.col("media"))).alias("media"),
        F.max(date_col).cast("string").alias("created"))


def class_closure(edges: DataFrame) -> DataFrame:
    """Transitive closure (child, ancestor) of a class hierarchy of any depth.

    Each round joins the closure so far with itself (paths double in length) and
    adds the pairs that are new; a round without new pairs ends it, so cycles and
    diamonds end too. Rounds are written to the shared folder, so the plan
    doesn't grow with them.
    """
    closure = written(edges.select("child", F.col("parent").alias("ancestor")).distinct(), "closure")
    while True:
        further = closure.select(F.col("child").alias("ancestor"), F.col("ancestor").alias("above"))
        new = written(closure.join(further, "ancestor").select("child", F.col("above").alias("ancestor")).distinct()
                             .join(closure, ["child", "ancestor"], "left_anti"), "closure-new")
        if new.isEmpty():
            return closure
        closure = written(closure.unionByName(new), "closure")


def instances_with_inference(instances: DataFrame, edges: DataFrame) -> DataFrame:
    """(instance, class) for the direct class and every transitive superclass.
    The closure is a written table: the planner sees its size and broadcasts it
    if that is small, so the few distinct classes don't become hot shuffle keys."""
    clo = class_closure(edges)
    inferred = instances.join(clo, instances["class"] == clo["child"]).select("instance", F.col("ancestor").alias("class"))
    return instances.select("instance", "class").unionByName(inferred).distinct()


def page(rows: DataFrame, pos_col: str, start: int, size: int) -> DataFrame:
    """O2: rows [start, start + size) by a stored position."""
    return rows.where((F.col(pos_col) >= start) & (F.col(pos_col) < start + size))


def tail(rows: DataFrame, n: int, order: list[str]) -> DataFrame:
    """O3: the last n rows by `order` (a top-k, planned as TakeOrderedAndProject)."""
    return rows.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def rollback_to_date(results: DataFrame, date: str, pos_col: str = "ord",
                     date_col: str = "created") -> DataFrame:
    """Keep results up to the last row of `date` (scalar subquery on max pos)."""
    cut = results.where(F.col(date_col) == F.lit(date).cast("date")).select(F.max(pos_col))
    return results.where(F.col(pos_col) <= cut.scalar())
