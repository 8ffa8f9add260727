"""Adapters: derive the catalogue, transcript and vocabulary shapes from the
driver's tables (FIXTURES part B). Each adapter reads whole tables, so the work
grows with the data; nothing is sampled or capped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import ms_to_seconds_text

DOC_PREFIX = "http://example.org/doc/"
SEG_PREFIX = "http://example.org/seg/"
LAYER_PREFIX = "http://example.org/layer/"
HAL_EXAMPLE_PREFIX = "http://example.org/asa#oai:HAL:"
NAKALA_EXAMPLE_PREFIX = "https://api.nakala.example/data/10.34847/nkl."
AS_OF = "2024-02-15"
RECENT_DAYS = 10


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, resolved (listing, footers) once per application."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, id(spark), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


def _first_line(c):
    # substring_index stops at the first separator; split_part would split the whole text
    return F.substring_index(c, "\n", 1)


def _words(c):
    """The words of the whole text."""
    return F.filter(F.split(c, "[ \n]+"), lambda x: x != "")


def _media_uri(conv_id, hal_version):
    """Media URI of a conversation: two providers, by the id."""
    mkey = F.concat(F.lit("hal-"), F.lpad(conv_id.cast("string"), 8, "0"))
    return (F.when(conv_id % 4 != 0, F.concat(F.lit(HAL_EXAMPLE_PREFIX), mkey, hal_version))
             .otherwise(F.concat(F.lit(NAKALA_EXAMPLE_PREFIX), conv_id.cast("string"))))


def cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text-document catalogue rows, one per document (segment)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", _words(F.col("text")).alias("_words"))
    media_num = F.when(F.col("doc_id") % 10 == 9, F.col("doc_id") - 1).otherwise(F.col("doc_id"))
    first = _first_line(F.col("text"))
    media = F.concat(F.lit(DOC_PREFIX), media_num.cast("string"))
    return d.select(
        F.col("doc_id").alias("ord"),
        F.col("doc_id"),
        media.alias("media"),
        F.concat(F.lit(SEG_PREFIX), F.col("doc_id").cast("string")).alias("media_seg"),
        F.concat(F.lit(LAYER_PREFIX), media_num.cast("string")).alias("layer"),
        F.concat(media, F.lit("/instance")).alias("instance"),
        F.when(F.col("doc_id") % 3 == 0, F.lit(K.CORE_TEMPORAL_DOCUMENT))
         .otherwise(F.lit(K.CORE_TEXT)).alias("media_type"),
        F.concat_ws(" ", "lang", "source").alias("label"),
        F.col("lang"),
        F.col("source"),
        F.concat(F.col("text"), F.lit(" | "), F.col("source"), F.lit(" | "), F.col("source")).alias("presentation"),
        F.array_min("_words").alias("k1"),
        F.array_max("_words").alias("k2"),
        F.try_element_at("_words", F.lit(-1)).alias("k3"),
        F.when(F.col("doc_id") % 7 == 0, F.lit("editor")).otherwise(F.lit("harvester")).alias("last_user"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 60).cast("int")).alias("created"),
        first.alias("title"),
        F.col("lang").alias("title_lang"),
        F.concat(F.lit("Programme "), F.col("source")).alias("title2"),
        F.concat(media, F.lit("/document")).alias("url"),
    )




def _q(s, p, o, g, kind, datatype=None, lang=None):
    none = F.lit(None).cast("string")
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), g.alias("g"),
                    F.lit(kind).alias("o_kind"),
                    (F.lit(datatype) if datatype else none).alias("o_datatype"),
                    (lang if lang is not None else none).alias("o_lang"))


def catalog_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue graph as quads (media, layers, segments, literals). Documents of one
    media repeat its quads; the store removes repeats when it places them."""
    c = cat(spark, sf_dir)
    m, seg, layer, inst = F.col("media"), F.col("media_seg"), F.col("layer"), F.col("instance")
    none = F.lit(None).cast("string")
    keep_subject = F.col("doc_id") % 11 != 0
    quads = F.array(
        _q(m, K.RDF_TYPE, F.col("media_type"), m, "uri"),
        _q(layer, K.CORE_DOCUMENT, m, layer, "uri"),
        _q(layer, K.CORE_SEGMENT, seg, layer, "uri"),
        _q(seg, K.RDFS_LABEL, F.col("label"), seg, "literal"),
        _q(seg, K.RDFS_LABEL, F.when(F.col("doc_id") % 5 == 0, F.col("lang")).otherwise(none), seg, "literal"),
        _q(seg, K.DC_DESCRIPTION, F.col("presentation"), seg, "literal"),
        _q(seg, K.DC_SUBJECT, F.when(keep_subject, F.col("k1")).otherwise(none), seg, "literal"),
        _q(seg, K.DC_SUBJECT, F.when(keep_subject, F.col("k2")).otherwise(none), seg, "literal"),
        _q(seg, K.DC_SUBJECT, F.when(keep_subject, F.col("k3")).otherwise(none), seg, "literal"),
        _q(seg, K.CORE_CREATION_DATE, F.col("created").cast("string"), seg, "literal"),
        _q(seg, K.CORE_LAST_USER, F.concat(F.lit(K.USER), F.col("last_user")), seg, "uri"),
        _q(seg, K.DC_TITLE, F.col("title"), seg, "literal", lang=F.col("title_lang")),
        _q(seg, K.DC_TITLE2, F.col("title2"), seg, "literal"),
        _q(m, K.CORE_INSTANCE, inst, m, "uri"),
        _q(inst, K.CORE_HTTP_URL, F.col("url"), m, "literal"),
    )
    return (c.select(F.inline(F.array_distinct(quads)))
             .where(F.col("o").isNotNull() & (F.col("o") != "")))


def seg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed transcript segments derived from conversations (one media per conv)."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.trim(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    mkey = F.concat(F.lit("hal-"), F.lpad(F.col("conv_id").cast("string"), 8, "0"))
    media = _media_uri(F.col("conv_id"), F.lit("v1"))
    s = (c.select("conv_id", "turn", "role", text.alias("text"))
          .withColumn("len", F.length("text").cast("bigint"))
          .withColumn("end_ms", F.sum(F.col("len") * 40).over(w))
          .withColumn("start_ms", F.col("end_ms") - F.col("len") * 40))
    return s.select(
        F.col("turn").alias("ord"),
        "conv_id", "turn", "role",
        mkey.alias("mkey"),
        media.alias("media"),
        "start_ms", "end_ms",
        ms_to_seconds_text("start_ms").alias("start_raw"),
        ms_to_seconds_text("end_ms").alias("end_raw"),
        "text",
        F.when(F.col("role") == "system", F.lit(None).cast("double"))
         .otherwise((F.col("len") % 100).cast("double") / 100).alias("confidence"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected-transcript lines 'start-end : text' (blank text on every 3rd turn)."""
    s = seg(spark, sf_dir)
    body = F.when(F.col("turn") % 3 == 2, F.lit("")).otherwise(F.col("text"))
    return s.select(F.col("mkey").alias("file"), F.col("turn").alias("line_no"),
                    F.concat(F.col("start_raw"), F.lit("-"), F.col("end_raw"), F.lit(" : "), body).alias("line"))


def vocab_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vocabulary rows in file order, with first-match copies and exact duplicates."""
    b = table(spark, sf_dir, "benchmark").select("item_id", "text")
    label = F.concat(F.split_part("text", F.lit(" "), F.lit(1)), F.lit(" "),
                     F.split_part("text", F.lit(" "), F.lit(2)))
    base = b.select(
        F.col("item_id"),
        label.alias("strLabel"),
        F.concat(F.lit("class"), (F.col("item_id") % 5).cast("string")).alias("subclass"),
        F.concat(F.lit("urn:e:"), F.col("item_id").cast("string")).alias("entity"),
        F.concat(F.lit("urn:c:"), (F.col("item_id") % 5).cast("string")).alias("uriclass"),
        F.concat(F.lit("list"), (F.col("item_id") % 3).cast("string")).alias("list_name"),
    )
    originals = base.withColumn("ord", F.col("item_id"))
    copies = (base.where(F.col("item_id") < 5)
                  .withColumn("entity", F.concat("entity", F.lit(":copy")))
                  .withColumn("ord", F.col("item_id") + 1000000))
    dups = base.where(F.col("item_id") % 10 == 7).withColumn("ord", F.col("item_id") + 2000000)
    cols = ["ord", "strLabel", "subclass", "entity", "uriclass", "list_name"]
    return originals.select(cols).unionByName(copies.select(cols)).unionByName(dups.select(cols))


def class_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.select(F.concat(F.lit("nation/"), F.col("n_nationkey").cast("string")).alias("child"),
                     F.concat(F.lit("region/"), F.col("n_regionkey").cast("string")).alias("parent"))
             .unionByName(r.select(F.concat(F.lit("region/"), F.col("r_regionkey").cast("string")).alias("child"),
                                   F.lit("World").alias("parent"))))


def typed_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("instance"),
                    F.concat(F.lit("nation/"), F.col("c_nationkey").cast("string")).alias("class"))


def raters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form ratings (unit, rater, value); 'length' is missing on every 3rd doc."""
    lab = table(spark, sf_dir, "labels")
    doc = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    j = lab.join(doc, "doc_id")
    arr = F.array(
        F.struct(F.lit("quality").alias("rater"), F.col("quality").cast("bigint").alias("value")),
        F.struct(F.lit("safe").alias("rater"), (1 - F.col("toxic")).cast("bigint").alias("value")),
        F.struct(F.lit("length").alias("rater"),
                 F.when(F.col("doc_id") % 3 != 0, (F.col("n_chars") > 1000).cast("bigint"))
                  .alias("value")),
    )
    return (j.select(F.col("doc_id").alias("unit"), F.inline(arr))
             .where(F.col("value").isNotNull()))


def title_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles asked for by staff: first lines of the fr and en documents, in doc order."""
    d = table(spark, sf_dir, "documents").where(F.col("lang").isin("fr", "en"))
    return d.select(F.col("doc_id").alias("line_no"), _first_line(F.col("text")).alias("title"))


def _conv_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id").distinct()


def tcat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcript catalogue (the interviews CSV): media with a version suffix
    (v2 on some), and 'entretien avec <speaker> (...)' titles shared by several media."""
    c = _conv_ids(spark, sf_dir)
    media = _media_uri(F.col("conv_id"), F.when(F.col("conv_id") % 6 == 1, F.lit("v2")).otherwise(F.lit("v1")))
    title = F.concat(F.lit("entretien avec Speaker "), (F.col("conv_id") % 40).cast("string"),
                     F.lit(" (entretien "), F.col("conv_id").cast("string"), F.lit(")"))
    return c.select(F.col("conv_id").alias("ord"), media.alias("media"), title.alias("title"))


def txt_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected TXT file names: key-carrying export names, or speaker names."""
    c = _conv_ids(spark, sf_dir)
    mkey = F.concat(F.lit("hal-"), F.lpad(F.col("conv_id").cast("string"), 8, "0"))
    name = (F.when(F.col("conv_id") % 5 == 0, F.concat(F.lit("export__."), mkey, F.lit("v1.lintoai.txt")))
             .otherwise(F.concat(F.lit("entretien avec Speaker "), (F.col("conv_id") % 45).cast("string"),
                                 F.lit(" (revu "), F.col("conv_id").cast("string"), F.lit(").txt"))))
    return c.select(name.alias("txtname"))


def transcript_file_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the transcript files that exist (media not yet transcribed have none)."""
    from quadrant.functions.expressions import media_key
    s = seg(spark, sf_dir).where(F.col("conv_id") % 5 != 0).select("media").distinct()
    return s.select(media_key("media").alias("file_key"))


def transcript_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, media): the media of every transcript file key (no segment scan)."""
    c = _conv_ids(spark, sf_dir)
    mkey = F.concat(F.lit("hal-"), F.lpad(F.col("conv_id").cast("string"), 8, "0"))
    media = _media_uri(F.col("conv_id"), F.lit("v1"))
    return c.select(mkey.alias("file"), media.alias("media"))
