"""Quad sets: transcript -> quads (X4), delete / replace a transcription
(J11, J12), N-Quads serialisation and parsing (K6, S7), and 500-quad update
requests (K7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import layer_uri, nq_line, nq_object, nq_unescape, segment_uri
from quadrant.operators.positions import dense_position
from quadrant.operators.transcripts import segment_timecodes
from quadrant.sources.store import QUAD_COLUMNS


def register(spark, source) -> None:
    from quadrant.session import ship_package
    ship_package(spark)
    spark.dataSource.register(source)


def _none():
    return F.lit(None).cast("string")


def _quad(s, p, o, g, kind, datatype=None):
    return F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), g.alias("g"),
                    F.lit(kind).alias("o_kind"),
                    (F.lit(datatype) if datatype else _none()).alias("o_datatype"),
                    _none().alias("o_lang"))


def segments_to_quads(seg: DataFrame, media_col: str = "media", keep: tuple[str, ...] = ()) -> DataFrame:
    """One layer graph per media (type, label, document, one segment link per
    segment) and one graph per segment (begin/end/duration as time code and time
    ref, type, text, optional confidence): 3 + 9n (+1 per confidence) quads
    before set dedupe. Layer rows come from a distinct over media, so nothing is
    gathered per media."""
    s = segment_timecodes(seg).withColumn("_layer", layer_uri(media_col))
    s = s.withColumn("_seg", segment_uri("_layer", "start_raw"))
    layer, segu = F.col("_layer"), F.col("_seg")
    per_seg = F.array(
        _quad(layer, K.CORE_SEGMENT, segu, layer, "uri"),
        _quad(segu, K.CORE_BEGIN_TIME, F.col("begin_tc"), segu, "literal"),
        _quad(segu, K.CORE_BEGIN_TIME_TR, F.col("begin_tr").cast("string"), segu, "literal", K.XSD_INTEGER),
        _quad(segu, K.CORE_END_TIME, F.col("end_tc"), segu, "literal"),
        _quad(segu, K.CORE_END_TIME_TR, F.col("end_tr").cast("string"), segu, "literal", K.XSD_INTEGER),
        _quad(segu, K.CORE_DURATION, F.col("duration_tc"), segu, "literal"),
        _quad(segu, K.CORE_DURATION_TR, F.col("duration_tr").cast("string"), segu, "literal", K.XSD_INTEGER),
        _quad(segu, K.RDF_TYPE, F.lit(K.CORE_ASR_SEGMENT), segu, "uri"),
        _quad(segu, K.CORE_TEXT_PROP, F.col("text"), segu, "literal"),
        _quad(segu, K.CORE_CONFIDENCE, F.col("confidence").cast("string"), segu, "literal", K.XSD_FLOAT),
    )
    seg_quads = s.select(*keep, F.inline(per_seg)).where(F.col("o").isNotNull())
    layers = s.select(*keep, media_col, "_layer").distinct()
    lay = F.col("_layer")
    per_layer = F.array(
        _quad(lay, K.RDF_TYPE, F.lit(K.CORE_ASR_LAYER), lay, "uri"),
        _quad(lay, K.RDFS_LABEL, F.lit(K.ASR_LAYER_LABEL), lay, "literal"),
        _quad(lay, K.CORE_DOCUMENT, F.col(media_col), lay, "uri"),
    )
    layer_quads = layers.select(*keep, F.inline(per_layer))
    return seg_quads.unionByName(layer_quads).dropDuplicates()


def doomed_graphs(quads: DataFrame, media: DataFrame, media_col: str = "media") -> DataFrame:
    """J11 helper: the ASR layer graphs of the media, and their segment graphs."""
    layers = (quads.where((F.col("p") == K.CORE_DOCUMENT))
                   .join(media.select(F.col(media_col).alias("o")).distinct(), "o", "left_semi")
                   .select(F.col("s").alias("g"))
                   .join(quads.where((F.col("p") == K.RDF_TYPE) & (F.col("o") == K.CORE_ASR_LAYER))
                              .select(F.col("s").alias("g")), "g", "left_semi"))
    segs = (quads.where(F.col("p") == K.CORE_SEGMENT)
                 .join(layers.select(F.col("g").alias("s")), "s", "left_semi")
                 .select(F.col("o").alias("g")))
    return layers.union(segs).distinct()


def delete_transcription(quads: DataFrame, media: DataFrame, media_col: str = "media") -> DataFrame:
    """Drop every quad in the doomed graphs (anti-join on g)."""
    return quads.join(doomed_graphs(quads, media, media_col), "g", "left_anti")


def replace_transcription(quads: DataFrame, new_quads: DataFrame, media: DataFrame,
                          media_col: str = "media") -> DataFrame:
    """Delete the old layers of `media`, then add the new quads, as a set.
    Idempotent: replacing twice equals replacing once."""
    kept = delete_transcription(quads, media, media_col).select(QUAD_COLUMNS)
    return kept.unionByName(new_quads.select(QUAD_COLUMNS)).dropDuplicates()


# ------------------------------------------------------------------ K6 / S7
def to_nquads(quads: DataFrame) -> DataFrame:
    return quads.select(nq_line().alias("value"))


IRI = r"<[^<>\"{}|^`\\\x00-\x20]*(?:\\[uU][0-9A-Fa-f]{4,8}[^<>\"{}|^`\\\x00-\x20]*)*>"
BLANK_NODE = r"_:[\p{L}\p{N}_](?:[\p{L}\p{N}_.\-\u00B7]*[\p{L}\p{N}_\-\u00B7])?"
#: subject, predicate, graph, datatype, language, IRI or blank object, literal body
STATEMENT = (rf"(?s)^[ \t]*+({IRI}|{BLANK_NODE})[ \t]*+({IRI})[ \t]*+"
             rf"(?:({IRI}|{BLANK_NODE})|\"([^\"\\]*+(?:\\.[^\"\\]*+)*+)\"(?:\^\^({IRI})|@([A-Za-z]+(?:-[A-Za-z0-9]+)*))?)"
             rf"[ \t]*+({IRI}|{BLANK_NODE})?[ \t]*+\.[ \t]*+(?:#.*)?[\r\n]*+$")
NO_STATEMENT = r"^\s*(#.*)?$"
FOUND, BETWEEN = "\u0002", "\u0001"  # no term but a literal can hold them
SKOLEM = "urn:bnode:"


def _terms(lines: DataFrame, col: str) -> DataFrame:
    """`terms` of each line, null where it is no statement: one match of the grammar, with
    the literal last, as only it can hold any character."""
    v = F.col(col)
    cut = F.regexp_replace(v, STATEMENT, FOUND + BETWEEN.join(f"${i}" for i in (1, 2, 7, 5, 6, 3, 4)))
    return lines.withColumn("_cut", cut).withColumn("terms", F.when(F.col("_cut").startswith(FOUND), F.split(F.substring("_cut", 2, 1 << 30), BETWEEN, 7)))


def rejected_nquads(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines that `parse_nquads` can't read: no statement, not blank, not a comment."""
    return _terms(lines, col).where(F.col(col).isNotNull() & F.col("terms").isNull() & ~F.col(col).rlike(NO_STATEMENT)).drop("_cut", "terms")


def parse_nquads(lines: DataFrame, col: str = "value", scope: Column | None = None) -> DataFrame:
    """N-Quads text -> quad table; `rejected_nquads` returns the other lines.

    Subject, object and graph may be blank nodes; these get an IRI of their own
    (`urn:bnode:`, a digest of `scope`, the label), so that a label means one node
    in a file and another in the next; scope is the file's name unless given. A
    statement without a graph belongs to the default graph (g null). Comments may
    follow the dot. Escapes are resolved in IRIs and literals.
    """
    where = F.md5(scope if scope is not None else F.input_file_name())
    # a written table may lose the file's name, so it is taken on the way in
    t = _terms(lines.withColumn("_scope", where), col).where(F.col("terms").isNotNull())
    term = [F.col("terms")[i] for i in range(7)]
    plain = lambda c: F.when(c.contains("\\"), nq_unescape(c)).otherwise(c)

    def node(c):
        return (F.when(c.startswith("<"), plain(F.substring(c, 2, F.length(c) - 2)))
                 .when(c.startswith("_:"), F.concat(F.lit(SKOLEM), F.col("_scope"), F.lit(":"), F.substring(c, F.lit(3), F.length(c)))))
    is_uri = term[5] != ""
    return t.select(
        node(term[0]).alias("s"), node(term[1]).alias("p"), F.when(is_uri, node(term[5])).otherwise(plain(term[6])).alias("o"), node(term[2]).alias("g"),
        F.when(is_uri, "uri").otherwise("literal").alias("o_kind"), node(term[3]).alias("o_datatype"), F.when(term[4] != "", term[4]).alias("o_lang"))


# ------------------------------------------------------------------ K7
def update_batches(quads: DataFrame, bucket_col: str = "bucket", size: int = K.QUADS_PER_REQUEST) -> DataFrame:
    """Cut each bucket's quads, in (g, s, p, o) order, into requests of `size`
    statements (`INSERT DATA { GRAPH <g> { s p o } ... }`); no empty request.

    Positions come from a range-partitioned scan, so a bucket holding a third of
    the quads is numbered by many tasks; each request then holds <= size rows.
    """
    order = ["g", "s", "p", "o", "o_kind", "o_datatype", "o_lang"]
    pos = dense_position(quads, [F.col(c).asc_nulls_first() for c in order], group=[bucket_col], name="_pos")
    triple = F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), nq_object("o", "o_kind", "o_datatype", "o_lang"))
    stmt = F.when(F.col("g").isNull(), F.concat(triple, F.lit(" ."))).otherwise(
        F.concat(F.lit("GRAPH <"), F.col("g"), F.lit("> {"), triple, F.lit("}")))
    b = pos.select(bucket_col, F.floor(F.col("_pos") / size).cast("bigint").alias("batch"), "_pos", stmt.alias("stmt"))
    return b.groupBy(bucket_col, "batch").agg(
        F.count(F.lit(1)).alias("n_quads"),
        F.concat(F.lit("INSERT DATA {"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "stmt"))),
                                          lambda x: x["stmt"]), " "),
                 F.lit("}")).alias("request"))


def deliver_requests(batches: DataFrame, journal: str, sender: str | None = None, bucket_col: str = "bucket") -> None:
    """K7 delivery as a sink (`quadrant.sources.delivery`): requests become visible in
    the journal when all tasks have succeeded, and not at all otherwise."""
    from quadrant.sources.delivery import QuadDelivery
    register(batches.sparkSession, QuadDelivery)
    rows = batches.select(F.col(bucket_col).cast("long").alias("bucket"), "batch", "n_quads", "request")
    rows.write.format(QuadDelivery.name()).mode("append").options(path=journal, **({"sender": sender} if sender else {})).save()


def deliver_batches(batches: DataFrame, sender, bucket_col: str = "bucket") -> DataFrame:
    """K7 delivery: send each request with `sender(requests: pd.Series) ->
    pd.Series[bool]` on the executors (Arrow batches), returning one ack per
    request. Requests are independent and set-valued, so a re-sent request
    after a lost task is harmless."""
    import pandas as pd

    from quadrant.session import ship_package
    ship_package(batches.sparkSession)

    def run(parts):
        for pdf in parts:
            ok = sender(pdf["request"]).astype(bool).values
            yield pd.DataFrame({bucket_col: pdf[bucket_col].values, "batch": pdf["batch"].values,
                                "n_quads": pdf["n_quads"].values, "ok": ok})

    return batches.select(bucket_col, "batch", "n_quads", "request").mapInPandas(
        run, f"{bucket_col} bigint, batch bigint, n_quads bigint, ok boolean")
