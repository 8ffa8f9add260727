"""Hand-made golden cases (FIXTURES part C) and invariants."""

from pyspark.sql import functions as F

from quadrant.functions import constants as K
from quadrant.functions.expressions import media_key, ms_to_srt_stamp
from quadrant.operators import catalog as C
from quadrant.operators import label as L
from quadrant.operators import quads as QD
from quadrant.operators import textprep as T
from quadrant.operators import transcripts as TR
from quadrant.operators.evaluate import krippendorff_alpha


def test_c1_transcript_merge(spark):
    lines = ["0.0-1.0 : ", "1.0-2.0 : a", "2.0-3.0 : ", "3.0- : ", "", "4.0-5.0 : b: c-d", "noise",
             "5.0-6.0 : ", "6.0-7.0 : e"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(lines)], "file string, line_no long, line string")
    segs, rejects = TR.coalesce_transcript(df)
    got = sorted((r.start, r.end, r.text) for r in segs.collect())
    assert got == [("1.0", "3.0", "a"), ("4.0", "5.0", "b: c-d"), ("6.0", "7.0", "e")]
    assert [r.line_no for r in rejects.collect()] == [6]


def test_c1_merge_without_blank_text(spark):
    df = spark.createDataFrame([("f", 0, "1.0-2.0 : x"), ("f", 1, "2.0-3.0 : ")], "file string, line_no long, line string")
    segs, _ = TR.coalesce_transcript(df)
    assert all(r.text != "" for r in segs.collect())


def test_c2_srt_stamp(spark):
    ms = [0, 5000, 5500, 3661250, 90000500]
    df = spark.createDataFrame([(m,) for m in ms], "ms long")
    got = [r[0] for r in df.select(ms_to_srt_stamp("ms")).collect()]
    assert got == ["00:00:00,000", "00:00:05,000", "00:00:05,500", "01:01:01,250", "25:00:00,500"]


def _parse(spark, chunk, response):
    df = spark.createDataFrame([(response,)], "response string").withColumn(
        "chunk", F.array(*[F.struct(F.lit(x.lower()).alias("match"), F.lit(x).alias("label")) for x in chunk]))
    return df.select(L.parse_response()).first()[0]


def test_c3_parse_predictions(spark):
    chunk = ["A", "B(x)", "C"]
    assert _parse(spark, chunk, "A, B(x)") == ["A", "B(x)"]
    assert _parse(spark, chunk, "Rien") == []
    assert _parse(spark, chunk, "a, A , A") == ["A", "A"]
    assert _parse(spark, chunk, "") == []
    assert _parse(spark, chunk, "D") == []
    assert _parse(spark, ["A", "E, F"], "E, F") == []
    assert _parse(spark, chunk, "A\u00a0,\u00a0B(x)\t") == ["A", "B(x)"]


def test_c4_media_key(spark):
    rows = ["http://media.example.org/asa#oai:HAL:hal-00012345v1", "http://x/asa#oai:HAL:hal-1v10",
            "https://api.nakala.example/data/10.34847/nkl.7", "http://other.example/m/1"]
    df = spark.createDataFrame([(r,) for r in rows], "media string")
    got = df.select(media_key("media").alias("k"), media_key("media", True).alias("kv")).collect()
    assert [r.k for r in got] == ["hal-00012345", "hal-1", "10.34847.nkl.7", None]
    assert got[0].kv == "hal-00012345v1"


def test_c5_name_match(spark):
    schema = "ord long, media string, title string"
    txt = spark.createDataFrame([("entretien avec Ann Lee (X).txt",)], "txtname string")
    both = spark.createDataFrame([(0, "http://h/asa#oai:HAL:k1v1", "entretien avec Ann Lee (X)"),
                                  (1, "http://h/asa#oai:HAL:k1v2", "entretien avec Ann Lee (X)")], schema)
    only = spark.createDataFrame([(0, "http://h/asa#oai:HAL:k1v1", "entretien avec Ann Lee (X)")], schema)
    none = spark.createDataFrame([(0, "http://h/asa#oai:HAL:k1v1", "entretien avec Bob (X)")], schema)
    assert TR.name_to_media(txt, both).first().jsonname == "k1v2.lintoai.json"
    assert TR.name_to_media(txt, only).first().jsonname == "k1v1.lintoai.json"
    assert TR.name_to_media(txt, none).first().jsonname == "No match found.lintoai.json"


def test_c6_quad_count(spark):
    rows = [("http://m/media/1", i, f"{i}.5", f"{i + 1}.0", f"t{i}", (0.5 if i % 2 else None)) for i in range(5)]
    seg = spark.createDataFrame(rows, "media string, ord long, start_raw string, end_raw string, text string, confidence double")
    q = QD.segments_to_quads(seg)
    n, c = 5, 2
    assert q.count() == 3 + 9 * n + c


def test_c7_presentation_merge(spark):
    df = spark.createDataFrame([("m", "s1", "a | b | a"), ("m", "s2", "b | c")], "media string, media_seg string, presentation string")
    got = {r.presentation for r in T.merge_presentations(df).collect()}
    assert got == {"a | b | b | c"}


def test_c8_null_keywords(spark):
    df = spark.createDataFrame([("l", "p", None)], "lab string, presentation string, keywords string")
    assert T.classification_text(df).first().text is None


def test_c9_keyword_fanout(spark):
    rows = spark.createDataFrame([("s", l, k) for l in ("x", "y") for k in ("p", "q")],
                                 "media_seg string, lab1 string, keyword string")
    r = C.group_concat(rows, ["media_seg"]).first()
    assert r.lab == "x | y" and r.keywords == "p, p, q, q"


def test_nquads_round_trip(spark):
    quads = spark.createDataFrame([
        ("http://s", "http://p", 'a "q" \\ back\nline', "http://g", "literal", None, "fr"),
        ("http://s", "http://p", "tab\t nel\u0085 ls\u2028 end", "http://g", "literal", None, None),
        ("http://s", "http://p", "12", "http://g", "literal", K.XSD_INTEGER, None),
        ("http://s", "http://p", "http://o", "http://g", "uri", None, None),
    ], "s string, p string, o string, g string, o_kind string, o_datatype string, o_lang string")
    back = QD.parse_nquads(QD.to_nquads(quads))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, quads.collect()))


def test_nquads_escapes_comments_and_rejects(spark):
    lines = [r'<http://s> <http://p> "a\tb \u00E9 \U0001F600 \uD83D\uDE00 \\n" <http://g> .', "# a comment", "",
             r"<http://s> <http://p> <http://o/\u00E9> <http://g> .", "<http://s> _:b <http://o> <http://g> .", "no quad"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r.o for r in QD.parse_nquads(df).collect()) == ["a\tb \u00e9 \U0001F600 \U0001F600 \\n", "http://o/\u00e9"]
    assert sorted(r.value for r in QD.rejected_nquads(df).collect()) == sorted(lines[4:])


def test_class_chain_and_cycle(spark):
    chain = spark.createDataFrame([(f"c{i}", f"c{i + 1}") for i in range(150)], "child string, parent string")
    assert C.class_closure(chain).where("child = 'c0'").count() == 150
    cycle = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "b")], "child string, parent string")
    assert C.class_closure(cycle).count() == 9


def test_document_keys_stay_text(spark):
    from quadrant.session import work_dir
    path = work_dir(spark, "keys")
    rows = spark.createDataFrame([("007", 0, "x"), ("1.10", 0, "y")], "k string, n long, line string")
    TR.write_documents(rows, "k", ["n"], "line", path)
    assert sorted(r.k for r in TR.read_documents(spark, path, "k").collect()) == ["007", "1.10"]


def test_f1_counts_what_one_side_lacks(spark):
    from quadrant.operators.evaluate import f1_scores
    schema = "unit long, label string, value long"
    truth = spark.createDataFrame([(1, "x", 1), (2, "x", 1)], schema)
    pred = spark.createDataFrame([(1, "x", 1), (3, "x", 1)], schema)
    r = f1_scores(truth, pred).where("scope = 'label'").first()
    assert (r.tp, r.fp, r.fn, r.f1) == (1, 1, 1, 0.5)
    r = f1_scores(truth, pred, universe=truth).where("scope = 'label'").first()
    assert (r.tp, r.fp, r.fn) == (1, 0, 1)


def test_null_label_matches_nothing(spark):
    raw = spark.createDataFrame([(0, "Word", "c", "e0", "u"), (1, None, "c", "e1", "u")],
                                "ord long, strLabel string, subclass string, entity string, uriclass string")
    texts = spark.createDataFrame([("s1", "a word"), ("s2", "none"), ("s3", None)], "media_seg string, text string")
    got = {r.media_seg: [x.entity for x in r.predicted_labels] for r in L.records(texts, L.Vocabulary(raw)).collect()}
    assert got == {"s1": ["e0"], "s2": [], "s3": []}


def test_labels_with_commas_as_in_the_pair_form(spark):
    raw = spark.createDataFrame([(0, "red, blue", "c", "e0", "u"), (1, "blue", "c", "e1", "u"), (2, "red", "c", "e2", "u")],
                                "ord long, strLabel string, subclass string, entity string, uriclass string")
    texts = spark.createDataFrame([("s1", "RED, blue sky"), ("s2", "blue")], "media_seg string, text string")
    v = L.Vocabulary(raw, qualified=False)
    pairs = L.lexical_response(L.lexical_pairs(texts, v.chunks, v.n_chunks, v.blocks))
    by_pair = L.collect_predictions(pairs.select("media_seg", "chunk_id", L.parse_response().alias("labels")))
    want = {r.media_seg: r.labels for r in by_pair.collect()}
    assert {r.media_seg: r.labels for r in L.predict(texts, v).collect()} == want == {"s1": ["red", "blue", "blue", "red"], "s2": ["blue"]}


def test_replace_twice_is_once(spark):
    rows = [("http://m/media/1", i, f"{i}.0", f"{i + 1}.0", f"t{i}", None) for i in range(3)]
    schema = "media string, ord long, start_raw string, end_raw string, text string, confidence double"
    old = QD.segments_to_quads(spark.createDataFrame(rows, schema))
    new_rows = [("http://m/media/1", 0, "0.0", "3.0", "merged", None)]
    new = QD.segments_to_quads(spark.createDataFrame(new_rows, schema))
    media = spark.createDataFrame([("http://m/media/1",)], "media string")
    once = QD.replace_transcription(old, new, media)
    twice = QD.replace_transcription(once, new, media)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert once.count() == 3 + 9


def test_alpha_identical_raters(spark):
    r = spark.createDataFrame([(u, rater, u % 2) for u in range(20) for rater in ("a", "b")],
                              "unit long, rater string, value long")
    assert krippendorff_alpha(r).first().alpha == 1.0


def test_update_batches_cover_input(spark):
    rows = [(f"http://s/{i}", "http://p", str(i), f"http://g/{i % 3}", "literal", None, None, i % 2) for i in range(1234)]
    q = spark.createDataFrame(rows, "s string, p string, o string, g string, o_kind string, o_datatype string, "
                                    "o_lang string, bucket long")
    b = QD.update_batches(q).collect()
    assert sum(r.n_quads for r in b) == 1234
    assert max(r.n_quads for r in b) <= K.QUADS_PER_REQUEST
    assert all(r.n_quads > 0 for r in b)


def test_malformed_times_give_no_time_quads(spark):
    seg = spark.createDataFrame([("http://m/media/1", 0, "1.0x", "", "t", None)],
                                "media string, ord long, start_raw string, end_raw string, text string, confidence double")
    q = QD.segments_to_quads(seg)
    preds = {r.p for r in q.collect()}
    assert K.CORE_TEXT_PROP in preds and K.CORE_BEGIN_TIME_TR not in preds


def test_percent_encode_path_matches_quote(spark):
    from urllib.parse import quote
    from quadrant.functions.expressions import percent_encode_path
    samples = ["http://media.example.org/asa#oai:HAL:hal-1v1", "a b/c~d*e+f", "é à/ü?x=1&y=2", "Études aréales"]
    df = spark.createDataFrame([(x,) for x in samples], "u string")
    got = [r[0] for r in df.select(percent_encode_path("u")).collect()]
    assert got == [quote(x, safe="/") for x in samples]
