"""The numbers FIXTURES.md part B states for sf0.01, reproduced."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from quadrant.operators.catalog import class_closure
from quadrant.sources import fixtures as FX

SF = "/root/testdata/sf0.01"


def test_catalogue_shape(spark):
    c = FX.cat(spark, SF)
    assert c.count() == 1000 and c.select("media").distinct().count() == 900
    assert E.queries()["dedupe_keep_first"](spark, SF).count() == 900


def test_recent_documents_388(spark):
    assert E.queries()["recent_documents"](spark, SF).count() == 388


def test_lexical_matches(spark):
    q = E.queries()["index_quads"](spark, SF)
    assert q.count() == 337
    assert q.select("s").distinct().count() == 248
    assert q.select("o").distinct().count() == 25


def test_alpha_and_f1(spark):
    a = {r.raters: r.alpha for r in E.queries()["krippendorff_alpha"](spark, SF).collect()}
    assert a["all"] == -0.030975 and a["identical"] == 1.0
    f = [r for r in E.queries()["f1_scores"](spark, SF).collect() if r.label == "quality"][0]
    assert (f.tp, f.fp, f.fn, f.f1) == (157, 33, 184, 0.591337)


def test_class_closure_55(spark):
    assert class_closure(FX.class_edges(spark, SF)).count() == 55


def test_seg_shape(spark):
    s = FX.seg(spark, SF)
    assert s.count() == 536 and s.select("media").distinct().count() == 100
    raw = FX.table(spark, SF, "conversations")
    assert raw.where(F.col("text").contains("\n")).count() == 335
