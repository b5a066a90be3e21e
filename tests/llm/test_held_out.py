"""Quality verdicts do not depend on whether, or how many, clean documents are trusted."""

import pytest
from corpus_helpers import SMALL, documents  # noqa: F401

from pontualis.llm import quality_rules


@pytest.mark.parametrize("size, percent", [("0.01", 50), ("0.01", 25), ("0.1", 10), ("0.1", 3)])
def test_held_out_clean_documents_are_kept(spark, size, percent):
    folder = SMALL.replace("0.001", size)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.withColumn("held", quality_rules.F.expr(f"pmod(xxhash64(doc_id), 100) >= {percent}"))
    ratio = quality_rules.fit_ratio(docs, labels.where("quality = 1 AND NOT held"))
    judged = (quality_rules.quality_rules(docs, ratio).join(labels, "doc_id")
              .where("quality = 1 AND NOT _out.base_failed").collect())
    for held in (True, False):
        verdicts = [r._out.kept for r in judged if r.held == held]
        assert len(verdicts) > 50 and verdicts.count(False) <= 0.02 * len(verdicts)


def test_bad_documents_are_rejected_with_all_labels(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    ratio = quality_rules.fit_ratio(docs, labels.where("quality = 1"))
    judged = (quality_rules.quality_rules(docs, ratio).join(labels.where("quality = 0"), "doc_id")
              .where("NOT _out.base_failed").collect())
    assert len(judged) > 100 and sum(r._out.kept for r in judged) <= 0.01 * len(judged)


def test_a_document_does_not_vouch_for_itself(spark, documents):
    clean = [(i, " ".join(f"word{(7 * i + 3 * k) % 90}" for k in range(200))) for i in range(60)]
    rows = [*clean, (100, " ".join(f"only{k}" for k in range(100))), (101, " ".join(f"once{k}" for k in range(100)))]
    docs = documents(rows)
    trusted = spark.createDataFrame([(i,) for i in [*range(0, 60, 2), 100]], "doc_id bigint")
    got = {r.doc_id: r._out for r in quality_rules.quality_rules(docs, quality_rules.fit_ratio(docs, trusted)).collect()}
    assert got[100].fair_llr == pytest.approx(got[101].fair_llr, abs=0.05)
    assert abs(got[101].fair_llr) < 0.05 and got[100].kept and got[101].kept
