"""op2: base spans against Python's re, trees, redaction."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from gavlake.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        if i % 2:
            v = v * 2 - 9 if v > 4 else v * 2
        total += v
    return total % 10 == 0


def base_spans(text):
    out = [("email", *m.span()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


TRICKY = [
    "a@b.c_d@e.f x@y 1.2.3.4.5.6.7.8 999.1.1.1 00255.001.0.0 +1 (017) 555-7713 +12",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111.", "1 " * 20000,
    "\U0001F600 é \x01 x@y.zz \x02 +12 345 678 901 " * 3, "a" * 50000 + "@b.c", "1" * 30000, "+1+2+3 .@. @", "",
    "tel: 555-771-3000 or call 555 123 4567", "x.y@z.com," * 2000,
]


@pytest.fixture(scope="module")
def model():
    return [-1.0], {k: float("inf") for k in pii.KINDS}


def test_base_spans(spark, small, model):
    texts = TRICKY + [r.text for r in small.collect()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.find_pii(docs, model).select("doc_id", "found").collect():
        assert [tuple(x) for x in r.found] == base_spans(texts[r.doc_id]), texts[r.doc_id][:80]


def test_report(small):
    rows = {r.doc_id: r.text for r in small.collect()}
    for r in pii.pii_report(small).collect():
        want = base_spans(rows[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(joined.split(",")) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [
            sum(k == kind for k, _, _ in want) for kind in ("email", "ip", "card", "phone")]


def test_edge_cases(edge_docs, edge_rows, no_docs):
    got = pii.pii_report(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert sum(r.n_email for r in got) == 1 and sum(r.n_phone for r in got) == 1
    assert pii.pii_report(no_docs).collect() == []


def cued_corpus(spark):
    """Personal data with and without cues, and numbers that rules refute."""
    rows = []
    for i in range(400):
        cue = "tel: " if i % 2 else "word "
        card = next(f"41{i:04d}555566{k:04d}" for k in range(10_000) if luhn(f"41{i:04d}555566{k:04d}"))
        bad = f"{int(card) + 1}"
        rows.append((i, f"{cue}+1 555 {i % 900 + 100} {i % 9000 + 1000} and 10.{i % 250}.{i % 99}.7 or mail jo{i}@corp.org "
                        f"then card {card} but 5{i:04d} 77 {i % 97} and {bad} or 10.{i % 250 + 300}.1.2 x"))
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_disguised_and_uncued_spans(spark):
    """What the added spans are: no base span, no refuted one; each is named with its text."""
    model = pii.fit(pii.candidates(cued_corpus(spark)))
    assert all(np.isfinite(t) for t in model[1].values())
    cases = {
        "reach ann.lee (at) corp (dot) org today": ["ann.lee (at) corp (dot) org"],
        "mail: ann.lee [at] corp [dot] org today": ["ann.lee [at] corp [dot] org"],
        "tel: 1 555 123 4567 now": ["1 555 123 4567"],
        "it had 1 555 123 4567 rows": [],                                  # no cue, no plus
        "pair 4111111111111111 4111111111111111 end": ["4111111111111111", "4111111111111111"],
        "pair 4111111111111112 4111111111111112 end": [],                  # the checksum fails
        "ver 10.300.1.2 and 1.2.3 end": [],
        "in 1999 2000 2001 we": [],
        "see ann (at) noon": [],                                           # no address
        "": [], "nothing here": [],
    }
    docs = spark.createDataFrame(list(enumerate(cases)), "doc_id long, text string")
    texts = list(cases)
    for r in pii.find_pii(docs, model).collect():
        got = [texts[r.doc_id][x.start:x.end] for x in r.found if x.kind.endswith("_like")]
        assert got == cases[texts[r.doc_id]], texts[r.doc_id]
        for x in r.scored:
            assert 0 <= x.score <= 1 and (x.added is False or texts[r.doc_id][x.start:x.end] in got)


def test_spans_are_added_on_the_given_table(spark):
    """Two cards in one run of digits are no base span; the shapes within are found."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pii.pii_report(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    added = [(r.text[int(a):int(b)], k) for r in rows for k, a, b in (x.split(":") for x in r.spans.split(",") if x)
             if k.endswith("_like")]
    assert added and all(k == "card_like" and luhn(re.sub("[^0-9]", "", t)) for t, k in added)
    assert all(x.count("+") <= 1 for r in rows for x in r.scores.split(","))
    assert {r.doc_id: r.spans for r in rows} == {r.doc_id: r.spans for r in pii.pii_report(docs).collect()}


def test_columns_with_the_helpers_names_stay(spark, model):
    own = ("_clean", "_digit", "_mail", "_number", "_base", "_good", "_kinds", "_sound", "_email_parts", "value", "kept0_clean")
    docs = spark.createDataFrame([(1, "a x@y.zz b")], "doc_id long, text string")
    for c in own:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    row = pii.find_pii(docs, model).first()
    assert [row[c] for c in own] == [f"own {c}" for c in own] and len(row.found) == 1


def test_tree_expression_equals_the_model(spark):
    r = np.random.default_rng(1)
    x = np.stack([r.integers(0, bins, 300) for _, _, bins in pii.FEATURES], axis=1)
    yes = (x[:, 1] > 2).astype(float) * 3 + (x[:, 4] == 1)
    trees = pii.fit_trees(x, yes, 4 - yes)
    want = sum(pii._apply(t, x) for t in trees)
    names = [n for n, _, _ in pii.FEATURES]
    df = spark.createDataFrame([(i, *map(int, v)) for i, v in enumerate(x)], ["i", *names])
    got = (df.select("i", F.struct(*names).alias("x"))
           .selectExpr("i", " + ".join(f"({pii._sql(t)})" for t in trees) + " as s").orderBy("i").collect())
    assert np.allclose([g.s for g in got], want, atol=1e-5)
    assert want[yes > 2].mean() > want[yes < 2].mean()


def test_redact(spark, model):
    docs = spark.createDataFrame([(1, "mail a@b.co now, +1 (017) 555-7713 end"), (2, None)],
                                 "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(docs, model).collect()}
    assert got == {1: "mail [email] now, [phone] end", 2: None}


def test_native_plan(small):
    plan = pii.pii_report(small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
