import random
import re

import pytest
from pyspark.sql import functions as F

from veritide.operators import text_pii

TESTDATA = "/root/testdata"
#: The patterns as Python reads them.
BOTH = re.compile(f"({text_pii.EMAIL_IN_TEXT})|({text_pii.PHONE_IN_TEXT})", re.ASCII)


def _hidden(found):
    if "@" in found:
        return found[0] + "***" + found[found.index("@") :]
    digits = re.sub(r"\D", "", found)
    return "***-***-" + digits[-4:] if re.fullmatch(r"\d{3}-\d{3}-\d{4}", found) else "***" + digits[-4:]


def _checked(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, body string")
    spans = {}
    for r in text_pii.text_spans(frame, "id", "body").collect():
        spans.setdefault(r.id, []).append((r.kind, r.start, r.stop, r.found))
    masked = {r.id: r.body for r in text_pii.text_masked(frame, "body").collect()}
    for i, text in enumerate(texts):
        hits = list(BOTH.finditer(text or ""))
        assert spans.get(i, []) == [("email" if m[1] else "phone", m.start(), m.end(), m[0]) for m in hits], text
        assert masked[i] == (None if text is None else BOTH.sub(lambda m: _hidden(m[0]), text)), text


CASES = [
    None,
    "",
    "no one here",
    "a@b.org",
    "write to nora.q+x@mail.example.org, or call 212-555-0101.",
    "(212) 555-0101 or +1 212.555.0101 or 1-212-555-0101 or 2125550101",
    "12125550101234",  # more digits than a number has
    "x2125550101y 21255501011 0212-555-0101",
    "a@b.org;c@d.net a@b.c @x.org a@.org a@@b.org",
    "2125550101@phones.org is an address",
    "née@héllo.org né@x.org 🙂 212-555-0101 🙂 z@y.org",
    "212-555-0101 212-555-0102\n212-555-0103\t+12125550104",
    "tail a@b.org",
    "a" * 40_000 + "@",
    "5 " * 3000 + "212 555 0101",
    "a@b.com_x@y.org",
]


def test_spans_and_masks(spark):
    _checked(spark, CASES)


def test_spans_and_masks_of_made_texts(spark):
    rng = random.Random(1)
    parts = ["a", "x.y", "@", "b.org", ".", "-", " ", "+1", "(", ")", "212", "555", "0101", "2125550101", "é", "🙂", "\n", "7", "_"]
    _checked(spark, ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)])


def test_golden_counts(spark):
    documents = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    found = text_pii.exposure(documents, "text").first()
    assert (found.texts, found.emails, found.with_email) == (1000, 12, 11)


def test_nothing_is_left_in_masked_text(spark):
    documents = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    masked = text_pii.text_masked(documents, "text")
    assert masked.columns == documents.columns
    assert masked.where(F.regexp_like("text", F.lit(text_pii.PHONE_IN_TEXT))).count() == 0
    plan = masked._sc._jvm.PythonSQLUtils.explainString(masked._jdf.queryExecution(), "simple")
    assert not re.search("Exchange|Python", plan)


@pytest.mark.parametrize("name", ["body", "spans", "kind"])
def test_columns_of_any_name(spark, name):
    frame = spark.createDataFrame([(1, "a@b.org")], f"id long, `{name}` string")
    assert text_pii.text_spans(frame, "id", name).columns == ["id", "kind", "start", "stop", "found"]
    assert text_pii.text_masked(frame, name).first()[name] == "a***@b.org"
