"""Account numbers before further capitals or numbers; labels on both sides of a number."""

from lakeops.llm import pii


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.spans for r in pii.span_report(docs).collect()}
    return [got[i] for i in range(len(texts))]


def test_iban_before_other_words(spark):
    de, gb = "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    texts = [
        f"IBAN {de} Please pay", f"iban {gb} The bank", f"{de} EUR 500", f"{de} 2024", f"{de} {gb} X", f"{gb}, {de}A",
        "DE12 GB82 WEST 1234 5698 7654 32 OK", f"{de}x {de[:-1]}1", "MT84 MALT 0110 0001 2345 MTLC AST0 01S EUR",
        f"{de} " * 300,
    ]
    d, g = len(de), len(gb)
    assert found(spark, texts) == [
        f"iban:5:{5 + d}", f"iban:5:{5 + g}", f"iban:0:{d}", f"iban:0:{d}", f"iban:0:{d},iban:{d + 1}:{d + 1 + g}",
        f"iban:0:{g}", f"iban:5:{5 + g}", "", "iban:0:38", ",".join(f"iban:{i * 23}:{i * 23 + d}" for i in range(300)),
    ]


def test_label_after_the_number(spark):
    texts = [
        "123-45-6789 (SSN)", "555-123-4567 is my mobile", "123-45-6789 | Social Security no.", "555-123-4567",
        "123-45-6789" + " " * pii.REACH + "ssn", "ssn " + "x" * pii.REACH + " 123-45-6789 tax id",
    ]
    at = 4 + pii.REACH + 1
    assert found(spark, texts) == [
        "ssn:0:11", "local_phone:0:12", "ssn:0:11", "", "", f"ssn:{at}:{at + 11}",
    ]
