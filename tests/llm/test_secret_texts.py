"""Secrets in long and hostile texts."""

import base64
import re
import time

import pytest

from cellscape.llm import secret_scan

HEADER = base64.urlsafe_b64encode(b'{"alg":"HS256"}').decode().rstrip("=")


def kinds(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    return {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["found"]] for r in secret_scan.scan(rows).collect()}


def test_nested_header_is_no_token(spark):
    deep = base64.urlsafe_b64encode(b"[" * 100_000).decode().rstrip("=")
    got = kinds(spark, [f"eyJ{deep}.a.b", f"EYJ{HEADER}.a.b and eyJx {HEADER}.c.d"])
    assert got[0] == []
    assert [k for k, _, _ in got[1]] == ["jwt", "jwt"]


@pytest.mark.parametrize("text", ["eyJ" * 1_700_000, ("é " + "0123456789abcdef" * 2 + " ") * 140_000, "x" * 5_000_000])
def test_texts_of_five_megabytes(spark, text):
    kinds(spark, ["warm up"])
    begin = time.time()
    got = kinds(spark, [text])[0]
    assert time.time() - begin < 20
    assert [(a, b) for k, a, b in got if k == "hex"] == [m.span() for m in re.finditer("[0-9a-f]{16,}", text)]
