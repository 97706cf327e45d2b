"""Code extraction."""

from tidemark.functions.text import extract_code, zfill


def test_code_extraction(spark):
    rows = [("GRD", "a: -5"), ("GRD", "a: 12345678"), ("GRD", "a:\t42 \n"), ("GRD", "no colon"),
            ("GRD", "a: b: c"), ("PPA", "a: 1"), ("GRD", None), ("GRD", "a:"), ("GRD", "x: +7")]
    df = spark.createDataFrame(rows, "ppa_grd string, descripcion string")
    got = [r[0] for r in df.select(extract_code("descripcion", "ppa_grd")).collect()]
    assert got == ["-00005", "12345678", "000042", None, "00000b", None, None, "000000", "+00007"]


def test_zfill_matches_python(spark):
    vals = ["", "1", "-1", "+12", "123456", "1234567", "-123456", "ab", "-", "--5"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(zfill("s", 6)).collect()]
    assert got == [v.zfill(6) for v in vals]
