"""Column cleaning and masking on edge values."""

from pyspark.sql import functions as F

from coursewise.functions import text as T


def one(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_field_count_java_semantics(spark):
    lines = ["a\tb", "a\tb\t\t", "\t\t", "", "a\t\tb", "a\tb\tc\t"]
    assert one(spark, lines, T.field_count) == [2, 2, 1, 1, 3, 3]


def test_field_count_ok_17(spark):
    f17 = "\t".join(str(i) for i in range(17))
    empty_last = "\t".join(str(i) for i in range(16)) + "\t"
    f18_empty_last = f17 + "\t"
    f16 = "\t".join(str(i) for i in range(16))
    empty_mid = "\t".join("" if i == 5 else str(i) for i in range(17))
    got = one(spark, [f17, empty_last, f18_empty_last, f16, empty_mid], lambda c: T.field_count_ok(c, 17))
    assert got == [True, False, True, False, True]


def test_java_trim_and_blank(spark):
    vals = ["  a b ", "\t\n x\r", "\x00y\x1f", "", "   ", None, "　z"]
    assert one(spark, vals, T.java_trim) == ["a b", "x", "y", "", "", None, "　z"]
    assert one(spark, vals, T.is_blank) == [False, False, False, True, True, True, False]


def test_mask_phone_a(spark):
    vals = ["18701420001", "1870142000199", "", "   ", "18701", None]
    assert one(spark, vals, T.mask_phone) == ["187xxxx0001", "187xxxx0001", "", "   ", None, None]


def test_mask_phone_b(spark):
    vals = ["13000000123", "123", None]
    assert one(spark, vals, lambda c: T.mask_phone(c, "*****", keep_blank=False)) == ["130*****0123", None, None]


def test_strip_newlines(spark):
    assert one(spark, ["a\nb", "\n", None], T.strip_newlines) == ["ab", "", None]


def test_mask_name_and_redact(spark):
    assert one(spark, ["Zhang San", "L", "", None], T.mask_name) == ["Zxx", "Lxx", None, None]
    assert one(spark, ["secret"], lambda c: T.redact()) == ["******"]


def test_code_label(spark):
    vals = ["1", "2", "3", "4", "5", "0", None, "x"]
    assert one(spark, vals, T.code_label) == ["PC", "Mobile", "App", "WeChat", "other", "other", "other", "other"]


def test_int_text(spark):
    vals = ["7", "+7", "-7", " 7", "7 ", "x", "", "2147483648"]
    assert one(spark, vals, T.is_int_text) == [True, True, True, False, False, False, False, False]
