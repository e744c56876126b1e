"""Scalar functions on literals."""

import pytest
from pyspark.sql import functions as F

from edicta.functions import dates, rules, text, urls


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (text.normalize_key, "  Ñuñoa / O'Higgins ", "nunoa o higgins"), (lambda c: text.normalize_key(c, ""), "O Higgins", "ohiggins"), (text.slugify, "", "s_n"), (text.slugify, None, "s_n"), (text.slugify, "N° 12-A", "n_12_a"),
        (text.fold, "  ＯＲＤЕΝ№​ Á́ x", "ordenn° a x"), (text.fold, None, None), (text.collapse, "﻿ a  \n b ", "a b"), (text.unify, "ﬁnº", "fin°"),
        (urls.normalized_url, "HTTP://WWW.A.cl//x//y.pdf#z", "http://www.a.cl/x/y.pdf"), (urls.normalized_url, "a.cl/x?b=1", "https://a.cl/x?b=1"), (urls.root_host, "https://www.muni.cl:8080/a", "muni.cl"), (urls.to_https, "http://a", "https://a"),
        (urls.file_name, "https://a.cl/x/mi%20acto.pdf", "mi acto.pdf"), (urls.file_name, "https://a.cl/", None), (lambda c: urls.parameter(c, "id"), "https://a.cl/v?x=1&id=9", "9"), (lambda c: urls.parameter(c, "id"), "https://a.cl/v", None), (urls.page_number, "https://a.cl/page/7/", 7), (urls.page_number, "https://a.cl", 1), (urls.unquoted, "a+b%20c", "a+b c"),
        (dates.legal_date, "2024-03-05", "2024-03-05"), (dates.legal_date, "5-3-2024", "2024-03-05"), (dates.legal_date, "2024/03", "2024-03"), (dates.legal_date, "año 1999", "1999"), (dates.legal_date, "nada", "S/F"), (dates.legal_date, None, "S/F"), (dates.legal_date, "2024-13", "2024"),
        (dates.long_date, "dado el 5 de Mayo de 2023 en", "2023-05-05"), (dates.long_date, "mayo de 2023", None), (dates.year, "xx", None), (dates.recent, "S/F", False), (dates.recent, "2021", True), (dates.recent, "2098-01-01", False), (dates.recent, None, False),
        (dates.act_number, "Ordenanza 28", "28"), (dates.act_number, "0012/2018", "12"), (dates.act_number, "S/N", "S/N"), (dates.act_number, None, "S/N"), (dates.act_number, "1.078", "1078"), (dates.synthetic, "2020-01-01", True), (dates.precision, "2020-01", "month"),
    ],
)
def test_function(spark, f, value, want):
    assert one(spark, f, value) == want


def test_rules(spark):
    sets = [rules.Rule(2, "b", "y"), rules.Rule(1, "a", "x", negate="nox"), rules.Rule(3, "b", "z")]
    assert one(spark, lambda c: rules.first_label(c, sets, "none"), "xy") == "a"
    assert one(spark, lambda c: rules.first_label(c, sets, "none"), "nox y") == "b"
    assert one(spark, lambda c: rules.first_label(c, sets, "none"), None) == "none"
    assert one(spark, lambda c: rules.all_labels(c, sets), "xyz") == ["a", "b"] and one(spark, lambda c: rules.all_labels(c, sets), None) == []
    assert one(spark, lambda c: rules.score(c, [("x", 2), ("y", 3)]), "xy") == 5 and one(spark, lambda c: rules.score(c, [("x", 2)]), None) == 0


def test_same_site(spark):
    df = spark.createDataFrame([("https://a.cl/x", "http://www.a.cl"), ("https://sub.a.cl", "https://a.cl"), ("https://ba.cl", "https://a.cl"), (None, "x")], "a string, b string")
    assert [r.s for r in df.select(urls.same_site(F.col("a"), F.col("b")).alias("s")).collect()] == [True, True, False, None]
