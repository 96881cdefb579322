import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketlens.config import FeatureConfig, MaskingConfig
from basketlens.functions import casts, keys, masking, text
from basketlens.functions import predicates as p
from helpers import column

PHONES = [
    ("+7 (513) 412-52-86", "85134125286"),
    ("8 (528) 953-92-64", "85289539264"),
    ("+7 (480) 396-5223", "84803965223"),
    ("8 (008) 860-08-48", "80088600848"),
    ("8 827 109 1043", "88271091043"),
    ("+71918255371", "81918255371"),
    ("82330958498", "82330958498"),
    ("12345", None),
    ("+1 (480) 396-5223", "+14803965223"),
    ("71918255371", "71918255371"),
    ("8233095849a", None),
    ("82330958498\n", None),
    ("", None),
    (None, None),
]


def test_clean_phone(spark):
    df = spark.createDataFrame(PHONES, "phone string, wanted string")
    assert column(df, text.clean_phone(F.col("phone"))) == [b for _, b in PHONES]


def test_clean_email(spark):
    df = spark.createDataFrame([(" Foo @Bar.org ",), ("",), ("  ",), (None,)], "email string")
    assert column(df, text.clean_email(F.col("email"))) == ["foo@bar.org", None, None, None]


def test_normalize_trims_spaces_only_and_lowers_any_alphabet(spark):
    df = spark.createDataFrame([("  ИВАНОВ Ё ",), ("\tÀB\t",), (None,)], "t string")
    assert column(df, text.normalize(F.col("t"))) == ["иванов ё", "\tàb\t", None]


def test_category(spark):
    names = [
        ("🥖 Зерновые и хлебобулочные изделия", "зерновые и хлебобулочные изделия"),
        ("🥩 Мясо, рыба, яйца и бобовые", "мясо, рыба, яйца и бобовые"),
        ("🥛 Молочные продукты", "молочные продукты"),
        ("🍏 Фрукты и ягоды", "фрукты и ягоды"),
        ("🥦 Овощи и зелень", "овощи и зелень"),
        (", 🥖🍏 Чай", "чай"),
        ("🍏🥖 Чай", "🥖 чай"),
    ]
    df = spark.createDataFrame(names, "g string, wanted string")
    assert column(df, text.category(F.col("g"))) == [b for _, b in names]


def test_category_names_match_the_feature_roles():
    roles = FeatureConfig().roles
    assert roles.meat == "мясо, рыба, яйца и бобовые" and roles.fruit == "фрукты и ягоды"


def test_split_is_literal(spark):
    df = spark.createDataFrame([("a.b|c", )], "t string")
    assert column(df, text.split_list(F.col("t"))) == [["a.b", "c"]]
    assert column(df, text.split_list(F.col("t"), ".")) == [["a", "b|c"]]


def test_timestamp_notations(spark):
    moment = dt.datetime(2024, 3, 5, 10, 20, 30)
    values = [
        ("2024-03-05T10:20:30.123456", moment),
        ("2024-03-05 10:20:30", moment),
        ("05.03.2024 10:20:30", moment),
        ("2024/03/05 10:20:30", moment),
        ("20240305102030", moment),
        ("1709634030", moment),
        ("1709634030500", moment),
        ("Mar 5 2024", dt.datetime(2024, 3, 5)),
        ("Mar 5 2024 10:20:30", moment),
        ("20240305", dt.datetime(2024, 3, 5)),
        ("12:00", None),
        ("2024", None),
        ("2024-03-05", dt.datetime(2024, 3, 5)),
        ("05.03.2024", dt.datetime(2024, 3, 5)),
        ("yesterday", None),
        ("", None),
        (None, None),
    ]
    df = spark.createDataFrame([(v,) for v, _ in values], "t string")
    found = column(df, casts.timestamp(F.col("t")).cast("timestamp_ntz"))
    assert found == [m for _, m in values]


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("12.345", "1"), ("abc", "99999"), ("", "-3"), (None, None)], "m string, s string")
    assert column(df, casts.money(F.col("m"))) == [Decimal("12.35"), None, None, None]
    assert column(df, casts.short(F.col("s"))) == [1, None, -3, None]
    assert column(df, p.positive_money(F.col("m"))) == [True, False, False, False]


def test_flag_text(spark):
    df = spark.createDataFrame([("True",), ("False",), ("maybe",), (None,)], "b string")
    assert column(df, casts.boolean(F.col("b"))) == [True, False, None, None]
    assert column(df, p.is_true_text(F.col("b"))) == [True, False, False, False]


def test_tax_number(spark):
    values = ["1234567890", "123456789", "12345678901", "123456789a", "1234567890\n", "", None]
    df = spark.createDataFrame([(v,) for v in values], "inn string")
    assert column(df, p.is_tax_number(F.col("inn"))) == [True] + [False] * 6


def test_surrogate_key(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "", "b"), ("a", "b", None), ("a|b", "c", ""), ("a", "b|c", "")], "x string, y string, z string"
    )
    found = column(df, keys.surrogate_key(F.col("x"), F.col("y"), F.col("z")))
    assert found[0] == found[1] and len(set(found)) == 4 and all(0 <= k < 2**60 for k in found)
    spaced = spark.createDataFrame([(" Улица ", "X")], "x string, y string")
    plain = spark.createDataFrame([("улица", "x")], "x string, y string")
    assert column(spaced, keys.normalized_key("x", "y")) == column(plain, keys.normalized_key("x", "y"))


DOCUMENT = (
    "_id bigint, phone string, n int, manager struct<name: string, phone: string, email: string>, "
    "contacts array<struct<email: string, kind: string>>, tags array<string>, email array<string>"
)


def _masked(spark, config):
    df = spark.createDataFrame(
        [
            (1, "+7 (513) 412-52-86", 5, ("A", "12345", " A@B.c"), [("x@y.z", "w"), (None, "h")], ["a@b.c"], ["q"]),
            (2, "8 513 412 52 86", 6, None, [("x@y.z", "w")], None, None),
        ],
        DOCUMENT,
    )
    return masking.mask_documents(df, config).orderBy("_id").collect()


def test_keyed_masking_reaches_any_depth(spark):
    import hashlib

    def token(value):
        def digest(text):
            return hashlib.sha256(text.encode()).hexdigest()

        return digest("mask-key:" + digest("outer:key") + digest("mask-key:" + digest("inner:key") + value))

    first, second = _masked(spark, MaskingConfig("keyed", "key"))
    assert first["_id"] == "1" and first["n"] == 5
    assert first["phone"] == second["phone"] == token("85134125286")
    assert first["manager"].asDict() == {"name": "A", "phone": None, "email": token("a@b.c")}
    assert [tuple(c) for c in first["contacts"]] == [(token("x@y.z"), "w"), (None, "h")]
    assert first["tags"] == ["a@b.c"] and first["email"] == ["q"]
    assert second["manager"] is None and second["tags"] is None


@pytest.mark.parametrize("mode", ["keyed", "random"])
def test_plans_hold_no_secret(spark, mode):
    secret = "TOPSECRET"
    df = spark.createDataFrame([("1", "a@b.c")], "_id string, email string")
    masked = masking.mask_documents(df, MaskingConfig(mode, secret))
    masked.collect()
    plan = masked._jdf.queryExecution().toString()
    assert "sha2" in plan or "md5" in plan
    assert not any(hidden in plan for hidden in (secret, "randstr", *masking.masking_keys(secret)))


def test_random_masking_is_not_joinable(spark):
    first, second = _masked(spark, MaskingConfig("random"))
    assert len(first["phone"]) == 32 and first["phone"] != second["phone"]
    assert first["contacts"][0]["email"] != second["contacts"][0]["email"]
    assert first["manager"]["phone"] is None
    again, _ = _masked(spark, MaskingConfig("random"))
    assert again["phone"] != first["phone"]


def test_keyed_masking_needs_a_secret():
    with pytest.raises(ValueError):
        MaskingConfig()
    with pytest.raises(ValueError):
        FeatureConfig(fruit_counts="both")
