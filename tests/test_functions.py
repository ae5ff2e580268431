import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinweave.config import BlockingConfig
from kinweave.functions import minhash, text
from kinweave.operators.features import jaro_winkler


def column(spark, values, f, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


NAMES = {
    "O'Reilly's Barbershop": "o reilly s barbershop",
    "  PRIME   MONEY  ": "prime money",
    "B+ Retail Inc": "b retail inc",
    "राम मार्केटिंग प्राइवेट लिमिटेड": "राम मार्केटिंग प्राइवेट लिमिटेड",
    "Fractales Amis Groupe S.A.S": "fractales amis groupe s a s",
    "17560 Ellis Road, Tahlequah, OK": "17560 ellis road tahlequah ok",
    "63 R. DE DIEPPE, LILLE": "63 r de dieppe lille",
    "Straße": "strasse",
    "": "",
    None: "",
}


def test_normalisers(spark):
    assert column(spark, list(NAMES), text.normalize_text) == list(NAMES.values())
    assert column(spark, list(NAMES), text.normalize_exact) == list(NAMES.values())
    assert text.fold("ﬁne") == "fine" and text.fold(float("nan")) == ""
    assert column(spark, ["US", "  India  ", "France", None], text.normalize_country) == ["us", "india", "france", ""]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(max_codepoint=0x7E), max_size=40))
def test_fold_is_stable(value):
    assert text.fold(text.fold(value)) == text.fold(value)


def test_native_and_exact_agree_on_ascii(spark):
    values = ["a!b\tc", "x  y\n z", "A-B_C", "~1~", "  "]
    assert column(spark, values, text.normalize_text) == [text.fold(v) for v in values]


def test_names(spark):
    names = ["orelee s barbershop llc", "prime money inc", "ram marketing pvt ltd", "llc inc", ""]
    assert column(spark, names, text.core_name) == ["orelee s barbershop", "prime money", "ram marketing", "llc inc", ""]
    assert column(spark, names[1:2], text.compact_name) == ["primemoney"]


def test_address_keys(spark):
    got = column(spark, ["1795 westchester drive high point nc", "001795 westchester dr", "", "12 34", "market plaza", "0 main"], text.address_keys)
    assert got == [["a_nw:1795_westchester", "a_nw:1795_high"], ["a_nw:1795_westchester"], [], ["a_nn:12_34"], ["a_ww:market_plaza"], ["a_nw:0_main"]]


def test_ngrams_and_pairs(spark):
    got = column(spark, ["orelee", "", "a"], text.char_ngrams)
    assert {"^or", "ele", "ee$"} <= set(got[0]) and got[1:] == [["^$"], ["^a$"]]
    assert column(spark, ["d c b a e", "x", ""], lambda c: text.token_pairs(text.tokens(c))) == [["a_b", "a_c", "a_d", "b_c", "b_d", "c_d"], [], []]


def test_id_lists(spark):
    assert column(spark, ["S2-10, S3-5, S2-10", "", None], text.parse_id_list) == [["S2-10", "S3-5"], [], []]
    assert column(spark, [["S3-2", "S2-1", "S3-2"], []], text.serialize_id_list, "array<string>") == ["S2-1,S3-2", ""]
    assert column(spark, ["S2-1", "S1-1"], text.has_target_prefix) == [True, False]


def test_minhash_finds_a_typo(spark):
    a, b, c = column(spark, ["orelee barbershop", "orele barbershop", "acme manufacturing"], minhash.band_keys)
    assert len(a) == 8 and set(a) & set(b) and not set(a) & set(c)


def test_config(monkeypatch):
    monkeypatch.setenv("LSH_MAX_CANDIDATES", "7")
    monkeypatch.setenv("BLOCKING_SOFT_COUNTRY_MODE", "false")
    got = BlockingConfig.from_environment(rules=("exact_name",))
    assert (got.lsh_max_candidates, got.blocking_soft_country_mode, got.rules) == (7, False, ("exact_name",))
    with pytest.raises(ValueError):
        BlockingConfig(lsh_num_bands=7)
    with pytest.raises(ValueError):
        BlockingConfig(rules=("nothing",))


def test_jaro_winkler():
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.961111, abs=1e-6)
    assert jaro_winkler("", "") == 0 and jaro_winkler("a", "a") == 1 and jaro_winkler("ab", "xy") == 0
