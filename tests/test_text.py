import pytest
from pyspark.sql import functions as F

from weftlink.config import Settings
from weftlink.functions import text as X
from weftlink.functions.indic import to_itrans
from weftlink.functions.phonetic import codes, primary_code
from weftlink.functions.similarity import jaro_winkler_text
from weftlink.sources.entities import clean


def one(spark, column, *values):
    return [r[0] for r in spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, t string").orderBy("k").select(column).collect()]


def test_char_ngrams(spark):
    values = ["hello", "abc", "abcd", "a b c", "a", "ab", " ", "  ", "", None, "nullname", "NullAddr", " \tnullname\r\n", "nullnames", "prefix nulladdr", "é漢x\ny"]
    got = one(spark, X.char_ngrams(F.col("t")), *values)
    assert got[:4] == [["hel", "ell", "llo"], ["abc"], ["abc", "bcd"], ["a b", " b ", "b c"]]
    assert got[4:8] == [["a"], ["ab"], [" "], ["  "]] and got[8:13] == [[]] * 5
    assert got[13][0] == "nul" and got[14][0] == "pre" and got[15] == ["é漢x", "漢x\n", "x\ny"]


def test_index_ngrams_skip_sentinels_with_an_id(spark):
    assert one(spark, X.index_ngrams(F.col("t"), "nullname"), "nullname 12", "nullname", "nullnamed") == [[], [], ["nul", "ull", "lln", "lna", "nam", "ame", "med"]]


def test_null_repair_and_country(spark):
    assert one(spark, X.repair_null(F.col("t")), None, " N/A ", "None", "-", "x-", "") == ["", "", "", "", "x-", ""]
    assert one(spark, X.normalise_country(F.col("t")), " USA", "us", None, "France ") == ["us", "us", "", "france"]


def test_cleaning(spark):
    assert one(spark, X.clean_name(F.col("t")), "I.B.M. Corp", "AT&T  Inc.", "a@b", "Café Straße", "ﬁn", "!!", "राम") == ["ibm corporation", "at and t incorporated", "a at b", "cafe strae", "fin", "", "rama"]
    assert one(spark, X.clean_address(F.col("t")), "12 Main St., Rd 5", "1st st") == ["12 main street road 5", "1st street"]
    assert one(spark, X.is_cross_script(F.col("t")), "राम x", "abc", None, "தமிழ்", "ଓଡ଼ିଆ") == [1, 0, 0, 1, 0]
    assert one(spark, X.name_for_vectors(F.col("t")), " A \t b ", None) == ["a b", ""]


def test_clean_table(spark):
    raw = spark.createDataFrame([("S1-1", "Foo Inc", "1 Main St", "USA"), ("S1-2", "", None, "us")], "entity_id string, business_name string, business_address string, country string")
    a, b = clean(raw, "S1").orderBy("entity_id").collect()
    assert (a.name_for_bm25, a.addr_for_bm25, a.country, a.source, a.is_cross_script) == ("foo incorporated", "1 main street", "us", "S1", 0)
    assert (b.name_for_bm25, b.name_for_vectors, b.addr_for_bm25) == ("nullname S1-2", "nullname S1-2", "nulladdr S1-2")


def test_itrans():
    assert [to_itrans(x) for x in ("राम", "कृष्ण", "नमस्ते", "a ९", "বাংলা")] == ["rAma", "kRRiShNa", "namaste", "a 9", "bAMlA"]


def test_phonetic():
    assert codes("smith retail") != codes("x") and set(codes("smith retail")) & set(codes("smyth corp"))
    assert not set(codes("apple")) & set(codes("microsoft"))
    assert codes("123") == codes("") == codes(None) == []
    assert primary_code("Smith") == primary_code("SMITH") == "SM0"
    assert [primary_code(x) for x in ("Thompson", "Knight", "Philip", "Xavier", "church", "school")] == ["TMPS", "NT", "FLP", "SF", "XRX", "SKL"]


@pytest.mark.parametrize(("a", "b", "score"), [("martha", "marhta", 0.961111), ("dixon", "dicksonx", 0.813333), ("abc", "xyz", 0.0), ("", "", 0.0), ("a", "a", 1.0), (None, "a", 0.0)])
def test_jaro_winkler(a, b, score):
    assert abs(jaro_winkler_text(a, b) - score) < 1e-6


def test_settings(spark):
    got = Settings.load({"DAG_K_BASE": "7", "BM25_K1": "x", "ENABLE_TRANSLITERATION": "Yes", "NULL_LITERALS": " a , b,", "BATCH_SIZE": "2.5"})
    assert (got.dag_k_base, got.bm25_k1, got.enable_transliteration, got.null_literals, got.batch_size) == (7, 1.5, True, ("a", "b"), 10000)
    spark.conf.set("spark.weftlink.dag_k_base", "9")
    assert Settings.load({"DAG_K_BASE": "7"}, spark).dag_k_base == 9
    spark.conf.unset("spark.weftlink.dag_k_base")


def test_sql_functions(spark):
    from weftlink.functions import register

    register(spark)
    row = spark.sql("SELECT jaro_winkler('martha', 'marhta') AS j, metaphone_codes('smith') AS m, fold_ascii('Café') AS f, to_itrans('राम') AS t").first()
    assert (round(row.j, 4), row.m, row.f, row.t) == (0.9611, ["SM0"], "Cafe", "rAma")
