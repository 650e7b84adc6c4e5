"""House numbers, the finishing chain and wording of places, by worked cases."""

from pyspark.sql import functions as F

from foliospark.functions import script as S
from foliospark.operators import cards, finalize, grouping


def test_house_numbers(spark):
    rows = [
        (1, 0, "81", 0.9, "en"), (1, 1, "8", 0.95, "hi"),
        (2, 0, "१४३", 0.8, "hi"), (2, 1, "383", 0.99, "en"),           # the script's own digits silence the other reader
        (3, 0, "13अ", 0.7, "hi"), (3, 1, "133", 0.99, "en"),            # a letter read as a digit
        (4, 0, "ॐ७", 0.9, "hi"),
        (5, 0, "##", 0.9, "hi"), (5, 1, None, None, "en"),
        (6, 0, "12", 0.6, "hi"), (6, 1, "12", 0.6, "en"), (6, 2, "17", 0.65, "en"),
    ]
    df = spark.createDataFrame(rows, "card int, ord int, text string, score double, source string")
    got = {r.card: (r.value, r.why) for r in cards.resolve_house(df, ["card"]).collect()}
    assert got[2] == ("143", "") and got[3][0] == "13अ" and got[4] == ("77", "house_no_symbol_fixed")
    assert got[1] == ("8", "house_no_readings_disagree") and got[6] == ("12", "house_no_readings_disagree") and got[5] == ("", "")
    assert cards.resolve_house(df.limit(0), ["card"]).count() == 0


def test_status(spark):
    rows = [("S", None, 1, 1, None, None, 0.0), ("", "R", 5, 5, None, None, 70.0), ("", "R", 4, 5, "E", 0.6, 70.0), ("", None, None, 1, None, None, 70.0), (None, None, None, 1, "E", 0.4, None), ("#", None, None, 1, None, None, 0.0)]
    df = spark.createDataFrame(rows, "m string, l string, ls int, s int, g string, gs double, stamp double")
    got = [(r.x.code, r.x.deleted) for r in df.select(cards.derive_status("m", "l", "ls", "s", "g", "gs", "stamp").alias("x")).collect()]
    assert got == [("S", True), ("R", True), ("E", True), ("?", True), ("", False), ("#", False)]


def test_finalize_is_repeatable(spark):
    v = spark.createDataFrame([("kumar", 5000), ("ram", 500)], "token string, n bigint")
    rows = [(1, "ram kmar", 0.99, None, None, "green village", 0.95, ""), (2, "ramkumar", 0.95, "ram kumar", 0.9, "greenvillage", 0.5, "x"), (3, None, None, None, None, None, 0.1, None)]
    rows += [(10 + i, "ram kumar", 0.9, None, None, "green village", 0.95, "") for i in range(4)]
    df = spark.createDataFrame(rows, "id int, name string, name_score double, other string, other_score double, place string, confidence double, reason string")
    out, after = finalize.finalize(df, v)
    got = {r.id: r for r in out.collect()}
    assert got[1].name == "ram kumar" and got[1].reason == "name_vocab_fixed" and got[2].name == "ram kumar" and got[2].place == "green village" and got[3].name is None
    assert {r.token: r.n for r in after.collect()}["kumar"] == 5004
    assert {r.id: r.name for r in finalize.finalize(df, v)[0].collect()} == {i: r.name for i, r in got.items()}


def test_wording_of_places():
    assert S.repair_place("क्ष संख्या - 2") == "कक्ष संख्या-2"
    assert S.repair_words("संखयान 1") == "संख्या-1" and S.repair_words("मधय पसाद") == "मध्य प्रसाद"
    assert S.room_number("नमबर-उ") == "नम्बर-3" and S.room_number("नबर 2") == "नम्बर-2"
    assert S.vote_words([("vilage", 0.5), ("x", 0.9)], [("village", 0.9)]) == ["village", "x"]


def test_building_names(spark):
    names = ["प्राथमिक विद्यालय कक्ष संख्या-2", "प्राथमिक विद्यालय रामपुर नं 2", "कक्ष 2", None, "प्राथमिक विद्यालय रामपुर"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = {r.i: (r.b, r.k) for r in df.select("i", grouping.building_name(F.col("n")).alias("b"), grouping.place_key(F.col("n")).alias("k")).collect()}
    assert [got[i][0] for i in range(5)] == ["प्राथमिक विद्यालय", "प्राथमिक विद्यालय रामपुर", "कक्ष 2", "", "प्राथमिक विद्यालय रामपुर"]
    for n, i in zip(names, range(5), strict=True):
        assert got[i][1] == (None if n is None else grouping._plain_key(n))
