"""Lines, grids, glyphs, words and gates on cases that the driver's tables do not hold."""

from pyspark.sql import functions as F

from foliospark.operators import gates, layout, sequence


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_grid(spark):
    ten = [(1, 10 * k + d, y) for k in range(11) for d in (0, 1) for y in range(30)] + [(2, 5, y) for y in range(30)]
    across = [(p, x, y) for p in (1, 2) for y in (0, 40, 41) for x in range(100)]
    make = lambda r: spark.createDataFrame(r, "page int, x int, y int")
    got = layout.grid(make(ten), make(across), ["page"]).collect()
    assert [(r.page, r.xs, r.ys) for r in got] == [(1, [10 * k for k in range(11)], [0, 40])]
    assert layout.grid(make(ten).limit(0), make(across), ["page"]).count() == 0


def test_words_numbers_and_edges(spark):
    ink = spark.createDataFrame([(1, x) for x in [0, 1, 2, 6, 7, 20, 21, 22, 40, 41]] + [(2, 5)], "line int, x int")
    words = layout.words_of_line(ink, ["line"], "x")
    assert rows(words, "line", "word", "x0", "x1") == [(1, 1, 0, 3), (1, 2, 6, 8), (1, 3, 20, 23), (1, 4, 40, 42), (2, 1, 5, 6)]
    assert rows(layout.edge_word(words, ["line"]), "line", "x0") == [(1, 0), (2, 5)] and rows(layout.edge_word(words, ["line"], last=True), "x0") == [(5,), (40,)]
    tall = words.withColumn("height", F.when(F.col("word") == 3, 3).otherwise(20))
    assert rows(layout.number_first(tall, ["line"]), "line", "word", "x0", "x1") == [(1, 1, 0, 8), (1, 2, 20, 23), (1, 3, 40, 42), (2, 1, 5, 6)]


def test_serial_glyph(spark):
    spans = {1: [(0, 1, 30), (4, 9, 15), (14, 18, 15), (20, 24, 15)], 2: [(4, 9, 15), (11, 16, 15)], 3: [(4, 30, 15), (40, 44, 15)], 4: [(4, 9, 15)]}
    px = spark.createDataFrame([(c, x, h, 32) for c, runs in spans.items() for a, b, h in runs for x in range(a, b + 1)], "card int, x int, rows int, height int")
    assert rows(layout.serial_glyph(px, ["card"], "height"), "card", "x0", "x1") == [(1, 4, 9)]


def test_text_lines(spark):
    n = {**{y: 5 for y in range(0, 10)}, **{y: (1 if y == 40 else 6) for y in range(26, 56)}, **{y: 5 for y in range(80, 82)}}
    got = layout.text_lines(spark.createDataFrame([(1, y, v) for y, v in n.items()], "page int, y int, n int"), ["page"], "y", "n")
    assert rows(got, "y0", "y1", "middle") == [(0.0, 9.0, 4), (26.0, 39.0, 32), (41.0, 55.0, 48)]


def test_header_lines(spark):
    spans = [(1, 0, 10, 0, 8, "part"), (1, 10.5, 20, 3, 9, "ial"), (1, 30, 40, 2, 9, "name"), (1, 0, 9, 12, 18, "second"), (1, 0, 9, 60, 70, "below"), (2, 0, 5, 0, 5, "no table")]
    s = spark.createDataFrame([(p, float(a), float(b), float(c), float(d), t) for p, a, b, c, d, t in spans], "page int, x0 double, x1 double, y0 double, y1 double, text string")
    got = layout.header_lines(s, spark.createDataFrame([(1, 50.0)], "page int, top double"), "page")
    assert rows(got, "page", "row", "text") == [(1, 1, "partial name"), (1, 2, "second")]


def test_twins(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, "outer"), (1, 2.0, 3.0, "inner"), (1, 30.0, 2.0, "next"), (1, 4.0, 7.0, "of inner alone"), (2, 1.0, 1.0, "other")], "page int, x double, y double, name string")
    got = gates.without_twins(boxes, ["page"], "x", "y", 5)
    assert got.columns == boxes.columns and rows(got, "name") == [("next",), ("of inner alone",), ("other",), ("outer",)]


def test_gates(spark):
    t = spark.createDataFrame([("10", 1), ("9", 2), ("x", 3), (None, 4), ("009", 5)], "k string, i int")
    assert [r.k for r in gates.by_number(t, "k").collect()] == ["009", "9", "10", None, "x"]
    d = spark.createDataFrame([("-", 30.0, 30.0), ("a", 5.0, 3.0), ("a", 5.0, 9.0), (None, 50.0, 9.0)], "t string, w double, h double")
    assert [r.d for r in d.select(gates.is_dash("t", "w", "h").alias("d")).collect()] == [True, True, False, True]
    r = spark.createDataFrame([(1, "ab", 0.9), (2, "abcdef", 0.5), (3, "abcdef", 0.9)], "card int, text string, score double")
    weak = gates.needs_another_cut("text", "score", F.lit(False))
    assert rows(gates.retried(r, r.withColumn("text", F.lit("again")), ["card"], weak).where("text = 'again'"), "card") == [(1,), (2,)]


def test_numbers_of_one_hot_unit(spark):
    df = spark.range(0, 3000, 1, 6).select((F.col("id") % 1000 == 7).alias("u"), (F.col("id") * 7919 % 3000).alias("v"), F.lit(1).alias("_tie"))
    got = sequence.numbered(df, ["u"], ["v"], "place").orderBy("u", "v").collect()
    for flag in (False, True):
        assert [r.place for r in got if r.u == flag] == list(range(sum(r.u == flag for r in got)))
    assert sequence.numbered(df.limit(0), ["u"], ["v"], "place").count() == 0
