import datetime as dt

from pyspark.sql import functions as F

from itinera import functions as X


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_int32_guard(spark):
    vals = ["123", "2147483647", "2147483648", "12a", "", None, "-5", "0000000000000000000000001"]
    got = one(spark, X.int32_or_null("x"), [(v,) for v in vals], "x string")
    assert got == [123, 2147483647, None, None, None, None, None, 1]


def test_hhmm(spark):
    vals = ["0000", "2359", "2400", "1260", "930", "12:30", None]
    got = one(spark, X.hhmm_minutes("x", -1), [(v,) for v in vals], "x string")
    assert got == [0, 1439, -1, -1, -1, -1, -1]


def test_tsql_substring(spark):
    rows = [("abcdef", 0, 3), ("abcdef", -1, 3), ("abcdef", 2, 3), ("abcdef", -5, 3)]
    got = one(spark, X.tsql_substring(F.col("x"), F.col("s"), F.col("n")), rows, "x string, s int, n int")
    assert got == ["ab", "a", "bcd", ""]


def test_minute_diff_counts_boundaries(spark):
    rows = [(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0)),
            (dt.datetime(2024, 1, 1, 10, 0, 0), dt.datetime(2024, 1, 1, 10, 0, 59)),
            (dt.datetime(2024, 1, 1, 10, 5, 0), dt.datetime(2024, 1, 1, 9, 59, 30))]
    got = one(spark, X.minute_diff("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
    assert got == [1, 0, -6]


def test_advance_days(spark):
    d = dt.date
    rows = [(1, d(2024, 1, 10), d(2024, 1, 5), d(2024, 2, 1)),    # booked after issue -> from issue
            (1, d(2024, 1, 1), d(2024, 1, 5), d(2024, 2, 1)),     # from booking
            (1, d(2022, 1, 1), d(2024, 1, 5), d(2024, 2, 1)),     # > 365 -> 0
            (5, d(2024, 1, 10), d(2024, 1, 5), d(2024, 1, 1)),    # exchange, travel before issue -> -1
            (5, None, d(2024, 1, 5), d(2024, 1, 7)),              # booking null -> issue
            (3, d(2024, 1, 1), d(2024, 1, 5), d(2024, 2, 1))]     # other type keeps previous
    expr = X.advance_days("bt", "bd", "idt", "ts", F.lit(7))
    got = one(spark, expr, rows, "bt int, bd date, idt date, ts date")
    assert got == [27, 31, 0, -1, 2, 7]


def like(value, pattern):
    """One LIKE by recursion over the pattern."""
    if not pattern:
        return not value
    if pattern[0] == "%":
        return any(like(value[i:], pattern[1:]) for i in range(len(value) + 1))
    if pattern[0] == "[":
        end = pattern.find("]", 3 if pattern[1:2] == "^" else 2)
        if end < 0:
            return False
        inside, rest = pattern[1:end], pattern[end + 1:]
        negated = len(inside) > 1 and inside[0] == "^"
        inside, chars = inside[negated:], set()
        i = 0
        while i < len(inside):
            if inside[i + 1:i + 2] == "-" and i + 2 < len(inside):
                chars |= {chr(c) for c in range(ord(inside[i]), ord(inside[i + 2]) + 1)}
                i += 3
            else:
                chars.add(inside[i])
                i += 1
        return bool(value) and (value[0] in chars) != negated and like(value[1:], rest)
    return bool(value) and pattern[0] in ("_", value[0]) and like(value[1:], pattern[1:])


def test_like_patterns_as_data(spark):
    patterns = ["%", "", "a%", "%b", "a_c", "[a-c]1", "[^a-c]1", "%[0-9][^0-9]", "x.y", "a+(b)|c$", "[[]x", "[.^]x", "[&&a]", "a[b", "100%",
                "a\\b", "^a", "{2}", "]x", "%]", "[a-c][a-c]%_", "_%_"]
    values = ["", "a", "b1", "d1", "abc", "a1c", "x.y", "xay", "a+(b)|c$", "[x", ".x", "^x", "&", "a", "a[b", "100", "1009", "a\\b", "^a",
              "{2}", "22", "]x", "q]", "a\nc", "cb", "bca", "5x", "55", "a\n"]
    df = spark.createDataFrame([(p, v) for p in patterns for v in values], "p string, v string")
    got = {(r.p, r.v): r.hit for r in df.withColumn("hit", F.regexp_like("v", X.like_regex(F.col("p")))).collect()}
    wrong = {k: hit for k, hit in got.items() if hit != like(k[1], k[0])}
    assert not wrong, wrong


def test_like_class_and_money(spark):
    got = one(spark, X.like_class("x", "[0-1][0-9][0-5][0-9]"), [("1259",), ("1260",), ("2259",)], "x string")
    assert got == [True, False, False]
    got = one(spark, X.to_money("x"), [("",), ("12,50",), ("abc",), (" 3.1 ",)], "x string")
    assert [None if v is None else str(v) for v in got] == ["0.0000", "12.5000", None, "3.1000"]


def test_saturday_and_signed(spark):
    rows = [(dt.date(2024, 1, 5), dt.date(2024, 1, 8)),   # Friday(6) + 3 nights -> 1
            (dt.date(2024, 1, 1), dt.date(2024, 1, 3))]   # Monday(2) + 2 -> 0
    assert one(spark, X.saturday_stay("a", "b"), rows, "a date, b date") == [1, 0]
    got = one(spark, X.signed(F.col("a"), F.col("bt")), [(5, 1), (5, 7), (-5, 4)], "a int, bt int")
    assert got == [5, -5, -5]


def test_great_circle(spark):
    got = one(spark, X.great_circle_miles("a", "b", "c", "d"), [(0.0, 0.0, 0.0, 1.0)],
              "a double, b double, c double, d double")
    assert abs(got[0] - 69.09) < 0.05
