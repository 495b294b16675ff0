import datetime

from textlab.operators import profile
from textlab.operators import profile_states as ps
from textlab.plans import comparisons, overview


def frame(spark):
    day = datetime.date
    return spark.createDataFrame(
        [("x", 1, day(2020, 1, 2), "ab", ["p", "q"]), ("x", None, day(2020, 1, 1), "abcd", []),
         (None, 1, None, None, None), ("y", 2, day(2021, 1, 1), "a", ["p"])],
        "name string, section int, filingDate date, sentence string, tickers array<string>",
    )


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_shape(spark):
    assert rows(profile.shape(frame(spark))) == {(4, 5, "name,section,filingDate,sentence,tickers")}


def test_null_is_a_value(spark):
    counted = rows(profile.unique_counts(frame(spark), ["name", "section"]))
    assert counted == {("name", 3), ("section", 3)}
    one = spark.createDataFrame([(1,), (None,), (1,)], "v int")
    assert rows(profile.unique_counts(one, ["v"])) == {("v", 2)}
    assert rows(profile.unique_counts(one, ["v"], approx=True)) == {("v", 2)}


def test_exploded_lists(spark):
    lists = spark.createDataFrame([(["a", "b"],), ([],), (None,)], "t array<string>")
    assert rows(profile.unique_exploded(lists, "t")) == {("t", 3)}


def test_groups_keep_null_and_break_ties_by_key(spark):
    assert rows(profile.group_count(frame(spark), "name")) == {("x", 2), ("y", 1), (None, 1)}
    tied = spark.createDataFrame([("b",), ("a",), ("c",)], "k string")
    assert [r[0] for r in profile.top_groups(tied, "k", 2).collect()] == ["a", "b"]


def test_text_stats(spark):
    assert rows(profile.text_stats(frame(spark), "sentence")) == {(7 / 3, 2.0, 1, 4)}
    even = spark.createDataFrame([("a",), ("ab",), ("abcd",), ("abcde",)], "s string")
    assert profile.text_stats(even, "s").first()["median_length"] == 3.0


def test_missing_data(spark):
    assert rows(profile.missing_data(frame(spark))) == {
        ("name", 1), ("section", 1), ("filingDate", 1), ("sentence", 1), ("tickers", 1)}
    assert profile.missing_data(spark.createDataFrame([(1,)], "v int")).count() == 0


def test_dates_sort_and_contains(spark):
    assert rows(profile.date_range(frame(spark), "filingDate")) == {("2020-01-01", "2021-01-01")}
    assert [r.name for r in comparisons.sort_ascending(frame(spark), "filingDate").collect()] == [None, "x", "x", "y"]
    assert comparisons.filter_contains(frame(spark), "name", "x").count() == 2
    assert [tuple(r) for r in comparisons.chain_top(frame(spark), 1).collect()] == [(None, 1), ("x", 1)]
    assert [r[0] for r in profile.first_distinct(frame(spark), "section", 2).collect()] == [None, 1]


def test_overall_rows(spark):
    df = frame(spark)
    report = rows(overview.as_rows(df, overview.overall_stats(df, distinct=["name"], lists=["tickers"])))
    assert ("shape", "rows", 4.0, None) in report
    assert ("unique", "tickers", 3.0, None) in report
    assert ("missing", "sentence", 1.0, None) in report
    assert ("top_groups", "x", 2.0, None) in report
    assert ("dates", "earliest", None, "2020-01-01") in report


def parts_of(stats):
    return {part: rows(df) for part, df in stats.items() if part != "states"}


def test_states_of_two_halves_merge_to_those_of_the_whole(spark):
    df = frame(spark)
    stated = lambda part: ps.profile_states(part, ["name", "section"], "filingDate", "sentence")
    halves = [stated(df.where("coalesce(section, 0) = 1")), stated(df.where("coalesce(section, 0) <> 1"))]
    whole = stated(df)
    assert rows(ps.merged(*halves)) == rows(whole) == rows(ps.merged(whole, stated(df.limit(0))))
    got = parts_of(overview.report_parts(ps.merged(*halves), df, distinct=["name"]))
    assert got == parts_of(overview.overall_stats(df, distinct=["name"]))
    assert got["shape"] == rows(profile.shape(df)) and got["missing_data"] == rows(profile.missing_data(df))
    assert got["text_statistics"] == rows(profile.text_stats(df, "sentence")) and got["date_range"] == rows(profile.date_range(df, "filingDate"))
    assert got["unique_values"] == rows(profile.unique_counts(df, ["name"])) and got["top_groups"] == rows(profile.top_groups(df, "name", 10))
    assert got["section_distribution"] == rows(profile.top_groups(df, "section", 15))
    approx = overview.overall_stats(df, distinct=["name", "sentence"], approx=True)
    assert rows(approx["unique_values"]) == {("name", 3), ("sentence", 4)}


def test_the_report_reads_its_table_once(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    stated = ps.profile_states(df, ["name"], "filingDate", "sentence")
    assert stated._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    report = overview.as_rows(df, overview.overall_stats(df, distinct=["name"]))
    assert str(tmp_path) not in report._jdf.queryExecution().optimizedPlan().toString()
    assert not any(str(tmp_path) in f for f in report.inputFiles())


def test_empty_input(spark):
    df = frame(spark).limit(0)
    stats = overview.overall_stats(df, distinct=["name"])
    assert profile.text_stats(df, "sentence").first()[0] is None
    assert stats["scalars"].first()["rows"] == 0
    assert overview.as_rows(df, stats).count() > 0


def test_scalar_report_is_one_scan_and_top_k_does_not_sort_globally(spark, sf):
    from queries import views

    plan = profile.top_groups(views.sentences(spark, sf), "name", 10)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
