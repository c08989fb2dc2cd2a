"""Text formats and model tables, written and read back."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from broadsheet.operators import articles, profiles
from broadsheet.plans import flows
from broadsheet.sources import tables

LOG = "user_id long, news_id long, click_ts timestamp_ntz, title string, content string, publish_text string"


@pytest.fixture
def log(frame, at):
    topics = {1: "red fox den", 2: "red fox hill", 3: "blue sea sand", 4: "blue sea wave", 5: "fox den hill"}
    clicks = [(1, 1), (1, 1), (1, 2), (2, 3), (2, 4), (3, 5), (3, 3), (4, 4)]
    rows = [
        (u, n, at(i), topics[n].split()[0], f"{topics[n]} {topics[n]} word{n}", "2024年01月01日00:00")
        for i, (u, n) in enumerate(clicks)
    ]
    return frame(rows, LOG)


def test_brief_log_with_other_line_ends(spark, tmp_path, rows, at):
    path = tmp_path / "brief.tsv"
    path.write_bytes(b"7\t11\t1704067200\r\n 8 \t12\t1704070800\r\n")
    read = tables.read_brief_log(spark, str(path))
    assert rows(read, "user_id", "news_id", "click_ts") == [(7, 11, at(0)), (8, 12, at(1))]


def test_click_log_keeps_quotes_and_odd_text(spark, tmp_path):
    path = tmp_path / "log.tsv"
    path.write_text('7\t11\t1704067200\t"title\tit\'s "so" \\ 50%|x\tNULL\n', encoding="utf-8")
    (row,) = tables.read_click_log(spark, str(path)).collect()
    assert (row["title"], row["content"], row["publish_text"]) == ('"title', 'it\'s "so" \\ 50%|x', "NULL")


def test_click_log_round_trip(spark, tmp_path, log, rows):
    path = str(tmp_path / "log")
    tables.write_click_log(log, path)
    assert rows(tables.read_click_log(spark, path), *log.columns) == rows(log, *log.columns)


def test_keyword_map_keeps_full_precision_and_skips_broken_entries(spark, frame, tmp_path, rows):
    tags = frame([(1, "a", 1 / 3), (1, "b", 1e-7)], "news_id long, term string, weight double")
    news = frame([(1, "NULL")], "news_id long, publish_text string")
    path = str(tmp_path / "map")
    tables.write_keyword_map(tags, news, path)
    assert rows(tables.read_keyword_map(spark, path), "term", "weight") == [("a", 1 / 3), ("b", 1e-7)]
    broken = frame([(1, "x:1|y|z:2:3||w:4|")], "news_id long, keywords string")
    assert rows(tables.parse_keyword_lines(broken), "term", "weight") == [("w", 4.0), ("x", 1.0)]


def test_labelled_csv_with_header_and_label_elsewhere(spark, tmp_path, rows):
    path = tmp_path / "l.csv"
    path.write_text("h1,h2,h3\n1,yes,0.5\nred,no,2\n")
    read = tables.read_labelled_csv(spark, str(path), label_index=1, header=True)
    assert sorted((r["label"], tuple(r["cells"])) for r in read.collect()) == [("no", ("red", "2")), ("yes", ("1", "0.5"))]


def test_labelled_csv_of_any_width(spark, tmp_path, frame):
    path = tmp_path / "l.csv"
    path.write_text('1,a,b,c\n2\n3,"x, ""y""",\n')
    read = tables.read_labelled_csv(spark, str(path))
    assert sorted((r["label"], tuple(r["cells"])) for r in read.collect()) == [("1", ("a", "b", "c")), ("2", ()), ("3", ('x, "y"', ""))]
    tables.write_labelled_csv(frame([("1", 'q"uo,te', None)], "label string, a string, b string"), str(tmp_path / "w"))
    assert [tuple(r["cells"]) for r in tables.read_labelled_csv(spark, str(tmp_path / "w")).collect()] == [('q"uo,te', "")]


def test_cells_are_numbers_ids_or_zero(frame, rows):
    seen = frame([("red",), ("blue",), ("red",), ("3",)], "cell string")
    words = tables.cell_dictionary(seen)
    assert rows(words, "cell_id", "cell") == [(1, "red"), (2, "blue")]
    new = frame([(1, "blue"), (2, "0.5"), (3, "green")], "id long, cell string")
    assert rows(tables.index_cells(new, words, ["id"]), "id", "value") == [(1, 2.0), (2, 0.5), (3, 0.0)]


def test_tagged_union(frame, rows):
    merged = tables.tagged_union({"a": frame([(1,)], "x int"), "b": frame([(2, 3)], "x int, y int")})
    assert sorted(map(tuple, merged.select("source", "x", F.coalesce("y", F.lit(-1))).collect())) == [("a", 1, -1), ("b", 2, 3)]


@pytest.mark.parametrize("format", ["parquet", "csv", "json"])
def test_write_table_overwrites(spark, frame, tmp_path, format):
    path = str(tmp_path / "t")
    for n in (3, 2):
        tables.write_table(frame([(i,) for i in range(n)], "x int"), path, format)
    assert spark.read.schema("x int").format(format).load(path).count() == 2


def test_profile_flow(spark, log, tmp_path, rows, frame):
    folder = str(tmp_path / "model")
    state = flows.train_profiles(log, folder)
    assert set(p.name for p in Path(folder).iterdir()) == {"manifest", "versions"} and set(state) == set(flows.PROFILE_TABLES)
    assert state["articles"].count() == 5
    lists = flows.recommend_from_profiles(spark, folder, log, frame([(1,)], "user_id long"), 2)
    assert [r[1] for r in rows(lists, "rank", "news_id")] == [1, 2]
    everyone = flows.recommend_from_profiles(spark, folder, log)
    assert everyone.select("user_id").distinct().count() == 4
    assert everyone.groupBy("user_id").count().where("count <> 5").count() == 0


def test_lists_with_later_clicks_equal_those_of_all_clicks(spark, log, tmp_path, rows):
    first, whole = str(tmp_path / "first"), str(tmp_path / "whole")
    flows.train_profiles(log, whole)
    tags = flows.train_profiles(log, first)["tags"]
    later = F.col("user_id") == 2
    tables.save_state({"profiles": profiles.keyword_profile(articles.brief_clicks(log.where(~later)), tags)}, first)
    updates = profiles.keyword_profile(articles.brief_clicks(log.where(later)), tags)
    columns = ["user_id", "rank", "news_id"]
    expected = rows(flows.recommend_from_profiles(spark, whole, log), *columns)
    assert rows(flows.recommend_after_updates(spark, first, updates, log), *columns) == expected


def test_session_flow_boosts_what_was_read_in_the_slot(spark, log, tmp_path, at):
    folder = str(tmp_path / "model")
    tags = flows.train_profiles(log, folder)["tags"]
    now = F.lit(at(40)).cast("timestamp_ntz")
    lists = flows.recommend_for_session(spark, folder, log, log, now, n=3)
    assert lists.groupBy("user_id").count().where("count <> 3").count() == 0
    boosted = profiles.slot_boosted_profile(articles.brief_clicks(log), tags, now)
    plain = flows.ranking.recommend_by_overlap(boosted, tags, 3, articles=flows.article_list(log))
    key = lambda r: (r["user_id"], r["rank"], r["news_id"])
    assert sorted(map(key, lists.collect())) == sorted(map(key, plain.collect()))


def test_lines_with_bad_numbers_become_nulls(spark, frame, tmp_path):
    path = str(tmp_path / "lines")
    frame([("x|y\t3",), ("5|0\t4",)], "value string").write.text(path)
    read = tables.read_assignments(spark, path)
    assert sorted((r["news_id"] or 0, r["category"]) for r in read.collect()) == [(0, 3), (5, 4)]
    lines = frame([(1, "a:0.5|b:heavy|")], "news_id long, keywords string")
    found = {r["term"]: r["weight"] for r in tables.parse_keyword_lines(lines).collect()}
    assert found == {"a": 0.5, "b": None}
    log = frame([("1", "one", None)], "user_id string, news_id string, click_ts timestamp_ntz")
    assert [tuple(r) for r in articles.brief_clicks(log).collect()] == [(1, None, None)]


def test_category_flow(spark, log, tmp_path, at):
    folder = str(tmp_path / "model")
    model = flows.train_categories(log, folder, k=2)
    assert model["assignment"].count() == 5
    assert flows.classify_new(spark, folder, log).count() == 5
    now = F.lit(at(40)).cast("timestamp_ntz")
    lists = flows.recommend_from_categories(log, model["assignment"], now, 3)
    assert {r["user_id"] for r in lists.collect()} == {1, 2, 3, 4}
    new = flows.recommend_new(spark, folder, log, log, now, 2)
    assert {r["user_id"] for r in new.collect()} == {1, 2, 3, 4}
    assert new.where("rank > 2").count() == 0


def test_a_failed_save_leaves_the_old_model(spark, tmp_path):
    folder = str(tmp_path / "model")
    one, two = spark.range(3), spark.range(5)
    tables.save_state({"a": one, "b": one}, folder)
    broken = two.select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        tables.save_state({"a": two, "b": broken}, folder)
    kept = tables.load_state(spark, folder, ["a", "b"])
    assert (kept["a"].count(), kept["b"].count()) == (3, 3)
    before = kept["a"]
    tables.save_state({"a": two}, folder)
    now = tables.load_state(spark, folder, ["a", "b"])
    assert (now["a"].count(), now["b"].count(), before.count()) == (5, 3, 3)  # a reader keeps what it had
