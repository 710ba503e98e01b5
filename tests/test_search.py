"""Work lists, search filters, first hits, and which repositories are taken up."""

import random
from datetime import date, datetime

from runsift import Settings
from runsift.operators import discover, providers, worklist

HIT = "slug STRING, seg_idx INT, lang_idx INT, page INT, pos INT"


def test_weekly_segments(spark):
    ranges = [
        ("one-day", "2020-01-01", "2020-01-01"), ("backwards", "2020-01-02", "2020-01-01"), ("seven", "2020-01-01", "2020-01-07"),
        ("eight", "2020-01-01", "2020-01-08"), ("bad", "soon", "2020-01-08"), ("none", None, "2020-01-08"),
        ("long", "2018-12-01", "2024-11-30"), ("short-form", "2020", "2020-02"), ("no-day", "2020-02-31", "2020-03-02"),
    ]
    got = worklist.weekly_segments(spark.createDataFrame(ranges, "name STRING, range_start STRING, range_end STRING")).collect()
    by_name = {}
    for r in sorted(got, key=lambda r: r.seg_idx):
        by_name.setdefault(r.name, []).append((r.segment_from.isoformat(), r.segment_to.isoformat()))
    assert len(by_name.pop("long")) == 314
    assert by_name == {
        "one-day": [("2020-01-01", "2020-01-01")],
        "seven": [("2020-01-01", "2020-01-07")],
        "eight": [("2020-01-01", "2020-01-07"), ("2020-01-08", "2020-01-08")],
    }


def test_segment_forms(spark):
    rows = [
        (1, {"from": "a", "to": "b"}, None), (2, {"start": " a ", "end": "b\n"}, None), (3, {"from_": "a", "to_": "b"}, None),
        (4, None, ["a", "b"]), (5, None, ["a"]), (6, {"from": "a"}, None), (7, {"from": " ", "to": "b"}, None),
        (8, {"from": "", "start": "s", "to": "b", "end": "x"}, None), (9, None, None),
    ]
    frame = spark.createDataFrame(rows, "ordinal INT, fields MAP<STRING, STRING>, pair ARRAY<STRING>")
    got = {r.ordinal: (r.segment_from, r.segment_to) for r in worklist.normalise_segments(frame).collect()}
    assert got == {1: ("a", "b"), 2: ("a", "b"), 3: ("a", "b"), 4: ("a", "b"), 8: ("s", "b")}


def test_segments_of_settings(spark):
    def shown(**given):
        segments = worklist.settings_segments(spark, Settings.from_mapping(given))
        return segments and [(str(r.segment_from), str(r.segment_to)) for r in segments.orderBy("seg_idx").collect()]

    week = {"segment_start": "2020-01-01", "segment_end": "2020-01-08"}
    assert shown() is None
    assert shown(**week) == [("2020-01-01", "2020-01-07"), ("2020-01-08", "2020-01-08")]
    written = [{"start": "2021-02-01", "to": "2021-02-03"}, ["2021-01-01", "2021-01-02"], {"from": "2021-01-01"}]
    assert shown(search_segments=written, **week) == [("2021-02-01", "2021-02-03"), ("2021-01-01", "2021-01-02")]
    assert shown(search_segments=[{"from": "2021-01-01"}], **week) == shown(**week)
    assert shown(segment_start="soon", segment_end="2020-01-08") is None


def test_work_list(spark):
    segments = spark.createDataFrame([(0, date(2020, 1, 1), date(2020, 1, 7)), (1, date(2020, 1, 8), date(2020, 1, 14))],
                                     "seg_idx INT, segment_from DATE, segment_to DATE")
    rows = worklist.work_list(segments, ["A", "B"], Settings(search_pages=3, min_stars=0)).collect()
    assert len(rows) == 12 and {(r.seg_idx, r.lang_idx, r.page) for r in rows} == {
        (s, la, p) for s in (0, 1) for la in (0, 1) for p in (1, 2, 3)}
    assert rows[0].search == "language:A created:2020-01-01..2020-01-07"
    assert worklist.work_list(segments, ["A"], Settings(search_pages=0)).count() == 0
    bare = worklist.work_list(None, [], Settings(min_stars=5, updated_since="2020-02-02"), base=spark.range(1)).collect()
    assert [(r.lang, r.page, r.search) for r in bare] == [("", 1, "pushed:>=2020-02-02 stars:>=5")]


REPO = "slug STRING, language STRING, stargazers_count LONG, created_at TIMESTAMP, pushed_at TIMESTAMP"


def test_search_filter(spark):
    old, new = datetime(2020, 1, 7, 23, 59), datetime(2024, 5, 1)
    repos = spark.createDataFrame([
        ("a", "Java", 50, old, old), ("b", "Java", 49, old, new), ("c", "Perl", 90, old, new), ("d", "Ruby", None, old, new),
        ("e", "Ruby", 80, datetime(2020, 1, 8), new), ("f", "Ruby", 80, datetime(2019, 12, 31), old)], REPO)
    segments = spark.createDataFrame([(0, date(2020, 1, 1), date(2020, 1, 7)), (1, date(2020, 1, 7), date(2020, 1, 8))],
                                     "seg_idx INT, segment_from DATE, segment_to DATE")
    chosen = Settings(languages=("Ruby", "Java"), updated_since="2024-01-01")
    found = {(r.slug, r.seg_idx, r.lang_idx) for r in worklist.search_filter(repos, chosen, segments).collect()}
    assert found == {("a", 0, 1), ("a", 1, 1), ("e", 1, 0)}
    assert {r.slug for r in worklist.search_filter(repos, chosen).collect()} == {"e"}
    everything = Settings(languages=(), min_stars=0, updated_since="")
    assert worklist.search_filter(repos, everything).count() == 6


def test_lists(spark):
    first = spark.createDataFrame([("a",), ("a",), ("b",)], "v STRING")
    removed = spark.createDataFrame([("b",), ("b",)], "v STRING")
    both = worklist.append_lists(first, removed)
    assert sorted(r.v for r in both.collect()) == ["a", "a", "b", "b", "b"]
    assert [r.v for r in worklist.remove_listed(both, removed, "v").collect()] == ["a", "a"]
    untidy = spark.createDataFrame([(" a",), ("a",), (" ",), ("",), (None,)], "v STRING")
    assert [r.v for r in worklist.clean_distinct(untidy, "v").collect()] == ["a"]


def test_page_chains(spark):
    rows = [(0, 0, p, 200, False) for p in (1, 2, 4)] + [(0, 0, 3, 422, False)]
    rows += [(0, 1, 1, 200, False), (0, 1, 2, None, True), (0, 1, 3, 200, False), (1, 0, 1, 500, False), (1, 0, 2, 200, False)]
    rows += [(1, 1, 1, 200, None), (1, 1, 2, 200, False)]
    frame = spark.createDataFrame(rows, "seg_idx INT, lang_idx INT, page INT, status INT, request_failed BOOLEAN")
    kept = {(r.seg_idx, r.lang_idx, r.page) for r in discover.cut_page_chains(frame).collect()}
    assert kept == {(0, 0, 1), (0, 0, 2), (0, 1, 1), (1, 1, 1), (1, 1, 2)}


def test_first_seen_is_the_first_in_traversal_order(spark):
    rnd = random.Random(3)
    hits = [(f"o/{rnd.randint(0, 40)}", s, la, p, pos) for s in range(3) for la in range(3) for p in range(1, 4) for pos in range(5)]
    want = {}
    for slug, *place in sorted(hits, key=lambda h: h[1:]):
        want.setdefault(slug, tuple(place))
    for seed in (1, 2):
        random.Random(seed).shuffle(hits)
        got = discover.first_seen(spark.createDataFrame(hits, HIT)).collect()
        assert {r.slug: (r.seg_idx, r.lang_idx, r.page, r.pos) for r in got} == want
    good, rejects = discover.split_rejects(spark.createDataFrame([("a/b", 0, 0, 1, 0), ("", 0, 0, 1, 1), (None, 0, 0, 1, 2), ("", 0, 0, 1, 3)], HIT))
    assert good.count() == 1 and rejects.count() == 3


def test_search_pages(spark):
    rows = [(0, la, f"o/{i:03d}", i % 7) for la in (0, 1) for i in range(60)]
    frame = spark.createDataFrame(rows, "seg_idx INT, lang_idx INT, slug STRING, stargazers_count LONG")
    for splits in (1, 5):
        chosen = Settings(search_per_page=4, search_pages=3, hot_key_splits=splits)
        got = {(r.lang_idx, r.slug): (r.page, r.pos) for r in discover.search_pages(frame, chosen).collect()}
        for la in (0, 1):
            best = sorted((r for r in rows if r[1] == la), key=lambda r: (-r[3], r[2]))[:12]
            assert {s: (n // 4 + 1, n % 4) for n, (_, _, s, _) in enumerate(best)} == {s: v for (lang, s), v in got.items() if lang == la}
    up = discover.search_pages(frame, Settings(search_per_page=1, search_pages=1, search_order="asc"))
    assert {r.slug for r in up.collect()} == {"o/000"}


def test_seen(spark):
    results = spark.createDataFrame(
        [("retry-only", "p", "retry"), ("both", "p", "ready"), ("both", "q", "retry"), ("null", "p", None), ("error", "p", "error")],
        "slug STRING, provider STRING, status STRING")
    repos = spark.createDataFrame([(s, 0, 0, 1, i) for i, s in enumerate(["new", "retry-only", "both", "null", "error", "newer"])], HIT)
    assert {r.slug for r in discover.drop_seen(repos, results).collect()} == {"new", "retry-only", "newer"}
    assert [r.slug for r in discover.limit_unseen(repos, results, 2).collect()] == ["new", "retry-only"]
    assert discover.limit_unseen(repos, results, 0).count() == 0
    pairs = repos.select("slug").crossJoin(spark.createDataFrame([("p",), ("q",)], "provider STRING"))
    left = {(r.slug, r.provider) for r in discover.drop_seen_pairs(pairs, results).collect()}
    assert left == {(s, p) for s in ("new", "newer", "retry-only") for p in "pq"} | {(s, "q") for s in ("both", "null", "error")}


def test_providers(spark):
    probes = spark.createDataFrame(
        [("both", "runs", 200, 3), ("both", "travis_yml", 200, None), ("gh", "runs", 200, 1), ("gh", "travis_yml", 302, None),
         ("tr", "runs", 200, 0), ("tr", "travis_yml", 200, None), ("none", "runs", 404, 9), ("none", "travis_yml", None, None)],
        "slug STRING, probe STRING, status INT, total_count LONG")
    detected = providers.detect_providers(probes)
    assert {r.slug: list(r.providers) for r in detected.collect()} == {
        "both": ["github_actions", "travis_ci"], "gh": ["github_actions"], "tr": ["travis_ci"], "none": []}
    repos = spark.createDataFrame([("both",), ("none",), ("not-probed",)], "slug STRING")
    assert {(r.slug, r.provider) for r in providers.fan_out(repos, detected).collect()} == {
        ("both", "github_actions"), ("both", "travis_ci"), ("none", "unknown"), ("not-probed", "unknown")}
