"""Decision tables of the column functions, one row per branch."""

import hashlib
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from runsift.functions import actors, entities, messages, outcomes, quota, requests, text
from runsift import fixed_values as fv

C = F.col


def test_human_actor(values):
    table = [
        (None, False),
        ("{}", False),
        ('{"id":5}', True),
        ('"x"', False),
        ("[]", False),
        ('{"login":"talbot","type":"User"}', False),
        ('{"login":"x[bot]","type":"User"}', False),
        ('{"login":"DEPENDABOT","type":""}', False),
        ('{"login":"ann","type":"Bot"}', False),
        ('{"login":"ann","type":"Organization"}', True),
        ('{"login":null,"type":null}', True),
        ("not json", False),
        ('{"login":"ci-bot"}', False),
    ]
    assert values("a STRING", [(a,) for a, _ in table], actors.is_human(C("a"))) == [h for _, h in table]


def test_run_actor_and_worth(values):
    bob = '{"login":"bob","type":"User"}'
    rows = [("u", "{}", bob), ("u", None, bob), ("u", None, None), ("u", "[]", bob), ("u", '"x"', bob), ("", bob, bob), (None, bob, bob), ("u", " { } ", bob)]
    expected = [True, True, False, True, False, False, False, True]
    chosen = actors.run_actor(C("t"), C("a"))
    assert values("u STRING, t STRING, a STRING", rows, actors.worth_a_request(C("u"), chosen)) == expected


ADMIN, ACCEPT = '{"message":"Must have ADMIN rights"}', '{"message":"Unsupported \'Accept\' header"}'


@pytest.mark.parametrize("code, table", [
    (outcomes.github_code, [
        (200, None, "ok"), (302, None, "redirect"), (401, "{}", "auth"), (403, "{}", "auth"), (404, "{}", "gone"),
        (404, ADMIN, "auth"), (403, ACCEPT, "auth"), (500, ACCEPT, "auth"), (410, "{}", "error"), (415, "{}", "auth"),
        (429, "{}", "error"), (503, None, "error"), (404, "not json", "gone"), (404, '["admin rights"]', "auth"),
        (404, '{"message":"other","note":"admin rights"}', "gone"), (404, '{"message":"","note":"admin rights"}', "auth"),
        (404, '{"message":"admin\\u0020rights"}', "auth"), (404, '{"message":"unsupported \\u0027accept\\u0027 header"}', "auth"),
        (200, ADMIN, "ok"),
    ]),
    (outcomes.travis_code, [
        (200, None, "ok"), (302, None, "redirect"), (401, "", "auth"), (403, "", "auth"), (404, ADMIN, "gone"),
        (415, "", "error"), (410, "", "error"), (429, "", "error"), (503, "", "error"),
    ]),
])
def test_first_response(values, code, table):
    rows = [(s, b) for s, b, _ in table]
    assert values("s INT, b STRING", rows, code(C("s"), C("b"))) == [o for _, _, o in table]


def test_log_outcome(values):
    rows = [(None, None), ("redirect", 200), ("redirect", 500), ("redirect", None), ("ok", None), ("gone", 200), ("auth", None)]
    assert values("c STRING, f INT", rows, outcomes.log_outcome(C("c"), C("f"))) == [
        "error", "ok", "error", "error", "ok", "gone", "auth"]


def test_probe_predicates(values):
    assert values("s INT", [(200,), (302,), (404,), (None,)], outcomes.content_exists(C("s"))) == [True, False, False, False]
    rows = [(200, 3), (200, 0), (200, None), (404, 3), (None, None)]
    assert values("s INT, n LONG", rows, outcomes.has_runs(C("s"), C("n"))) == [True, False, False, False, False]


def test_slugs_and_addresses(values):
    rows = [("a/b",), ("a/b/c",), ("plain",), (None,)]
    assert values("s STRING", rows, text.slug_owner(C("s")))[:2] == ["a", "a"]
    assert values("s STRING", rows, text.slug_name(C("s"))) == ["b", "b/c", None, None]
    assert values("s STRING", rows, text.is_slug(C("s"))) == [True, True, False, False]
    assert values("s STRING", rows[:2], text.travis_slug(C("s"))) == ["a%2Fb", "a%2Fb/c"]
    one = rows[:1]
    assert values("s STRING", one, text.runs_address("https://h//", C("s"))) == ["https://h/repos/a/b/actions/runs"]
    assert values("s STRING", one, text.contents_address("https://h", C("s"), F.lit("//x.yml"))) == ["https://h/repos/a/b/contents/x.yml"]
    assert values("s STRING", one, text.travis_builds_address("https://h", C("s"))) == ["https://h/repo/a%2Fb/builds"]
    assert values("s STRING", one, text.search_address("https://h/")) == ["https://h/search/repositories"]
    assert values("j LONG", [(7,)], text.travis_log_address("https://h", C("j"))) == ["https://h/job/7/log"]


def test_search_string(values):
    d1, d2 = date(2020, 1, 1), date(2020, 1, 7)
    rows = [("Java", d1, d2, "2019-01-01", 50), ("", None, None, "2019-01-01", 0), ("Java", d1, None, "", 5), (None, None, None, None, 0)]
    expected = ["language:Java created:2020-01-01..2020-01-07 stars:>=50", "pushed:>=2019-01-01", "language:Java stars:>=5", ""]
    search = text.search_string(C("l"), C("f"), C("t"), C("u"), C("m"))
    assert values("l STRING, f DATE, t DATE, u STRING, m INT", rows, search) == expected


def test_lists_masks_and_keys(values):
    rows = [([" a ", "", "  ", "b\n", "a"],), ([],)]
    assert values("a ARRAY<STRING>", rows, text.clean_strings(C("a"))) == [["a", "b", "a"], []]
    assert values("a ARRAY<STRING>", [(["A", "B"],), ([],)], text.language_clause(C("a"))) == ["language:A OR language:B", ""]
    assert values("s STRING", [("123456789",), ("12345678",), (None,)], text.mask_secret(C("s"))) == ["1234...6789", "...", None]
    keys = values("u STRING, p STRING", [("u", None), ("u", "{}"), ("u", '{"page": 1}')], text.request_key(C("u"), C("p")))
    assert keys == [hashlib.md5(t.encode()).hexdigest() for t in ("u:null", "u:{}", 'u:{"page": 1}')]


def test_waits(values):
    rows = [(None,), ("0.2",), ("7",), ("Wed, 21 Oct",), ("",)]
    assert values("h STRING", rows, requests.retry_after_seconds(C("h"), 300)) == [300.0, 1.0, 7.0, 300.0, 300.0]
    assert values("n INT", [(1,), (2,), (4,)], requests.backoff_seconds(C("n"), 0.25)) == [0.25, 0.5, 2.0]
    assert values("n INT", [(0,), (1,), (3,)], requests.backoff_total(C("n"), 0.25)) == [0.0, 0.25, 1.75]


def test_github_disposition(values):
    spam = '{"message":"Flagged as SPAMMY"}'
    table = [  # method, status, remaining, body, cache, failed, retries, disposition, marks
        ("GET", 304, None, None, "readable", False, 0, "serve_cached", False),
        ("GET", 304, None, None, "unreadable", False, 0, "retry_without_etag", False),
        ("GET", 304, None, None, "none", False, 0, "return", False),
        ("POST", 304, None, None, "readable", False, 0, "return", False),
        ("GET", 401, None, spam, "none", False, 0, "retry_credential_removed", False),
        ("GET", 429, "5", "{}", "none", False, 0, "return", True),
        ("GET", 429, "5", spam, "none", False, 0, "retry_credential_disabled", True),
        ("GET", 403, "0", spam, "none", False, 0, "retry_quota_exhausted", True),
        ("GET", 403, "1", "{}", "none", False, 0, "return", False),
        ("GET", 403, "1", spam, "none", False, 0, "retry_credential_disabled", False),
        ("GET", 400, None, spam, "none", False, 0, "return", False),
        ("GET", 404, None, spam, "none", False, 0, "retry_credential_disabled", False),
        ("GET", 503, None, "", "none", False, 2, "retry_server_error", False),
        ("GET", 503, None, "", "none", False, 3, "return", False),
        ("GET", 200, None, spam, "none", False, 0, "return", False),
        ("GET", None, None, None, "none", True, 2, "retry_failed", False),
        ("GET", None, None, None, "none", True, 3, "give_up", False),
    ]
    schema = "m STRING, s INT, r STRING, b STRING, c STRING, f BOOLEAN, n INT"
    rows = [t[:7] for t in table]
    told = requests.github_disposition(
        C("m"), C("s"), C("r"), requests.is_spam_flag(C("s"), C("b")), C("c"), C("f"), C("n"), 3)
    assert values(schema, rows, told) == [t[7] for t in table]
    assert values(schema, rows, requests.quota_exhausted(C("s"), C("r"))) == [t[8] for t in table]


def test_travis_disposition(values):
    rows = [(429, False, 9), (503, False, 2), (503, False, 3), (404, False, 0), (None, True, 0), (None, True, 3)]
    told = requests.travis_disposition(C("s"), C("f"), C("n"), 3)
    assert values("s INT, f BOOLEAN, n INT", rows, told) == [
        "wait_and_retry", "retry_server_error", "return", "return", "retry_failed", "give_up"]


def test_quota_columns(values):
    rows = [(3, 50), (0, 50), (0, 150), (None, None), (7, 150)]
    schema, now = "r LONG, t LONG", F.lit(100)
    assert values(schema, rows, quota.effective_quota(C("r"), C("t"), now, stored=True)) == [5000, 5000, 0, 5000, 7]
    assert values(schema, rows, quota.effective_quota(C("r"), C("t"), now, stored=False)) == [3, 5000, 0, 5000, 7]
    assert values("d BOOLEAN", [(True,), (False,), (None,)], quota.is_enabled(C("d"))) == [False, True, True]
    at = datetime(2024, 1, 1)
    now_at = F.lit(at)
    assert values("c TIMESTAMP", [(None,), (at,), (datetime(2024, 1, 2),)], quota.cool_down_label(C("c"), now_at)) == [
        "Ready", "Ready", "2024-01-02T00:00:00Z"]
    assert values("c TIMESTAMP", [(None,), (at,)], quota.last_used_label(C("c"))) == ["Never", "2024-01-01T00:00:00Z"]


def test_messages_cover_all_reasons(values):
    rows = [(reason,) for reason in fv.GITHUB_REASONS]
    told = messages.message_for(C("r"), fv.GITHUB_REASONS, F.lit("12"))
    assert values("r STRING", rows, told) == [t.replace("%s", "12") for _, t in fv.GITHUB_REASONS.values()]
    assert values("r STRING", rows, messages.status_for(C("r"), fv.GITHUB_REASONS)) == [s for s, _ in fv.GITHUB_REASONS.values()]


def test_entity_guards(values):
    rows = [(200, '{"a":1}'), (404, '{"message":"x"}'), (200, "[1]"), (200, "no"), (200, None), (200, "3")]
    schema = "s INT, b STRING"
    assert values(schema, rows, entities.body_shape(C("b"))) == ["object", "object", "list", None, None, "scalar"]
    assert values(schema, rows, entities.object_or_null(C("s"), C("b"))) == ['{"a":1}', None, None, None, None, None]
    assert values(schema, rows, entities.object_or_null(C("s"), C("b"), raw=True))[1] == '{"message":"x"}'
    graph = [(200, '{"data":1,"errors":[]}'), (502, '{"errors":[1]}'), (200, '{"data":1}')]
    assert values(schema, graph, entities.graphql_body(C("s"), C("b"))) == ['{"data":1,"errors":[]}', "{}", '{"data":1}']
    assert values(schema, graph, entities.graphql_has_errors(C("s"), C("b"))) == [True, False, False]
