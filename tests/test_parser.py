import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanloom.operators.metrics import Range, default_step, exemplar_count
from spanloom.operators.search import legacy_query
from spanloom.plans import ast as A
from spanloom.plans.parser import duration_ns, parse, parse_attribute, unquote


def expr(text):
    return parse("{ " + text + " }").root.stages[0].expr


@pytest.mark.parametrize(
    ("text", "ns"),
    [("100ms", 10**8), ("1.5s", 1_500_000_000), ("1h30m", 5400 * 10**9), ("2d", 172800 * 10**9), ("1w", 604800 * 10**9), ("5us", 5000), ("5µs", 5000), ("7ns", 7), ("1y", 31536000 * 10**9)],
)
def test_durations(text, ns):
    assert duration_ns(text) == ns
    assert expr(f"duration > {text}").right == A.Static("duration", ns)


def test_precedence():
    assert expr(".a = 1 && .b = 2 || .c = 3").op == "||"
    assert expr("1 + 2 * 3 = 7").left == A.Binary("+", A.Static("int", 1), A.Binary("*", A.Static("int", 2), A.Static("int", 3)))
    assert expr("2 ^ 3 ^ 2 = 512").left.right.op == "^"
    assert expr("-.a + 1 = 0").left.op == "+"
    assert isinstance(expr("!.a && .b").left, A.Unary)
    root = parse("{ .a } && { .b } >> { .c }").root.stages[0]
    assert root.op == "&&" and root.right.op == ">>"


def test_attributes():
    assert expr('span."attr with space" = 1').left == A.Attr("span", "attr with space")
    assert expr(".http.status-code = 200").left == A.Attr("", "http.status-code")
    assert expr("resource.service.name != nil").left == A.Attr("resource", "service.name")
    assert expr("trace:duration > 1s").left.name == "traceDuration"
    assert parse_attribute("service.name") == A.Attr("", "service.name")
    assert parse_attribute("event.exception.type") == A.Attr("event", "exception.type")


def test_metrics():
    q = parse("{ kind = server } | quantile_over_time(duration, .5, 0.99) by (name, span.x) | topk(3) > 1ms with (exemplars=true, sample=0.1)")
    assert q.root.agg.quantiles == (0.5, 0.99) and [b.text for b in q.root.agg.by] == ["name", "span.x"]
    assert q.root.second == (A.Rank("topk", 3), A.Threshold(">", 0.001)) and q.hints == {"exemplars": True, "sample": 0.1}
    q = parse("({} | rate()) - ({} | rate()) - ({} | rate()) * 2")
    assert q.root.op == "-" and q.root.left.op == "-" and q.root.right.op == "*"
    q = parse("60 * ({} | rate()) | bottomk(2)")
    assert q.root.left == 60.0 and q.root.second == (A.Rank("bottomk", 2),)
    q = parse('{ name = "a | rate()" } | compare({ status = error }, 5, 10, 20)')
    assert (q.root.agg.top, q.root.agg.start_ns, q.root.agg.end_ns) == (5, 10, 20)


@pytest.mark.parametrize(
    "text",
    ["", "{", "{ .a = }", "{} | rate() by ()", "{} | topk(2)", "{ } | 1 > 2", "{ .a ~~ 1 }", "{} | quantile_over_time(duration, 2)", "{} | coalesce", "5", "{} | compare({}, 1, 2)", "{} }"],
)
def test_errors(text):
    with pytest.raises(A.QueryError):
        parse(text)


def test_unquote():
    assert unquote(r'"a\"b\\c\n\x41é"') == 'a"b\\c\nAé'
    assert unquote("`a\\b`") == "a\\b"


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=20))
def test_strings_survive(text):
    quoted = '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'
    assert expr(f"name = {quoted}").right == A.Static("string", text)


def test_ranges_and_steps():
    assert Range(1_500, 9_001, 1000).aligned() == Range(1000, 10_000, 1000)
    second = 10**9
    assert default_step(3600 * second) == 15 * second
    assert default_step(24 * 3600 * second) == 300 * second
    assert default_step(10 * second) == 50_000_000
    assert exemplar_count(None, {}) == 100 and exemplar_count(5000, {}) == 1000 and exemplar_count(3, {"exemplars": 7}) == 7
    assert exemplar_count(0, {}) == 100 and exemplar_count(3, {"exemplars": False}) == 0


def test_legacy_tags():
    assert legacy_query({"service.name": "a.b", "status": "error"}, "1s", "2s") == (
        '{ .service.name =~ "(?is).*a\\\\.b.*" && status = error && duration >= 1s && duration <= 2s }'
    )
    with pytest.raises(A.QueryError):
        legacy_query({}, "2s", "1s")
