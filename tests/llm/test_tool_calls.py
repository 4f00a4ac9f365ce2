from tidemark.llm.tool_calls import Param, Tool, chain_depths, link_calls, unlinked

CALLS = "conv_id long, call_id string, turn long, tool string, arguments string, after string, rank string"
RESULTS = "conv_id long, call_id string, turn long, content string, before string"
TOOLS = (Tool("add", (Param("a", "integer", True), Param("b", "number"), Param("tags", "array"), Param("o", "object"))), Tool("now", ()))

ROWS = [
    (1, "x", 1, "add", '{"b": 2.5, "a": 1}', None),
    (1, "y", 2, "add", '{"a": "1", "z": null}', "z"),
    (1, "z", 3, "now", "{}", "x"),
    (1, "z", 3, "now", "{}", "x"),  # a repeated row
    (1, "u", 4, "now", '{"k":1}', "nowhere"),
    (1, "c1", 5, "now", "{}", "c2"),
    (1, "c2", 6, "now", "{}", "c1"),
    (1, "c3", 7, "now", "{}", "c1"),
    (2, "x", 1, "other", "[1]", "x"),
    (2, "w", 2, "other", "{}", None),
    (2, "v", None, None, None, None),
    (2, "q", 9, "add", '{"a":1,"b":"s","tags":[1],"o":{"y":1,"x":[true,null]}}', None),
    (None, "x", 1, "add", "{}", None),
    (3, None, 1, "add", "{}", None),
]
ANSWERS = [(1, "x", 9, "later"), (1, "x", 2, "first"), (1, "gone", 2, "lost"), (2, "w", 3, None), (None, "x", 4, "none"), (1, "z", None, "é\n")]


def frames(spark):
    return spark.createDataFrame([(*r, "clash") for r in ROWS], CALLS), spark.createDataFrame([(*r, "clash") for r in ANSWERS], RESULTS)


def test_links_order_and_errors(spark):
    calls, results = frames(spark)
    got = {(r.conv_id, r.call_id): r for r in link_calls(calls, results, TOOLS).collect()}
    order = sorted((r.position, r.call_id) for r in got.values() if r.conv_id == 1)
    assert order == [(1, "x"), (2, "u"), (3, "z"), (4, "y"), (5, "c1"), (6, "c2"), (7, "c3")]
    assert [got[1, k].depth for k in ("x", "z", "y", "u", "c1", "c3")] == [0, 1, 2, 0, None, None]
    assert got[1, "z"].copies == 2
    assert (got[1, "x"].n_results, got[1, "x"].result_turn) == (2, 2)
    errors = {k: list(r.errors) for k, r in got.items()}
    assert errors[1, "x"] == []
    assert errors[1, "y"] == ["type:a", "unknown:z"]
    assert errors[1, "u"] == ["unknown:k"]
    assert errors[1, "c1"] == ["circular"]
    assert errors[2, "x"] == ["not_an_object", "circular"]
    assert errors[2, "w"] == ["unknown_tool"]
    assert errors[2, "v"] == ["not_an_object"]
    assert errors[2, "q"] == ["type:b"]
    assert got[1, "x"].message == '{"arguments":{"a":1,"b":2.5},"id":"x","name":"add","result":"first"}'
    assert got[2, "q"].message == '{"arguments":{"a":1,"b":"s","o":{"x":[true,null],"y":1},"tags":[1]},"id":"q","name":"add"}'
    assert got[1, "z"].message == '{"arguments":{},"id":"z","name":"now","result":"é\\n"}'


def test_unlinked(spark):
    calls, results = frames(spark)
    got = {(r.kind, r.conv_id, r.call_id) for r in unlinked(calls, results).collect()}
    assert got == {("result", 1, "gone"), ("result", None, "x"), ("call", None, "x"), ("call", 3, None)}


def test_empty(spark):
    calls, results = frames(spark)
    assert link_calls(calls.limit(0), results, TOOLS).count() == 0
    assert link_calls(calls, results.limit(0), TOOLS).filter("n_results > 0").count() == 0
    assert unlinked(calls.limit(0), results.limit(0)).count() == 0


def test_long_chain(spark):
    rows = [(1, f"c{k}", k, "now", "{}", f"c{k - 1}") for k in range(700)]
    df = spark.createDataFrame(rows, "conv_id long, call_id string, turn long, tool string, arguments string, after string")
    assert {r.turn: r.depth for r in chain_depths(df).collect()} == {k: k for k in range(700)}
