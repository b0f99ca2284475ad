from __future__ import annotations

import json
import random

from pseudora.llm import chatformat

SCHEMA = "conv_id long, turn long, role string, text string, level string, place int"


def call(id, name, arguments):
    return f"<tool_call>{json.dumps({'name': name, 'id': id, 'arguments': arguments})}</tool_call>"


def answer(id, content):
    return f"<tool_result>{json.dumps({'content': content, 'id': id})}</tool_result>"


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], SCHEMA)
    found = {}
    for r in chatformat.format_chat(df).collect():
        found.setdefault((r["conv_id"], r["turn"]), []).append(r)
    return found


def test_links_levels_and_validity(spark):
    rows = [
        (1, 0, "user", 'say "hé"\n'),
        (1, 1, "assistant", "Let me. " + call("a", "search", {"query": "x", "limit": 3}) + call("b", "fetch", {"url": "$a"})),
        (1, 2, "tool", answer("a", {"z": 1, "a": [True, None]}) + answer("zz", 1)),
        (1, 3, "assistant", call("c", "fetch", {"url": "$b", "headers": {"k": "v"}}) + call("d", "search", {"limit": "3"})),
        (1, 4, "tool", answer("b", "late")),
        (2, 0, "assistant", call("a", "search", {"query": 5}) + call("e", "calculate", {"expression": "$f"})),
        (2, 1, "assistant", call("f", "calculate", {"expression": "$e"}) + call("g", "nothing", {}) + call("h", "search", {"query": "q", "more": 1})),
        (2, 2, "assistant", "<tool_call>not json</tool_call>"),
        (3, 0, "tool", answer("q", 1)),
        (3, 1, "assistant", call("q", "search", {"query": "late call"})),
    ]
    found = run(spark, rows)
    row = {k: v[0] for k, v in found.items()}
    message = {k: json.loads(v["message"]) for k, v in row.items()}
    assert row[1, 0]["message"] == '{"content":"say \\"hé\\"\\n","conv_id":1,"role":"user","tool_calls":[],"tool_results":[],"turn":0}'
    a, b = message[1, 1]["tool_calls"]
    assert (a["level"], a["linked"], a["valid"], a["result"]) == (0, True, True, '{"a":[true,null],"z":1}')
    assert a["arguments"] == '{"limit":3,"query":"x"}'
    assert (b["level"], b["linked"], b["valid"]) == (1, True, True)
    c, d = message[1, 3]["tool_calls"]
    assert (c["level"], c["linked"], c["valid"]) == (2, False, True)
    assert (d["level"], d["valid"]) == (0, False)
    assert [r["linked"] for r in message[1, 2]["tool_results"]] == [True, False]
    assert (row[1, 2]["n_results"], row[1, 2]["n_linked"]) == (2, 1)
    assert [x["level"] for x in message[2, 0]["tool_calls"]] == [0, -1]
    assert [x["valid"] for x in message[2, 1]["tool_calls"]] == [True, False, False]
    assert message[2, 0]["tool_calls"][0]["valid"] is False
    assert (row[2, 2]["n_calls"], row[2, 2]["n_valid"], row[2, 2]["n_linked"]) == (1, 0, 0)
    assert message[3, 0]["tool_results"][0]["linked"] is False


def test_nulls_repeats_and_no_rows(spark):
    rows = [(None, None, None, None), (1, 0, None, ""), (1, 0, "user", call("a", "search", {"query": "x"}))] * 2
    rows.append((None, 1, "assistant", call("a", "search", {"query": "y"})))
    found = run(spark, rows)
    assert sum(map(len, found.values())) == len(rows)
    assert json.loads(found[None, None][0]["message"])["content"] is None
    assert run(spark, []) == {}


def test_keys_are_sorted_at_every_depth(spark):
    rows = [(1, 0, "assistant", call("a", "fetch", {"url": "u", "headers": {"b": 1, "a": {"d": [], "c": 2.5}}}))]
    message = run(spark, rows)[1, 0][0]["message"]
    arguments = json.loads(message)["tool_calls"][0]["arguments"]
    assert arguments == json.dumps(json.loads(arguments), sort_keys=True, separators=(",", ":"))
    assert message == json.dumps(json.loads(message), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_the_query_works_on_calls_of_the_given_rows(spark, tmp_path):
    """A conversation of 2,000 turns holds nearly all rows."""
    from pseudora.llm import queries

    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f'say "{k}" <b>', "x", 9) for k in range(2000)]
    rows += [(2, 0, "system", "be kind", "x", 9), (2, 1, "user", None, "x", 9), (2, None, "user", "a", "x", 9)]
    rows += [(3, 0, "system", "be kind", "x", 9), (3, 1, "user", "$a", "x", 9), (3, 2, "assistant", "b", "x", 9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    found = {(r["conv_id"], r["turn"]): r for r in queries.QUERIES["op3_format_chat"](spark, str(tmp_path)).collect()}
    assert len(found) == len(rows)
    long = [found[1, k] for k in range(2000)]
    assert all((r["n_calls"], r["n_results"], r["n_linked"]) == ((1, 0, 1), (0, 1, 1))[k % 2] for k, r in enumerate(long))
    levels = {}
    for k in range(0, 2000, 2):
        levels[k] = 1 + levels[k - 2 * -(-k // 4)] if k >= 2 else 0
        assert long[k]["level"] == long[k + 1]["level"] == levels[k]
    assert max(levels.values()) > 5
    for k in range(0, 2000, 2):
        (made,) = json.loads(long[k]["message"])["tool_calls"]
        assert made["valid"] == (not isinstance(json.loads(made["arguments"]).get("limit"), str))
    assert 300 < sum(r["n_valid"] for r in long) < 1000
    assert [found[2, k]["n_calls"] for k in (0, 1, None)] == [0, 0, 0]
    assert (found[3, 1]["n_linked"], found[3, 1]["level"], found[3, 2]["n_linked"]) == (1, 0, 1)


def test_parts_are_numbered_in_topological_order(spark):
    names = [("d", "$zz"), ("a", "$c"), ("c", "$b"), ("b", "x"), ("e", "x")]
    calls = "".join(call(n, "fetch", {"url": need}) for n, need in names)
    rows = [(1, 0, "assistant", calls), (1, 1, "tool", answer("a", 1) + answer("b", 2) + answer("none", 3) + answer("c", 4))]
    found = run(spark, rows)
    made = json.loads(found[1, 0][0]["message"])["tool_calls"]
    assert [c["id"] for c in made] == ["d", "a", "c", "b", "e"]
    assert [c["id"] for c in sorted(made, key=lambda c: c["order"])] == ["b", "e", "c", "a", "d"]
    results = json.loads(found[1, 1][0]["message"])["tool_results"]
    assert [r["id"] for r in sorted(results, key=lambda r: r["order"])] == ["b", "c", "a", "none"]


def plain_levels(needs):
    """Levels by repeated passes over all calls."""
    levels = dict.fromkeys(needs, -1)
    for _ in needs:
        for k, named in needs.items():
            below = [levels.get(n, -1) for n in named]
            levels[k] = -1 if -1 in below else 1 + max(below, default=-1)
    return levels


def levels_of(spark, conversations):
    rows = [(c, k, sorted(named)) for c, needs in conversations.items() for k, named in needs.items()]
    calls = spark.createDataFrame(rows, "_conv long, id string, needs array<string>")
    found = {(r["_conv"], r["id"]): r["level"] for r in chatformat.call_levels(calls).collect()}
    assert len(found) == len(rows)
    return found


def test_levels_equal_repeated_passes(spark):
    chance = random.Random(6)
    conversations = {}
    for c in range(40):
        names = [f"n{k}" for k in range(chance.randint(1, 25))]
        conversations[c] = needs = {}
        for k, n in enumerate(names):
            back = names[: k + (chance.random() < 0.04)] + ["gone"] * (chance.random() < 0.05)
            needs[n] = set(chance.sample(back, min(len(back), chance.choice([0, 1, 1, 1, 2, 3]))))
    conversations[50] = {"a": {"b"}, "b": {"a"}, "c": {"a"}, "d": {"c", "e"}, "e": set(), "f": {"f"}, "g": {"e"}}
    want = {(c, k): level for c, needs in conversations.items() for k, level in plain_levels(needs).items()}
    assert levels_of(spark, conversations) == want
    assert {-1, 0, 1, 5} <= set(want.values())


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    kept, rounds = chatformat.stored, []
    monkeypatch.setattr(chatformat, "stored", lambda df, name: rounds.append(name) or kept(df, name))
    chain = {f"n{k}": {f"n{k - 1}"} if k else set() for k in range(10_000)}
    found = levels_of(spark, {1: chain | {"top": {"n9999", "n3"}, "over": {"top"}}})
    assert all(found[1, f"n{k}"] == k for k in range(10_000))
    assert (found[1, "top"], found[1, "over"]) == (10_000, 10_001)
    assert len(rounds) < 25
