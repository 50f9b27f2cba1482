from helixframe.llm import preferences

TURNS = "array<struct<role:string,text:string>>"


def test_prefix_is_the_prompt_and_masks_cover_assistants(spark):
    a = [("user", "q"), ("assistant", "x"), ("user", "r"), ("assistant", "good")]
    b = [("user", "q"), ("assistant", "x"), ("user", "r"), ("assistant", "bad"), ("user", "why")]
    rows = [(1, a, b), (2, a, a), (3, None, b), (4, [], []), (5, a[:1], b), (5, a[:1], b)]
    df = spark.createDataFrame(rows, f"pair_id long, chosen {TURNS}, rejected {TURNS}")
    got = {r.pair_id: r for r in preferences.format_pairs(df).collect()}
    r = got[1]
    assert r.n_prompt_turns == 3 and r.usable
    assert r.prompt == "<|user|>\nq<|end|>\n<|assistant|>\nx<|end|>\n<|user|>\nr<|end|>\n"
    assert [r.chosen_text[m.start : m.end] for m in r.chosen_mask] == ["good<|end|>\n"]
    assert [r.rejected_text[m.start : m.end] for m in r.rejected_mask] == ["bad<|end|>\n"]
    assert got[2].n_prompt_turns == 4 and not got[2].usable and got[2].chosen_text == ""
    assert got[3].n_prompt_turns == 0 and got[3].prompt == "" and not got[3].usable
    assert got[4].n_prompt_turns == 0 and got[5].n_prompt_turns == 1


def test_turns_with_nulls_and_repeats(spark):
    df = spark.createDataFrame(
        [(1, 1, "assistant", "b"), (1, 0, None, "a"), (1, 0, "user", None), (1, 1, "assistant", "b"), (2, None, "user", "z")],
        "conv_id long, turn long, role string, text string",
    )
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in preferences.conversation_turns(df).collect()}
    assert got[1] == [("", "a"), ("user", ""), ("assistant", "b"), ("assistant", "b")] and got[2] == [("user", "z")]


def test_query_against_a_plain_loop(spark, sf):
    turns = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    convs = {k: [x[1:] for x in sorted(v)] for k, v in turns.items()}
    render = lambda ts: "".join(f"<|{a}|>\n{b}<|end|>\n" for a, b in ts)
    got = {r.pair_id: r for r in preferences.op7_preferences(spark, sf).collect()}
    assert set(got) == {k // 2 for k in convs}
    for pair, r in got.items():
        ids = sorted(k for k in convs if k // 2 == pair)
        chosen = convs[ids[0]]
        half = len(chosen) // 2
        rejected = chosen[:half] + (convs[ids[1]][half:] if len(ids) > 1 else [])
        n = 0
        while n < min(len(chosen), len(rejected)) and chosen[n] == rejected[n]:
            n += 1
        assert (r.n_prompt_turns, r.prompt, r.chosen_text, r.rejected_text) == (n, render(chosen[:n]), render(chosen[n:]), render(rejected[n:]))


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert preferences.format_pairs(preferences.derived_pairs(df)).count() == 0
