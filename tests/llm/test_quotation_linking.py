from matchpeaks.llm import quotation_linking as q

ASK = "How do I read the table with all its columns at once?"
ANSWER = "Use the reader of the library, it takes a list of names.\nAnd close the file when you are done with it."
ROWS = [
    (1, 0, "user", ASK),
    (1, 1, "assistant", f"On Monday Ann wrote:\n> {ASK}\n\n{ANSWER}"),
    (1, 2, "user", f"> > {ASK}\n> {ANSWER.splitlines()[1]}\nThanks, that was it."),
    (1, 3, "user", "Unrelated note."),
    (1, 4, "assistant", ">  how DO i read the TABLE\n> with all its columns at once?\nAsked before."),
    (2, 0, "user", f"> {ANSWER.splitlines()[0]}\nSeen elsewhere."),
    (2, 0, "user", f"> {ANSWER.splitlines()[0]}\nSeen elsewhere."),
    (2, 1, None, "> said by nobody in this table at all"),
    (2, 2, "user", None),
    (None, 0, "user", f"> {ASK}"),
    (3, None, "user", ASK),
    (3, 1, "user", ""),
]


def linked(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int, message string")
    return {(r["conv_id"], r["turn"]): r for r in q.link_quotations(df).collect()}


def test_threads(spark):
    found = linked(spark, ROWS)
    assert len(found) == 11
    assert [found[1, t]["reply_to_turn"] for t in range(5)] == [None, 0, 1, None, 0]
    assert [(found[1, t]["root_turn"], found[1, t]["depth"]) for t in range(5)] == [(0, 0), (0, 1), (0, 2), (3, 0), (0, 1)]
    assert found[1, 1]["text"] == ANSWER and found[1, 2]["text"] == "Thanks, that was it." and found[1, 0]["text"] == ASK
    assert found[1, 2]["max_level"] == 2 and found[1, 2]["n_quotes"] == 2 and found[1, 2]["n_linked"] == 2
    assert found[2, 0]["n_rows"] == 2 and found[2, 0]["n_elsewhere"] == 1 and found[2, 0]["reply_to_turn"] is None
    assert found[2, 1]["text"] == "" and found[2, 1]["n_linked"] == 0
    assert found[2, 2]["text"] == "" and found[None, 0]["text"] == "" and found[3, None]["text"] == ASK


def test_long_chains_and_empty_tables(spark):
    said = [f"This is what message number {i} has to say to all." for i in range(20)]
    rows = [(7, i, "user", (f"> {said[i - 1]}\n" if i else "") + said[i]) for i in range(20)]
    found = linked(spark, rows)
    assert [found[7, i]["depth"] for i in range(20)] == list(range(20)) and {r["root_turn"] for r in found.values()} == {0}
    assert linked(spark, []) == {}


def test_levels_against_plain_count(spark):
    lines = ["> a", ">> b", "> > c", "a > b", "", "\t>d", " >>> e", "&gt; f"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").select("line", q.level_of("line").alias("n"))
    assert {r["line"]: r["n"] for r in df.collect()} == dict(zip(lines, [1, 2, 2, 0, 0, 1, 3, 0]))


def test_only_built_in_functions(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string")
    plan = q.link_quotations(df)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_short_lines_are_linked_inside_their_conversation(spark):
    rows = [
        (1, 0, "user", "Shall I?\nYes, do it today\nBye"),
        (1, 1, "user", "> Yes, do it today\nDone."),
        (1, 2, "user", "> Shall I?\n> Bye\nWell."),
        (2, 0, "user", "> Shall I?\n> Bye\nNot from here."),
    ]
    found = linked(spark, rows)
    assert [found[1, t]["reply_to_turn"] for t in range(3)] == [None, 0, 0] and [found[1, t]["n_linked"] for t in range(3)] == [0, 1, 1]
    assert found[1, 2]["root_turn"] == 0 and found[2, 0]["n_linked"] == 0
