"""Chat rotation against a plain rendering, parts, defined cases."""

from collections import defaultdict

from pyspark.sql import functions as F

from feedloom.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def plain(rows):
    """{(conv, participant): (text, trained text)} rendered one turn after another."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append(((turn is not None, turn or 0), role or "unknown", text or ""))
    out = {}
    for conv, turns in convs.items():
        for me in {role for _, role, _ in turns}:
            text, trained = "", ""
            for _, role, said in sorted(turns):
                text += ("<|assistant|>\n" if role == me else f"<|user name={role}|>\n") + said + "<|end|>\n"
                trained += said + "<|end|>" if role == me else ""
            out[conv, me] = (text, trained)
    return out


def rendered(df, **kw):
    parts = defaultdict(list)
    for r in chat.rotate(df, **kw).collect():
        parts[r["conv_id"], r["participant"]].append(r)
    out = {}
    for key, rows in parts.items():
        rows.sort(key=lambda r: r["part"])
        text = "".join(r["text"] for r in rows)
        at = 0
        for r in rows:
            assert r["offset"] == at and r["n_chars"] == len(r["text"])
            at += len(r["text"])
        trained = "".join(r["text"][s["start"]:s["end"]] for r in rows for s in r["loss_spans"])
        out[key] = (text, trained)
    return out, parts


ROWS = [(1, 0, "ann", "hi"), (1, 1, "bob", "höllo"), (1, 2, "cy", ""), (1, 3, "ann", None), (1, 3, "ann", None),
        (None, 0, "ann", "x"), (None, None, None, "y" * 100_000), (2, 5, None, None), (2, 5, "b", "same"),
        (3, -2**63, "a", "low"), (3, 2**63 - 1, "b", "high")]


def test_against_plain_rendering(spark):
    df = spark.createDataFrame(ROWS, TURNS).withColumn("part", F.lit("own")).withColumn("_at", F.lit(0))
    assert rendered(df)[0] == plain(ROWS)


def test_on_the_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    assert rendered(df)[0] == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_a_long_dialogue_comes_in_parts(spark):
    rows = [(1, 10 * i, f"s{i % 3}", f"t{i}") for i in range(100)]
    got, parts = rendered(spark.createDataFrame(rows, TURNS), part_turns=10)
    assert got == plain(rows)
    assert max(r["n_turns"] for r in parts[1, "s0"]) <= 11 and len(parts[1, "s0"]) == 10


def test_tied_null_and_outlying_turns_are_cut_too(spark):
    rows = ([(None, i % 2, f"s{i % 3}", f"t{i % 7}") for i in range(100)] + [(None, None, "s0", "z" * 300 + str(i)) for i in range(30)]
            + [(1, i, "a", f"t{i}") for i in range(45)] + [(1, 10**12, "b", "far")] + [(2, 3, "a", "same")] * 25)
    got, parts = rendered(spark.createDataFrame(rows, TURNS).repartition(3), part_turns=10)
    assert got == plain(rows)
    assert all(r["n_turns"] <= 10 for ps in parts.values() for r in ps)
    assert {key: len(ps) for key, ps in parts.items() if key[1] != "s0"} == {
        (None, "s1"): 13, (None, "s2"): 13, (1, "a"): 5, (1, "b"): 5, (2, "a"): 3}


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], TURNS)).collect() == []


def test_sql_and_query_agree_on_a_long_dialogue(spark, tmp_path):
    import duckdb
    from feedloom.llm import queries
    rows = ([(1, i if i < 2500 else 10**9 + i % 7, f"s{i % 3}", f"t{i % 11}") for i in range(3000)]
            + [(2, None, "a", "same")] * 1500 + [(None, 0, None, None), (None, 1, "b", "x" * 300)])
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(queries.ORACLES["op4_chat_rotation"])
    got = queries.op4_chat_rotation(spark, str(tmp_path)).select(*want.columns)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
    assert sorted(r[3] for r in want.fetchall() if r[0] == 1 and r[1] == "s0") == [952, 1024, 1024]
